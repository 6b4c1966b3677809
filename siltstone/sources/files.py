"""Files of any Hadoop file system (local, s3a, gs) as fetched items."""

from __future__ import annotations

import re
from urllib.parse import quote

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions.globs import included
from siltstone.functions.text import base_name, extension

#: Content types by file ending.
CONTENT_TYPES = {"html": "text/html", "htm": "text/html", "md": "text/markdown", "markdown": "text/markdown", "txt": "text/plain", "json": "application/json"}
GENERIC = ("application/octet-stream", "binary/octet-stream")


def content_type(path: Column, header: Column | None = None) -> Column:
    """The given type unless it is generic, else by the ending."""
    known = F.create_map(*[F.lit(x) for pair in CONTENT_TYPES.items() for x in pair])[extension(path)]
    own = F.coalesce(known, F.lit(GENERIC[0]))
    if header is None:
        return own
    plain = F.nullif(F.trim(F.lower(header)), F.lit(""))
    return F.when(plain.isNull() | plain.isin(*GENERIC), own).otherwise(header)


@F.pandas_udf(T.StringType())
def encoded_path(paths: pd.Series) -> pd.Series:
    return paths.map(lambda path: quote(path, safe="/:@!$&'()*+,;=~-._"), na_action="ignore")


def file_items(spark: SparkSession, root: str, source_id: str, extensions: tuple[str, ...] | None = ("html", "htm"), include: list[str] | None = None, exclude: list[str] | None = None, max_files: int | None = None, base_url: str | None = None) -> DataFrame:
    """(source_id, canonical_url, title, content_type, body, size, modified): one read of the folder tree. Globs are
    matched against the path below root; empty files and folders are left out. With max_files the first by path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    marker = root.split("://", 1)[-1].strip("/")
    below = F.regexp_replace(F.col("path"), rf"^.*?{re.escape(marker)}/", "")
    files = files.withColumn("relative", below).filter("length > 0")
    if extensions:
        files = files.filter(F.lower(F.regexp_extract("relative", r"\.([^./]+)$", 1)).isin(*extensions))
    files = files.filter(included(F.col("relative"), include, exclude))
    if max_files is not None:
        files = files.orderBy("path").limit(max_files)
    url = F.concat(F.lit(base_url.rstrip("/") + "/"), encoded_path(F.col("relative"))) if base_url else F.col("path")
    return files.select(
        F.lit(source_id).alias("source_id"),
        url.alias("canonical_url"),
        base_name(F.col("relative")).alias("title"),
        content_type(F.col("relative")).alias("content_type"),
        F.decode("content", "UTF-8").alias("body"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def path_items(spark: SparkSession, paths: list[str], source_id: str) -> DataFrame:
    """Items of files named one by one, of any type, in their order (discovered); those that don't exist are not-found
    anomalies."""
    uri = [p if "://" in p or p.startswith("file:") else f"file://{p}" for p in paths]
    wanted = spark.createDataFrame([(u, i) for i, u in enumerate(dict.fromkeys(uri))], "path string, discovered long")
    config, jvm = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm
    there = [u for u in dict.fromkeys(uri) if (p := jvm.org.apache.hadoop.fs.Path(u)).getFileSystem(config).exists(p)]
    plain = lambda c: F.regexp_replace(c, r"^file:/+", "/")
    rows = None
    if there:
        read = spark.read.format("binaryFile").load(there).select(plain(F.col("path")).alias("key"), F.decode("content", "UTF-8").alias("body"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
        rows = wanted.withColumn("key", plain(F.col("path"))).join(read, "key", "left")
    else:
        rows = wanted.select("*", F.lit(None).cast("string").alias("body"), F.lit(None).cast("long").alias("size"), F.lit(None).cast("timestamp").alias("modified"))
    have = F.col("body").isNotNull()
    return rows.select(
        F.lit(source_id).alias("source_id"), F.col("path").alias("canonical_url"), base_name(F.col("path")).alias("title"), content_type(F.col("path")).alias("content_type"), "body", "size", "modified",
        F.when(have, "fetched").otherwise("error").alias("outcome"), F.when(~have, "not-found").alias("category"), F.lit(None).cast("string").alias("message"), "discovered",
    )

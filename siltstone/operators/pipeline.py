"""Fetched items to documents to chunks: one lazy chain whose outcome is a column, never an exception."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.operators.chunking import chunks_of
from siltstone.operators.html_blocks import extract
from siltstone.session import spread

BLOCK = "array<struct<type:string,text:string,heading_path:array<string>>>"
_BLOCK = pa.list_(pa.struct([("type", pa.string()), ("text", pa.string()), ("heading_path", pa.list_(pa.string()))]))
_CHUNK = pa.list_(pa.struct([("chunk_index", pa.int32()), ("chunk_count", pa.int32()), ("content", pa.string()), ("content_hash", pa.string()), ("estimated_tokens", pa.int32()), ("heading_path", pa.list_(pa.string()))]))
CHUNK = "array<struct<chunk_index:int,chunk_count:int,content:string,content_hash:string,estimated_tokens:int,heading_path:array<string>>>"


def _mapped(df: DataFrame, added: list[tuple[str, pa.DataType, str]], function) -> DataFrame:
    """df with columns from function(row) -> tuple; batches are cut so that long bodies don't pile up."""
    schema = f"{df._jdf.schema().toDDL()}, " + ", ".join(f"{n} {ddl}" for n, _, ddl in added)

    def run(batches):
        for batch in batches:
            step = max(1, min(1000, batch.num_rows * (8 << 20) // max(1, batch.nbytes)))
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                rows = [function(r) for r in part.to_pylist()]
                columns = [pa.array([r[i] for r in rows], type=t) for i, (_, t, _) in enumerate(added)]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, *[n for n, _, _ in added]])

    return df.mapInArrow(run, schema)


def documents(items: DataFrame, options: dict | None = None) -> DataFrame:
    """items (canonical_url, title, content_type, body and any others but blocks) with outcome, message, doc_title,
    html_locale, normalized_content, both hashes and new_blocks.

    outcome is `document`, `skipped` for items without text (empty_or_short_document true) or unsupported types, and
    `error` where extraction failed; one bad item never stops the others.
    """

    def one(row):
        try:
            found = extract(row["body"], row["content_type"], row["canonical_url"], row["title"], options)
        except Exception as problem:  # noqa: BLE001 - the failure is the item's outcome
            return ("error", f"{type(problem).__name__}: {problem}"[:1024], None, None, None, None, None, None, False)
        if found is None:
            return ("skipped", "unsupported content type", None, None, None, None, None, None, False)
        empty = not found["blocks"]
        return ("skipped" if empty else "document", "empty document" if empty else None, found["title"], found["html_locale"], found["normalized_content"], found["raw_content_hash"], found["normalized_content_hash"], found["blocks"], empty)

    text = pa.string()
    added = [(n, text, "string") for n in ("outcome", "message", "doc_title", "html_locale", "normalized_content", "raw_content_hash", "normalized_content_hash")]
    return _mapped(spread(items), [*added, ("new_blocks", _BLOCK, BLOCK), ("empty_or_short_document", pa.bool_(), "boolean")], one)


def chunks(docs: DataFrame, budget: int | None = None, blocks: str = "blocks") -> DataFrame:
    """A row for each chunk of each document; documents without text have none."""
    packed = _mapped(spread(docs), [("packed", _CHUNK, CHUNK)], lambda row: (chunks_of(row[blocks] or [], budget),))
    return packed.drop(blocks).withColumn("chunk", F.explode("packed")).drop("packed").select("*", "chunk.*").drop("chunk")


def source_counts(outcomes: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of outcomes per source in one pass."""
    count = lambda c: F.count_if(c)
    return outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("processed"),
        count(F.col("outcome") == "document").alias("document_count"),
        count(F.col("outcome") == "error").alias("error_count"),
        count(F.col("outcome") == "skipped").alias("skipped_count"),
        count(F.col("empty_or_short_document")).alias("empty_or_short_document_count"),
    )


def funnel(items: DataFrame, keys: list[str], external: str, url: str = "canonical_url") -> DataFrame:
    """Discovered items of each source, those unique by address, and those of them left after best of group by external
    id; items without an address or id all count."""
    rank = Window.partitionBy(*keys, url).orderBy(F.asc_nulls_first(external))
    first = F.col(url).isNull() | (F.row_number().over(rank) == 1)
    marked = items.withColumn("first", first)
    return marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("discovered"),
        F.count_if(F.col("first")).alias("unique"),
        (F.count_distinct(F.when(F.col("first"), F.col(external))) + F.count_if(F.col("first") & F.col(external).isNull())).alias("deduped"),
    )

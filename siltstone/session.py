"""Session factory and the two things every distributed operator needs: a table reader and a lineage cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "siltstone", cores: int | str = "*", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session with the settings the engine is written for; on a cluster pass master and sizes by spark-submit."""
    builder = (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or the context's checkpoint folder.

    Where the session names none, a folder below the warehouse is taken; a machine-local temporary one only for a local
    master, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
            spark.sparkContext.setCheckpointDir(named)
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="siltstone-checkpoints-")
    else:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_siltstone"
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder, so that it survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df written as compressed Parquet into the shared folder and read back; for tables that several branches read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/siltstone-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """A plain scan in at least as many partitions as there are cores, for work outside the JVM: a table of few files
    is placed anew, a large one stays as it is read. What isn't a plain scan stays as it is, since asking for its
    partitions would run it."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "MapIn" in plan:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_STORED: list[str] = []


def release(spark: SparkSession) -> int:
    """Delete the tables of stored() once their results have been read; returns how many there were."""
    hadoop, n = spark.sparkContext._jvm.org.apache.hadoop.fs, len(_STORED)
    while _STORED:
        path = hadoop.Path(_STORED.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n

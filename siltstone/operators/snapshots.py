"""What changed between full snapshots, by gaps and islands over key and row hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.session import stored

#: The states of a delivery that lists all documents of its index.
FULL_STATES = ("complete", "activated", "superseded")


def canonical_source(source: Column) -> Column:
    """No white space at the ends, lower case."""
    return F.lower(F.regexp_replace(source, r"(?U)^\s+|\s+$", ""))


def canonical_address(url: Column) -> Column:
    """No white space at the ends, no fragment, scheme and host in lower case; path and query keep their case."""
    bare = F.regexp_replace(F.regexp_replace(url, r"(?U)^\s+|\s+$", ""), r"(?s)#.*$", "")
    head = F.regexp_extract(bare, r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*://[^/?]*)", 1)
    return F.concat(F.lower(head), F.substr(bare, F.length(head) + F.lit(1)))


def full_deliveries(runs: DataFrame) -> DataFrame:
    """(series, run_id, seq, last_seq): full deliveries of each index numbered from 1 by started_at, ties by id.

    Exact duplicate rows of runs count once. A run without id, index or start can't be placed and is left out.
    """
    full = (
        runs.filter(F.col("finished_at").isNotNull() & F.col("lifecycle_status").isin(*FULL_STATES))
        .select(F.col("index_name").alias("series"), F.col("id").alias("run_id"), "started_at")
        .filter(F.col("series").isNotNull() & F.col("run_id").isNotNull() & F.col("started_at").isNotNull())
        .distinct()
    )
    order = Window.partitionBy("series").orderBy("started_at", "run_id")
    return full.select(
        "series",
        "run_id",
        F.row_number().over(order).alias("seq"),
        F.count(F.lit(1)).over(Window.partitionBy("series")).cast("int").alias("last_seq"),
    )


def validity_intervals(rows: DataFrame) -> DataFrame:
    """(series, source_id, canonical_url, row_hash, last_seq, from_seq, to_seq): the longest stretches of consecutive
    snapshots that list a record with one hash.

    rows: series, source_id, canonical_url, seq, last_seq, row_hash, created_at, id, in any number and order per
    snapshot. Of several rows of a record in one snapshot the latest created_at holds (ties: greater hash, then id).
    Windows and aggregation share one hash partitioning by record, so there is one shuffle; a group holds one
    record's history and never a whole source.
    """
    record = ("series", "source_id", "canonical_url")
    latest = Window.partitionBy(*record, "seq").orderBy(
        F.col("created_at").desc_nulls_last(), F.col("row_hash").desc_nulls_last(), F.col("id").desc_nulls_last()
    )
    history = Window.partitionBy(*record).orderBy("seq")
    placed = rows.repartition(*record)
    one = placed.withColumn("rank", F.row_number().over(latest)).filter("rank = 1")
    starts = one.withColumn("before", F.lag(F.struct("seq", "row_hash")).over(history)).withColumn(
        "starts",
        F.when(
            F.col("before").isNotNull()
            & (F.col("before.seq") == F.col("seq") - 1)
            & F.col("before.row_hash").eqNullSafe(F.col("row_hash")),
            0,
        ).otherwise(1),
    )
    islands = starts.withColumn("island", F.sum("starts").over(history.rowsBetween(Window.unboundedPreceding, 0)))
    return islands.groupBy(*record, "last_seq", "island", "row_hash").agg(
        F.min("seq").alias("from_seq"), F.max("seq").alias("to_seq")
    )


def change_events(intervals: DataFrame) -> DataFrame:
    """(series, seq, change_type, source_id, canonical_url, row_hash) from starts, ends and adjacency of intervals.

    An interval that starts right after another of its record is a change; one that starts otherwise, beyond the
    first snapshot, is an addition; one that ends before the last snapshot without a successor right after it is a
    removal in the snapshot after its end. row_hash is that of the added, changed or removed state.
    """
    history = Window.partitionBy("series", "source_id", "canonical_url").orderBy("from_seq")
    beside = intervals.withColumn("prior_to", F.lag("to_seq").over(history)).withColumn(
        "next_from", F.lead("from_seq").over(history)
    )
    adjoins = F.coalesce(F.col("prior_to") == F.col("from_seq") - 1, F.lit(False))
    followed = F.coalesce(F.col("next_from") == F.col("to_seq") + 1, F.lit(False))
    start = F.when(
        F.col("from_seq") > 1,
        F.struct(
            F.col("from_seq").alias("seq"), F.when(adjoins, F.lit("changed")).otherwise(F.lit("added")).alias("change_type")
        ),
    )
    end = F.when(
        (F.col("to_seq") < F.col("last_seq")) & ~followed,
        F.struct((F.col("to_seq") + 1).alias("seq"), F.lit("removed").alias("change_type")),
    )
    return (
        beside.withColumn("event", F.explode(F.filter(F.array(start, end), lambda e: e.isNotNull())))
        .select("series", "event.seq", "event.change_type", "source_id", "canonical_url", "row_hash")
    )


def snapshot_changes(records: DataFrame, runs: DataFrame) -> DataFrame:
    """(run_id, change_type, source_id, canonical_url, previous_url): added, removed, changed and moved records of
    every full delivery against the one before it.

    Nulls: a missing hash equals only a missing hash and never makes a move; null source or address is an identity of
    its own. Empty tables give no rows; extra columns are ignored. moved holds every pair of an added and a removed
    record of one step with equal hashes; the join is an equi-join that adaptive execution splits where one hash is
    frequent, so no group is gathered in one task. The events, a small part of the input, are written to the shared
    folder once, so that additions and removals are not derived again for the moves.
    """
    deliveries = full_deliveries(runs)
    rows = records.select(
        F.col("run_id"),
        canonical_source(F.col("source_id")).alias("source_id"),
        canonical_address(F.col("canonical_url")).alias("canonical_url"),
        F.lower("normalized_content_hash").alias("row_hash"),
        "created_at",
        "id",
    ).join(deliveries, "run_id")
    events = change_events(validity_intervals(rows))
    named = stored(events.join(deliveries.select("series", "seq", "run_id"), ["series", "seq"]))
    plain = named.select("run_id", "change_type", "source_id", "canonical_url", F.lit("").alias("previous_url"))
    added = named.filter("change_type = 'added' and row_hash is not null").select(
        "run_id", "row_hash", "source_id", "canonical_url"
    )
    removed = named.filter("change_type = 'removed' and row_hash is not null").select(
        "run_id", "row_hash", F.col("canonical_url").alias("previous_url")
    )
    moved = added.join(removed, ["run_id", "row_hash"]).select(
        "run_id", F.lit("moved").alias("change_type"), "source_id", "canonical_url", "previous_url"
    )
    return plain.unionByName(moved.distinct())

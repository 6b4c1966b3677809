"""Streaming forms: an event log by time window, keep-first by address, and incremental embedding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _marked(events: DataFrame, at: str, late: str) -> DataFrame:
    """A stream with its watermark, on a time of the kind that watermarks need; tables stay as they are."""
    return events.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late) if events.isStreaming else events


def windowed_counts(events: DataFrame, at: str = "ts", kind: str = "event_type", value: str = "value", width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and sums of events by window and type; rows later than the watermark are dropped by a stream."""
    events = _marked(events, at, late)
    return events.groupBy(F.window(at, width).alias("w"), kind).agg(F.count(F.lit(1)).alias("events"), F.sum(value).alias("total")).select(F.col("w.start").alias("from"), F.col("w.end").alias("to"), kind, "events", "total")


def first_seen(items: DataFrame, at: str, url: str = "canonical_url", late: str = "1 day") -> DataFrame:
    """The first item of each address within the watermark."""
    if items.isStreaming:
        return _marked(items, at, late).dropDuplicatesWithinWatermark([url])
    return items.dropDuplicates([url])


def spaced_starts(requests: DataFrame, host: str, at: str, tie: str, seconds: float) -> DataFrame:
    """requests with `waited`, the microseconds each has to wait so that the starts of a host lie `seconds` apart, first
    come first served. Start n is the latest of (arrival j + (n - j) spacings) over all j up to n, which a running
    maximum gives without going from one to the next."""
    gap = F.lit(int(seconds * 1_000_000)).cast("long")
    order = Window.partitionBy(host).orderBy(at, tie)
    arrival, n = F.unix_micros(F.col(at).cast("timestamp")), F.row_number().over(order)
    placed = requests.withColumns({"arrival": arrival, "nth": n})
    latest = F.max(F.col("arrival") - F.col("nth") * gap).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("waited", latest + F.col("nth") * gap - F.col("arrival")).drop("arrival", "nth")


def on_each_batch(items: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str):
    """Work through what has arrived and stop; the checkpoint folder makes a repeated call continue after it."""
    return items.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sessions(events: DataFrame, at: str = "ts", user: str = "user_id", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user by gap: start, end and events."""
    events = _marked(events, at, late)
    return events.groupBy(F.session_window(at, gap).alias("s"), user).agg(F.count(F.lit(1)).alias("events")).select(user, F.col("s.start").alias("from"), F.col("s.end").alias("to"), "events")

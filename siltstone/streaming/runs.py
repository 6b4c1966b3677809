"""Runs that stand still, from a stream of their events, with state for each run."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

UNFINISHED = ("created", "crawling", "embedding", "verifying")


def stale_runs(events: DataFrame, minutes: int = 360, run: str = "run_id", state: str = "state", at: str = "at", late: str = "10 minutes") -> DataFrame:
    """(run_id, state, since): runs whose last event left them unfinished for `minutes` of event time. A later event of
    the same run starts its time anew; finished runs keep no state."""
    limit = minutes * 60_000

    def step(key: tuple, frames: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            last, since = held.get
            held.remove()
            yield pd.DataFrame({"run_id": [key[0]], "state": [last], "since": [pd.Timestamp(since, unit="ms")]})
            return
        last, since = held.get if held.exists else (None, -1)
        for frame in frames:
            for row in frame.itertuples():
                moment = int(row.at.timestamp() * 1000)
                if moment >= since:
                    last, since = row.state, moment
        if last in UNFINISHED:
            held.update((last, since))
            held.setTimeoutTimestamp(max(since + limit, held.getCurrentWatermarkMs() + 1))
        elif held.exists:
            held.remove()

    shaped = events.select(F.col(run).cast("string").alias("run_id"), F.col(state).alias("state"), F.col(at).cast("timestamp").alias("at"))
    return shaped.withWatermark("at", late).groupBy("run_id").applyInPandasWithState(step, "run_id string, state string, since timestamp", "state string, since long", "append", GroupStateTimeout.EventTimeTimeout)

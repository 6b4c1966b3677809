"""Small helpers around mapInArrow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Rows and characters that a Python worker holds at once; longer texts come in batches of one row.
SLICE_ROWS = 2000
SLICE_BYTES = 16 << 20


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most SLICE_ROWS rows and about SLICE_BYTES bytes; a longer row comes alone."""
    rows = batch.num_rows
    if not rows:
        return
    step = max(1, min(SLICE_ROWS, rows * SLICE_BYTES // max(1, batch.nbytes)))
    for start in range(0, rows, step):
        yield batch.slice(start, step)


def map_arrow(df: DataFrame, schema: str, function: Callable[[pa.RecordBatch], dict | None], fields: pa.Schema) -> DataFrame:
    """df through function, which turns a slice of rows into a dict of columns; schema and fields describe the same columns."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                columns = function(part)
                if columns:
                    yield pa.RecordBatch.from_pydict(columns, schema=fields)

    return df.mapInArrow(run, schema)

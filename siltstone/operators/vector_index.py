"""An inverted file of vectors: cells around centroids, of which a search reads only the nearest.

Centroids are fitted on a bounded sample by spherical k-means; every row is put into the cell of its nearest centroid,
and rows are written in the order of their cells, so that the filter on cells reaches the row groups of the files. A cell
also knows the widest angle of its rows, by which an exact search tells which cells can hold anything better.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.operators import search
from siltstone.session import stored

#: Rows the centroids are fitted on, the most cells, and the share of cells that a search reads.
SAMPLE_ROWS, MOST_CELLS, PROBED = 32_768, 4096, 0.25
CENTROIDS = "cell int, centroid array<float>, angle double"


def is_usable(vector: str, size: int) -> Column:
    """`size` finite values that aren't all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(column: pa.Array, size: int) -> np.ndarray:
    values = np.asarray(column.flatten(), dtype=np.float32).reshape(-1, size)
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def fitted(sample: np.ndarray, cells: int, rounds: int = 8, seed: int = 11) -> np.ndarray:
    """Unit centroids of unit vectors; a cell that loses all its vectors keeps its centroid."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([(sample[a : a + 4096] @ centroids.T).argmax(axis=1) for a in range(0, len(sample), 4096)])
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(norm > 0, sums / np.maximum(norm, 1e-12), centroids)
    return centroids


def built(rows: DataFrame, size: int, key: str = "chunk_id", vector: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(rows with their cell, in the order of cells; cell and centroid). All rows stay, those without a usable vector have
    no cell; the fit reads at most about SAMPLE_ROWS. Without any usable vector there are no centroids."""
    spark = rows.sparkSession
    fit = rows.filter(is_usable(vector, size))
    total = fit.count()
    cells = max(1, min(MOST_CELLS, round(math.sqrt(total))))
    share = math.ceil(1_000_000 * min(1.0, SAMPLE_ROWS / max(1, total)))
    drawn = fit.filter(F.pmod(F.xxhash64(key), F.lit(1_000_000)) < share).select(F.col(vector).cast("array<float>").alias("v")).toArrow()
    if not drawn.num_rows:
        return rows.withColumn("cell", F.lit(None).cast("int")), spark.createDataFrame([], CENTROIDS)
    centroids = fitted(unit_rows(drawn.column("v").combine_chunks(), size), cells)

    def place(batches):
        for batch in batches:
            at, angle = np.full(batch.num_rows, -1, dtype=np.int32), np.zeros(batch.num_rows)
            good = np.flatnonzero(batch.column("usable").to_numpy(zero_copy_only=False))
            if len(good):
                vectors = batch.column(vector).take(pa.array(good)).cast(pa.list_(pa.float32()))
                similar = unit_rows(vectors, size) @ centroids.T
                at[good] = similar.argmax(axis=1)
                angle[good] = np.arccos(np.clip(similar.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(at, mask=at < 0), pa.array(angle)], names=[*batch.schema.names[:-1], "cell", "angle"])

    fields = [*rows.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())]
    placed = stored(rows.withColumn("usable", is_usable(vector, size)).mapInArrow(place, T.StructType(fields)))
    widest = {r["cell"]: r["angle"] for r in placed.filter("cell is not null").groupBy("cell").agg(F.max("angle").alias("angle")).collect()}
    table = spark.createDataFrame([(i, c.tolist(), float(widest[i])) for i, c in enumerate(centroids) if i in widest], CENTROIDS)
    return placed.drop("angle").repartitionByRange("cell", key).sortWithinPartitions("cell", key), table


def bounds(centroids: DataFrame, query: list[float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cells, cosine of their centroids, the greatest cosine that one of their rows can have), nearest first."""
    rows = centroids.toArrow()  # at most MOST_CELLS
    if not rows.num_rows or not any(query):
        return (np.zeros(0, dtype=int),) * 3
    at = np.asarray(query, dtype=np.float64)
    similar = unit_rows(rows.column("centroid").combine_chunks(), len(query)) @ (at / np.linalg.norm(at))
    reach = np.cos(np.maximum(np.arccos(np.clip(similar, -1, 1)) - rows.column("angle").to_numpy() - 1e-3, 0.0))
    order = np.argsort(-similar, kind="stable")
    return rows.column("cell").to_numpy()[order], similar[order], reach[order]


def top_k(indexed: DataFrame, centroids: DataFrame, query: list[float], k: int = search.DEFAULT_LIMIT, probes: int | None = None, exact: bool = False) -> DataFrame:
    """search.top_k() over the nearest cells: PROBED of them, or `probes`. With exact, over those too that can hold a row
    as near as the k-th found there, so that none is missed."""
    cells, _, reach = bounds(centroids, query)
    many = probes if probes is not None else max(1, math.ceil(PROBED * len(cells)))
    near = cells[:many]
    if exact and len(cells) > many:
        found = search.top_k(indexed.filter(F.col("cell").isin(near.tolist())), query, k).select("score").collect()  # k rows
        near = cells if len(found) < k else np.union1d(near, cells[reach >= found[-1]["score"]])
    return search.top_k(indexed.filter(F.col("cell").isin(near.tolist())), query, k)

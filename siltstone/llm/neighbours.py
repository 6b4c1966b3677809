"""The k most similar vectors of every vector.

Unit vectors are projected by m Gaussian (2-stable) directions: the squared distance of two projections over the
squared distance of the vectors follows a chi-square law with m degrees of freedom. A kd-tree over the projections of a
bounded sample gives leaves; every row is put into a leaf and the boxes of the leaves are taken from all rows. Rows of
neighbouring leaves form a block, and blocks form areas. A block first searches itself; it then asks for the leaves that
its rows leave open, and the areas with rows that ask or are asked for meet in pairs, each pair once for both sides.
There a row takes the leaves by rising projected distance and leaves the search when even a vector as near as its k-th
best so far would, with probability `sure`, have shown up at a smaller projected distance (the chi-square stopping test).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_arrow
from siltstone.session import stored

#: Rows of an area, least number of areas where there are as many blocks, and rows of the next leaves that are searched
#: between two tests.
AREA_ROWS, AREAS, STEP_ROWS = 65_536, 5, 1024


def chi_square_quantile(probability: float, degrees: int) -> float:
    """Where the chi-square law of an even number of degrees reaches a probability."""
    low, high = 0.0, 1000.0
    for _ in range(80):
        mid = (low + high) / 2
        rest = math.exp(-mid / 2) * sum((mid / 2) ** k / math.factorial(k) for k in range(degrees // 2))
        low, high = (mid, high) if 1 - rest < probability else (low, mid)
    return high


def directions(size: int, degrees: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((size, degrees))


def unit(values: np.ndarray) -> np.ndarray:
    wide = values.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.linalg.norm(wide, axis=1, keepdims=True)


class Tree:
    """A kd-tree as arrays; leaves are numbered from left to right, so that neighbours in number are near."""

    def __init__(self, points: np.ndarray, leaves: int):
        self.axis, self.cut, self.left, self.right = [], [], [], []
        self.leaves = 0
        self.grow(points, leaves)
        self.arrays = tuple(np.array(x) for x in (self.axis, self.cut, self.left, self.right))

    def grow(self, points: np.ndarray, leaves: int) -> int:
        node = len(self.axis)
        for column in (self.axis, self.cut, self.left, self.right):
            column.append(-1)
        spread = points.max(axis=0) - points.min(axis=0) if len(points) else np.zeros(1)
        if leaves > 1 and len(points) > 1 and spread.max() > 0:
            axis = int(spread.argmax())
            half = leaves // 2
            cut = float(np.quantile(points[:, axis], half / leaves))
            below = points[:, axis] <= cut
            if below.any() and not below.all():
                self.axis[node], self.cut[node] = axis, cut
                self.left[node] = self.grow(points[below], half)
                self.right[node] = self.grow(points[~below], leaves - half)
                return node
        self.left[node] = self.leaves
        self.leaves += 1
        return node

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        axis, cut, left, right = self.arrays
        node = np.zeros(len(points), dtype=np.int64)
        rows = np.arange(len(points))
        while len(rows):
            at = node[rows]
            rows, at = rows[axis[at] >= 0], at[axis[at] >= 0]
            below = points[rows, axis[at]] <= cut[at]
            node[rows] = np.where(below, left[at], right[at])
        return left[node]


def box_distance(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance from each point to each box."""
    out = np.zeros((len(points), len(low)), dtype=points.dtype)
    for d in range(points.shape[1]):
        x = points[:, d, None]
        gap = np.maximum(np.maximum(low[None, :, d] - x, x - high[None, :, d]), 0.0)
        out += gap * gap
    return out


def merge_best(best_s, best_i, found_s, found_i, k):
    """The k best of two lists for each row: greater similarity first, ties to the smaller id, each id once."""
    s, i = np.hstack([best_s, found_s]), np.hstack([best_i, found_i])
    by_id = np.argsort(i, axis=1, kind="stable")
    twin = np.zeros(i.shape, dtype=bool)
    sorted_i = np.take_along_axis(i, by_id, axis=1)
    np.put_along_axis(twin, by_id[:, 1:], sorted_i[:, 1:] == sorted_i[:, :-1], axis=1)
    s, i = np.where(twin, -9.0, s), np.where(twin, -1, i)
    order = np.lexsort((i, -s), axis=1)[:, :k]
    return np.take_along_axis(s, order, axis=1), np.take_along_axis(i, order, axis=1)


def add_best(best_s: np.ndarray, best_i: np.ndarray, rows: np.ndarray, s: np.ndarray, i: np.ndarray, k: int) -> None:
    """Put candidates (row, similarity, id) among the k best of their rows, in place; an id counts once."""
    some = np.unique(rows)
    every = np.concatenate([np.repeat(some, k), rows])
    s, i = np.concatenate([best_s[some].ravel(), s]), np.concatenate([best_i[some].ravel(), i])
    order = np.lexsort((-s, i, every))
    every, s, i = every[order], s[order], i[order]
    fresh = np.ones(len(every), dtype=bool)
    fresh[1:] = (every[1:] != every[:-1]) | (i[1:] != i[:-1]) | (i[1:] < 0)
    every, s, i = every[fresh], s[fresh], i[fresh]
    order = np.lexsort((i, -s, every))
    every, s, i = every[order], s[order], i[order]
    start = np.searchsorted(every, some)
    place = np.arange(len(every)) - np.repeat(start, np.diff(np.append(start, len(every))))
    keep = place < k
    best_s[every[keep], place[keep]], best_i[every[keep], place[keep]] = s[keep], i[keep]


def best_of(similar: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best columns of each row with their ids; all columns as good as the k-th are weighed, so ties are exact."""
    width = similar.shape[1]
    if width > k:
        limit = np.partition(similar, width - k, axis=1)[:, width - k]
        most = int((similar >= limit[:, None]).sum(axis=1).max())
        if most == k:
            at = np.argpartition(-similar, k - 1, axis=1)[:, :k]
        else:
            order = np.lexsort((np.broadcast_to(ids, similar.shape), -similar), axis=1)
            at = order[:, :k]
    else:
        at = np.broadcast_to(np.arange(width), similar.shape)
    return np.take_along_axis(similar, at, axis=1), ids[at]


def vectors_of(column: pa.ChunkedArray, size: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten(), dtype=np.float32).reshape(-1, size)


def usable(rows: DataFrame, size: int = 64, key: str = "chunk_id", same: str = "content_hash", vector: str = "embedding") -> DataFrame:
    """(id, vec): rows with exactly `size` finite values that aren't all zero; of the rows with one value of `same`
    that with the smallest key. Rows without a value of `same` stand for themselves; rows without a key are left out."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fit = rows.filter((F.size(vector) == size) & finite & F.exists(vector, lambda x: x != 0) & F.col(key).isNotNull())
    one = F.coalesce(F.col(same), F.concat(F.lit("\u0000"), F.col(key).cast("string")))
    fit = fit.select(one.alias("same"), F.col(key).cast("long").alias("id"), F.col(vector).cast("array<float>").alias("vec"))
    rank = Window.partitionBy("same").orderBy("id")
    return fit.withColumn("n", F.row_number().over(rank)).filter("n = 1").select("id", "vec")


def neighbours(
    points: DataFrame,
    k: int = 5,
    size: int = 64,
    least: float = -1.0,
    degrees: int = 8,
    sure: float = 0.97,
    leaf_rows: int = 64,
    max_leaves: int = 16_384,
    sample_rows: int = 65_536,
    block_rows: int = 4096,
) -> DataFrame:
    """(id, near, cosine): for every row of (id, vec) its k most similar other rows with a cosine of `least` or more.

    Equal vectors: only the k + 1 smallest ids of a group are searched, since no other can be among anyone's k best
    with ties to the smaller id; the others get the k smallest of their group. The tree is fitted on at most
    sample_rows rows, all rows are indexed; a leaf of many rows is split over blocks and areas, which are bounded in
    rows. Fewer than k other rows give fewer; an empty table gives none.
    """
    spark = points.sparkSession
    ranked = Window.partitionBy("vec").orderBy("id")
    points = stored(points)
    first = stored(points.withColumn("n", F.row_number().over(ranked)).filter(F.col("n") <= k + 1))
    total = first.count()
    if not total:
        return spark.createDataFrame([], "id long, near long, cosine double")
    few = first.filter(F.col("n") <= k).groupBy("vec").agg(F.collect_list("id").alias("near"))
    rest = (
        points.join(first.select("id"), "id", "left_anti").join(few, "vec").select("id", F.explode("near").alias("near"), F.lit(1.0).alias("cosine"))
        if points.count() > total
        else None
    )
    base = directions(size, degrees)
    fraction = min(1.0, sample_rows / total)
    drawn = first.select("id", "vec") if fraction == 1.0 else first.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * fraction)).select("id", "vec")

    def project(batch: pa.RecordBatch) -> dict:
        flat = (unit(vectors_of(batch.column(1), size)) @ base).astype(np.float32)
        return {"p": pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, degrees), type=pa.int32()), pa.array(flat.ravel()))}

    sample = map_arrow(drawn, "p array<float>", project, pa.schema([("p", pa.list_(pa.float32()))])).toArrow()
    tree = Tree(vectors_of(sample.column("p"), degrees).astype(np.float64), max(1, min(max_leaves, total // leaf_rows)))

    def place(batch: pa.RecordBatch) -> dict:
        flat = (unit(vectors_of(batch.column(1), size)) @ base).astype(np.float32).astype(np.float64)
        return {"id": batch.column(0), "vec": batch.column(1), "leaf": tree.leaf_of(flat)} | {f"p{d}": flat[:, d] for d in range(degrees)}

    fields = [("id", pa.int64()), ("vec", pa.list_(pa.float32())), ("leaf", pa.int32()), *[(f"p{d}", pa.float64()) for d in range(degrees)]]
    schema = "id long, vec array<float>, leaf int, " + ", ".join(f"p{d} double" for d in range(degrees))
    placed = stored(map_arrow(first.select("id", "vec"), schema, place, pa.schema(fields)))
    boxes = placed.groupBy("leaf").agg(*[f(f"p{d}").alias(f"{n}{d}") for n, f in (("a", F.min), ("z", F.max)) for d in range(degrees)], F.count(F.lit(1)).alias("rows")).orderBy("leaf").toPandas()
    leaf_no = boxes["leaf"].to_numpy()
    low, high = (boxes[[f"{n}{d}" for d in range(degrees)]].to_numpy() for n in "az")
    widest = chi_square_quantile(sure, degrees)
    farthest = 2.0 - 2.0 * least

    # a leaf begins where the rows of the leaves before it end; its rows are spread over the blocks it reaches into
    rows = boxes["rows"].to_numpy()
    before = np.cumsum(rows) - rows
    in_block = max(1, min(block_rows, max(512, -(-total // 12))))
    in_area = -(-max(in_block, min(AREA_ROWS, -(-total // AREAS))) // in_block) * in_block
    reaches = (before + rows - 1) // in_block - before // in_block + 1
    whole = reaches == 1
    shares = spark.createDataFrame(list(zip(leaf_no.tolist(), (before // in_block).tolist(), reaches.tolist())), "leaf int, begin long, reaches long")
    in_leaf = F.col("begin") + F.pmod(F.xxhash64("id"), F.col("reaches"))
    blocks = placed.join(shares, "leaf").withColumn("block", in_leaf.cast("int")).withColumn("area", (in_leaf * in_block / in_area).cast("int")).drop("begin", "reaches")

    def reach(worst: np.ndarray) -> np.ndarray:
        return widest * np.minimum(np.maximum(2.0 - 2.0 * worst, 1e-9), farthest)

    def against(ids, vecs, best_s, best_i, data_ids, data_vecs):
        narrow, data_narrow = vecs.astype(np.float32), data_vecs.astype(np.float32)
        for a in range(0, len(ids), 512):
            for b in range(0, len(data_ids), 8192):
                bound = np.maximum(best_s[a : a + 512, -1], least) - 1e-5
                if bound.min() > -1.0:
                    # single precision finds what can be among the best, double precision says what it is worth
                    hit = narrow[a : a + 512] @ data_narrow[b : b + 8192].T >= bound.astype(np.float32)[:, None]
                    r, c = np.divmod(np.flatnonzero(hit), hit.shape[1])
                    other = ids[a + r] != data_ids[b + c]
                    r, c = r[other], c[other]
                    if len(r):
                        exact = np.einsum("ij,ij->i", vecs[a + r], data_vecs[b + c])
                        add_best(best_s, best_i, a + r, exact, data_ids[b + c], k)
                    continue
                similar = vecs[a : a + 512] @ data_vecs[b : b + 8192].T
                similar[ids[a : a + 512, None] == data_ids[None, b : b + 8192]] = -9.0
                found = best_of(similar, data_ids[b : b + 8192], k)
                s, i = merge_best(best_s[a : a + 512], best_i[a : a + 512], found[0], np.where(found[0] < -8, -1, found[1]), k)
                best_s[a : a + 512], best_i[a : a + 512] = s, i

    own_schema = "block int, area int, leaf int, id long, vec array<float>, near array<long>, cosine array<double>, asks array<int>"
    own_fields = pa.schema([("block", pa.int32()), ("area", pa.int32()), ("leaf", pa.int32()), ("id", pa.int64()), ("vec", pa.list_(pa.float32())), ("near", pa.list_(pa.int64())), ("cosine", pa.list_(pa.float64())), ("asks", pa.list_(pa.int32()))])

    def inside(table: pa.Table) -> pa.Table:
        """The block's rows among themselves; its first row holds the leaves reaching elsewhere that the stopping test
        leaves open for any of its rows."""
        ids = table.column("id").to_numpy()
        vecs = unit(vectors_of(table.column("vec"), size))
        at = np.stack([table.column(f"p{d}").to_numpy() for d in range(degrees)], axis=1)
        n = len(ids)
        best_s, best_i = np.full((n, k), -9.0), np.full((n, k), -1, dtype=np.int64)
        against(ids, vecs, best_s, best_i, ids, vecs)
        open_ = np.zeros(len(leaf_no), dtype=bool)
        elsewhere = np.flatnonzero(~(whole & np.isin(leaf_no, table.column("leaf").to_numpy())))
        for a in range(0, n, 256):
            some = elsewhere[~open_[elsewhere]]
            if len(some):
                open_[some] = (box_distance(at[a : a + 256], low[some], high[some]) <= reach(best_s[a : a + 256, -1])[:, None]).any(axis=0)
        ends = pa.array(np.arange(0, n * k + 1, k), type=pa.int32())
        near, cosine = (pa.ListArray.from_arrays(ends, pa.array(x.ravel())) for x in (best_i, best_s))
        asks = pa.array([leaf_no[open_].tolist()] + [None] * (n - 1), type=pa.list_(pa.int32()))
        return pa.table([*(table.column(c) for c in ("block", "area", "leaf", "id", "vec")), near, cosine, asks], schema=own_fields)

    own = stored(blocks.groupBy("block").applyInArrow(inside, own_schema))
    asked = own.filter("asks is not null").select("block", "area", F.explode("asks").alias("leaf"))
    places = own.select("leaf", "block", "area").distinct()
    met = stored(asked.join(places.select("leaf", F.col("area").alias("other")).distinct(), "leaf"))
    # a place goes to the areas that ask for its leaf and to those its own block asks
    goes = places.join(met.select("leaf", F.col("other").alias("area"), F.col("area").alias("other")).distinct(), ["leaf", "area"]).unionByName(
        places.join(met.select("block", "other").distinct(), "block")
    )
    sent = own.join(goes.distinct(), ["leaf", "block", "area"]).select(
        F.least("area", "other").alias("left_area"), F.greatest("area", "other").alias("right_area"), "area", "leaf", "id", "vec", "near", "cosine"
    )
    out_fields = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("cosine", pa.float64())])

    def towards(mine: dict, data: dict) -> tuple:
        """The rows of one side against those of the other, by rising projected distance of the leaves."""
        ids, vecs, best_s, best_i = mine["ids"], mine["vecs"], mine["best_s"].copy(), mine["best_i"].copy()
        for a in range(0, len(ids), 512):
            q = slice(a, a + 512)
            far = box_distance(mine["at"][q], data["low"], data["high"])
            nearest = np.argsort(far.mean(axis=0), kind="stable")
            steps = np.cumsum((data["end"] - data["begin"])[nearest]) // STEP_ROWS
            for some in np.split(nearest, np.flatnonzero(np.diff(steps)) + 1):
                live = a + np.flatnonzero(far[:, some].min(axis=1) <= reach(best_s[q, -1]))
                if len(live):
                    rows = np.concatenate([np.arange(data["begin"][j], data["end"][j]) for j in some])
                    s, i = best_s[live], best_i[live]
                    against(ids[live], vecs[live], s, i, data["ids"][rows], data["vecs"][rows])
                    best_s[live], best_i[live] = s, i
        fresh = (best_i >= 0) & (best_s >= least) & ~(best_i[:, :, None] == mine["best_i"][:, None, :]).any(axis=2)
        return np.repeat(ids, fresh.sum(axis=1)), best_i[fresh], best_s[fresh]

    def outside(table: pa.Table) -> pa.Table:
        """Two areas, or one area and itself."""
        areas, leaves = table.column("area").to_numpy(), table.column("leaf").to_numpy()
        order = np.lexsort((leaves, areas))
        every = {"ids": table.column("id").to_numpy(), "vecs": unit(vectors_of(table.column("vec"), size))}
        for name, column in (("best_s", "cosine"), ("best_i", "near")):
            every[name] = np.asarray(table.column(column).combine_chunks().flatten()).reshape(-1, k)
        every["at"] = (every["vecs"] @ base).astype(np.float32)
        sides = []
        for area in np.unique(areas):
            rows = order[areas[order] == area]
            side = {name: column[rows] for name, column in every.items()}
            which, begin = np.unique(leaves[rows], return_index=True)
            sides.append(side | {"begin": begin, "end": np.append(begin[1:], len(rows))} | {name: box[np.searchsorted(leaf_no, which)].astype(np.float32) for name, box in (("low", low), ("high", high))})
        if table.column("left_area")[0] == table.column("right_area")[0]:
            found = [towards(sides[0], sides[0])]
        else:
            found = [towards(a, b) for a, b in (sides, sides[::-1])] if len(sides) == 2 else []
        columns = [np.concatenate(c) for c in zip(*found)] or [np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)]
        return pa.table([pa.array(c) for c in columns], schema=out_fields)

    searched = sent.groupBy("left_area", "right_area").applyInArrow(outside, "id long, near long, cosine double")
    settled = own.select("id", F.explode(F.arrays_zip("near", "cosine")).alias("x")).select("id", "x.near", "x.cosine").filter((F.col("near") >= 0) & (F.col("cosine") >= least))
    every = searched.unionByName(settled)
    every = every.unionByName(rest) if rest is not None else every
    best = Window.partitionBy("id").orderBy(F.desc("cosine"), "near")
    return every.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("id", "near", "cosine")


def similar_pairs(found: DataFrame, least: float) -> DataFrame:
    """(chunk_id_a, chunk_id_b), a < b: pairs of which one is among the other's best and whose cosine reaches least."""
    near = found.filter(F.col("cosine") >= least)
    return near.select(F.least("id", "near").alias("chunk_id_a"), F.greatest("id", "near").alias("chunk_id_b")).distinct()

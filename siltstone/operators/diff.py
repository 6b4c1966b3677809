"""Difference of a candidate run against the live one, and the evidence for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions.text import segments
from siltstone.session import stored

IDENTITY = ("source_id", "canonical_url")
CLASSES = ("added", "removed", "changed", "moved")


def run_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """(change_type, source_id, canonical_url, title, locale, previous_source_id, previous_url, previous_hash,
    current_hash): one full outer join by identity, and an equi-join on the hash for moves.

    Moves pair every added with every removed document of an equal, non-null hash, whatever their sources; both stay
    added and removed. Hashes compare null-safely. Identities must be unique in each side.
    """
    prev = previous.select(*IDENTITY, F.col("normalized_content_hash").alias("previous_hash"), F.lit(True).alias("was"))
    cur = current.select(*IDENTITY, "title", "locale", F.col("normalized_content_hash").alias("current_hash"), F.lit(True).alias("is"))
    both = prev.join(cur, list(IDENTITY), "full_outer")
    change = (
        F.when(F.col("was").isNull(), "added")
        .when(F.col("is").isNull(), "removed")
        .when(~F.col("previous_hash").eqNullSafe(F.col("current_hash")), "changed")
    )
    none = F.lit(None).cast("string")
    plain = both.withColumn("change_type", change).filter("change_type is not null").select(
        "change_type", *IDENTITY, "title", "locale", none.alias("previous_source_id"), none.alias("previous_url"), "previous_hash", "current_hash"
    )
    added = plain.filter("change_type = 'added' and current_hash is not null").select(*IDENTITY, "title", "locale", F.col("current_hash").alias("h"))
    removed = plain.filter("change_type = 'removed' and previous_hash is not null").select(
        F.col("source_id").alias("previous_source_id"), F.col("canonical_url").alias("previous_url"), F.col("previous_hash").alias("h")
    )
    moved = added.join(removed, "h").select(F.lit("moved").alias("change_type"), *IDENTITY, "title", "locale", "previous_source_id", "previous_url", F.col("h").alias("previous_hash"), F.col("h").alias("current_hash"))
    return plain.unionByName(moved)


def diff_summary(diff: DataFrame, previous: DataFrame, current: DataFrame) -> DataFrame:
    """One row of counts: previous, current, and of each class."""
    tagged = diff.select("change_type")
    for side, name in ((previous, "previous"), (current, "current")):
        tagged = tagged.unionByName(side.select(F.lit(name).alias("change_type")))
    return tagged.agg(*[F.count_if(F.col("change_type") == c).alias(f"{c}_count") for c in ("previous", "current", *CLASSES)])


def listed(diff: DataFrame) -> DataFrame:
    """With a position in each class by address, then source. Rows are placed by ranges of class and address and
    numbered within their range, so that a class is spread over all tasks; only the sizes of ranges are added up."""
    order = ["change_type", "canonical_url", "source_id", "previous_url"]
    ranged = stored(diff.repartitionByRange(*order).withColumn("range", F.spark_partition_id()))
    sizes = ranged.groupBy("change_type", "range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("change_type").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("change_type", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("change_type", "range").orderBy(*order[1:])
    numbered = ranged.withColumn("nth", F.row_number().over(within)).join(starts, ["change_type", "range"])
    return numbered.withColumn("position", (F.col("before") + F.col("nth")).cast("int")).select(*diff.columns, "position")


def first_changes(diff: DataFrame, limit: int = 50) -> DataFrame:
    """The first changes across classes in their order, with the number left out."""
    rank = F.create_map(*[x for i, c in enumerate(CLASSES) for x in (F.lit(c), F.lit(i))])[F.col("change_type")]
    kept = diff.withColumn("rank", rank).orderBy("rank", "canonical_url", "source_id", "previous_url").limit(limit)
    return kept.withColumn("hidden", F.lit(max(0, diff.count() - limit))).drop("rank")


def entry_counts(diff: DataFrame) -> DataFrame:
    """(source_id, canonical_url, entries): classes a document stands in, each once."""
    return diff.select("change_type", *IDENTITY).distinct().groupBy(*IDENTITY).agg(F.count(F.lit(1)).alias("entries"))


def current_keys(diff: DataFrame) -> DataFrame:
    """Identities of added, changed and moved documents of the current run."""
    return diff.filter(F.col("change_type").isin("added", "changed", "moved")).select(*IDENTITY).distinct()


def covered(documents: DataFrame, diff: DataFrame) -> DataFrame:
    """Current documents that the difference names."""
    return documents.join(current_keys(diff), list(IDENTITY), "left_semi")


def uncovered(diff: DataFrame, documents: DataFrame) -> DataFrame:
    """Entries no document stands for; removed ones always stay."""
    rest = diff.filter("change_type <> 'removed'").join(documents.select(*IDENTITY).distinct(), list(IDENTITY), "left_anti")
    return diff.filter("change_type = 'removed'").unionByName(rest.select(*diff.columns))


def annotated(documents: DataFrame, diff: DataFrame) -> DataFrame:
    """documents with their entries as a sorted array, empty for those without."""
    entry = F.struct("change_type", "previous_url", "previous_hash", "current_hash")
    grouped = diff.groupBy(*IDENTITY).agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    empty = F.array().cast(grouped.schema["entries"].dataType)
    return documents.join(grouped, list(IDENTITY), "left").withColumn("entries", F.coalesce("entries", empty))


def document_segments(chunks: DataFrame) -> DataFrame:
    """(source_id, canonical_url, position, segment): the lines of a document's chunks in order."""
    ordered = F.array_sort(F.collect_list(F.struct("chunk_index", "content")))
    joined = chunks.groupBy(*IDENTITY).agg(F.array_join(F.transform(ordered, lambda c: c["content"]), "\n").alias("text"))
    return joined.select(*IDENTITY, F.posexplode(segments(F.col("text"))).alias("position", "segment"))


def multiset_difference(left: DataFrame, right: DataFrame, keys: tuple[str, ...], value: str, order: str) -> DataFrame:
    """Rows of left beyond the number of equal values in right, by key and in order: a right value cancels the earliest
    equal one of left."""
    nth = Window.partitionBy(*keys, value).orderBy(order)
    mine = left.withColumn("nth", F.row_number().over(nth))
    theirs = right.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("there"))
    same = [mine[k].eqNullSafe(theirs[k]) for k in (*keys, value)]
    joined = mine.join(theirs, same, "left").select(*[mine[c] for c in left.columns], "nth", "there")
    return joined.filter(F.col("nth") > F.coalesce("there", F.lit(0))).drop("nth", "there")


def bounded(rows: DataFrame, keys: tuple[str, ...], value: str, order: str, most: int = 100, chars: int = 20_000, mark: str = "…") -> DataFrame:
    """(keys, segments, omitted): the first `most` values of each key within `chars` characters, the mark included
    where one is cut, and how many were left out. Values beyond the bound never reach a collecting aggregate."""
    window = Window.partitionBy(*keys).orderBy(order)
    run = rows.withColumn("n", F.row_number().over(window)).withColumn("before", F.coalesce(F.sum(F.length(value)).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    room = F.lit(chars) - F.col("before")
    shown = F.when(F.length(value) <= room, F.col(value)).otherwise(F.concat(F.substr(F.col(value), F.lit(1), F.greatest(room - len(mark), F.lit(0)).cast("int")), F.lit(mark)))
    kept = run.withColumn("in", (F.col("n") <= most) & (room > 0)).withColumn("shown", F.when(F.col("in"), shown))
    return kept.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.when(F.col("in"), F.struct("n", "shown")))), lambda s: s["shown"]).alias("segments"),
        F.count_if(~F.col("in")).alias("omitted"),
    )


def content_changes(previous_chunks: DataFrame, current_chunks: DataFrame, changed: DataFrame, most: int = 100, chars: int = 20_000) -> DataFrame:
    """(source_id, canonical_url, removed_segments, added_segments, removed_omitted, added_omitted) of changed documents."""
    only = changed.select(*IDENTITY).distinct()
    before = document_segments(previous_chunks.join(only, list(IDENTITY), "left_semi"))
    now = document_segments(current_chunks.join(only, list(IDENTITY), "left_semi"))
    gone = bounded(multiset_difference(before, now, IDENTITY, "segment", "position"), IDENTITY, "segment", "position", most, chars)
    new = bounded(multiset_difference(now, before, IDENTITY, "segment", "position"), IDENTITY, "segment", "position", most, chars)
    gone = gone.select(*IDENTITY, F.col("segments").alias("removed_segments"), F.col("omitted").alias("removed_omitted"))
    new = new.select(*IDENTITY, F.col("segments").alias("added_segments"), F.col("omitted").alias("added_omitted"))
    empty = F.array().cast("array<string>")
    return (
        only.join(gone, list(IDENTITY), "left")
        .join(new, list(IDENTITY), "left")
        .select(*IDENTITY, *[F.coalesce(c, empty).alias(c) for c in ("removed_segments", "added_segments")], *[F.coalesce(c, F.lit(0)).alias(c) for c in ("removed_omitted", "added_omitted")])
    )


def changed_since(column: str, other: str) -> Column:
    """IS DISTINCT FROM."""
    return ~F.col(column).eqNullSafe(F.col(other))

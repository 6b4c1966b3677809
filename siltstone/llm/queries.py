"""Queries of the operators for training data, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm import boilerplate, language, leakage, neighbours, quality, repeated_lines, residue, splitting, tokens
from siltstone.session import table


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    points = neighbours.usable(table(spark, base, "chunks"))
    return neighbours.similar_pairs(neighbours.neighbours(points, k=5, least=0.85), 0.85)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    return residue.residue(table(spark, base, "extracted_documents"))


def p3_slots(spark: SparkSession, base: str) -> DataFrame:
    return residue.slots(table(spark, base, "extracted_documents").distinct())


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    return boilerplate.page_blocks(table(spark, base, "pages")).filter("boilerplate").select("page_id", "block_no").distinct()


def p4_main_text(spark: SparkSession, base: str) -> DataFrame:
    return boilerplate.main_text(table(spark, base, "pages"))


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    return repeated_lines.Repeats(table(spark, base, "extracted_documents"), near=False).places()


def p5_clusters(spark: SparkSession, base: str) -> DataFrame:
    return repeated_lines.Repeats(table(spark, base, "extracted_documents")).clusters()


def p5_cleaned(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "extracted_documents")
    return repeated_lines.without_places(rows, repeated_lines.Repeats(rows).near_places())


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    return splitting.split_items(table(spark, base, "extracted_documents"), with_text=False).select("extract_id", "item_no").distinct()


def p6_pieces(spark: SparkSession, base: str) -> DataFrame:
    return splitting.split_items(table(spark, base, "extracted_documents")).distinct()


def p6_rejoined(spark: SparkSession, base: str) -> DataFrame:
    """Of each oversized item: the text its pieces give without their overlaps, and that all keep to limit and overlap."""
    found = splitting.split_items(table(spark, base, "extracted_documents")).distinct()
    order = Window.partitionBy("extract_id", "item_no").orderBy("piece_no")
    before = found.withColumn("before", F.coalesce(F.lag("end").over(order), F.lit(0)))
    own = F.expr("substring(content, before - start + 1)")
    right = (F.length("content") <= 2000) & (F.col("before") - F.col("start") == F.least(F.lit(200), F.col("before")))
    whole = before.groupBy("extract_id", "item_no").agg(F.array_sort(F.collect_list(F.struct("piece_no", own.alias("own")))).alias("parts"), F.bool_and(right).alias("right"))
    return whole.select("extract_id", "item_no", F.md5(F.array_join(F.transform("parts", lambda p: p["own"]), "")).alias("text"), "right")


def p7_found(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "extracted_documents")
    labelled = language.label_documents(rows, language.fit(rows))
    return language.wrong_or_mixed(labelled).select("extract_id", "segment_no", "lang")


def p7_languages(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "extracted_documents")
    labelled = language.label_documents(rows, language.fit(rows))
    return labelled.dropDuplicates(["extract_id", "segment_no", "lang"]).select("extract_id", "segment_no", "lang", F.round("confidence", 4).alias("confidence"), "first_line", "last_line")


def p8_ids(spark: SparkSession, base: str) -> DataFrame:
    return tokens.encoded(table(spark, base, "documents"))


def p8_offsets(spark: SparkSession, base: str) -> DataFrame:
    return tokens.piece_offsets(table(spark, base, "documents"))


def p9_found(spark: SparkSession, base: str) -> DataFrame:
    return leakage.leaked(table(spark, base, "documents"), table(spark, base, "eval_items"))


def p9_paraphrases(spark: SparkSession, base: str) -> DataFrame:
    return leakage.paraphrased(table(spark, base, "documents"), table(spark, base, "eval_items"))


def p10_found(spark: SparkSession, base: str) -> DataFrame:
    return quality.not_prose(quality.sentence_shares(table(spark, base, "documents"))).select(F.col("key").alias("doc_id")).distinct()


def p10_statistics(spark: SparkSession, base: str) -> DataFrame:
    shown = [F.round(c, 4).alias(c) for s in quality.STATISTICS for c in (s, f"{s}_z", f"{s}_rank")]
    return quality.document_quality(table(spark, base, "documents")).select(F.col("key").alias("doc_id"), "lang", *shown)


def p10_quartiles(spark: SparkSession, base: str) -> DataFrame:
    return quality.quantile_table(quality.distributions(quality.document_statistics(table(spark, base, "documents"))))


_QUERIES = (
    p2_found, p3_found, p3_slots, p4_found, p4_main_text, p5_found, p5_clusters, p5_cleaned, p6_found, p6_pieces, p6_rejoined, p7_found, p7_languages,
    p8_ids, p8_offsets, p9_found, p9_paraphrases, p10_found, p10_statistics, p10_quartiles,
)


def queries() -> dict:
    return {q.__name__: q for q in _QUERIES}


P6_FOUND = """
SELECT DISTINCT extract_id, CAST(item_no AS INT) AS item_no FROM (
  SELECT extract_id, -1 AS item_no, normalized_content AS t FROM extracted_documents
  UNION ALL
  SELECT extract_id, i - 1 AS item_no, blocks[i].text AS t
  FROM (SELECT extract_id, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM extracted_documents)
) WHERE length(t) > 2000
"""


P6_REJOINED = """
SELECT DISTINCT extract_id, CAST(item_no AS INT) AS item_no, md5(t) AS text, true AS "right" FROM (
  SELECT extract_id, -1 AS item_no, normalized_content AS t FROM extracted_documents
  UNION ALL
  SELECT extract_id, i - 1 AS item_no, blocks[i].text AS t
  FROM (SELECT extract_id, blocks, unnest(range(1, len(blocks) + 1)) AS i FROM extracted_documents)
) WHERE length(t) > 2000
"""


def oracle_sql() -> dict:
    return {"p6_found": P6_FOUND, "p6_rejoined": P6_REJOINED}

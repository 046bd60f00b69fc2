"""Queries of the problems on training data and, where SQL can say it, their twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import fusion, leaks, quality, sampling, similar, tokens
from terrace.llm.sql import SQL  # noqa: F401
from terrace.runtime import table


def _draw(spark: SparkSession, d: str) -> sampling.Draw:
    return sampling.draw(table(spark, d, "ranked"), table(spark, d, "sample_targets"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d).report.filter("short").select("draw_id", "bucket")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d).report


def p1_sample(spark: SparkSession, d: str) -> DataFrame:
    return _draw(spark, d).sample


def p1_shares(spark: SparkSession, d: str) -> DataFrame:
    return p1_sample(spark, d).groupBy("draw_id", "cat").agg(F.count("*").alias("drawn"), F.count_distinct("iri").alias("iris"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    rows = similar.vectors(table(spark, d, "entities"), "entity_id", "vector")
    pairs = similar.all_pairs(similar.similar_pairs(rows, 0.95))
    return pairs.select(F.col("a").alias("entity_id_a"), F.col("b").alias("entity_id_b"))


def p3_nearest(spark: SparkSession, d: str) -> DataFrame:
    rows = similar.vectors(table(spark, d, "entities"), "entity_id", "vector")
    best = similar.nearest(rows, rows.filter(F.col("id") % 100 == 0), 10)
    return best.select(F.col("id").alias("entity_id"), F.col("neighbour").alias("neighbour_id"), "place", F.round("cosine", 6).alias("cosine"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return fusion.fuse(table(spark, d, "ranked")).filter("leads").select("build", "iri")


def p6_ranking(spark: SparkSession, d: str) -> DataFrame:
    return fusion.with_places(fusion.fuse(table(spark, d, "ranked"))).select("build", "iri", "place", F.round("fused", 9).alias("fused"), "leads")


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode(table(spark, d, "documents"))


def p7_decoded(spark: SparkSession, d: str) -> DataFrame:
    return tokens.decode(tokens.encode(table(spark, d, "documents")))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).filter("kind = 'verbatim'").select("doc_id", "item_id")


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).withColumns({"cosine": F.round("cosine", 4), "lcs_share": F.round("lcs_share", 4)})


def _quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.statistics(table(spark, d, "documents"), table(spark, d, "common_words"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return _quality(spark, d).filter("prose_share < 0.5").select("doc_id").distinct()


def p9_counts(spark: SparkSession, d: str) -> DataFrame:
    counted = ("mean_word_length", "symbol_ratio", "closed_lines", "common_share")
    return _quality(spark, d).select("doc_id", "words", *[F.round(c, 6).alias(c) for c in counted]).distinct()


def p9_statistics(spark: SparkSession, d: str) -> DataFrame:
    got = _quality(spark, d)
    return got.select(*[F.round(c, 6).alias(c) if t == "double" else c for c, t in got.dtypes])


_ALL = (p1_found, p1_report, p1_sample, p1_shares, p3_found, p3_nearest, p6_found, p6_ranking, p7_ids, p7_decoded, p8_found, p8_report, p9_found, p9_counts, p9_statistics)
QUERIES = {f.__name__: f for f in _ALL}

"""Registered queries of the corpus operators (``QUERIES``) and their DuckDB SQL where SQL can express them (``ORACLE``).

Every query applies its operator to the whole of its table and returns the whole result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collision_search, column_dedup, fuzzy_lines, jaccard_product, language, max_score, mixing, near_copies, packing, periodic_runs
from . import range_coder, spelling, url_filter
from .common import table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=4096, end_id=1)


def op2_column_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.classify(table(spark, sf_dir, "pages"))


def op4_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.nearest(table(spark, sf_dir, "embeddings"))


def op5_max_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return max_score.top_scores(table(spark, sf_dir, "embeddings"))


def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_lines.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op7_weighted_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, cap=2.0)


def op8_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_coder.round_trip(table(spark, sf_dir, "documents"), end_id=2)


def op9_signature_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copies.near_copies(table(spark, sf_dir, "documents"), words=2)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_runs(table(spark, sf_dir, "documents"))
    return periodic_runs.digests(periodic_runs.find_runs(docs, least=12))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), least_length=6, least_count=5, damage=199), ratio=5)


def op13_jaccard_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_product.jaccard_join(table(spark, sf_dir, "documents"), n=4)


QUERIES = {f.__name__: f for f in (
    op1_best_fit_packing, op2_column_dedup, op3_url_filter, op4_collision_search, op5_max_score, op6_fuzzy_lines, op7_weighted_fair_mixing, op8_token_blocks,
    op9_signature_join, op10_language_id, op11_periodic_runs, op12_spelling_variants, op13_jaccard_product)}

ORACLE: dict[str, str] = {"op5_max_score": max_score.ORACLE, "op7_weighted_fair_mixing": mixing.ORACLE}

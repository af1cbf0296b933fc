"""The queries of this subpackage, as (spark, sf_dir) -> DataFrame, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table


def op1_lattice_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lattice import score

    return score(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"))


def op3_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import best_fit_packing

    return best_fit_packing(table(spark, sf_dir, "documents"))


def op5_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(table(spark, sf_dir, "documents"))


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import personal_data

    return personal_data(table(spark, sf_dir, "documents"))


def op7_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import through_archives

    return through_archives(table(spark, sf_dir, "pages"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls

    return judge_urls(table(spark, sf_dir, "pages"))


def op9_water_filling_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(table(spark, sf_dir, "documents"))


def op10_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .top_k import top_k

    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .runs import run_report, with_planted_runs

    return run_report(with_planted_runs(table(spark, sf_dir, "documents")))


def op12_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"))


def op13_change_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .change_points import change_points

    return change_points(table(spark, sf_dir, "sale_lines"), "vendor_id", "shipped_at", "quantity")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_lattice_likelihood, op2_token_counts, op3_simhash_pivots, op4_best_fit_packing, op5_quality_cascade, op6_personal_data, op7_warc_archives, op8_url_filter, op9_water_filling_mix, op10_ball_tree_top_k, op11_periodic_runs, op12_feistel_shards, op13_change_points)}


def oracle_sql() -> dict[str, str]:
    from .change_points import ORACLE_SQL as op13
    from .quality import ORACLE_SQL as op5
    from .top_k import ORACLE_SQL as op10

    return {"op5_quality_cascade": op5, "op10_ball_tree_top_k": op10, "op13_change_points": op13}

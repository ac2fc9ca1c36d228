"""The queries of this subpackage and, where SQL can express them, their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import bpe, edit_counts, exact_dedup, forest, importance, line_dedup, packing, pieces, pii, sharding, simhash, spelling, toxicity
from vellum.llm.common import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), counts=True)


def op3_flow_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op6_char_tagger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(documents(spark, sf_dir))


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_counts.recount(edit_counts.sample_edits(documents(spark, sf_dir)))


def op8_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.segment(documents(spark, sf_dir))


def op9_tree_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(documents(spark, sf_dir))


def op13_importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_line_dedup": op2_line_dedup,
        "op3_flow_sharding": op3_flow_sharding,
        "op4_simhash": op4_simhash,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_char_tagger": op6_char_tagger,
        "op7_edit_counts": op7_edit_counts,
        "op8_sampled_pieces": op8_sampled_pieces,
        "op9_tree_forest": op9_tree_forest,
        "op10_slack_packing": op10_slack_packing,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_tree_bpe": op12_tree_bpe,
        "op13_importance_draw": op13_importance_draw,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_line_dedup": line_dedup.ORACLE, "op5_exact_dedup": exact_dedup.ORACLE}

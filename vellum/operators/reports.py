"""Aggregated reports over chunks, prompts and runs. Each is one pass with partial aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.base import n_words, strip


def _ends(content: Column) -> Column:
    return F.coalesce(F.right(strip(content), F.lit(1)).isin(".", "!", "?"), F.lit(False))


def _r(value: Column, name: str) -> Column:
    return F.round(value, 6).alias(name)


def chunk_quality(chunks: DataFrame, budget: int) -> DataFrame:
    """Per document: mean tokens, utilisation, share of chunks that end a sentence, evenness of sizes."""
    n = F.avg("token_count")
    even = F.when((F.count("*") > 1) & (n > 0), 1 - F.stddev_samp("token_count") / n).otherwise(1.0)
    return chunks.groupBy("doc_id").agg(_r(n, "avg_tokens"), _r(n / budget, "token_utilization"), _r(F.avg(_ends(F.col("content")).cast("int")), "boundary_preservation"), _r(even, "size_consistency"))


def chunking_report(docs: DataFrame, chunks: DataFrame, budget: int) -> DataFrame:
    """One row over the corpus; the join is of two rows."""
    whole = docs.agg(F.count("*").alias("original_docs"), F.sum(n_words(F.col("content"))).alias("_w"))
    made = chunks.agg(
        F.count("*").alias("total_chunks"),
        F.sum("token_count").alias("_cw"),
        F.avg("token_count").alias("_m"),
        F.stddev_samp("token_count").alias("_sd"),
        F.count_if(_ends(F.col("content"))).alias("complete_sentences"),
    )
    c = F.col
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return whole.join(made, F.lit(True)).select(
        "original_docs",
        "total_chunks",
        _r(ratio(c("total_chunks"), c("original_docs")), "chunks_per_doc"),
        _r(ratio(c("_cw"), c("_w")), "token_preservation"),
        _r(F.coalesce("_m", F.lit(0.0)), "avg_chunk_size"),
        _r(F.coalesce("_sd", F.lit(0.0)), "chunk_size_std"),
        _r(F.coalesce(c("_m") / budget, F.lit(0.0)), "token_utilization"),
        _r(F.coalesce(1 - F.try_divide(c("_sd"), c("_m")), F.lit(1.0)), "size_consistency"),
        "complete_sentences",
        _r(ratio(c("complete_sentences"), c("total_chunks")), "sentence_preservation_rate"),
    )

"""Documents to training examples, and the reports on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import chunks, classify, prompts

META = ("author", "title", "date", "source", "chunk_id", "total_chunks", "token_count", "content_type", "template_used")


def examples(docs: DataFrame, strategy: str = "paragraph_aware", budget: int = chunks.MAX_TOKENS, delimiter: str = "\n\n") -> DataFrame:
    """(doc_id, prompt, response, metadata): a chunk per example, its prompt by content type."""
    made = chunks.chunk(docs, strategy, budget, delimiter=delimiter)
    typed = prompts.with_context(made).withColumn("content_type", classify.content_type(F.col("title"), F.col("content")))
    context = {c: F.col(c) for c in prompts.DEFAULT_CONTEXT}
    prompt = prompts.training_prompt(F.col("title"), F.col("author"), F.col("date"), F.col("content"), F.col("content_type"), context)
    shown = typed.withColumn("template_used", F.lit("auto_selected"))
    return shown.select("doc_id", prompt.alias("prompt"), F.col("content").alias("response"), F.struct(*META).alias("metadata"))


def pipeline_report(docs: DataFrame, made: DataFrame) -> DataFrame:
    """One row: counts, lengths and diversity. Both inputs shrink to one row before they meet."""
    n = docs.agg(F.count("*").alias("input_documents"))
    m = made.agg(
        F.count("*").alias("examples"),
        F.avg(F.length("prompt")).alias("p"),
        F.avg(F.length("response")).alias("r"),
        F.count_distinct("metadata.content_type").alias("content_type_coverage"),
        F.count_distinct("metadata.template_used").alias("template_diversity"),
    )
    ratio = F.coalesce(F.try_divide(F.col("examples"), F.col("input_documents")), F.lit(0.0))
    return n.join(m, F.lit(True)).select("input_documents", "examples", F.round(ratio, 6).alias("expansion_ratio"), F.round("p", 6).alias("avg_prompt_length"), F.round("r", 6).alias("avg_response_length"), "content_type_coverage", "template_diversity")


def histograms(made: DataFrame) -> DataFrame:
    """Examples by content type and by template: (dimension, value, n)."""
    named = made.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(f"metadata.{k}").alias("value")) for d, k in (("content_type", "content_type"), ("template", "template_used"))])).alias("x"))
    return named.groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def effectiveness(docs: DataFrame) -> DataFrame:
    """Histograms of type, template, level and speaker in one pass: (dimension, value, n)."""
    made = prompts.generate(docs).select("content_type", "template_name", F.col("template_level").alias("difficulty"), "author")
    sets = made.groupingSets([["content_type"], ["template_name"], ["difficulty"], ["author"]], "content_type", "template_name", "difficulty", "author").agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    name = F.when(F.col("g") == 7, "content_type").when(F.col("g") == 11, "template").when(F.col("g") == 13, "difficulty").otherwise("speaker")
    return sets.select(name.alias("dimension"), F.coalesce("content_type", "template_name", "difficulty", "author").alias("value"), "n")


def effectiveness_summary(docs: DataFrame) -> DataFrame:
    """One row: documents, distinct types and templates, speakers that have a profile."""
    made = prompts.generate(docs)
    return made.agg(
        F.count("*").alias("total_documents"),
        F.count_distinct("content_type").alias("classification_coverage"),
        F.count_distinct("template_name").alias("template_diversity"),
        F.count_distinct("author").alias("speaker_coverage"),
        F.count_distinct(F.when(F.col("has_profile"), F.col("author"))).alias("supported_speakers"),
    )

"""Reformatting talks end to end: one narrow projection, no shuffle; only the statistics aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import talks

c = F.col
FAILED = "Failed to read content"


def reformat(docs: DataFrame, year: int | None = None) -> DataFrame:
    """`docs` (path, content) with content_type, success, message, warnings and the formatted text.

    The type is judged on the raw text, structure, metadata and body on the cleaned one. Types that are no
    talks are skipped, with a null text; a null content fails, as `FAILED`, with a null text too.
    """
    now = None if year is None else F.lit(year)
    typed = docs.withColumns({"content_type": talks.doc_type(c("content"), c("path")), "_clean": talks.clean_content(c("content"))})
    read = typed.withColumns({"_s": talks.structure(c("_clean")), "_b": talks.split_notes(c("_clean")), "_sp": talks.speaker(c("_clean")), "_t": talks.strip_stamp(talks.talk_title(c("_clean"))), "_d": talks.parse_date(c("_clean"), c("path"))})
    known = read.withColumn("_i", talks.infer(c("_sp.author"), c("_sp.author_title")))
    notes = F.when(c("_b.notes").isNotNull(), talks.format_notes(c("_b.notes")))
    drawn = known.withColumn("_out", talks.references(talks.standard_quotes(talks.clean_format(talks.render(c("_t"), c("_i.author"), c("_b.body"), c("_d"), c("_i.author_title"), notes)))))
    skipped = c("content_type").isin(talks.SKIPPED)
    warned = F.concat(
        F.transform(c("_s.issues"), lambda x: F.concat(F.lit("Structure issue: "), x)),
        F.when(~talks.valid_metadata(c("_t"), c("_i.author"), c("_d"), now), F.array(F.lit("Missing essential metadata"))).otherwise(F.array().cast("array<string>")),
        F.when(~talks.valid_output(c("_out"), c("content_type")), F.array(F.lit("Output validation failed"))).otherwise(F.array().cast("array<string>")),
    )
    return drawn.select(
        *docs.columns,
        F.when(c("content").isNull(), "invalid").otherwise(c("content_type")).alias("content_type"),
        (~skipped & c("content").isNotNull()).alias("success"),
        F.when(c("content").isNull(), FAILED).when(skipped, F.concat(F.lit("Skipped "), c("content_type"), F.lit(" content"))).otherwise("Successfully processed").alias("message"),
        F.when(skipped | c("content").isNull(), F.array().cast("array<string>")).otherwise(warned).alias("warnings"),
        F.when(~skipped, c("_out")).alias("formatted"),
        F.when(~skipped & c("content").isNotNull(), F.regexp_replace("path", r"\.txt$", "_formatted.txt")).alias("output_path"),
    )


def stats(results: DataFrame) -> DataFrame:
    """Counts by type: processed, successful, skipped, failed, with warnings."""
    failed = c("message") == FAILED
    return results.groupBy("content_type").agg(F.count("*").alias("processed"), F.count_if("success").alias("successful"), F.count_if(~c("success") & ~failed).alias("skipped"), F.count_if(failed).alias("failed"), F.count_if(F.size("warnings") > 0).alias("warned"))


def failures(results: DataFrame) -> DataFrame:
    """One row: how many results should stop a run, being neither a success nor of an invalid text."""
    return results.agg(F.count_if(~c("success") & (c("content_type") != "invalid")).alias("failed"))


def backups(docs: DataFrame) -> DataFrame:
    """(path, content) of the copies to write beside `docs` (path, content) before they are reformatted; a text that can't be read has none."""
    return docs.where("content is not null").select(F.concat("path", F.lit(".backup")).alias("path"), "content")


def dry_run(paths: DataFrame, existing: DataFrame) -> DataFrame:
    """One row: text files found, and those that would be processed."""
    todo = eligible(paths, existing).agg(F.count("*").alias("eligible"))
    return paths.agg(F.count_if(F.endswith("path", F.lit(".txt"))).alias("found")).join(todo, F.lit(True))


def eligible(paths: DataFrame, existing: DataFrame, skip_sessions: bool = True, overwrite: bool = False) -> DataFrame:
    """`paths` (path) that are text files, no session files, and have no output in `existing` (path) yet."""
    some = paths.where(F.endswith("path", F.lit(".txt")))
    if skip_sessions:
        some = some.where(~c("path").rlike(r"session\.txt$|sessionlangeng\.txt$"))
    if overwrite:
        return some
    out = existing.select(c("path").alias("_out"))
    return some.join(out, F.regexp_replace("path", r"\.txt$", "_formatted.txt") == c("_out"), "left_anti")

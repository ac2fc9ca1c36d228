"""Tables of a data folder, and the corpus view that document operators work on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a document; missing ones are the empty string.
DOCUMENT = ("content", "author", "title", "date", "source")

#: What the reader gives one task at most, by its defaults.
SMALL = 128 << 20


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """`df`, a table as read, over all cores: one so small that the reader gives it to few tasks is dealt out first.

    Only tables of less than SMALL bytes in fewer files than cores are shuffled, whatever the cluster.
    """
    spark, files = df.sparkSession, df.inputFiles()
    cores = spark.sparkContext.defaultParallelism
    if not 0 < len(files) < cores:
        return df
    size = spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0]
    return df.repartition(cores) if size < SMALL else df


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """documents as (doc_id, content, author, title, date, source); three in four have an author with a profile."""
    docs = spread(load(spark, folder, "documents").select("doc_id", "text", "source"))
    author = F.expr("case doc_id % 4 when 0 then 'Russell M. Nelson' when 1 then 'Dieter F. Uchtdorf' when 2 then 'Jeffrey R. Holland' else source end")
    return docs.select("doc_id", F.col("text").alias("content"), author.alias("author"), F.substring_index("text", "\n", 1).alias("title"), F.lit("").alias("date"), "source")


CORPUS = """SELECT doc_id, text AS content,
    CASE doc_id % 4 WHEN 0 THEN 'Russell M. Nelson' WHEN 1 THEN 'Dieter F. Uchtdorf' WHEN 2 THEN 'Jeffrey R. Holland' ELSE source END AS author,
    string_split(text, chr(10))[1] AS title, '' AS date, source FROM documents"""

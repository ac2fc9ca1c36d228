"""Acquisition: index URLs, links, resuming, and what is written where."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vellum.functions import html

c = F.col
# fixed value: where index pages are
BASE = "https://www.churchofjesuschrist.org"
CONTENT_TYPES = ("general-conference", "liahona")


def seeds(spark: SparkSession, first: int, last: int, content_type: str = "general-conference", upto: Column | None = None) -> DataFrame:
    """(year, month, url): April and October for conferences, the other months for the magazine, none after `upto`."""
    if not (isinstance(first, int) and 1900 <= first <= last <= 2100):
        raise ValueError("years must lie between 1900 and 2100, in order")
    if content_type not in CONTENT_TYPES:
        raise ValueError(f"content type must be one of {', '.join(CONTENT_TYPES)}")
    months = F.array(F.lit(4), F.lit(10)) if content_type == "general-conference" else F.filter(F.sequence(F.lit(1), F.lit(12)), lambda m: ~m.isin(4, 10))
    out = spark.range(first, last + 1).select(c("id").cast("int").alias("year"), F.explode(months).alias("month"))
    out = out.withColumn("url", F.format_string(f"{BASE}/study/{content_type}/%d/%02d?lang=eng", "year", "month"))
    return out if upto is None else out.where(F.make_date("year", "month", F.lit(1)) <= upto)


def links(pages: DataFrame, contains: str = "/study/", least_slashes: int = 5, least_parts: int = 1) -> DataFrame:
    """(page_id, pos, url) of the links of `pages` (page_id, url, html) that pass, made absolute, the page itself out."""
    parts = F.size(F.split(F.regexp_replace("href", "^/+|/+$", ""), "/"))
    found = pages.select("page_id", c("url").alias("_page"), html.site(c("url")).alias("_site"), F.posexplode_outer(html.hrefs(c("html"))).alias("pos", "href"))
    kept = found.where(F.contains("href", F.lit(contains)) & (html.slashes(c("href")) >= least_slashes) & (parts >= least_parts))
    return kept.withColumn("url", html.absolute(c("href"), c("_site"))).where("url is not null and url <> _page").select("page_id", "pos", "url")


def talk_links(pages: DataFrame, content_type: str = "general-conference") -> DataFrame:
    """(page_id, pos, url): the first occurrences of links to texts of a type.

    A link needs the type's path, five slashes and, without slashes at its ends, five parts, so that links to the
    index of a month, which name no text, stay out.
    """
    deep = pages.withColumn("html", F.coalesce("html", F.lit("")))
    kept = links(deep, f"/study/{content_type}/", 5, 5)
    return first_links(kept)


#: fixed value: links that the notebook takes, between the year and the language
_ANCHORED = r"^/study/general-conference/\d{4}/\d{2}/.+\?lang=eng$"


def anchored_links(pages: DataFrame) -> DataFrame:
    """(page_id, url): the distinct site-relative links of a page to talks in English, made absolute on BASE."""
    found = pages.select("page_id", F.explode(html.hrefs(c("html"))).alias("href")).where(c("href").rlike(_ANCHORED))
    return found.select("page_id", F.concat(F.lit(BASE), "href").alias("url")).distinct()


def first_links(found: DataFrame) -> DataFrame:
    """The first occurrence of each link of a page, in page order."""
    return found.withColumn("_n", F.row_number().over(W.partitionBy("page_id", "url").orderBy("pos"))).where("_n = 1").drop("_n")


def counts(found: DataFrame) -> DataFrame:
    """Links by year and month, by year, and in all: (year, month, n)."""
    return found.rollup("year", "month").agg(F.count("*").alias("n"))


def scraped(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(`pages` (url, text) with a text, one row of counts: pages, saved, failed); a blank text fails."""
    fine = F.trim(F.coalesce("text", F.lit(""))) != ""
    return pages.where(fine), pages.agg(F.count("*").alias("pages"), F.count_if(fine).alias("saved"), F.count_if(~fine).alias("failed"))


def remaining(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates (url, ...) whose file is not among `existing` (file_name): names are compared as they are stored."""
    named = candidates.withColumn("file_name", html.file_name(html.slug(c("url"))))
    return named.join(existing.select("file_name"), "file_name", "left_anti")


def target_path(content_type: Column, year: Column, month: Column, name: Column) -> Column:
    """content type/YYYY-MM/name; null for years, months or types that are not allowed."""
    fine = year.between(1900, 2100) & month.between(1, 12) & content_type.isin(*CONTENT_TYPES)
    return F.when(fine, F.concat_ws("/", content_type, F.format_string("%d-%02d", year, month), name))

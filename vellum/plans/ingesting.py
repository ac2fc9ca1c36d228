"""Queries: links, slugs, text of pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import html
from vellum.operators import ingest
from vellum.tables import load, spread

c = F.col


def _pages(s, d):
    return spread(load(s, d, "pages"))


def _links(s, d):
    return ingest.links(_pages(s, d), "/", 1)


# links to talks in place of the pages' own, and links to an index, with and without a slash at the end
_INDEX = '<a href="/study/general-conference/2024/10/">x</a><a href="/study/general-conference/2024/10?lang=eng">x</a><a href="/study/general-conference/2024/10/slug?lang=eng">x</a><a href="https://a.org/study/general-conference/2024/10/">x</a>'


def _talk_pages(s, d):
    return _pages(s, d).withColumn("html", F.concat(F.replace("html", F.lit('href="/'), F.lit('href="/study/general-conference/2024/04/')), F.lit(_INDEX)))


def _lateral(s, d):
    """The same links by a table function, called in SQL."""
    html.register(s)
    return s.sql("SELECT page_id, pos, link AS url FROM {pages} AS p, LATERAL talk_links(p.html, p.url, 'general-conference')", pages=_talk_pages(s, d))


def _dated(s, d):
    return ingest.first_links(_links(s, d)).withColumns({"year": (c("page_id") % 5 + 2000).cast("int"), "month": F.when(c("page_id") % 2 == 0, 4).otherwise(10)})


QUERIES = {
    "seed_urls": lambda s, d: ingest.seeds(s, 1971, 2024),
    "seed_urls_monthly": lambda s, d: ingest.seeds(s, 2008, 2024, "liahona", F.lit("2024-06-01").cast("date")),
    "extract_links": _links,
    "extract_links_strict": lambda s, d: ingest.talk_links(_talk_pages(s, d)),
    "extract_links_lateral": _lateral,
    "extract_links_anchored": lambda s, d: ingest.anchored_links(_talk_pages(s, d)),
    "dedupe_links": lambda s, d: ingest.first_links(_links(s, d)),
    "distinct_links": lambda s, d: _links(s, d).groupBy("page_id").agg(F.array_join(F.sort_array(F.collect_set("url")), "\n").alias("urls")),
    "scrape_counts": lambda s, d: ingest.scraped(_pages(s, d).select("url", F.when(c("page_id") % 4 > 0, html.without_tags(html.article(c("html")))).alias("text")))[1],
    "link_counts": lambda s, d: ingest.counts(_dated(s, d)),
    # the links of every third page have been fetched before
    "resume_antijoin": lambda s, d: ingest.remaining(_links(s, d), _links(s, d).where("page_id % 3 = 0").select(html.file_name(html.slug(c("url"))).alias("file_name")).distinct()),
    "counted_talks": lambda s, d: ingest.seeds(s, 2000, 2004).join(ingest.counts(_dated(s, d)).where("month is not null"), ["year", "month"], "left").select("year", "month", F.coalesce("n", F.lit(0)).alias("n")),
    "slug_clean": lambda s, d: _pages(s, d).select("page_id", html.slug(c("url")).alias("slug"), html.file_name(html.slug(c("url"))).alias("file_name")),
    "target_path": lambda s, d: _dated(s, d).select("page_id", "pos", ingest.target_path(F.lit("liahona"), c("year"), c("month"), html.file_name(html.slug(c("url")))).alias("path")),
    "html_strip_tags": lambda s, d: _pages(s, d).select("page_id", html.without_tags(c("html")).alias("text")),
    "html_article_text": lambda s, d: _pages(s, d).select("page_id", html.without_tags(html.article(c("html")), "\n").alias("text")),
    "html_to_text": lambda s, d: _pages(s, d).select("page_id", html.strict_text_of(c("html")).alias("text")).where("trim(text) <> ''"),
}

_HREF = """regexp_extract_all(html, '(?is)<a\\b[^>]*\\bhref="([^"]*)"', 1)"""


def _linked(pages: str, contains: str, least: int) -> str:
    return f"""SELECT page_id, pos, url FROM (SELECT page_id, page, pos, CASE WHEN starts_with(href, '/') THEN site || href WHEN starts_with(href, 'http') THEN href END AS url, href
        FROM (SELECT page_id, url AS page, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site, unnest({_HREF}) AS href, unnest(range(len({_HREF})))::INT AS pos FROM {pages}))
        WHERE contains(href, '{contains}') AND length(href) - length(replace(href, '/', '')) >= {least} AND url IS NOT NULL AND url <> page"""


_TALK_PAGES = f"""(SELECT page_id, url, replace(html, 'href="/', 'href="/study/general-conference/2024/04/') || '{_INDEX}' AS html FROM pages)"""
_LINKS = _linked("pages", "/", 1)
_FIRST = f"SELECT page_id, min(pos) AS pos, url FROM ({_LINKS}) GROUP BY page_id, url"
_DATED = f"SELECT *, (page_id % 5 + 2000)::INT AS year, CASE WHEN page_id % 2 = 0 THEN 4 ELSE 10 END AS month FROM ({_FIRST})"
_SLUG = "string_split(regexp_replace(url, '^/+|/+$', '', 'g'), '/')[-1]"
_FILE = f"CASE WHEN regexp_replace({_SLUG}, '[^\\p{{L}}\\p{{N}}\\-_.]', '', 'g') = '' THEN NULL WHEN ends_with(regexp_replace({_SLUG}, '[^\\p{{L}}\\p{{N}}\\-_.]', '', 'g'), '.txt') THEN regexp_replace({_SLUG}, '[^\\p{{L}}\\p{{N}}\\-_.]', '', 'g') ELSE regexp_replace({_SLUG}, '[^\\p{{L}}\\p{{N}}\\-_.]', '', 'g') || '.txt' END"
_TEXT = lambda x, sep: f"array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace({x}, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)\\s*>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]*>', {sep}, 'g'), chr(10)), lambda l: trim(regexp_replace(l, '\\s+', ' ', 'g'))), lambda l: l <> ''), chr(10))"
_URL = "'https://www.churchofjesuschrist.org/study/{}/' || year || '/' || lpad(month::VARCHAR, 2, '0') || '?lang=eng'"

ORACLES = {
    "seed_urls": f"SELECT year::INT AS year, month, {_URL.format('general-conference')} AS url FROM (SELECT unnest(range(1971, 2025)) AS year), (SELECT unnest([4, 10]) AS month)",
    "seed_urls_monthly": f"SELECT year::INT AS year, month::INT AS month, {_URL.format('liahona')} AS url FROM (SELECT unnest(range(2008, 2025)) AS year), (SELECT unnest(range(1, 13)) AS month) WHERE month NOT IN (4, 10) AND make_date(year, month, 1) <= DATE '2024-06-01'",
    "extract_links": _LINKS,
    # anchors by their quoted attribute, as the reference finds them: path, five slashes, five parts of the bare path, first of its page
    "extract_links_strict": f"""SELECT page_id, min(pos)::INT AS pos, url FROM (SELECT page_id, pos, page, href, CASE WHEN href[1] = '/' THEN site || href WHEN href[1:4] = 'http' THEN href END AS url FROM (SELECT page_id, url AS page, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS site, unnest({_HREF}) AS href, unnest(range(len({_HREF}))) AS pos FROM {_TALK_PAGES}))
        WHERE href LIKE '%/study/general-conference/%' AND len(string_split(href, '/')) > 5 AND len(string_split(trim(href, '/'), '/')) >= 5 AND url <> page GROUP BY page_id, url""",
    "extract_links_anchored": f"""SELECT DISTINCT page_id, 'https://www.churchofjesuschrist.org' || href AS url FROM (SELECT page_id, unnest({_HREF}) AS href FROM {_TALK_PAGES}) WHERE regexp_matches(href, '^/study/general-conference/[0-9]{{4}}/[0-9]{{2}}/.+[?]lang=eng$')""",
    "dedupe_links": _FIRST,
    "distinct_links": f"SELECT page_id, string_agg(url, chr(10) ORDER BY url) AS urls FROM ({_FIRST}) GROUP BY page_id",
    "scrape_counts": "SELECT count(*) AS pages, count(*) FILTER (WHERE page_id % 4 > 0) AS saved, count(*) FILTER (WHERE page_id % 4 = 0) AS failed FROM pages",
    # entities of the pages, with and without their semicolon, the ampersand last
    "html_to_text": rf"""SELECT page_id, text FROM (SELECT page_id, replace(replace(replace({_TEXT('html', chr(39) * 2)}, '&copy;', '©'), '&middot;', '·'), '&quot;', '"') AS t, regexp_replace(t, '&amp;?', '&', 'g') AS text FROM pages) WHERE trim(text) <> ''""",
    "link_counts": f"SELECT year, month, count(*) AS n FROM ({_DATED}) GROUP BY ROLLUP (year, month)",
    "resume_antijoin": f"SELECT {_FILE} AS file_name, page_id, pos, url FROM ({_LINKS}) WHERE coalesce({_FILE}, '') NOT IN (SELECT coalesce({_FILE}, '-') FROM ({_LINKS}) WHERE page_id % 3 = 0)",
    "counted_talks": f"SELECT s.year::INT AS year, s.month, coalesce(n, 0) AS n FROM (SELECT year, month FROM (SELECT unnest(range(2000, 2005)) AS year), (SELECT unnest([4, 10]) AS month)) s LEFT JOIN (SELECT year, month, count(*) AS n FROM ({_DATED}) GROUP BY ALL) c ON s.year = c.year AND s.month = c.month",
    "slug_clean": f"SELECT page_id, {_SLUG} AS slug, {_FILE} AS file_name FROM pages",
    "target_path": f"SELECT page_id, pos, 'liahona/' || year || '-' || lpad(month::VARCHAR, 2, '0') || coalesce('/' || {_FILE}, '') AS path FROM ({_DATED})",
    "html_strip_tags": f"SELECT page_id, {_TEXT('html', chr(39) * 2)} AS text FROM pages",
    "html_article_text": f"""SELECT page_id, {_TEXT("CASE WHEN regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1) <> '' THEN regexp_extract(html, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1) ELSE html END", 'chr(10)')} AS text FROM pages""",
}

ORACLES["extract_links_lateral"] = ORACLES["extract_links_strict"]

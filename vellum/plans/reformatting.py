"""Queries: cleaning, structure, metadata and layout of talks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import talks
from vellum.operators import reformat
from vellum.tables import load, spread

c = F.col
YEAR = 2025

# headers by doc_id % 8, in SQL that both engines read
_CASES = """CASE doc_id % 8
    WHEN 0 THEN 'Finding Peace in Trials' || nl || 'By Elder Joseph Q. Sample' || nl || 'Of the Seventy' || nl || 'April 1995' || nl || nl || text || nl || 'Notes' || nl || '1. See  2 Nephi  3:4.' || nl || nl || nl || '2. D&C 1:2'
    WHEN 1 THEN '14:56Walking in Light' || nl || 'By President Ann B. Sample' || nl || 'Of the First Presidency' || nl || text || '.....' || nl || nl || '  ' || nl || nl || 'end  '
    WHEN 2 THEN 'Authenticating...' || nl || '1990–1999 Contents' || nl || 'short'
    WHEN 3 THEN 'Contents' || nl || text
    WHEN 4 THEN replace(text, 'e', 'Ã©') || 'â' || 'Â'
    WHEN 5 THEN 'A Title of Its Own' || nl || 'Sister Mary Sample Sister Mary' || nl || 'October 2008' || nl || text || nl || 'A Title of Its Own' || nl || 'References' || nl || 'x'
    WHEN 6 THEN 'Some Cited Works' || nl || 'By Bishop One Sample' || nl || '1. See this' || nl || '2. See that' || nl || 'See there'
    ELSE 'Faith  in Every Footstep' || nl || '2008  October' || nl || '4:28' || nl || 'Faith  in Every Footstep' || nl || 'By Sam Sample' || nl || 'Of the Presiding Bishopric' || nl || text END"""
_PATHS = """CASE doc_id % 6 WHEN 0 THEN 'general-conference/1995-04/talk' WHEN 1 THEN 'liahona/2008-10/article' WHEN 2 THEN 'general-conference/2001-10/saturday-morning-session' WHEN 3 THEN 'misc/1999/october-talk' WHEN 4 THEN 'misc/contents' ELSE 'plain' END || CAST(doc_id AS VARCHAR(20)) || '.txt'"""
TALKS = f"SELECT doc_id, {_PATHS} AS path, {_CASES} AS content FROM (SELECT doc_id, text, chr(10) AS nl FROM documents)"

# talks as pages of a conference show them; every seventh doesn't name one
_CONFERENCE = """CASE WHEN doc_id % 7 > 0 THEN 'October 2008 General Conference' ELSE 'Magazine' END || chr(10) || CASE doc_id % 4 WHEN 0 THEN 'Menu: Go Ye Therefore to All' WHEN 1 THEN 'A longer heading: with a colon' WHEN 2 THEN 'The Price of Nothing at All' ELSE '' END || chr(10)
    || content || chr(10) || '→ next' || chr(10) || '  see 16:36 there' || chr(10) || CASE WHEN doc_id % 3 = 0 THEN 'My dear friends, it has been long since we have met like this today' ELSE 'short end' END"""


def talk_view(s, d) -> DataFrame:
    # a view of the documents with the headers above
    docs = spread(load(s, d, "documents").select("doc_id", "text")).withColumn("nl", F.lit("\n"))
    return docs.select("doc_id", F.expr(_PATHS.replace("VARCHAR(20)", "STRING")).alias("path"), F.expr(_CASES).alias("content"))


def _one(fn, name="content"):
    return lambda s, d: talk_view(s, d).select("doc_id", fn(c("content")).alias(name))


QUERIES = {
    "encoding_fix": _one(talks.fix_encoding),
    "encoding_fix_scraper": _one(talks.fix_scraper_encoding),
    "encoding_issue_counts": _one(talks.issue_count, "issues"),
    "encoding_issue_positions": lambda s, d: talk_view(s, d).select("doc_id", F.explode_outer(talks.issues(c("content"))).alias("x")).where("x is not null").select("doc_id", c("x.position").alias("position"), c("x.original").alias("original"), c("x.suggested_fix").alias("suggested_fix"), c("x.confidence").alias("confidence")),
    "timestamp_strip": lambda s, d: talk_view(s, d).select("doc_id", talks.strip_stamp(F.substring_index("content", "\n", 1)).alias("title")),
    "toc_clean": _one(talks.clean_toc),
    "normalize_ws": _one(talks.normalize_whitespace),
    "artifact_clean": _one(talks.clean_artifacts),
    "text_process": _one(talks.process),
    "clean_content": _one(talks.clean_content),
    "doc_type_detect": lambda s, d: talk_view(s, d).select("doc_id", talks.doc_type(c("content"), c("path")).alias("content_type")),
    "structure_report": lambda s, d: talk_view(s, d).select("doc_id", talks.structure(c("content")).alias("x")).select("doc_id", *[c(f"x.{k}").alias(k) for k in ("has_title", "has_author", "has_date", "has_body", "has_notes", "toc_contamination", "duplicate_title", "line_count")], F.array_join("x.issues", "; ").alias("issues")),
    "metadata_analyze": lambda s, d: talk_view(s, d).select("doc_id", talks.analyzed(c("content")).alias("x")).select("doc_id", "x.*"),
    "metadata_extract": lambda s, d: talk_view(s, d).select("doc_id", talks.speaker(c("content")).alias("x"), talks.talk_title(c("content")).alias("title")).select("doc_id", "title", "x.*"),
    "metadata_infer": lambda s, d: talk_view(s, d).select("doc_id", talks.speaker(c("content")).alias("x")).select("doc_id", talks.infer(c("x.author"), c("x.author_title")).alias("i")).select("doc_id", "i.*"),
    "metadata_validate": lambda s, d: talk_view(s, d).select("doc_id", talks.analyzed(c("content")).alias("x")).select("doc_id", talks.valid_metadata(c("x.title"), c("x.author"), c("x.date"), F.lit(YEAR)).alias("valid")),
    "date_parse": lambda s, d: talk_view(s, d).select("doc_id", talks.parse_date(c("content"), c("path")).alias("date")),
    "title_detect": _one(talks.talk_title, "title"),
    "body_extract": _one(talks.body, "body"),
    "notes_extract": _one(talks.notes, "notes"),
    "notes_split": lambda s, d: talk_view(s, d).select("doc_id", talks.split_notes(c("content")).alias("x")).select("doc_id", "x.*"),
    "notes_format": lambda s, d: talk_view(s, d).select("doc_id", talks.format_notes(F.when(c("doc_id") % 3 == 0, F.concat(talks.notes(c("content")), F.lit("\n  \n"))).otherwise(talks.notes(c("content")))).alias("notes")),
    "reference_format": _one(talks.references),
    "format_standard": lambda s, d: talk_view(s, d).select("doc_id", "content", talks.analyzed(c("content")).alias("x")).select("doc_id", talks.clean_format(talks.render(c("x.title"), c("x.author"), c("content"), c("x.date"), c("x.author_title"), F.lit(None).cast("string"))).alias("formatted")),
    "output_validate": lambda s, d: reformat.reformat(talk_view(s, d), YEAR).where("success").select("doc_id", talks.valid_output(c("formatted"), c("content_type")).alias("valid")),
    "reformat_e2e": lambda s, d: reformat.reformat(talk_view(s, d), YEAR).select("doc_id", "path", "content_type", "success", "message", F.array_join("warnings", "; ").alias("warnings"), "formatted", "output_path"),
    "reformat_stats": lambda s, d: reformat.stats(reformat.reformat(talk_view(s, d), YEAR)),
    "reformat_failures": lambda s, d: reformat.failures(reformat.reformat(talk_view(s, d), YEAR)),
    "reformat_backup": lambda s, d: reformat.backups(talk_view(s, d).withColumn("content", F.when(c("doc_id") % 7 > 0, c("content")))),
    "reformat_dry_run": lambda s, d: reformat.dry_run(talk_view(s, d).select("doc_id", "path"), talk_view(s, d).where("doc_id % 5 = 0").select(F.regexp_replace("path", r"\.txt$", "_formatted.txt").alias("path"))),
    "metadata_all": lambda s, d: talk_view(s, d).select("doc_id", talks.metadata(c("content"), c("path")).alias("x")).select("doc_id", "x.*"),
    "conference_clean": lambda s, d: talk_view(s, d).select("doc_id", F.expr(_CONFERENCE.replace("VARCHAR", "STRING")).alias("content")).select("doc_id", talks.conference_text(c("content")).alias("content")),
    # every fifth talk has been formatted before
    "reformat_eligible": lambda s, d: reformat.eligible(talk_view(s, d).select("doc_id", "path"), talk_view(s, d).where("doc_id % 5 = 0").select(F.regexp_replace("path", r"\.txt$", "_formatted.txt").alias("path"))),
}

_L = "string_split(content, chr(10))"
_S = r"regexp_replace({}, '^\s+|\s+$', '', 'g')".format
_RX = lambda p: "'" + p.replace("'", "''") + "'"
_HEAD = f"{_L}[1:30]"
_ANY = lambda ps, x: "(" + " OR ".join(f"regexp_matches({x}, {_RX(p)})" for p in ps) + ")"
_AUTHOR = f"len(list_filter({_HEAD}, lambda x: regexp_matches(x, {_RX(talks.AUTHORS[1])}))) > 0"
_LONG = f"len(list_filter({_L}, lambda x: length({_S('x')}) > 50))"
_FIRST = _S(f"{_L}[1]")
_ISSUE = "(" + " + ".join(f"((length(content) - length(replace(content, '{p}', ''))) // {len(p)})" for p, *_ in talks.ISSUES) + ")"


def _chain(x: str, table) -> str:
    for old, new in table:
        old_sql = "||".join(f"chr({ord(ch)})" for ch in old)
        x = f"replace({x}, {old_sql}, {_RX(new)})"
    return x


_NOTES = "coalesce(" + ", ".join(rf"CASE WHEN {_S(f'regexp_extract(content, {_RX(chr(40) + f"?is){chr(92)}n{n}?{chr(92)}s*{chr(92)}n(.*)$")}, 1)')} <> '' THEN 'Notes' || chr(10) || {_S(f'regexp_extract(content, {_RX(chr(40) + f"?is){chr(92)}n{n}?{chr(92)}s*{chr(92)}n(.*)$")}, 1)')} END" for n in ("Notes", "References", "Footnotes")) + ")"
_ODD_NOTES = f"CASE doc_id % 3 WHEN 0 THEN {_NOTES} || chr(10) || '  ' || chr(10) ELSE {_NOTES} END"
_TITLE = f"{_S(f'''list_filter({_L}, lambda x: NOT regexp_matches(lower(x), 'authenticating|contents|session|april|october') AND NOT regexp_matches({_S('x')}, 'By |Elder |President |Bishop |Sister |Of the Quorum|Of the First|Of the Seventy') AND length({_S('x')}) > 3 AND NOT regexp_matches({_S('x')}, '^[0-9]+$'))[1]''')}"
_LASTOF = lambda e: f"list_filter(list_transform({_HEAD}, lambda x: {e}), lambda x: x <> '')[-1]"
_ANALYZED = f"""SELECT doc_id, content, {_S(f"list_filter({_L}, lambda x: {_S('x')} <> '' AND NOT regexp_matches(x, 'Authenticating|Contents|Session'))[1]")} AS title, {_LASTOF(f"regexp_extract(x, {_RX(talks.AUTHORS[1])}, 0)")} AS author,
    {_LASTOF(f"CASE WHEN regexp_extract(x, {_RX(talks.TITLES[0])}, 0) <> '' THEN regexp_extract(x, {_RX(talks.TITLES[0])}, 0) ELSE regexp_extract(x, {_RX(talks.TITLES[1])}, 0) END")} AS author_title,
    {_LASTOF(f"CASE WHEN regexp_extract(x, {_RX(talks.DATES[0])}, 0) <> '' THEN regexp_extract(x, {_RX(talks.DATES[0])}, 0) ELSE regexp_replace(regexp_extract(x, {_RX(talks.DATES[1])}, 0), '\\s+', ' ', 'g') END")} AS date FROM ({TALKS})"""
_TOC_COUNT = " + ".join(f"regexp_matches(array_to_string({_L}[1:20], chr(10)), {_RX(p)})::INT" for p in talks.TOC)
_TYPE = f"""SELECT doc_id, CASE WHEN {_ANY(talks.SESSIONS, 'name')} THEN 'session_header' WHEN contains(name, 'contents') THEN 'contents_page'
    WHEN NOT regexp_matches(line, '^[0-9]{{1,2}}:[0-9]{{2}}[A-Za-z]') AND toc >= 2 AND NOT author AND n <= 3 THEN 'table_of_contents' WHEN lower(line) = 'contents' THEN 'contents_page'
    WHEN titled AND author AND n < 3 AND cites > n THEN 'citations_only'
    WHEN contains(path, 'liahona') AND author AND titled AND n > 10 THEN CASE WHEN regexp_matches(content, 'Making Friends|By \\w+ \\w+\\s*Church Magazines') THEN 'magazine_profile' ELSE 'liahona_article' END
    WHEN contains(path, 'liahona') AND n < 5 THEN 'short_remarks' WHEN NOT contains(path, 'liahona') AND contains(path, 'general-conference') AND author AND titled THEN CASE WHEN n < 5 THEN 'short_remarks' ELSE 'conference_talk' END
    WHEN author AND titled AND n > 3 THEN 'conference_talk' WHEN titled AND n > 1 THEN 'short_remarks' ELSE 'invalid' END AS content_type
    FROM (SELECT *, lower(string_split(path, '/')[-1]) AS name, {_FIRST} AS line, {_AUTHOR} AS author, {_LONG} AS n, length({_FIRST}) > 5 AS titled, {_TOC_COUNT} AS toc,
    len(list_filter({_L}, lambda x: regexp_matches({_S('x')}, '^\\d+\\.|^See |^".*?"|^\\w+\\s+\\d+:'))) AS cites FROM ({TALKS}))"""
_BODY = f"""SELECT doc_id, {_S("array_to_string(ls[start + 1:stop], chr(10))")} AS body FROM (SELECT doc_id, ls,
    coalesce(list_filter(list_transform(ls, lambda x, i: CASE WHEN {_S('x')} <> '' AND NOT (i <= 5 AND (regexp_matches(x, 'By |Elder |President |Bishop |Sister |Of the Quorum|Of the First|Of the Seventy|Of the Presiding') OR regexp_matches({_S('x')}, '^(April|October) [0-9]{{4}}'))) THEN i - 1 ELSE -1 END), lambda i: i >= 0)[1], 0) AS start,
    coalesce(list_filter(list_transform(ls, lambda x, i: CASE WHEN regexp_matches({_S('x')}, '(?i)^notes?$') THEN i - 1 ELSE -1 END), lambda i: i >= 0)[-1], len(ls)) AS stop FROM (SELECT doc_id, {_L} AS ls FROM ({TALKS})))"""

ORACLES = {
    "encoding_fix": f"SELECT doc_id, {_chain('content', talks.ENCODING)} AS content FROM ({TALKS})",
    "encoding_fix_scraper": f"SELECT doc_id, {_chain('content', talks.SCRAPER_ENCODING)} AS content FROM ({TALKS})",
    "encoding_issue_counts": f"SELECT doc_id, {_ISSUE}::INT AS issues FROM ({TALKS})",
    # parts between the occurrences of a pattern: the n-th begins behind the lengths of those before it
    "encoding_issue_positions": " UNION ALL ".join(
        f"""SELECT doc_id, (sum(n) OVER (PARTITION BY doc_id ORDER BY i) + (i - 1) * {len(p)})::INT AS position, '{p}' AS original, {_RX(f)} AS suggested_fix, {x}::DOUBLE AS confidence
        FROM (SELECT doc_id, unnest(list_transform(ps[:-2], lambda y: length(y))) AS n, unnest(range(1, len(ps))) AS i FROM (SELECT doc_id, string_split(content, '{p}') AS ps FROM ({TALKS}) WHERE contains(content, '{p}')))"""
        for p, f, x in talks.ISSUES
    ),
    "timestamp_strip": rf"SELECT doc_id, CASE WHEN x = '' THEN l ELSE x END AS title FROM (SELECT doc_id, {_L}[1] AS l, {_S(f'''regexp_replace({_L}[1], '^[0-9]{{1,2}}:[0-9]{{2}}', '')''')} AS x FROM ({TALKS}))",
    "normalize_ws": rf"""SELECT doc_id, regexp_replace(array_to_string(list_transform(string_split(regexp_replace(content, '\n\s*\n\s*\n', chr(10) || chr(10), 'g'), chr(10)), lambda x: rtrim(x)), chr(10)), '^\n+|\s+$', '', 'g') AS content FROM ({TALKS})""",
    "artifact_clean": rf"""SELECT doc_id, regexp_replace(regexp_replace(array_to_string(list_transform(ls, lambda x, i: CASE WHEN i BETWEEN 3 AND 10 AND len(ls) > 2 AND {_S('x')} = {_S('ls[1]')} THEN '' ELSE x END), chr(10)), '[â]{{2,}}', '"', 'g'), '\.{{4,}}', '...', 'g') AS content
        FROM (SELECT doc_id, string_split(regexp_replace(regexp_replace(content, '(?m)^\d{{1,2}}:\d{{2}}\s*$', '', 'g'), '(?m)^\d{{1,2}}:\d{{2}}\s+(Session|Morning|Afternoon|Evening)\b.*$', '', 'g'), chr(10)) AS ls FROM ({TALKS}))""",
    "doc_type_detect": _TYPE,
    "structure_report": f"""SELECT doc_id, has_title, has_author, has_date, has_body, has_notes, toc_contamination, duplicate_title, line_count, array_to_string(list_filter([CASE WHEN toc_contamination THEN 'Table of contents contamination detected' END, CASE WHEN duplicate_title THEN 'Duplicate title found' END,
        CASE WHEN NOT has_title THEN 'Missing title' END, CASE WHEN NOT has_author THEN 'Missing author information' END, CASE WHEN NOT has_date THEN 'Missing date information' END, CASE WHEN NOT has_body THEN 'Insufficient body content' END, CASE WHEN n > 0 THEN 'Found ' || n || ' encoding issues' END], lambda x: x IS NOT NULL), '; ') AS issues
        FROM (SELECT doc_id, {_FIRST} <> '' AS has_title, {_AUTHOR} AS has_author, len(list_filter({_HEAD}, lambda x: {_ANY(talks.DATES, 'x')})) > 0 AS has_date, {_LONG} > 3 AS has_body, len(list_filter({_L}[-20:], lambda x: regexp_matches(x, 'Notes|notes'))) > 0 AS has_notes,
        {_ANY(talks.TOC, 'content')} AS toc_contamination, {_FIRST} <> '' AND (length(content) - length(replace(content, {_FIRST}, ''))) / greatest(length({_FIRST}), 1) > 1 AS duplicate_title, len({_L})::INT AS line_count, {_ISSUE} AS n FROM ({TALKS}))""",
    "metadata_analyze": f"SELECT doc_id, title, author, author_title, date FROM ({_ANALYZED})",
    "metadata_validate": f"SELECT doc_id, coalesce(length({_S('title')}) >= 3 AND regexp_matches(author, 'Elder|President|Bishop|Sister') AND (date IS NULL OR regexp_extract(date, '^(April|October) ([0-9]{{4}})', 2) = '' OR try_cast(regexp_extract(date, '^(April|October) ([0-9]{{4}})', 2) AS INT) BETWEEN 1970 AND {YEAR + 1}), false) AS valid FROM ({_ANALYZED})",
    "date_parse": rf"""SELECT doc_id, CASE WHEN regexp_matches(content, '(?i)(April|October)\s+\d{{4}}') THEN regexp_extract(content, '(?i)(April|October)\s+(\d{{4}})', 1) || ' ' || regexp_extract(content, '(?i)(April|October)\s+(\d{{4}})', 2)
        WHEN regexp_matches(content, '(?i)\d{{4}}\s+(April|October)') THEN regexp_extract(content, '(?i)(\d{{4}})\s+(April|October)', 2) || ' ' || regexp_extract(content, '(?i)(\d{{4}})\s+(April|October)', 1)
        WHEN regexp_extract(path, '(\d{{4}})-(\d{{2}})', 2) = '04' THEN 'April ' || regexp_extract(path, '(\d{{4}})-(\d{{2}})', 1) WHEN regexp_extract(path, '(\d{{4}})-(\d{{2}})', 2) = '10' THEN 'October ' || regexp_extract(path, '(\d{{4}})-(\d{{2}})', 1)
        WHEN regexp_matches(path, '\d{{4}}') AND regexp_matches(lower(path), 'april|04') THEN 'April ' || regexp_extract(path, '(\d{{4}})', 1) WHEN regexp_matches(path, '\d{{4}}') AND regexp_matches(lower(path), 'october|10') THEN 'October ' || regexp_extract(path, '(\d{{4}})', 1) END AS date FROM ({TALKS})""",
    "title_detect": f"SELECT doc_id, {_TITLE} AS title FROM ({TALKS})",
    "body_extract": _BODY,
    "notes_extract": f"SELECT doc_id, {_NOTES} AS notes FROM ({TALKS})",
    # a line is kept if it isn't blank, or if the one before it isn't and some line before that was kept
    "notes_format": f"""SELECT doc_id, CASE WHEN coalesce(notes, '') = '' THEN '' ELSE array_to_string(list_transform(list_filter(list_transform(ls, lambda x, i: {{'x': x, 'p': CASE WHEN i > 1 THEN ls[i - 1] ELSE '' END}}), lambda z: z.x <> '' OR z.p <> ''), lambda z: z.x), chr(10)) END AS notes
        FROM (SELECT doc_id, notes, list_transform(string_split(notes, chr(10)), lambda x: {_S('x')}) AS ls FROM (SELECT doc_id, {_ODD_NOTES} AS notes FROM ({TALKS})))""",
    "reference_format": r"SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(content, '(\d+)\s+([A-Za-z]+)\s+(\d+):(\d+)', '\1 \2 \3:\4', 'g'), '(D&C)\s+(\d+):(\d+)', '\1 \2:\3', 'g'), '(\d+)\s+([A-Za-z]+)\.\s+(\d+):(\d+)', '\1 \2. \3:\4', 'g') AS content FROM (" + TALKS + ")",
    "format_standard": rf"""SELECT doc_id, {_S(rf"regexp_replace(regexp_replace(regexp_replace(f, '\n\s*\n\s*\n', chr(10) || chr(10), 'g'), '(?m)^BODY:\s*\n\s*', 'BODY:' || chr(10), 'g'), '\nNotes\s*\n\s*\n', chr(10) || 'Notes' || chr(10), 'g')")} AS formatted FROM (SELECT doc_id, coalesce('DATE: ' || date || chr(10), '') || 'TITLE: ' || coalesce(title, 'Unknown Title') || chr(10) || 'AUTHOR: ' || coalesce(author, 'Unknown Author') || coalesce(chr(10) || 'AUTHOR TITLE: ' || author_title, '') || chr(10) || 'BODY:' || chr(10) || content AS f FROM ({_ANALYZED}))""",
    "reformat_eligible": rf"SELECT doc_id, path FROM ({TALKS}) WHERE NOT regexp_matches(path, 'session\.txt$|sessionlangeng\.txt$') AND replace(path, '.txt', '_formatted.txt') NOT IN (SELECT replace(path, '.txt', '_formatted.txt') FROM ({TALKS}) WHERE doc_id % 5 = 0)",
}


def _named(x: str) -> str:
    line = _S(x)
    two = lambda p: f"CASE WHEN regexp_matches({line}, {_RX(p)}) THEN {_S(f'''regexp_extract({line}, {_RX(p)}, 1) || ' ' || regexp_extract({line}, {_RX(p)}, 2)''')} END"
    return f"coalesce({two(talks.SPEAKERS[0])}, {two(talks.SPEAKERS[1])}, CASE WHEN regexp_matches({line}, {_RX(talks.SPEAKERS[2])}) THEN {_S(f'regexp_extract({line}, {_RX(talks.SPEAKERS[2])}, 1)')} END, '')"


_OFFICE = "coalesce(" + ", ".join(f"nullif(regexp_extract({_S('x')}, {_RX(p)}, 1), '')" for p in talks.SPEAKER_TITLES) + ")"
_SPEAKER = f"""SELECT doc_id, content, hit.a AS author, CASE WHEN hit IS NOT NULL THEN list_filter(list_transform(ls[hit.i:hit.i + 4], lambda x: {_OFFICE}), lambda x: x IS NOT NULL)[1] END AS author_title
    FROM (SELECT doc_id, content, ls, list_filter(list_transform(ls[1:20], lambda x, i: {{'i': i, 'a': {_named('x')}}}), lambda h: h.a <> '')[1] AS hit FROM (SELECT doc_id, content, {_L} AS ls FROM ({TALKS})))"""
_INFERRED = "CASE WHEN contains(author_title, 'Quorum of the Twelve Apostles') THEN 'Of the Quorum of the Twelve Apostles' WHEN contains(author_title, 'First Presidency') THEN 'Of the First Presidency' WHEN contains(author_title, 'Seventy') THEN 'Of the Seventy' WHEN contains(author_title, 'Presiding Bishopric') THEN 'Of the Presiding Bishopric' ELSE author_title END"
ORACLES |= {
    "metadata_extract": f"SELECT doc_id, {_TITLE} AS title, author, author_title FROM ({_SPEAKER})",
    "metadata_infer": rf"SELECT doc_id, {_S(r'''regexp_replace(regexp_replace(author, '\s+(Elder|President|Bishop|Sister)\s+', ' ', 'g'), '\s+', ' ', 'g')''')} AS author, {_INFERRED} AS author_title FROM ({_SPEAKER})",
}


# ---- whole texts: cleaning in order, and reformatting as a join of its parts, each over the cleaned talks


def _over(name: str, view: str) -> str:
    return ORACLES[name].replace(f"({TALKS})", f"({view})")


def _without_contents(x: str) -> str:
    # a pattern that looks ahead takes what it sees and puts it back; repeated, as what it takes may begin the next match
    for p in talks.TOC_REMOVED:
        if "(?=" in p:
            again = f"(?ms){p.replace('(?=', '(')}"
            for _ in range(3):
                x = f"regexp_replace({x}, {_RX(again)}, '\\1', 'g')"
        else:
            x = f"regexp_replace({x}, {_RX('(?ms)' + p)}, '', 'g')"
    return x


_SIGNS = "regexp_matches(lower({}), 'contents|session|authenticating')".format
_BYLINE = r"(regexp_matches({0}, '^By (Elder|President|Bishop|Sister) ') OR regexp_matches({0}, '^(Elder|President|Bishop|Sister)\s+[A-Z]'))".format


def _toc(view: str) -> str:
    begin = f"""CASE WHEN {_S('x')} = '' OR {_SIGNS(_S('x'))} THEN -1 WHEN length({_S('x')}) > 10 AND NOT ends_with({_S('x')}, ':') AND coalesce({_BYLINE(_S('ls[i + 1]'))}, false) THEN i - 1
        WHEN {_BYLINE(_S('x'))} THEN CASE WHEN i > 1 AND {_S('ls[i - 1]')} <> '' THEN i - 2 ELSE i - 1 END ELSE -1 END"""
    return f"""SELECT doc_id, path, {_S(f"CASE WHEN stamped OR len(list_filter(ls[1:10], lambda x: {_SIGNS('x')})) = 0 THEN r ELSE array_to_string(ls[coalesce(list_filter(list_transform(ls, lambda x, i: {begin}), lambda i: i >= 0)[1], 0) + 1:], chr(10)) END")} AS content
        FROM (SELECT doc_id, path, r, stamped, string_split(r, chr(10)) AS ls FROM (SELECT doc_id, path, regexp_matches({_FIRST}, {_RX(talks.STAMPED)}) AS stamped, {_without_contents('content')} AS r FROM ({view})))"""


def _step(name: str, view: str) -> str:
    """An oracle of one text as a step that keeps the path."""
    return f"SELECT v.doc_id, v.path, w.content FROM ({view}) v JOIN ({_over(name, view)}) w ON v.doc_id = w.doc_id"


def _processed(view: str) -> str:
    return _step("normalize_ws", _step("artifact_clean", _toc(_step("encoding_fix", view))))


def _split(view: str) -> str:
    whole = _processed(view)
    at = "(length(content) - strpos(reverse(lower(content)), 'seton') - 4)"
    return f"""SELECT p.doc_id, CASE WHEN p.notes IS NOT NULL AND contains(lower(p.content), 'notes') AND p.at > 0 THEN {_S('substr(p.content, 1, p.at)')} ELSE b.body END AS body, p.notes
        FROM (SELECT doc_id, content, {at} AS at, {_NOTES} AS notes FROM ({whole})) p JOIN ({_over('body_extract', whole)}) b ON p.doc_id = b.doc_id"""


_BLOCK = r"General Conference\s+\w+\s+\d{4}\s+general conference.*?\w+\s*October \d{4} general conference"
_STAMP = r"^[0-9]{1,2}:[0-9]{2}"
_PLACES = lambda ls, cond: f"list_filter(list_transform({ls}, lambda x, i: CASE WHEN {cond} THEN i ELSE 0 END), lambda i: i > 0)[1]"
_CLEAN = f"""SELECT doc_id, path, CASE WHEN regexp_matches({_S('ls[1]')}, {_RX(talks.STAMPED)}) THEN {_S(f"regexp_replace(ls[1], '{_STAMP}', '')")} || substr(content, length(ls[1]) + 1)
    WHEN NOT {_ANY(talks.TOC, 'substr(content, 1, 1000)')} THEN content ELSE coalesce(CASE WHEN rs IS NOT NULL AND {_PLACES('rs', f"length({_S('x')}) > 5")} IS NOT NULL THEN array_to_string(rs[{_PLACES('rs', f"length({_S('x')}) > 5")}:], chr(10)) END,
        CASE WHEN stamp IS NOT NULL THEN array_to_string(list_prepend(regexp_extract({_S('ls[stamp]')}, '{_STAMP}(.+)', 1), ls[stamp + 1:]), chr(10)) WHEN again IS NOT NULL THEN array_to_string(ls[again:], chr(10)) END, content) END AS content
    FROM (SELECT *, {_PLACES('ls', f"regexp_matches({_S('x')}, '{_STAMP}.+')")} AS stamp, {_PLACES('ls', f"i > 10 AND i <= 100 AND length(title) > 10 AND ({_S('x')} = title OR {_S('x')} = bare OR (contains({_S('x')}, bare) AND length({_S('x')}) < length(bare) + 10))")} AS again
    FROM (SELECT *, {_S(f"regexp_replace(title, '{_STAMP}', '')")} AS bare FROM (SELECT doc_id, path, content, {_L} AS ls, {_FIRST} AS title, CASE WHEN regexp_matches(content, {_RX('(?s)' + _BLOCK)}) THEN string_split({_S(f"regexp_replace(content, {_RX('(?s)^.*?' + _BLOCK)}, '')")}, chr(10)) END AS rs FROM ({TALKS}))))"""
_FORMAT_NOTES = f"array_to_string(list_transform(list_filter(list_transform(ns, lambda x, i: {{'x': x, 'p': CASE WHEN i > 1 THEN ns[i - 1] ELSE '' END}}), lambda z: z.x <> '' OR z.p <> ''), lambda z: z.x), chr(10))"
_PARTS = f"""SELECT k.doc_id, k.path, y.content_type, i.author, i.author_title, CASE WHEN {_S(rf"regexp_replace(h.title, '{_STAMP}', '')")} = '' THEN h.title ELSE {_S(rf"regexp_replace(h.title, '{_STAMP}', '')")} END AS title, e.date, s.issues, n.body, n.notes, list_transform(string_split(n.notes, chr(10)), lambda x: {_S('x')}) AS ns
    FROM ({_CLEAN}) k JOIN ({_TYPE}) y ON k.doc_id = y.doc_id JOIN ({_over('metadata_infer', _CLEAN)}) i ON k.doc_id = i.doc_id JOIN ({_over('title_detect', _CLEAN)}) h ON k.doc_id = h.doc_id JOIN ({_over('date_parse', _CLEAN)}) e ON k.doc_id = e.doc_id
    JOIN ({_over('structure_report', _CLEAN)}) s ON k.doc_id = s.doc_id JOIN ({_split(_CLEAN)}) n ON k.doc_id = n.doc_id"""
_TIDY = lambda f: _S(rf"regexp_replace(regexp_replace(regexp_replace({f}, '\n\s*\n\s*\n', chr(10) || chr(10), 'g'), '(?m)^BODY:\s*\n\s*', 'BODY:' || chr(10), 'g'), '\nNotes\s*\n\s*\n', chr(10) || 'Notes' || chr(10), 'g')")
_REFERENCES = lambda f: rf"regexp_replace(regexp_replace(regexp_replace({f}, '(\d+)\s+([A-Za-z]+)\s+(\d+):(\d+)', '\1 \2 \3:\4', 'g'), '(D&C)\s+(\d+):(\d+)', '\1 \2:\3', 'g'), '(\d+)\s+([A-Za-z]+)\.\s+(\d+):(\d+)', '\1 \2. \3:\4', 'g')"
_DRAWN = f"""SELECT *, {_REFERENCES(_TIDY('f'))} AS formatted FROM (SELECT *, coalesce('DATE: ' || date || chr(10), '') || 'TITLE: ' || coalesce(title, 'Unknown Title') || chr(10) || 'AUTHOR: ' || coalesce(author, 'Unknown Author') || coalesce(chr(10) || 'AUTHOR TITLE: ' || author_title, '') || chr(10) || 'BODY:' || chr(10) || body
    || CASE WHEN notes IS NULL THEN '' WHEN ends_with(body, chr(10)) THEN {_FORMAT_NOTES} ELSE chr(10) || {_FORMAT_NOTES} END AS f FROM ({_PARTS}))"""
_LEAST = "CASE content_type " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in talks.MIN_BODY.items()) + " ELSE 100 END"
_FINE = f"(regexp_matches(formatted, '(?m)^TITLE: .+') AND regexp_matches(formatted, '(?m)^AUTHOR: .+') AND regexp_matches(formatted, '(?m)^BODY:') AND length({_S("substr(formatted, strpos(formatted, 'BODY:') + 5)")}) >= {_LEAST})"
_KNOWN = f"coalesce(length({_S('title')}) >= 3 AND regexp_matches(author, 'Elder|President|Bishop|Sister') AND (date IS NULL OR regexp_extract(date, '^(April|October) ([0-9]{{4}})', 2) = '' OR try_cast(regexp_extract(date, '^(April|October) ([0-9]{{4}})', 2) AS INT) BETWEEN 1970 AND {YEAR + 1}), false)"
_SKIP = "content_type IN (" + ", ".join(f"'{k}'" for k in talks.SKIPPED) + ")"
_RESULTS = f"""SELECT doc_id, path, content_type, NOT {_SKIP} AS success, CASE WHEN {_SKIP} THEN 'Skipped ' || content_type || ' content' ELSE 'Successfully processed' END AS message,
    CASE WHEN {_SKIP} THEN '' ELSE array_to_string(list_concat(list_transform(CASE WHEN issues = '' THEN []::VARCHAR[] ELSE string_split(issues, '; ') END, lambda x: 'Structure issue: ' || x), CASE WHEN NOT {_KNOWN} THEN ['Missing essential metadata'] ELSE [] END, CASE WHEN NOT {_FINE} THEN ['Output validation failed'] ELSE [] END), '; ') END AS warnings,
    CASE WHEN NOT {_SKIP} THEN formatted END AS formatted, CASE WHEN NOT {_SKIP} THEN regexp_replace(path, '\\.txt$', '_formatted.txt') END AS output_path FROM ({_DRAWN})"""
_ELIGIBLE = ORACLES["reformat_eligible"]
_MENDED = _chain("content", talks.SCRAPER_ENCODING)
_HAS = lambda x, parts: "(" + " OR ".join(f"contains({x}, {_RX(p)})" for p in parts) + ")"
_LISTED = "CASE " + " ".join(f"WHEN contains(x, {_RX(p)}) THEN {_RX(p)}" for p in talks.LISTED_TITLES) + " END"
_HITS = lambda what: f"list_filter(list_transform(st, lambda x, i: {{'i': i, 't': {what}}}), lambda h: h.t IS NOT NULL)[1]"
ORACLES |= {
    "toc_clean": f"SELECT doc_id, content FROM ({_toc(TALKS)})",
    "text_process": f"SELECT doc_id, content FROM ({_processed(TALKS)})",
    "clean_content": f"SELECT doc_id, content FROM ({_CLEAN})",
    "notes_split": _split(TALKS),
    "output_validate": f"SELECT doc_id, {_FINE} AS valid FROM ({_DRAWN}) WHERE NOT {_SKIP}",
    "reformat_e2e": _RESULTS,
    "reformat_stats": f"SELECT content_type, count(*) AS processed, count(*) FILTER (WHERE success) AS successful, count(*) FILTER (WHERE NOT success) AS skipped, 0::BIGINT AS failed, count(*) FILTER (WHERE warnings <> '') AS warned FROM ({_RESULTS}) GROUP BY content_type",
    "reformat_failures": f"SELECT count(*) AS failed FROM ({_TYPE}) WHERE {_SKIP} AND content_type <> 'invalid'",
    "reformat_backup": f"SELECT path || '.backup' AS path, content FROM ({TALKS}) WHERE doc_id % 7 > 0",
    "reformat_dry_run": f"SELECT count(*) AS found, (SELECT count(*) FROM ({_ELIGIBLE})) AS eligible FROM ({TALKS})",
    "metadata_all": f"SELECT s.doc_id, s.title, s.author, s.author_title, d.date FROM ({ORACLES['metadata_extract']}) s JOIN ({ORACLES['date_parse']}) d ON s.doc_id = d.doc_id",
    "conference_clean": f"""SELECT doc_id, CASE WHEN NOT contains(substr(content, 1, 500), 'Conference') THEN content WHEN start IS NULL THEN m ELSE array_to_string(list_concat(list_filter([title.t, speaker.t, CASE WHEN speaker IS NOT NULL THEN list_filter(st[speaker.i + 1:speaker.i + 4], lambda x: {_HAS('x', talks.OFFICES)})[1] END, '{talks.CONFERENCE_DATE}', ''], lambda x: x IS NOT NULL),
        list_filter(st[start:], lambda x: x <> '' AND NOT starts_with(x, '→') AND NOT contains(x, '16:36'))), chr(10)) END AS content
        FROM (SELECT *, coalesce({_HITS(f"CASE WHEN length(x) > 50 AND regexp_matches(lower(x), {_RX('|'.join(talks.OPENINGS))}) THEN x END")}.i, {_PLACES('st', 'i >= title.i + 5 AND length(x) > 80')}) AS start
        FROM (SELECT *, coalesce({_HITS(f"CASE WHEN {_HAS('x', talks.LISTED_MARKS)} AND length(x) > 15 THEN {_LISTED} END")}, {_HITS(f"CASE WHEN length(x) > 20 AND contains(x, ':') AND NOT {_SIGNS('x')} THEN x END")}, {{'i': 1, 't': 'Unknown Talk'}}) AS title, {_HITS("CASE WHEN regexp_matches(x, '^By (Elder|President|Sister)') THEN x END")} AS speaker
        FROM (SELECT doc_id, content, m, list_transform(string_split(m, chr(10)), lambda x: {_S('x')}) AS st FROM (SELECT doc_id, content, {_MENDED} AS m FROM (SELECT doc_id, {_CONFERENCE} AS content FROM ({TALKS}))))))""",
}

# every seventh text can't be read: it fails as an invalid one, is neither skipped nor warned of
QUERIES["reformat_stats_unread"] = lambda s, d: reformat.stats(reformat.reformat(talk_view(s, d).withColumn("content", F.when(c("doc_id") % 7 > 0, c("content"))), YEAR))
ORACLES["reformat_stats_unread"] = f"""SELECT CASE WHEN doc_id % 7 = 0 THEN 'invalid' ELSE content_type END AS content_type, count(*) AS processed, count(*) FILTER (WHERE success AND doc_id % 7 > 0) AS successful,
    count(*) FILTER (WHERE NOT success AND doc_id % 7 > 0) AS skipped, count(*) FILTER (WHERE doc_id % 7 = 0) AS failed, count(*) FILTER (WHERE warnings <> '' AND doc_id % 7 > 0) AS warned FROM ({_RESULTS}) GROUP BY 1"""

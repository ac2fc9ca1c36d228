"""Cleaning, structure and metadata of talk texts: encodings, contents tables, notes, titles, speakers, dates.

All are expressions over the text or its lines. Patterns use the Java flag d where a dot must exclude line
feeds only, and m where anchors stand for lines.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.base import BLANK, first, let, lines, occurrences, strip

# fixed values: replacements of mis-decoded sequences, in order; only the first matching form of a character counts
ENCODING = [("â", "–"), ("Ã©", "é"), ("Ã", "À"), ("â¦", "…"), ("Â", " "), ("\x80\x9c", '"'), ("\x80\x9d", '"'), ("\x80\x94", "—"), ("\x80\x99", "'"), ("\x80\x93", "–"), ("\x80\x98", "'"), ("\x80\xa6", "…"), ("\x80\xa0", " ")]
# fixed values: the scraper's own shorter table
SCRAPER_ENCODING = [("â", '"'), ("Ã©", "é"), ("Ã", "À"), ("Â", " ")]
# fixed values: (pattern, fix, confidence) of issues reported, every row on its own
ISSUES = [("â", '"', 0.95), ("â", '"', 0.95), ("â", "'", 0.95), ("Ã©", "é", 0.9), ("Ã", "À", 0.85), ("â¦", "…", 0.9), ("â", "—", 0.9), ("Â", " ", 0.85), ("â", "–", 0.85), ("Ã¡", "á", 0.9), ("Ã³", "ó", 0.9)]
# fixed values: signs of a table of contents
TOC = [r"Authenticating\.\.\.", r"\d{4}[â—–-]\d{4}", "ContentsSaturday Morning Session", "Saturday Morning SessionThe", "Sunday Afternoon SessionThe", "Contents(Saturday|Sunday|Priesthood)", r"^Contents\s*$", "ContentsContents", r"\d{4}\s+(January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{4}Contents", r"General Conference\s+\w+\s+\d{4}\s+general conference", "Contents.*?Session.*?Session", r"\w+\s*October \d{4} general conference"]
# fixed values: what is removed of a table of contents, over lines and across them
TOC_REMOVED = [r"Authenticating\.\.\.\s*", r"\d{4}â\d{4}\s+", r"General Conference\s+\w+\s+\d{4}\s+general conference.*?\w+\s*October \d{4} general conference", r"Contents\s*", "Saturday Morning Session.*?Sunday Afternoon Session", r"(?:Saturday|Sunday) (?:Morning|Afternoon) Session.*?(?=\n\n|\n[A-Z])", r"(?:Priesthood|Relief Society|Young Women) Session.*?(?=\n\n|\n[A-Z])", r"^.*?Session\s*.*?(?=\n\n[A-Z][a-z].*?\n)", r"^\s*(?:The |Elder |President |Bishop |Sister ).*?(?:Quorum|Presidency|Seventy|Bishopric)\s*$", r"^\s*\d{1,2}:\d{2}.*$"]
# fixed values: authors, their titles, dates
AUTHORS = ["By (Elder|President|Bishop|Sister) ([^\n]+)", "(Elder|President|Bishop|Sister) ([^\n]+)"]
TITLES = ["Of the (Quorum of the Twelve Apostles|First Presidency|Seventy)", "Of the (Presiding Bishopric|Relief Society|Young Women)"]
DATES = [r"(April|October) (\d{4})", r"(\d{4})\s+(April|October)"]
SPEAKERS = [r"By\s+(Elder|President|Bishop|Sister)\s+([^\n\r]+?)(?:\n|$)", r"^(Elder|President|Bishop|Sister)\s+([^\n\r]+?)(?:\n|Of the)", r"By\s+([^\n\r]+?)(?:\n|$)"]
SPEAKER_TITLES = ["Of the (Quorum of the Twelve Apostles)", "Of the (First Presidency)", "Of the (Seventy)", "Of the (Presiding Bishopric)", "Of the (Relief Society General Presidency)", "Of the (Young Women General Presidency)", "Of the (Primary General Presidency)", "(Relief Society General President)", "(Young Women General President)", "(Primary General President)"]
SESSIONS = ["saturday-morning-session", "sunday-afternoon-session", "priesthood-session", "relief-society-session", "young-women-session", "general-young-women-meeting"]
HONORIFICS = ["Elder", "President", "Bishop", "Sister"]
# fixed values: shortest body by type, 100 for others
MIN_BODY = {"conference_talk": 500, "short_remarks": 100, "liahona_article": 300, "magazine_profile": 200, "citations_only": 50, "session_header": 50, "contents_page": 50, "table_of_contents": 50, "invalid": 50}
SKIPPED = ["session_header", "table_of_contents", "contents_page", "invalid"]
# how the patterns above that run from an opening to a closing text close, in their order; the others hold no such run
TOC_CLOSING = [None, None, r"\w+\s*October \d{4} general conference", None, "Sunday Afternoon Session", r"\n[\nA-Z]", r"\n[\nA-Z]", r"\n\n[A-Z][a-z].*?\n", r"(?:Quorum|Presidency|Seventy|Bishopric)\s*$", None]
# what texts hold that the patterns above match: one of these words; others aren't searched
TOC_WORDS = [["Authenticating..."], [], ["Contents"], ["Saturday Morning SessionThe"], ["Sunday Afternoon SessionThe"], ["Contents"], ["Contents"], ["Contents"], ["Contents"], ["General Conference"], ["Contents"], ["general conference"]]
TOC_REMOVED_WORDS = [["Authenticating..."], ["â"], ["general conference"], ["Contents"], ["Sunday Afternoon Session"], [" Session"], [" Session"], ["Session"], ["Quorum", "Presidency", "Seventy", "Bishopric"], [":"]]
#: Lines that are looked at before all others, where the first of a kind is wanted.
FEW = 40
# fixed value: a first line that begins with a time
STAMPED = r"^\d{1,2}:\d{2}[A-Za-z]"


def _replaced(text: Column, table: list[tuple[str, str]]) -> Column:
    for old, new in table:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def fix_encoding(text: Column, intent: bool = False) -> Column:
    """Replaces mis-decoded sequences; with `intent`, decodes UTF-8 read as Latin-1 anew where that is possible."""
    if intent:
        return F.when(text.rlike("[Â-ô][\u0080-¿]") & ~text.rlike("[^\u0000-ÿ]"), F.decode(F.encode(text, "ISO-8859-1"), "UTF-8")).otherwise(text)
    return _replaced(text, ENCODING)


def fix_scraper_encoding(text: Column) -> Column:
    return _replaced(text, SCRAPER_ENCODING)


def issue_count(text: Column) -> Column:
    total = F.lit(0)
    for pattern, n in Counter(p for p, *_ in ISSUES).items():
        total = total + occurrences(text, pattern) * n
    return total


def issues(text: Column) -> Column:
    """Array of (position, original, suggested_fix, confidence), by position, then in the table's order."""

    def hits(pattern: str, fix: str, confidence: float, order: int) -> Column:
        parts = F.split(text, pattern, -1)
        ends = F.aggregate(F.slice(parts, 1, F.size(parts) - 1), F.struct(F.array().cast("array<int>").alias("p"), F.lit(0).alias("at")), lambda a, x: F.struct(F.array_append(a["p"], a["at"] + F.length(x)).alias("p"), (a["at"] + F.length(x) + len(pattern)).alias("at")), lambda a: a["p"])
        return F.transform(ends, lambda p: F.struct(p.alias("position"), F.lit(order).alias("o"), F.lit(pattern).alias("original"), F.lit(fix).alias("suggested_fix"), F.lit(confidence).alias("confidence")))

    return F.array_sort(F.flatten(F.array(*[hits(*row, i) for i, row in enumerate(ISSUES)])))


def strip_stamp(title: Column) -> Column:
    """Without a leading mm:ss; the title itself where nothing else is left."""
    cut = strip(F.regexp_replace(title, r"^\d{1,2}:\d{2}", ""))
    return F.when(cut == "", title).otherwise(cut)


def normalize_whitespace(text: Column) -> Column:
    once = F.regexp_replace(text, r"\n\s*\n\s*\n", "\n\n")
    bare = F.regexp_replace(once, r"(?m)[^\S\n]+$", "")
    return F.rtrim(F.regexp_replace(bare, r"\A(?:[^\S\n]*\n)+", ""), F.lit(BLANK))


def clean_artifacts(text: Column) -> Column:
    """Without standalone and session time stamps, repeats of the title in lines 3 to 10, and runs of dots."""

    def untimed(t: Column) -> Column:
        alone = F.regexp_replace(t, r"(?md)^\d{1,2}:\d{2}\s*$", "")
        return F.when(t.rlike(r"(?md)^\d{1,2}:\d{2}\s"), F.regexp_replace(alone, r"(?md)^\d{1,2}:\d{2}\s+(Session|Morning|Afternoon|Evening)\b.*$", "")).when(t.rlike(r"(?md)^\d{1,2}:\d{2}$"), alone).otherwise(t)

    def deduped(ls: Column) -> Column:
        title = strip(F.get(ls, F.lit(0)))
        again = lambda x, i: F.when((i >= 2) & (i < 10) & (F.size(ls) > 2) & (strip(x) == title), "").otherwise(x)
        return F.array_join(F.transform(ls, again), "\n")

    t = let(lines(let(text, lambda t: F.when(~F.contains(t, F.lit(":")), t).otherwise(untimed(t)))), deduped)
    held = lambda t, part, p, to: let(t, lambda x: F.when(~F.contains(x, F.lit(part)), x).otherwise(F.regexp_replace(x, p, to)))
    return held(held(t, "ââ", "[â]{2,}", '"'), "....", r"\.{4,}", "...")


def _any(patterns: list[str], x: Column) -> Column:
    return F.array_max(F.array(*[x.rlike(p) for p in patterns]))


def _holds(x: Column, words: list[str]) -> Column:
    out = F.contains(x, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(x, F.lit(w))
    return out


def _toc_signs(x: Column) -> list[Column]:
    """Whether each pattern of TOC is found."""
    return [_holds(x, w) & x.rlike(f"(?d){p}") if w else x.rlike(f"(?d){p}") for p, w in zip(TOC, TOC_WORDS, strict=True)]


def _removed(text: Column, pattern: str, closing: str | None) -> Column:
    """`text` without the matches of a pattern, in time linear in its length.

    No match can end beyond the last place where the pattern can close, so only what lies before is searched; else each
    opening behind it would be followed to the end of the text. What runs to a heading's end opens with a session, too,
    so it is searched up to where the last session closes.
    """
    words = TOC_REMOVED_WORDS[TOC_REMOVED.index(pattern)]
    lacks = lambda t: ~_holds(t, words)
    if closing is None:
        return let(text, lambda t: F.when(lacks(t), t).otherwise(F.regexp_replace(t, f"(?ms){pattern}", "")))
    head = lambda t, p: F.regexp_extract(t, rf"(?ms)\A.*{p}", 0)

    def cut(t: Column) -> Column:
        last = let(head(t, closing), lambda h: head(h, rf"Session\s*.*?{closing}")) if pattern.startswith("^.*?Session") else head(t, closing)
        return let(last, lambda h: F.when(h == "", t).otherwise(F.concat(F.regexp_replace(h, f"(?ms){pattern}", ""), F.substr(t, F.length(h) + 1))))

    return let(text, lambda t: F.when(lacks(t), t).otherwise(cut(t)))


def clean_toc(text: Column, intent: bool = False) -> Column:
    """Removes tables of contents; what then still shows signs of one is cut to its title.

    The patterns' dots cross lines, so a line that begins with mm:ss takes the rest of the text with it; with
    `intent` they stay within lines.
    """
    t = text
    for p, closing in zip(TOC_REMOVED, TOC_CLOSING, strict=True):
        t = F.regexp_replace(t, f"(?m){p}", "") if intent else _removed(t, p, closing)

    # fixed values: signs of a table of contents, and lines that name an author
    def cut(ls: Column) -> Column:
        signs = lambda x: _any(["contents", "session", "authenticating"], F.lower(x))
        author = lambda x: x.rlike(r"^By (Elder|President|Bishop|Sister) ") | x.rlike(r"^(Elder|President|Bishop|Sister)\s+[A-Z]")
        at = lambda i: strip(F.get(ls, i))

        def begin(x: Column, i: Column) -> Column:
            line = strip(x)
            titled = (F.length(line) > 10) & ~F.endswith(line, F.lit(":")) & F.coalesce(author(at(i + 1)), F.lit(False))
            before = F.when((i > 0) & (F.coalesce(at(i - 1), F.lit("")) != ""), i - 1).otherwise(i)
            return F.when((line == "") | signs(line), F.lit(-1)).when(titled, i).when(author(line), before).otherwise(-1)

        starts = F.filter(F.transform(ls, begin), lambda i: i >= 0)
        start = F.coalesce(first(starts), F.lit(0))
        dirty = F.exists(F.slice(ls, 1, 10), signs)
        return F.when(dirty, F.array_join(F.slice(ls, start + 1, F.size(ls)), "\n")).otherwise(F.array_join(ls, "\n"))

    stamped = strip(F.substring_index(text, "\n", 1)).rlike(STAMPED)
    return let(t, lambda x: strip(F.when(stamped, x).otherwise(let(lines(x), cut))))


def process(text: Column) -> Column:
    return normalize_whitespace(clean_artifacts(clean_toc(fix_encoding(text))))


def notes(text: Column) -> Column:
    """The notes, under the heading Notes; null if there are none."""

    def after(low: Column, name: str) -> Column:
        rest = strip(F.regexp_extract(text, rf"(?is)\n{name}?\s*\n(.*)$", 1))
        return F.when(F.contains(low, F.lit(f"\n{name[:-1].lower()}")), let(rest, lambda r: F.when(r != "", F.concat(F.lit("Notes\n"), r))))

    return let(F.lower(text), lambda low: F.coalesce(*[after(low, n) for n in ("Notes", "References", "Footnotes")]))


def body(text: Column) -> Column:
    """What follows the metadata among the first five lines, up to the last line that says Notes."""

    def cut(ls: Column) -> Column:
        def keeps(x: Column, i: Column) -> Column:
            line = strip(x)
            meta = line.rlike("By |Elder |President |Bishop |Sister |Of the Quorum|Of the First|Of the Seventy|Of the Presiding") | line.rlike(r"^(April|October) \d{4}")
            return F.when((line != "") & ~((i < 5) & meta), i).otherwise(-1)

        begins = lambda some: first(F.filter(F.transform(some, keeps), lambda i: i >= 0))
        start = F.coalesce(begins(F.slice(ls, 1, FEW)), begins(ls), F.lit(0))
        ends = F.filter(F.transform(ls, lambda x, i: F.when(F.contains(F.lower(x), F.lit("note")) & strip(x).rlike("(?i)^notes?$"), i).otherwise(-1)), lambda i: i >= 0)
        end = F.coalesce(F.element_at(F.when(F.size(ends) > 0, ends), -1), F.size(ls))
        return strip(F.array_join(F.slice(ls, start + 1, F.greatest(end - start, F.lit(0))), "\n"))

    return let(lines(text), cut)


def split_notes(text: Column) -> Column:
    """(body, notes) of a processed text: notes after the first heading, body up to the last mention of notes."""

    def of(t: Column) -> Column:
        low = F.lower(t)
        at = F.length(t) - F.locate("seton", F.reverse(low)) - 4  # of the last occurrence, from 0
        has = F.contains(low, F.lit("notes")) & (at > 0)
        # the mention of notes is looked for only where there are some
        return let(notes(t), lambda n: F.struct(F.when(n.isNotNull() & has, strip(F.substring(t, F.lit(1), at))).otherwise(body(t)).alias("body"), n.alias("notes")))

    return let(process(text), of)


# ---- type and structure


def _head(text: Column, n: int) -> Column:
    return F.slice(lines(text), 1, n)


def has_author(text: Column) -> Column:
    return F.exists(_head(text, 30), lambda x: x.rlike(AUTHORS[1]))


def long_lines(text: Column) -> Column:
    return F.size(F.filter(lines(text), lambda x: F.length(strip(x)) > 50))


def doc_type(text: Column, path: Column) -> Column:
    """One of nine types by file name, contents signs, author, title and long lines."""
    name = F.lower(F.substring_index(path, "/", -1))
    line = strip(F.substring_index(text, "\n", 1))
    return let(F.struct(line.alias("line"), has_author(text).alias("author"), long_lines(text).alias("n")), lambda x: _typed(text, path, name, x["line"], x["author"], x["n"]))


def _typed(text: Column, path: Column, name: Column, line: Column, author: Column, n: Column) -> Column:
    def signs(head: Column) -> Column:
        total = F.lit(0)
        for x in _toc_signs(head):
            total = total + x.cast("int")
        return total

    toc, titled = let(F.array_join(_head(text, 20), "\n"), signs), F.length(line) > 5
    pure = ~line.rlike(STAMPED) & ~author & (n <= 3) & (toc >= 2)
    cites = F.size(F.filter(lines(text), lambda x: strip(x).rlike(r'^\d+\.|^See |^".*?"|^\w+\s+\d+:')))
    profile = text.rlike(r"Making Friends|By \w+ \w+\s*Church Magazines")
    liahona, conference = F.contains(path, F.lit("liahona")), F.contains(path, F.lit("general-conference"))
    return (
        F.when(_any(SESSIONS, name), "session_header")
        .when(F.contains(name, F.lit("contents")), "contents_page")
        .when(pure, "table_of_contents")
        .when(F.lower(line) == "contents", "contents_page")
        .when(titled & author & (n < 3) & (cites > n), "citations_only")
        .when(liahona & author & titled & (n > 10), F.when(profile, "magazine_profile").otherwise("liahona_article"))
        .when(liahona & (n < 5), "short_remarks")
        .when(~liahona & conference & author & titled, F.when(n < 5, "short_remarks").otherwise("conference_talk"))
        .when(author & titled & (n > 3), "conference_talk")
        .when(titled & (n > 1), "short_remarks")
        .otherwise("invalid")
    )


def structure(text: Column) -> Column:
    """Struct of what a text has and an array of its issues."""
    line = strip(F.substring_index(text, "\n", 1))
    title, author, full = line != "", has_author(text), long_lines(text) > 3
    date = F.exists(_head(text, 30), lambda x: x.rlike(DATES[0]) | x.rlike(DATES[1]))
    note = F.exists(F.slice(lines(text), F.greatest(F.size(lines(text)) - 19, F.lit(1)), F.lit(20)), lambda x: x.rlike("Notes|notes"))
    toc = F.lit(False)
    for x in _toc_signs(text):
        toc = toc | x
    again = title & (((F.length(text) - F.length(F.replace(text, line))) / F.greatest(F.length(line), F.lit(1))) > 1)
    # fixed values: what is said of each issue
    said = F.array_compact(
        F.array(
            F.when(toc, "Table of contents contamination detected"),
            F.when(again, "Duplicate title found"),
            F.when(~title, "Missing title"),
            F.when(~author, "Missing author information"),
            F.when(~date, "Missing date information"),
            F.when(~full, "Insufficient body content"),
            let(issue_count(text), lambda n: F.when(n > 0, F.concat(F.lit("Found "), n.cast("string"), F.lit(" encoding issues")))),
        )
    )
    parts = {"has_title": title, "has_author": author, "has_date": date, "has_body": full, "has_notes": note, "toc_contamination": toc, "duplicate_title": again, "line_count": F.size(lines(text)), "issues": said}
    return F.struct(*[v.alias(k) for k, v in parts.items()])


# ---- metadata


def analyzed(text: Column) -> Column:
    """(title, author, author_title, date) by the analyzer's rule: the last matching of the first thirty lines."""
    head = _head(text, 30)
    last = lambda xs: F.element_at(F.when(F.size(xs) > 0, xs), -1)
    shown = F.filter(lines(text), lambda x: (strip(x) != "") & ~x.rlike("Authenticating|Contents|Session"))
    author = F.filter(F.transform(head, lambda x: F.regexp_extract(x, AUTHORS[1], 0)), lambda x: x != "")
    titles = F.filter(F.transform(head, lambda x: F.coalesce(*[F.nullif(F.regexp_extract(x, p, 0), F.lit("")) for p in TITLES], F.lit(""))), lambda x: x != "")
    dated = F.filter(F.transform(head, lambda x: F.coalesce(F.nullif(F.regexp_extract(x, DATES[0], 0), F.lit("")), F.nullif(F.regexp_replace(F.regexp_extract(x, DATES[1], 0), r"\s+", " "), F.lit("")), F.lit(""))), lambda x: x != "")
    return F.struct(strip(first(shown)).alias("title"), last(author).alias("author"), last(titles).alias("author_title"), last(dated).alias("date"))


def parse_date(text: Column, path: Column) -> Column:
    """Month and year from the text, else from the path."""
    a = F.regexp_extract(text, r"(?i)(April|October)\s+(\d{4})", 1)
    b = F.regexp_extract(text, r"(?i)(\d{4})\s+(April|October)", 2)
    ym = F.regexp_extract(path, r"(\d{4})-(\d{2})", 2)
    year = F.regexp_extract(path, r"(\d{4})", 1)
    low = F.lower(path)
    return (
        F.when(a != "", F.concat_ws(" ", a, F.regexp_extract(text, r"(?i)(April|October)\s+(\d{4})", 2)))
        .when(b != "", F.concat_ws(" ", b, F.regexp_extract(text, r"(?i)(\d{4})\s+(April|October)", 1)))
        .when(ym == "04", F.concat(F.lit("April "), F.regexp_extract(path, r"(\d{4})-(\d{2})", 1)))
        .when(ym == "10", F.concat(F.lit("October "), F.regexp_extract(path, r"(\d{4})-(\d{2})", 1)))
        .when((year != "") & low.rlike("april|04"), F.concat(F.lit("April "), year))
        .when((year != "") & low.rlike("october|10"), F.concat(F.lit("October "), year))
    )


def speaker(text: Column) -> Column:
    """(author, author_title): the first of twenty lines that names one, and the title in the five from it on."""

    def named(x: Column) -> Column:
        line = strip(x)
        two = lambda p: F.when(line.rlike(p), strip(F.concat_ws(" ", F.regexp_extract(line, p, 1), F.regexp_extract(line, p, 2))))
        return F.coalesce(two(SPEAKERS[0]), two(SPEAKERS[1]), F.when(line.rlike(SPEAKERS[2]), strip(F.regexp_extract(line, SPEAKERS[2], 1))))

    def of(ls: Column) -> Column:
        found = F.filter(F.transform(F.slice(ls, 1, 20), lambda x, i: F.struct(i.alias("i"), named(x).alias("a"))), lambda x: x["a"].isNotNull() & (x["a"] != ""))
        hit = first(found)
        title = lambda x: F.coalesce(*[F.nullif(F.regexp_extract(strip(x), p, 1), F.lit("")) for p in SPEAKER_TITLES])
        near = F.filter(F.transform(F.slice(ls, F.coalesce(hit["i"], F.lit(0)) + 1, F.lit(5)), title), lambda x: x.isNotNull())
        return F.struct(hit["a"].alias("author"), F.when(hit.isNotNull(), first(near)).alias("author_title"))

    return let(lines(text), of)


def talk_title(text: Column) -> Column:
    def shown(x: Column) -> Column:
        line = strip(x)
        skip = F.lower(line).rlike("authenticating|contents|session|april|october") | line.rlike("By |Elder |President |Bishop |Sister |Of the Quorum|Of the First|Of the Seventy")
        return ~skip & (F.length(line) > 3) & ~line.rlike(r"^\d+$")

    return let(lines(text), lambda ls: strip(F.coalesce(first(F.filter(F.slice(ls, 1, FEW), shown)), first(F.filter(ls, shown)))))


def infer(author: Column, author_title: Column) -> Column:
    """(author, author_title) with repeated honorifics and spaces collapsed, and four titles in standard form."""
    a = strip(F.regexp_replace(F.regexp_replace(author, r"\s+(Elder|President|Bishop|Sister)\s+", " "), r"\s+", " "))
    t = author_title
    for name in reversed(["Quorum of the Twelve Apostles", "First Presidency", "Seventy", "Presiding Bishopric"]):
        t = F.when(F.contains(author_title, F.lit(name)), f"Of the {name}").otherwise(t)
    return F.struct(a.alias("author"), t.alias("author_title"))


# fixed values: of the scraper's conference cleaner: marks of a listed title, listed titles, what follows a speaker, openings, the date
LISTED_MARKS = ["Let Him Do It with Simplicity", "Christian Courage", "The Price of", "Go Ye Therefore", "You Know Enough", "Come What May"]
LISTED_TITLES = ["Let Him Do It with Simplicity", "Christian Courage: The Price of Discipleship", "Go Ye Therefore", "You Know Enough", "Come What May, and Love It"]
OFFICES = ["Of the Quorum", "President", "Bishop", "Relief Society"]
OPENINGS = ["we have gathered", "my dear", "brothers and sisters", "recently", "today i", "this morning", "i am grateful", "it is good"]
CONFERENCE_DATE = "October 2008"


def conference_text(text: Column) -> Column:
    """The text of a conference page: title, speaker, office, date and what follows the talk's opening.

    Texts that don't name a conference at their start stay as they are, those without an opening only have their
    encoding mended. Lines that are blank, begin with an arrow or hold the player's 16:36 are left out.
    """
    has = lambda x, parts: F.array_max(F.array(*[F.contains(x, F.lit(p)) for p in parts]))

    def of(t: Column) -> Column:
        return let(lines(t), lambda ls: drawn(t, ls))

    def drawn(t: Column, ls: Column) -> Column:
        hit = lambda cond, what: first(F.filter(F.transform(ls, lambda x, i: F.when(cond(strip(x)), F.struct(i.alias("i"), what(strip(x)).alias("t")))), lambda h: h["t"].isNotNull()))
        listed = hit(lambda x: has(x, LISTED_MARKS) & (F.length(x) > 15), lambda x: F.coalesce(*[F.when(F.contains(x, F.lit(p)), p) for p in LISTED_TITLES]))
        headed = hit(lambda x: (F.length(x) > 20) & F.contains(x, F.lit(":")) & ~F.lower(x).rlike("contents|session|authenticating"), lambda x: x)
        none = F.struct(F.lit(0).alias("i"), F.lit("Unknown Talk").alias("t"))

        def body(title: Column) -> Column:
            by = hit(lambda x: x.rlike("^By (Elder|President|Sister)"), lambda x: x)
            office = first(F.filter(F.transform(F.slice(ls, F.coalesce(by["i"], F.lit(0)) + 2, F.lit(4)), strip), lambda x: has(x, OFFICES)))
            opening = hit(lambda x: (F.length(x) > 50) & F.lower(x).rlike("|".join(OPENINGS)), lambda x: x)["i"]
            later = first(F.filter(F.transform(ls, lambda x, i: F.when((i >= title["i"] + 5) & (F.length(strip(x)) > 80), i)), lambda i: i.isNotNull()))
            start = F.coalesce(opening, later)
            kept = F.filter(F.transform(F.slice(ls, F.coalesce(start, F.lit(0)) + 1, F.size(ls)), strip), lambda x: (x != "") & ~F.startswith(x, F.lit("→")) & ~F.contains(x, F.lit("16:36")))
            head = F.array_compact(F.array(title["t"], by["t"], F.when(by.isNotNull(), office), F.lit(CONFERENCE_DATE), F.lit("")))
            return F.when(start.isNull(), t).otherwise(F.array_join(F.concat(head, kept), "\n"))

        return let(F.coalesce(listed, headed, none), body)

    return F.when(F.contains(F.substring(text, 1, 500), F.lit("Conference")), let(fix_scraper_encoding(text), of)).otherwise(text)


def metadata(text: Column, path: Column) -> Column:
    """(title, author, author_title, date) of a text, by the extractor's rules."""
    return let(speaker(text), lambda s: F.struct(talk_title(text).alias("title"), s["author"].alias("author"), s["author_title"].alias("author_title"), parse_date(text, path).alias("date")))


def valid_metadata(title: Column, author: Column, date: Column, year: Column | None = None) -> Column:
    y = F.regexp_extract(date, r"^(April|October) (\d{4})", 2)
    last = (F.year(F.current_date()) if year is None else year) + 1
    dated = date.isNull() | (y == "") | y.cast("string").try_cast("int").between(F.lit(1970), last)
    return F.coalesce((F.length(strip(title)) >= 3) & author.rlike("|".join(HONORIFICS)) & dated, F.lit(False))


# ---- formatting


def format_notes(text: Column) -> Column:
    """Notes under their heading, lines stripped, blank ones single; nothing for none."""
    headed = F.when(F.startswith(strip(text), F.lit("Notes")), text).otherwise(F.concat(F.lit("Notes\n"), text))
    bare = F.array_join(F.transform(lines(headed), strip), "\n")
    single = F.regexp_replace(F.regexp_replace(bare, r"^\n+", ""), r"\n{3,}", "\n\n")
    return F.when(F.coalesce(text, F.lit("")) == "", "").otherwise(F.regexp_replace(single, r"\n+\z", "\n"))


def render(title: Column, author: Column, body_: Column, date: Column, author_title: Column, notes_: Column) -> Column:
    """The standard layout; date and author's title appear where they are known."""
    tail = F.when(notes_.isNull(), "").when(F.endswith(body_, F.lit("\n")), notes_).otherwise(F.concat(F.lit("\n"), notes_))
    return F.concat(
        F.coalesce(F.concat(F.lit("DATE: "), date, F.lit("\n")), F.lit("")),
        F.lit("TITLE: "),
        F.coalesce(title, F.lit("Unknown Title")),
        F.lit("\nAUTHOR: "),
        F.coalesce(author, F.lit("Unknown Author")),
        F.coalesce(F.concat(F.lit("\nAUTHOR TITLE: "), author_title), F.lit("")),
        F.lit("\nBODY:\n"),
        body_,
        tail,
    )


def clean_format(text: Column) -> Column:
    t = F.regexp_replace(text, r"\n\s*\n\s*\n", "\n\n")
    t = F.regexp_replace(t, r"(?m)^BODY:\s*\n\s*", "BODY:\n")
    return strip(F.regexp_replace(t, r"\nNotes\s*\n\s*\n", "\nNotes\n"))


def standard_quotes(text: Column, intent: bool = False) -> Column:
    """As it is; with `intent`, typographic quotes become plain ones."""
    return F.translate(text, "“”‘’", "\"\"''") if intent else text


def references(text: Column) -> Column:
    t = F.regexp_replace(text, r"(\d+)\s+([A-Za-z]+)\s+(\d+):(\d+)", "$1 $2 $3:$4")
    t = F.regexp_replace(t, r"(D&C)\s+(\d+):(\d+)", "$1 $2:$3")
    return F.regexp_replace(t, r"(\d+)\s+([A-Za-z]+)\.\s+(\d+):(\d+)", "$1 $2. $3:$4")


def min_body(kind: Column) -> Column:
    return F.coalesce(*[F.when(kind == k, v) for k, v in MIN_BODY.items()], F.lit(100))


def valid_output(text: Column, kind: Column) -> Column:
    content = strip(F.substring(text, F.locate("BODY:", text) + 5, F.length(text)))
    return text.rlike(r"(?m)^TITLE: .+") & text.rlike(r"(?m)^AUTHOR: .+") & text.rlike("(?m)^BODY:") & (F.length(content) >= min_body(kind))


def clean_content(text: Column) -> Column:
    """A text from its own start on: behind a time stamp, a block of contents, or up to its repeated title."""
    head = F.substring(text, 1, 1000)
    dirty = let(head, lambda x: F.array_max(F.array(*_toc_signs(x))))
    line = F.substring_index(text, "\n", 1)
    stamped = strip(line).rlike(STAMPED)
    unstamped = F.concat(strip(F.regexp_replace(line, r"^\d{1,2}:\d{2}", "")), F.substring(text, F.length(line) + 1, F.length(text)))
    block = r"(?s)General Conference\s+\w+\s+\d{4}\s+general conference.*?\w+\s*October \d{4} general conference"

    def after_block(ls: Column) -> Column:
        starts = F.filter(F.transform(ls, lambda x, i: F.when(F.length(strip(x)) > 5, i).otherwise(-1)), lambda i: i >= 0)
        return F.when(F.size(starts) > 0, F.array_join(F.slice(ls, first(starts) + 1, F.size(ls)), "\n"))

    rest = F.when(text.rlike(block), let(lines(strip(F.regexp_replace(text, rf"(?s)^.*?{block[4:]}", ""))), after_block))

    def legacy(ls: Column) -> Column:
        title = strip(F.get(ls, F.lit(0)))
        clean = strip(F.regexp_replace(title, r"^\d{1,2}:\d{2}", ""))
        at = lambda cond: first(F.filter(F.transform(ls, lambda x, i: F.when(cond(strip(x), i), i).otherwise(-1)), lambda i: i >= 0))
        stamp = at(lambda x, i: x.rlike(r"^\d{1,2}:\d{2}.+"))
        from_stamp = F.array_join(F.concat(F.array(F.regexp_extract(strip(F.get(ls, stamp)), r"^\d{1,2}:\d{2}(.+)", 1)), F.slice(ls, stamp + 2, F.size(ls))), "\n")
        repeat = at(lambda x, i: (i >= 10) & (i < 100) & (F.length(title) > 10) & ((x == title) | (x == clean) | (F.contains(x, clean) & (F.length(x) < F.length(clean) + 10))))
        return F.when(stamp.isNotNull(), from_stamp).when(repeat.isNotNull(), F.array_join(F.slice(ls, repeat + 1, F.size(ls)), "\n"))

    return F.when(stamped, unstamped).when(~dirty, text).otherwise(F.coalesce(rest, let(lines(text), legacy), text))

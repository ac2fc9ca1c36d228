"""Content types and topics by weighted keywords; ties go to the class named first."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.base import let, occurrences

# fixed values: classes with title keywords, content keywords and structural patterns, in the order of ties
RULES = {
    "sermon": (["teach", "doctrine", "gospel", "principle"], ["brothers and sisters", "my dear friends", "let me share", "i want to speak"], ["first.*second.*third", "let me.*suggest", "i invite you"]),
    "testimony": (["testimony", "witness", "know"], ["i know", "i testify", "my testimony", "bear witness", "spirit whispers"], ["i know that", "my testimony.*is", "i witness"]),
    "prayer": (["prayer", "pray", "heavenly father"], ["heavenly father", "dear father", "we thank thee", "we pray", "amen"], ["our.*father", "we.*grateful", "in.*name.*jesus"]),
    "teaching": (["learning", "teach", "education", "instruction"], ["learn", "understand", "study", "ponder", "scripture"], ["we learn.*", "scripture teaches", "let us.*understand"]),
    "doctrinal": (["doctrine", "principle", "truth", "revelation"], ["doctrine", "revealed", "truth", "principle", "eternal"], ["doctrine.*teaches", "truth.*is", "principle.*of"]),
    "personal_story": (["experience", "story", "learned"], ["when i was", "i remember", "experience taught", "learned that"], ["i.*remember", "years ago", "experience.*taught"]),
}
# fixed values: topics with their keywords, in the order of ties
TOPICS = {
    "faith": ["faith", "believe", "trust", "confidence"],
    "family": ["family", "marriage", "children", "parent"],
    "service": ["serve", "service", "help", "ministry"],
    "repentance": ["repent", "forgive", "mercy", "change"],
    "temple": ["temple", "covenant", "ordinance", "sacred"],
    "priesthood": ["priesthood", "authority", "keys", "ordain"],
    "testimony": ["testimony", "witness", "know", "spirit"],
    "revelation": ["revelation", "inspiration", "guidance", "direction"],
}
# fixed values: weights of a title keyword, a content keyword and a structural pattern
WEIGHTS = (3, 1, 2)


def _sum(parts: list[Column]) -> Column:
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


def argmax(scores: dict[str, Column], otherwise: str) -> Column:
    """The name with the largest positive score, the first of equals."""
    ranked = F.array(*[F.struct(s.alias("s"), F.lit(-i).alias("o"), F.lit(name).alias("name")) for i, (name, s) in enumerate(scores.items())])
    return let(F.array_max(ranked), lambda best: F.when(best["s"] > 0, best["name"]).otherwise(otherwise))


def runs(text: Column, pattern: str) -> Column:
    """How often a pattern of literals with `.*` between them matches, its dots staying within lines; linear in the text.

    A match with a `.*` takes all of its line that it can, so a line has one match or none: one if the literals follow
    each other from the first place of the first. Texts that lack one of the literals aren't matched at all.
    """
    parts = [p for p in pattern.split(".*") if p]
    if parts == [pattern]:
        return occurrences(text, pattern)
    whole = "".join(f"(?>.*?{re.escape(p)})" for p in parts)
    lacks = F.lit(False)
    for p in reversed(parts):
        lacks = lacks | ~F.contains(text, F.lit(p))
    return F.when(lacks, 0).otherwise(F.regexp_count(text, F.lit(f"(?md)^{whole}")))


def type_scores(title: Column, content: Column) -> dict[str, Column]:
    """Score of each class; title and content must be in lower case."""
    out = {}
    for name, (titles, keywords, patterns) in RULES.items():
        parts = [F.when(F.contains(title, F.lit(k)), WEIGHTS[0]).otherwise(0) for k in titles]
        parts += [occurrences(content, k) * WEIGHTS[1] for k in keywords]
        parts += [runs(content, p) * WEIGHTS[2] for p in patterns]
        out[name] = _sum(parts)
    return out


def content_type(title: Column, content: Column) -> Column:
    return let(F.lower(title), lambda t: let(F.lower(content), lambda c: argmax(type_scores(t, c), "general")))


def simple_type(title: Column, content: Column) -> Column:
    """The short decision list: title first, then content."""
    t, c = F.lower(title), F.lower(content)
    has = lambda x, *ks: F.greatest(*[F.contains(x, F.lit(k)) for k in ks])
    return F.when(has(t, "testimony", "witness"), "testimony").when(has(t, "prayer", "pray"), "prayer").when(has(c, "i know", "i testify"), "testimony").when(has(c, "heavenly father", "amen"), "prayer").otherwise("general")


def topic(content: Column) -> Column:
    return let(F.lower(content), lambda c: argmax({t: _sum([occurrences(c, k) for k in ks]) for t, ks in TOPICS.items()}, "gospel principles"))

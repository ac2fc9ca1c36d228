"""Per-text style features and quality scores. Words are runs of letters, digits and _, or single marks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vellum.functions.base import let, n_words, strip
from vellum.functions.chunks import sentences

WORD = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
# fixed values: rhetorical patterns
RHETORIC = ["brothers and sisters", "i (know|testify|witness) that", "let me (share|tell|suggest)", "my dear (friends|brothers|sisters)", "i invite you to", "may (we|you|i)", "(father|lord|god) (has|will|wants)", "in the name of jesus christ"]
# fixed values: signs of faulty character recognition
OCR = [r"\b[a-z]+[0-9]+[a-z]+\b", r"\b[A-Z]{3,}\b", r"[^\w\s]{3,}", r"\b\w{1,2}\b.*\b\w{1,2}\b"]


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def _mean(values: Column) -> Column:
    """Mean of an array of numbers, null if empty."""
    return F.try_divide(F.aggregate(values, F.lit(0.0), lambda a, x: a + x.cast("double")), F.size(values).cast("double"))


def features(text: Column, parts: Column | None = None) -> Column:
    """Struct of what style is compared by: sentence lengths, words, marks, rhetoric. `parts` are the text's sentences, if not those by pattern."""

    def of(t: Column) -> Column:
        return let(tokens(t), lambda w: let(F.transform(sentences(t) if parts is None else parts, lambda s: F.size(tokens(s))), lambda n: _features(t, w, n)))

    return let(text, of)


def _features(t: Column, w: Column, n: Column) -> Column:
    mean = _mean(n)
    square = _mean(F.transform(n, lambda x: x.cast("double") * x))
    low = F.lower(t)
    named = {
        "avg_length": F.coalesce(mean, F.lit(0.0)),
        "length_variance": F.coalesce(square - mean * mean, F.lit(0.0)),
        "avg_word_length": F.coalesce(_mean(F.transform(w, F.length)), F.lit(0.0)),
        "type_token_ratio": F.coalesce(F.try_divide(F.size(F.array_distinct(w)), F.size(w)), F.lit(0.0)),
        "avg_sentence_length": F.coalesce(F.try_divide(F.size(w), F.size(n)), F.lit(0.0)),
        "punctuation_density": F.coalesce(F.try_divide(F.regexp_count(t, F.lit("[.,!?;:]")), F.length(t)), F.lit(0.0)),
    }
    return F.struct(*[v.alias(k) for k, v in named.items()], F.array(*[F.regexp_count(low, F.lit(f"(?d){p}")) for p in RHETORIC]).alias("rhetoric"))


def readability(text: Column) -> Column:
    return let(tokens(text), lambda w: let(sentences(text), lambda s: _readability(w, s)))


def _readability(w: Column, s: Column) -> Column:
    return 1 / (1 + F.try_divide(F.size(w), F.size(s)) / 20 + F.coalesce(_mean(F.transform(w, F.length)), F.lit(0.0)) / 6)


def coherence(text: Column) -> Column:
    """Mean overlap of the word sets of neighbouring sentences; 1 for a single one."""

    def of(ws: Column) -> Column:
        pairs = F.transform(F.slice(ws, 2, F.size(ws)), lambda w, i: F.try_divide(F.size(F.array_intersect(F.get(ws, i), w)).cast("double"), F.size(F.array_union(F.get(ws, i), w))))
        return F.when(F.size(ws) < 2, 1.0).otherwise(F.coalesce(_mean(F.filter(pairs, lambda x: x.isNotNull())), F.lit(0.0)))

    return let(F.transform(sentences(text), lambda s: F.array_distinct(tokens(F.lower(s)))), of)


def completeness(text: Column) -> Column:
    return _completeness(text, tokens(text), sentences(text))


def _completeness(text: Column, w: Column, s: Column) -> Column:
    end = F.when(strip(text).rlike(r"[.!?]$"), 1.0).otherwise(0.5)
    return end * 0.4 + F.least(F.size(w) / 50, F.lit(1.0)) * 0.4 + F.when(F.size(s) >= 2, 1.0).otherwise(0.7) * 0.2


def grammar(text: Column, parts: Column | None = None) -> Column:
    upper = F.when(text.rlike(r"\p{Lu}"), 0.3).otherwise(0.0)
    marks = F.when(text.rlike("[.,!?;:]"), 0.3).otherwise(0.0)
    return upper + marks + let(sentences(text) if parts is None else parts, lambda s: F.size(F.filter(s, lambda x: x.rlike(r"^\p{Lu}"))) / F.size(s)) * 0.4


def scores(text: Column) -> Column:
    """Struct of the four scores and their mean; all zero for a text without words."""
    parts = {"readability": readability(text), "coherence": coherence(text), "completeness": completeness(text), "grammar_quality": grammar(text)}
    return let(F.struct(*[v.alias(k) for k, v in parts.items()]), lambda x: F.struct(*[x[k].alias(k) for k in parts], F.when(F.size(tokens(text)) == 0, 0.0).otherwise((x["readability"] + x["coherence"] + x["completeness"] + x["grammar_quality"]) / 4).alias("overall_quality")))


def ocr_rate(text: Column) -> Column:
    """Signs of faulty recognition for each word."""
    hits = F.lit(0)
    for p in OCR:
        hits = hits + F.regexp_count(text, F.lit(f"(?Ud){p}"))
    return F.try_divide(hits, n_words(text))


def quality_score(text: Column) -> Column:
    """Weighted score: few recognition faults .4, readability .3, completeness .2, form .1."""
    faulty = F.when(F.coalesce(ocr_rate(text), F.lit(0.0)) > 0.05, 1.0).otherwise(0.0)
    # words and sentences are found once for all scores
    return let(tokens(text), lambda w: let(sentences(text), lambda s: (1 - faulty) * 0.4 + _readability(w, s) * 0.3 + _completeness(text, w, s) * 0.2 + grammar(text, s) * 0.1))

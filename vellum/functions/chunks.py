"""Token-budget chunking: greedy packing of sentences or paragraphs, and overlap.

Token counts of parts are taken once and the packing folds over numbers, not over growing strings; that is
exact for counts that add up, such as words. Text is put together once at the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.functions.base import let, n_words, strip, words
from vellum.tables import DOCUMENT

#: An expression for the number of tokens of a text.
Counter = Callable[[Column], Column]
MAX_TOKENS = 512
OVERLAP = 50
STRATEGIES = ("sentences", "paragraph_aware", "overlap")


def sentences(text: Column) -> Column:
    """Split at white space after a sentence's end."""
    return F.split(text, r"(?<=[.!?])\s+")


def paragraphs(text: Column, delimiter: str = "\n\n") -> Column:
    return F.filter(F.transform(F.split(text, delimiter), strip), lambda p: p != "")


def _starts(counts: Column, budget: int) -> Column:
    """1-based first parts of the chunks of greedily packed parts; a part over budget is a chunk of its own."""
    zero = F.struct(F.array(F.lit(1)).alias("st"), F.lit(0).alias("n"), F.lit(1).alias("i"))

    def step(a: Column, k: Column) -> Column:
        fits = (a["n"] == 0) | (a["n"] + k <= budget)
        return F.struct(
            F.when(fits, a["st"]).otherwise(F.array_append(a["st"], a["i"])).alias("st"),
            F.when(fits, a["n"] + k).otherwise(k).alias("n"),
            (a["i"] + 1).alias("i"),
        )

    return F.aggregate(counts, zero, step, lambda a: a["st"])


def pack(parts: Column, budget: int, separator: str, tokens: Counter = n_words) -> Column:
    """Chunks of consecutive parts, joined by `separator`, of at most `budget` tokens."""

    def of(p: Column) -> Column:
        def cut(st: Column) -> Column:
            end = lambda i: F.coalesce(F.get(st, i + 1), F.size(p) + 1)
            made = F.transform(st, lambda b, i: strip(F.array_join(F.slice(p, b, end(i) - b), separator)))
            return F.filter(made, lambda c: c != "")

        return let(_starts(F.transform(p, tokens), budget), cut)

    return let(parts, of)


def by_sentences(text: Column, budget: int = MAX_TOKENS, tokens: Counter = n_words) -> Column:
    return pack(sentences(text), budget, " ", tokens)


def by_paragraphs(text: Column, budget: int = MAX_TOKENS, delimiter: str = "\n\n", tokens: Counter = n_words) -> Column:
    """Paragraphs packed; one over budget, which packing leaves alone, is packed by sentences instead."""
    packed = pack(paragraphs(text, delimiter), budget, "\n\n", tokens)
    return F.flatten(F.transform(packed, lambda c: F.when(tokens(c) > budget, by_sentences(c, budget, tokens)).otherwise(F.array(c))))


def with_overlap(text: Column, budget: int = MAX_TOKENS, overlap: int = OVERLAP, delimiter: str = "\n\n", tokens: Counter = n_words) -> Column:
    """Paragraph chunks, each but the first led by the last tokens of the one before."""

    def tail(c: Column) -> Column:
        return let(words(c), lambda w: F.array_join(F.slice(w, F.greatest(F.size(w) - overlap, F.lit(0)) + 1, F.lit(overlap)), " "))

    return let(by_paragraphs(text, budget, delimiter, tokens), lambda cs: F.transform(cs, lambda c, i: F.when(i == 0, c).otherwise(F.concat(tail(F.get(cs, i - 1)), F.lit("\n\n"), c))))


def fixed(text: Column, size: int = 2000) -> Column:
    """Pieces of `size` characters."""
    return F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.length(text) / size).cast("int") - 1, F.lit(0))), lambda i: F.substr(text, i * size + 1, F.lit(size)))


def chunk(docs: DataFrame, strategy: str = "paragraph_aware", budget: int = MAX_TOKENS, overlap: int = OVERLAP, delimiter: str = "\n\n", tokens: Counter = n_words) -> DataFrame:
    """One row per chunk: the document's columns but content, with content, chunk_id, total_chunks, token_count.

    `tokens` counts those of a text, words unless another expression is given; overlap is in words.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Unknown chunking strategy: {strategy}")
    text = F.coalesce(F.col("content"), F.lit(""))
    made = {
        "sentences": lambda: by_sentences(text, budget, tokens),
        "paragraph_aware": lambda: by_paragraphs(text, budget, delimiter, tokens),
        "overlap": lambda: with_overlap(text, budget, overlap, delimiter, tokens),
    }[strategy]()
    known = [F.coalesce(F.col(c), F.lit("")).alias(c) if c in docs.columns else F.lit("").alias(c) for c in DOCUMENT[1:]]
    rest = [c for c in docs.columns if c not in DOCUMENT]
    # the outer form keeps the optimizer from computing the chunks a second time in a filter
    exploded = docs.select(*rest, *known, made.alias("_chunks")).select(*rest, *DOCUMENT[1:], F.size("_chunks").alias("total_chunks"), F.posexplode_outer("_chunks").alias("chunk_id", "content"))
    return exploded.where("content is not null").withColumn("token_count", tokens(F.col("content")))

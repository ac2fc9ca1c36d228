"""Sentence boundaries learnt from a corpus without labels, after Kiss and Strunk (2006).

A word is an abbreviation if it stands with a period far more often than periods stand at all; how long it is,
the periods within it and its occurrences without one count too. Words that follow sure sentence ends far more
often than elsewhere start sentences; pairs about an abbreviation's, initial's or number's period that occur
together far more often than by chance are collocations. All are log-likelihood ratios over counts that Spark
aggregates; only the words that pass leave the executors, and a model beyond LIMIT entries is refused.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.session import shared_dir

c = F.col
# fixed values: thresholds of the three ratios as published, and the likelihood of a period after an abbreviation
ABBREVIATION, STARTER, COLLOCATION, SURE = 0.3, 30.0, 7.88, 0.99
LIMIT = 1_000_000
#: Texts that are Python strings at a time.
SLICE = 64
NUMBER = "##number##"
_OPEN, _CLOSE = "\"'(\\[{“‘«„", "\"')\\]}”’»"
_OUTER = f"^[{_OPEN}]+|[{_CLOSE}]+$"
_NUMBER = "^-?[0-9][0-9.,-]*$"
_MARKS = "[.,;:!?…]+$"
TOKEN = "[^ \\t\\n\\x0B\\f\\r]+"


class Model(NamedTuple):
    abbreviations: frozenset[str]
    starters: frozenset[str]
    collocations: frozenset[tuple[str, str]]


def typed(docs: DataFrame) -> DataFrame:
    """(type, dotted, marked, next) for each token of `docs` (content).

    A token is a run without white space; its type is lower-case, without quotes, brackets and marks about it, or NUMBER.
    dotted: it ends in one period, marked: in ! or ?, next: the type of the token that follows, null at the end.
    """
    every = docs.select(F.regexp_extract_all("content", F.lit(TOKEN), F.lit(0)).alias("t"))
    each = every.select(F.explode(F.transform("t", lambda x, i: F.struct(x.alias("token"), F.get("t", i + 1).alias("then")))).alias("x"))
    core = each.select(F.regexp_replace("x.token", _OUTER, "").alias("core"), F.regexp_replace("x.then", _OUTER, "").alias("then"))
    bare = core.select("core", F.lower(F.regexp_replace("core", _MARKS, "")).alias("type"), F.lower(F.regexp_replace("then", _MARKS, "")).alias("next"))
    number = lambda x: F.when(c(x).rlike(_NUMBER), NUMBER).otherwise(c(x)).alias(x)
    return bare.where("type <> ''").select(number("type"), c("core").rlike("[^.]\\.$").alias("dotted"), c("core").rlike("[!?]$").alias("marked"), number("next"))


def _ratio(a: Column, b: Column, ab: Column, n: Column) -> Column:
    """Dunning's log-likelihood ratio of b occurring with a: counts of a, of b, of both, and of all."""
    a, b, ab, n = (x.cast("double") for x in (a, b, ab, n))
    p, p1, p2 = b / n, ab / a, (b - ab) / (n - a)
    part = lambda k, q, m: k * F.log(q) + m * F.log(1 - q)
    rest = n - a - b + ab
    alone = F.when(ab == a, 0.0).otherwise(part(ab, p1, a - ab))
    other = F.when((b == ab) | (rest <= 0), 0.0).otherwise(part(b - ab, p2, rest))
    return -2 * (part(ab, p, a - ab) + part(b - ab, p, rest) - alone - other)


def learn(docs: DataFrame) -> DataFrame:
    """The model of `docs` (content) as rows (kind, first, second, n, score): abbreviation, starter, collocation.

    n counts the word with a period, at sentence starts, or the pair. A null content has no words; a corpus without a
    period after any word gives no rows. Texts are read twice; counts of words and of pairs are written once.
    """
    folder, tokens = f"{shared_dir(docs.sparkSession)}/boundaries-{uuid.uuid4().hex}", typed(docs)

    def counted(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{folder}/{name}")
        return docs.sparkSession.read.schema(rows.schema).parquet(f"{folder}/{name}")

    types = counted(tokens.groupBy("type").agg(F.count("*").alias("n"), F.count_if("dotted").alias("dotted")), "types")
    # tokens that may end a sentence, each with the one that follows
    pairs = counted(tokens.where("(dotted or marked) and next <> ''").groupBy("type", "dotted", "next").agg(F.count("*").alias("n")), "pairs")
    total = types.agg(F.sum("n").alias("all_n"), F.sum("dotted").alias("all_dotted"))
    length = F.length(F.replace("type", F.lit("."), F.lit("")))
    without = c("n") - c("dotted")
    p = c("all_dotted").cast("double") / c("all_n")
    ratio = -2 * ((c("dotted") * F.log(p) + without * F.log(1 - p)) - (c("dotted") * F.log(F.lit(SURE)) + without * F.log(F.lit(1 - SURE))))
    score = ratio * F.exp(-length.cast("double")) * (F.length("type") - length + 1) * F.pow(length.cast("double"), -without.cast("double"))
    worded = types.where((c("dotted") > 0) & c("type").rlike("\\p{L}"))
    short = worded.join(F.broadcast(total), how="cross").select("type", c("dotted").alias("n"), score.alias("score")).where(c("score") >= ABBREVIATION)

    known = pairs.join(short.select("type", F.lit(True).alias("short")), "type", "left")
    open_ = F.coalesce("short", F.lit(False)) | (c("type") == NUMBER) | c("type").rlike("^\\p{L}$")
    ends = known.withColumn("open", c("dotted") & open_)
    begun = ends.where("not open").groupBy("next").agg(F.sum("n").alias("ab"))
    breaks = ends.where("not open").agg(F.sum("n").alias("a"))
    sizes = types.select("type", c("n").alias("b"))
    starts = begun.join(sizes, begun.next == sizes.type).join(F.broadcast(breaks), how="cross").join(F.broadcast(total), how="cross").where("next rlike '\\\\p{L}' and all_n / a > b / ab")
    starters = starts.select(c("next").alias("first"), c("ab").alias("n"), _ratio(c("a"), c("b"), c("ab"), c("all_n")).alias("score")).where(c("score") >= STARTER)
    held = ends.where("open").groupBy("type", "next").agg(F.sum("n").alias("ab")).where("ab > 1 and next rlike '\\\\p{L}'")
    both = held.join(types.select("type", c("n").alias("a")), "type").join(sizes.withColumnRenamed("type", "next"), "next").join(F.broadcast(total), how="cross").where("all_n / a > b / ab")
    collocations = both.select(c("type").alias("first"), c("next").alias("second"), c("ab").alias("n"), _ratio(c("a"), c("b"), c("ab"), c("all_n")).alias("score")).where(c("score") >= COLLOCATION)

    none = F.lit(None).cast("string")
    return (
        short.select(F.lit("abbreviation").alias("kind"), c("type").alias("first"), none.alias("second"), "n", "score")
        .unionByName(starters.select(F.lit("starter").alias("kind"), "first", none.alias("second"), "n", "score"))
        .unionByName(collocations.select(F.lit("collocation").alias("kind"), "first", "second", "n", "score"))
    )


def collect(rows: DataFrame, limit: int = LIMIT) -> Model:
    """A learnt model for the workers; one of more than `limit` entries is refused."""
    found = rows.select("kind", "first", "second").limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"the model has more than {limit} entries")
    of = lambda kind: [r for r in found if r.kind == kind]
    return Model(frozenset(r.first for r in of("abbreviation")), frozenset(r.first for r in of("starter")), frozenset((r.first, r.second) for r in of("collocation")))


_TOKEN, _EDGE, _TRAIL, _NUM = re.compile("[^ \t\n\x0b\f\r]+"), re.compile(_OUTER), re.compile(_MARKS), re.compile(_NUMBER)


def _type(token: str) -> tuple[str, str]:
    core = _EDGE.sub("", token)
    bare = _TRAIL.sub("", core).lower()
    return core, NUMBER if _NUM.match(bare) else bare


def split(text: str | None, model: Model) -> list[str]:
    """The sentences of a text. ! and ? end one, a period does except after an abbreviation, an initial or a number.

    An abbreviation's period does if a capitalised starter follows that isn't its collocation; a number's does if no
    small letter and no collocation follows; an initial's and an ellipsis don't.
    """
    found = [(m.end(), *_type(m.group())) for m in _TOKEN.finditer(text or "")]
    if not found:
        return []
    out, begin = [], 0
    for (end, core, kind), (_, then, after) in zip(found, found[1:], strict=False):
        if core[-1:] in ("!", "?"):
            ends = True
        elif not core.endswith(".") or core.endswith(".."):
            ends = False
        elif (kind, after) in model.collocations or (len(kind) == 1 and kind.isalpha()):
            ends = False
        elif kind in model.abbreviations:
            ends = after in model.starters and then[:1].isupper()
        else:
            ends = kind != NUMBER or not then[:1].islower()
        if ends:
            out.append(text[begin:end].strip())
            begin = end
    return [*out, text[begin:].strip()]


def splitter(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A function of a text column that gives its sentences; a null or blank text has none."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("array<string>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = shared.value
        for texts in batches:
            for at in range(0, len(texts), SLICE):  # a batch of Arrow has 10,000 texts: too many to be Python strings at once
                yield pa.array([split(t, held) for t in texts.slice(at, SLICE).to_pylist()], pa.list_(pa.string()))

    return of

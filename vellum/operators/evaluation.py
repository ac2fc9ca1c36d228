"""Style similarity of texts to an author's corpus, evaluation reports, and validation splits.

Corpora are never collected per author: words, features and n-grams are aggregated and joined by author.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vellum.functions import quality

c = F.col
FEATURES = ("avg_word_length", "type_token_ratio", "avg_sentence_length", "punctuation_density")
# fixed values: weights of the overall similarity and of the overall score
STYLE = {"vocab_overlap": 0.25, "structure_similarity": 0.25, "rhetorical_score": 0.2, "ngram_similarity": 0.2, "style_features": 0.1}
OUTPUT = (0.5, 0.3, 0.2)
MAX_FEATURES = 1000
#: Parts that the rows, or the terms, of an author are dealt over.
SALTS = 16


def by_author(rows: DataFrame, per_author: DataFrame, *key: str, how: str = "left") -> DataFrame:
    """`rows` with the columns of their author, of a table with one row an author.

    Rows of an author are dealt by `key` over SALTS parts, each with a copy of the author's row, so that an author of
    any share isn't one task's.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*key), F.lit(SALTS)).cast("int"))
    copies = per_author.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return dealt.join(copies, ["author", "_salt"], how).drop("_salt")


def vocab_overlap(texts: DataFrame, refs: DataFrame) -> DataFrame:
    """(id, vocab_overlap): share of the author's vocabulary that a text uses."""
    spread = lambda t, *keys: t.select(*keys, F.explode(F.array_distinct(quality.tokens(F.lower("text")))).alias("w"))
    vocab = spread(refs, "author").distinct()
    sizes = vocab.groupBy("author").agg(F.count("*").alias("size"))
    hits = spread(texts, "id", "author").join(vocab, ["author", "w"]).groupBy("id").agg(F.count("*").alias("hits"))
    return by_author(texts.select("id", "author").join(hits, "id", "left"), sizes, "id").select("id", F.coalesce(F.try_divide("hits", "size"), F.lit(0.0)).alias("vocab_overlap"))


def _close(g: Column, r: Column) -> Column:
    return 1 - F.abs(g - r) / F.greatest(r, F.lit(1.0))


def feature_scores(texts: DataFrame, refs: DataFrame, split: Callable[[Column], Column] | None = None) -> DataFrame:
    """(id, structure_similarity, rhetorical_score, style_features) from per-text features and author means; `split` gives a text's sentences."""
    n = len(quality.RHETORIC)
    if split is not None:
        texts, refs = (t.withColumn("_s", split(c("text"))) for t in (texts, refs))
    parts = None if split is None else c("_s")
    of = refs.select("author", quality.features(c("text"), parts).alias("f")).select("author", "f.*")
    means = of.groupBy("author").agg(F.avg("avg_length").alias("r_length"), F.avg("length_variance").alias("r_variance"), *[F.avg(f).alias(f"r_{f}") for f in FEATURES], F.array(*[F.avg(F.get("rhetoric", F.lit(i))) for i in range(n)]).alias("r_rhetoric"))
    own = texts.select("id", "author", quality.features(c("text"), parts).alias("f")).select("id", "author", "f.*")
    own = by_author(own, means, "id", how="inner")
    structure = (_close(c("avg_length"), c("r_length")) + _close(c("length_variance"), c("r_variance"))) / 2
    g, r = (lambda i: F.get("rhetoric", F.lit(i))), (lambda i: F.get("r_rhetoric", F.lit(i)))
    rhetoric = [F.when(r(i) > 0, F.least(F.try_divide(g(i), r(i)), F.lit(2.0)) / 2).otherwise(F.when(g(i) == 0, 1.0).otherwise(0.0)) for i in range(n)]
    sims = F.array_compact(F.array(*[F.when(c(f"r_{f}") > 0, F.greatest(F.lit(0.0), 1 - F.try_divide(F.abs(c(f) - c(f"r_{f}")), c(f"r_{f}")))) for f in FEATURES]))
    return own.select("id", structure.alias("structure_similarity"), (sum(rhetoric[1:], rhetoric[0]) / n).alias("rhetorical_score"), F.coalesce(quality._mean(sims), F.lit(0.0)).alias("style_features"))


def _grams(texts: DataFrame, *keys: str) -> DataFrame:
    """(keys, term, n): counts of two- and three-word terms; words have two letters or more."""
    w = texts.select(*keys, F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]{2,}"), 0).alias("w"))
    of = lambda k: F.transform(F.sequence(F.lit(0), F.size("w") - k), lambda i: F.array_join(F.slice("w", i + 1, F.lit(k)), " "))
    terms = F.concat(*[F.when(F.size("w") >= k, of(k)).otherwise(F.array().cast("array<string>")) for k in (2, 3)])
    return w.select(*keys, F.explode(terms).alias("term")).groupBy(*keys, "term").agg(F.count("*").alias("n"))


def top_terms(counted: DataFrame, most: int = MAX_FEATURES) -> DataFrame:
    """(author, top): the `most` most frequent terms of each author's `counted` (author, term, rn), ties to the first in order.

    Terms are ranked in SALTS parts of an author first; what any part hands on is bounded by `most`, so the author's own
    ranking never sees more than SALTS times that.
    """
    order = [c("rn").desc(), c("term")]
    part = F.pmod(F.xxhash64("term"), F.lit(SALTS))
    some = counted.withColumn("_part", part).withColumn("k", F.row_number().over(W.partitionBy("author", "_part").orderBy(*order))).where(c("k") <= most)
    listed = some.groupBy("author").agg(F.array_sort(F.collect_list(F.struct((-c("rn")).alias("m"), "term"))).alias("all"))
    return listed.select("author", F.transform(F.slice("all", 1, most), lambda x: F.struct(x["term"].alias("term"), (-x["m"]).alias("rn"))).alias("top"))


def ngram_similarity(texts: DataFrame, refs: DataFrame, features: int = MAX_FEATURES) -> DataFrame:
    """(id, ngram_similarity): TF-IDF cosine of a text and the author's corpus over their most frequent terms.

    A term that the text lacks can be among them only if it is among the corpus' own most frequent, and one that it has
    only if it is as frequent as the last of those; so a text is a row of such terms of its own, beside one list for
    each author. Counts of the corpus are those of its texts, not across their borders.
    """
    ref = _grams(refs.where("author is not null"), "author").where("term is not null").withColumnRenamed("n", "rn")
    top = top_terms(ref, features)
    least = top.select("author", F.when(F.size("top") >= features, F.element_at("top", -1)["rn"]).otherwise(F.lit(0)).alias("least"))
    own = _grams(by_author(texts, least, "id", how="inner"), "id", "author", "least").withColumnRenamed("n", "gn")
    placed = ref.join(top.select("author", F.posexplode("top").alias("pos", "x")).select("author", "x.term", "pos"), ["author", "term"], "left")
    rn = F.coalesce("rn", F.lit(0))
    some = own.join(placed, ["author", "term"], "left").where(rn + c("gn") >= c("least"))
    term = lambda m, term, rn, gn: F.struct(m.alias("m"), term.alias("term"), rn.alias("rn"), gn.alias("gn"))
    listed = some.groupBy("id", "author").agg(F.collect_list(term(-(rn + c("gn")), c("term"), rn, c("gn"))).alias("own"), F.collect_list("pos").alias("shared"))
    both = by_author(listed, top, "id", how="inner")
    # what exceeds `features` are the last `over` terms of both lists together: only so many of the corpus' are sorted with the text's
    lacking = both.withColumn("lacks", F.array_except(F.sequence(F.lit(0), F.size("top") - 1), "shared"))
    cut = lacking.withColumn("over", F.greatest(F.size("own") + F.size("lacks") - features, F.lit(0))).withColumn("sure", F.greatest(F.size("lacks") - c("over"), F.lit(0)))
    rest = F.transform(F.slice("lacks", c("sure") + 1, c("over")), lambda i: term(-F.get("top", i)["rn"], F.get("top", i)["term"], F.get("top", i)["rn"], F.lit(0).cast("long")))
    kept = F.slice(F.sort_array(F.concat("own", rest)), F.lit(1), F.size("own") + F.size("lacks") - c("sure") - c("over"))
    alone = (math.log(1.5) + 1) ** 2
    square = lambda n, other: n.cast("double") * n * F.when(other > 0, 1.0).otherwise(alone)
    before = F.aggregate(F.slice("lacks", F.lit(1), c("sure")), F.lit(0.0), lambda a, i: a + square(F.get("top", i)["rn"], F.lit(0)))
    zero = F.struct(F.lit(0.0).alias("d"), c("before").alias("x"), F.lit(0.0).alias("y"))
    sums = F.aggregate("kept", zero, lambda a, t: F.struct((a["d"] + t["rn"].cast("double") * t["gn"]).alias("d"), (a["x"] + square(t["rn"], t["gn"])).alias("x"), (a["y"] + square(t["gn"], t["rn"])).alias("y")))
    scored = cut.select("id", "author", kept.alias("kept"), before.alias("before")).select("id", "author", sums.alias("s")).select("id", "author", F.try_divide("s.d", F.sqrt(c("s.x") * c("s.y"))).alias("cosine"))
    return texts.select("id", "author").join(scored, ["id", "author"], "left").select("id", F.coalesce("cosine", F.lit(0.0)).alias("ngram_similarity"))


def style(texts: DataFrame, refs: DataFrame) -> DataFrame:
    """`texts` (id, author, text) against `refs` (author, text): the five similarities and their weighted sum.

    Rows that repeat an id are scored each on its own, equal rows once; a null text counts as empty, and what has
    no author, or one without a corpus, has similarity 0.
    """
    named = texts.withColumn("_key", F.md5(F.to_json(F.struct("id", "author", "text"))))
    once = named.select(c("_key").alias("id"), "author", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates(["id"])
    scored = vocab_overlap(once, refs).join(feature_scores(once, refs), "id", "left").join(ngram_similarity(once, refs), "id")
    out = named.join(scored.withColumnRenamed("id", "_key"), "_key").drop("_key")
    safe = {k: F.coalesce(F.nanvl(c(k), F.lit(0.0)), F.lit(0.0)) for k in STYLE}
    return out.withColumns(safe).withColumn("overall_similarity", sum((c(k) * w for k, w in list(STYLE.items())[1:]), c("vocab_overlap") * 0.25))


def evaluate(texts: DataFrame, refs: DataFrame) -> DataFrame:
    """`style` with quality scores, consistency (one half for an author without a corpus) and the overall score."""
    known = refs.select("author").distinct().withColumn("_known", F.lit(True))
    scored = by_author(style(texts, refs), known, "id", "text").withColumn("_q", quality.scores(c("text")))
    consistent = F.when(c("_known"), c("overall_similarity")).otherwise(0.5)
    whole = c("overall_similarity") * OUTPUT[0] + c("_q.overall_quality") * OUTPUT[1] + consistent * OUTPUT[2]
    return scored.select("*", "_q.*", consistent.alias("consistency_score"), whole.alias("overall_score")).drop("_q", "_known")


def report(outputs: DataFrame) -> DataFrame:
    """One row: means, population deviations, range, and bands of the overall score."""
    s = c("overall_score")
    return outputs.agg(
        *[F.round(F.avg(k), 6).alias(f"avg_{k}") for k in ("overall_similarity", "overall_quality", "consistency_score", "overall_score")],
        *[F.round(F.stddev_pop(k), 6).alias(f"std_{k}") for k in ("overall_similarity", "overall_quality", "consistency_score")],
        F.round(F.min(s), 6).alias("min_score"),
        F.round(F.max(s), 6).alias("max_score"),
        F.round(F.max(s) - F.min(s), 6).alias("score_span"),
        F.count("*").alias("total_evaluations"),
        F.count_if(s >= 0.8).alias("excellent"),
        F.count_if((s >= 0.6) & (s < 0.8)).alias("good"),
        F.count_if((s >= 0.4) & (s < 0.6)).alias("acceptable"),
        F.count_if(s < 0.4).alias("poor"),
    )


def author_report(outputs: DataFrame) -> DataFrame:
    return outputs.groupBy("author").agg(F.round(F.avg("overall_score"), 6).alias("avg_score"), F.round(F.stddev_pop("overall_score"), 6).alias("score_std"), F.count("*").alias("sample_count"))


def split(docs: DataFrame, key: str = "doc_id", ratio: float = 0.15, seed: int = 42) -> DataFrame:
    """`docs` with split: the ceil(n * ratio) rows of an author with the smallest hashes validate; an only row trains.

    Rows without an author are a group of their own, rows without a key rank first in theirs. Ranks are counted within (author, first byte of the hash), so an author of any share is dealt over tasks.
    """
    hashed = docs.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}|"), c(key).cast("string")))).withColumn("_b", F.substring("_h", 1, 2))
    sizes = hashed.groupBy("author", "_b").agg(F.count("*").alias("_n"))
    w = W.partitionBy("author")
    before = sizes.select("author", "_b", (F.sum("_n").over(w.orderBy("_b")) - c("_n")).alias("_before"), F.sum("_n").over(w).alias("_all"))
    same = c("author").eqNullSafe(c("_author")) & c("_b").eqNullSafe(c("_c"))
    ranked = hashed.join(before.withColumnsRenamed({"author": "_author", "_b": "_c"}), same).withColumn("_rank", c("_before") + F.row_number().over(W.partitionBy("author", "_b").orderBy("_h", key)))
    held = (c("_all") > 1) & (c("_rank") <= F.ceil(c("_all") * ratio))
    return ranked.withColumn("split", F.when(held, "validation").otherwise("train")).drop("_h", "_b", "_before", "_all", "_rank", "_author", "_c")


def prepare(examples: DataFrame, key: str = "doc_id", ratio: float = 0.15, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(examples with split, corpora, analysis) of `examples` (key, response, metadata.author).

    Corpora hold a row for each author with the number of its responses and their characters; responses stay rows
    of the first table, as an author's may be too many for one row. Analysis is the balance of the split by author.
    """
    rows = split(examples.withColumn("author", c("metadata.author")), key, ratio, seed)
    corpora = rows.groupBy("author").agg(F.count("*").alias("responses"), F.sum(F.length("response")).alias("characters"))
    return rows, corpora, split_balance(rows)


def plain_split(docs: DataFrame, key: str = "doc_id", ratio: float = 0.1, seed: int = 42) -> DataFrame:
    """`docs` with split by hash alone; sizes are near the ratio."""
    share = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), c(key).cast("string"))), 1, 8), 16, 10).cast("long") / 2**32
    return docs.withColumn("split", F.when(share < ratio, "validation").otherwise("train"))


def split_balance(rows: DataFrame) -> DataFrame:
    """Per author: rows to train and to validate, and the share of the latter."""
    out = rows.groupBy("author").agg(F.count_if(c("split") == "train").alias("train_count"), F.count_if(c("split") == "validation").alias("val_count"))
    return out.withColumn("val_ratio", F.round(c("val_count") / (c("train_count") + c("val_count")), 6))


def split_summary(rows: DataFrame) -> DataFrame:
    b = split_balance(rows)
    return b.agg(
        F.sum(c("train_count") + c("val_count")).alias("total_documents"),
        F.sum("train_count").alias("train_documents"),
        F.sum("val_count").alias("validation_documents"),
        F.round(F.sum("val_count") / F.sum(c("train_count") + c("val_count")), 6).alias("actual_ratio"),
        F.count("*").alias("total_authors"),
        F.count_if(c("train_count") > 0).alias("authors_in_train"),
        F.count_if(c("val_count") > 0).alias("authors_in_validation"),
        F.count_if((c("train_count") > 0) & (c("val_count") > 0)).alias("authors_in_both"),
    )

"""Queries: sentence boundaries learnt from the corpus, and chunks to a budget of sub-words."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import subwords
from vellum.operators import boundaries
from vellum.plans import duck
from vellum.tables import corpus

c = F.col


def _model(s, d):
    return boundaries.collect(boundaries.learn(corpus(s, d)))


def _subwords(s, d):
    import public_tokenizers

    return subwords.chunk(corpus(s, d), public_tokenizers.path("word_bpe_49k.json"), "overlap", 256, 32, "\n", lower=True)


QUERIES = {
    "sentence_model": lambda s, d: boundaries.learn(corpus(s, d)).withColumn("score", F.round("score", 4)),
    "trained_sentences": lambda s, d: corpus(s, d).select("doc_id", boundaries.splitter(s, _model(s, d))(c("content")).alias("parts")).select("doc_id", F.size("parts").alias("n_sentences"), F.array_max(F.transform("parts", F.length)).alias("longest")),
    # no SQL: words are cut into pieces letter by letter; tests hold it against a plain search
    "chunk_subwords": lambda s, d: _subwords(s, d).select("doc_id", "chunk_id", "total_chunks", "token_count", "content"),
}

_OUTER = duck.lit("^[\"'(\\[{“‘«„]+|[\"')\\]}”’»]+$")
_CORE = lambda x: f"regexp_replace({x}, {_OUTER}, '', 'g')"
_BARE = lambda x: f"lower(regexp_replace({x}, '[.,;:!?…]+$', ''))"
_KIND = lambda x: f"CASE WHEN regexp_matches({x}, '^-?[0-9][0-9.,-]*$') THEN '##number##' ELSE {x} END"
# Dunning: how much likelier the counts are with two chances than with one
_PART = lambda k, q, m: f"({k} * ln({q}) + ({m}) * ln(1 - ({q})))"
_LLR = f"""-2 * ({_PART('ab', 'b / n', 'a - ab')} + {_PART('(b - ab)', 'b / n', 'n - a - b + ab')} - CASE WHEN ab = a THEN 0 ELSE {_PART('ab', 'ab / a', 'a - ab')} END
    - CASE WHEN ab = b OR n - a - b + ab <= 0 THEN 0 ELSE {_PART('(b - ab)', '(b - ab) / (n - a)', 'n - a - b + ab')} END)"""
_LEARNT = f"""tk AS (SELECT doc_id, regexp_extract_all(text, '[^ \\t\\n\\x0B\\f\\r]+') AS t FROM documents),
    co AS (SELECT doc_id, {_CORE('tok')} AS core, {_CORE('nxt')} AS th FROM (SELECT doc_id, unnest(t) AS tok, unnest(list_append(t[2:], NULL)) AS nxt FROM tk)),
    ba AS (SELECT doc_id, core, th, {_BARE('core')} AS k0, {_BARE('th')} AS n0 FROM co),
    al AS (SELECT doc_id, core, th, {_KIND('k0')} AS kind, {_KIND('n0')} AS nxt FROM ba),
    ty AS (SELECT kind, count(*) AS c, count(*) FILTER (WHERE regexp_matches(core, '[^.]\\.$')) AS d FROM al WHERE kind <> '' GROUP BY kind),
    tot AS (SELECT sum(c)::DOUBLE AS n, sum(d)::DOUBLE AS dn FROM ty),
    ab AS (SELECT * FROM (SELECT kind, d, -2 * ((d * ln(dn / n) + (c - d) * ln(1 - dn / n)) - (d * ln(0.99::DOUBLE) + (c - d) * ln(0.01::DOUBLE))) * exp(-len) * (length(kind) - len + 1) * pow(len, -(c - d)) AS score
        FROM (SELECT *, length(replace(kind, '.', '')) AS len FROM ty WHERE d > 0 AND regexp_matches(kind, '\\p{{L}}')), tot) WHERE score >= 0.3),
    pr AS (SELECT kind, nxt, regexp_matches(core, '[^.]\\.$') AND (kind IN (SELECT kind FROM ab) OR kind = '##number##' OR regexp_matches(kind, '^\\p{{L}}$')) AS open, count(*) AS k
        FROM al WHERE kind <> '' AND nxt <> '' AND (regexp_matches(core, '[^.]\\.$') OR regexp_matches(core, '[!?]$')) GROUP BY ALL),
    st AS (SELECT * FROM (SELECT nxt, ab, {_LLR} AS score FROM (SELECT nxt, sum(k)::DOUBLE AS ab FROM pr WHERE NOT open GROUP BY nxt), (SELECT sum(k)::DOUBLE AS a FROM pr WHERE NOT open), (SELECT kind, c::DOUBLE AS b FROM ty), tot WHERE nxt = kind AND regexp_matches(nxt, '\\p{{L}}') AND n / a > b / ab) WHERE score >= 30),
    cl AS (SELECT * FROM (SELECT p.kind, nxt, ab, {_LLR} AS score FROM (SELECT kind, nxt, sum(k)::DOUBLE AS ab FROM pr WHERE open GROUP BY ALL HAVING sum(k) > 1) p, (SELECT kind, c::DOUBLE AS a FROM ty) x, (SELECT kind, c::DOUBLE AS b FROM ty) y, tot
        WHERE p.kind = x.kind AND nxt = y.kind AND regexp_matches(nxt, '\\p{{L}}') AND n / a > b / ab) WHERE score >= 7.88)"""

ORACLES = {
    "sentence_model": f"WITH {_LEARNT} SELECT 'abbreviation' AS kind, kind AS first, NULL AS second, d AS n, round(score, 4) AS score FROM ab UNION ALL SELECT 'starter', nxt, NULL, ab::BIGINT, round(score, 4) FROM st UNION ALL SELECT 'collocation', kind, nxt, ab::BIGINT, round(score, 4) FROM cl",
}

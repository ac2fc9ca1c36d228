"""Queries: chunking and its reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.functions import base, chunks
from vellum.operators import reports
from vellum.plans import duck
from vellum.tables import CORPUS, corpus

BUDGET = 128


def _chunks(spark, d, strategy) -> DataFrame:
    return chunks.chunk(corpus(spark, d), strategy, BUDGET, delimiter="\n").select("doc_id", "chunk_id", "total_chunks", "token_count", "content")


def _letters(text):
    return F.length(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))


QUERIES = {
    "chunk_sentences": lambda s, d: _chunks(s, d, "sentences"),
    # tokens counted by letters and digits rather than words
    "chunk_letters": lambda s, d: chunks.chunk(corpus(s, d), "sentences", 600, tokens=_letters).select("doc_id", "chunk_id", "total_chunks", "token_count", "content"),
    "chunk_paragraphs": lambda s, d: _chunks(s, d, "paragraph_aware"),
    "chunk_overlap": lambda s, d: _chunks(s, d, "overlap"),
    "chunk_fixed_chars": lambda s, d: corpus(s, d).select("doc_id", F.posexplode_outer(chunks.fixed(F.col("content"), 2000)).alias("pos", "piece")),
    "clean_whitespace": lambda s, d: corpus(s, d).select("doc_id", F.trim(F.regexp_replace("content", r"\s+", " ")).alias("content")),
    "word_counts": lambda s, d: corpus(s, d).select("doc_id", base.n_words(F.col("content")).alias("n_words"), F.size(chunks.sentences(F.col("content"))).alias("n_sentences")),
    "chunk_quality": lambda s, d: reports.chunk_quality(_chunks(s, d, "paragraph_aware"), BUDGET),
    "chunking_report": lambda s, d: reports.chunking_report(corpus(s, d), _chunks(s, d, "paragraph_aware"), BUDGET),
}

_ROWS = f"SELECT doc_id, unnest(range(len(chunks)))::INT AS chunk_id, len(chunks)::INT AS total_chunks, unnest(chunks) AS content FROM chunks"
_COUNTED = f"SELECT doc_id, chunk_id, total_chunks, len({duck.words('content')})::INT AS token_count, content FROM"
_SENTENCES = f"WITH docs AS ({CORPUS}),{duck.packed('docs', 'doc_id', duck.sentences('content'), BUDGET, duck.lit(' '), 'chunks')}"
_PARAGRAPHS = f"WITH {duck.paragraph_chunks(BUDGET)}"
_ENDS = "right(content, 1) IN ('.', '!', '?')"

_N = r"length(regexp_replace({}, '[^\p{{L}}\p{{N}}]', '', 'g'))".format

ORACLES = {
    "chunk_letters": f"WITH docs AS ({CORPUS}),{duck.packed('docs', 'doc_id', duck.sentences('content'), 600, duck.lit(' '), 'chunks', _N('x'))} SELECT doc_id, chunk_id, total_chunks, {_N('content')}::INT AS token_count, content FROM ({_ROWS})",
    "chunk_sentences": f"{_SENTENCES} {_COUNTED} ({_ROWS})",
    "chunk_paragraphs": f"{_PARAGRAPHS} {_COUNTED} ({_ROWS})",
    "chunk_overlap": f"""{_PARAGRAPHS}, r AS ({_ROWS}), o AS (SELECT doc_id, chunk_id, total_chunks, content, lag(content) OVER (PARTITION BY doc_id ORDER BY chunk_id) AS prev FROM r)
        {_COUNTED} (SELECT doc_id, chunk_id, total_chunks, CASE WHEN prev IS NULL THEN content ELSE array_to_string({duck.words('prev')}[-50:], ' ') || chr(10) || chr(10) || content END AS content FROM o)""",
    "chunk_fixed_chars": "SELECT doc_id, i::INT AS pos, substr(text, (i * 2000 + 1)::BIGINT, 2000) AS piece FROM (SELECT doc_id, text, unnest(range(greatest(ceil(length(text) / 2000.0)::INT, 1))) AS i FROM documents)",
    "clean_whitespace": r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS content FROM documents",
    "word_counts": f"SELECT doc_id, len({duck.words('text')})::INT AS n_words, len({duck.sentences('text')})::INT AS n_sentences FROM documents",
    "chunk_quality": f"""{_PARAGRAPHS}, r AS ({_COUNTED} ({_ROWS}))
        SELECT doc_id, round(avg(token_count), 6) AS avg_tokens, round(avg(token_count) / {BUDGET}, 6) AS token_utilization, round(avg(({_ENDS})::INT), 6) AS boundary_preservation,
        round(CASE WHEN count(*) > 1 AND avg(token_count) > 0 THEN 1 - stddev_samp(token_count) / avg(token_count) ELSE 1.0 END, 6) AS size_consistency FROM r GROUP BY doc_id""",
    "chunking_report": f"""{_PARAGRAPHS}, r AS ({_COUNTED} ({_ROWS})), o AS (SELECT count(*) AS n, sum(len({duck.words('text')})) AS w FROM documents),
        a AS (SELECT count(*) AS n, sum(token_count) AS w, avg(token_count) AS m, stddev_samp(token_count) AS sd, count(*) FILTER (WHERE {_ENDS}) AS e FROM r)
        SELECT o.n AS original_docs, a.n AS total_chunks, round(a.n / o.n, 6) AS chunks_per_doc, round(a.w / o.w, 6) AS token_preservation, round(m, 6) AS avg_chunk_size, round(sd, 6) AS chunk_size_std,
        round(m / {BUDGET}, 6) AS token_utilization, round(1 - sd / m, 6) AS size_consistency, e AS complete_sentences, round(e / a.n, 6) AS sentence_preservation_rate FROM o, a""",
}

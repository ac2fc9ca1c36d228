"""Queries: style, quality, splits, embeddings, near duplicates. Generated texts are assistant turns, corpora user turns."""

from __future__ import annotations

from pyspark.sql import functions as F

from vellum.functions import quality
from vellum.operators import curation, evaluation, vectors
from vellum.tables import corpus, load, spread

c = F.col
KEEP = ("vocab_overlap", "structure_similarity", "rhetorical_score", "ngram_similarity", "style_features", "overall_similarity")


def _texts(s, d):
    lead = F.when(c("conv_id") % 3 == 0, "Brothers and sisters, I know that God will help. ").otherwise("")
    return spread(load(s, d, "conversations")).select((c("conv_id") * 1000 + c("turn")).alias("id"), F.concat(F.lit("author "), (c("conv_id") % 4).cast("string")).alias("author"), F.concat(lead, c("text")).alias("text"), "role")


def _pair(s, d):
    t = _texts(s, d)
    return t.where("role = 'assistant'").drop("role"), t.where("role = 'user'").select("author", "text")


def _r(df, *cols):
    return df.select(*[c for c in df.columns if c not in cols], *[F.round(x, 6).alias(x) for x in cols])


def _scores(s, d):
    return corpus(s, d).select("doc_id", quality.scores(c("content")).alias("q")).select("doc_id", *[F.round(f"q.{k}", 6).alias(k) for k in ("readability", "coherence", "completeness", "grammar_quality", "overall_quality")])


def _split(s, d):
    return evaluation.split(corpus(s, d).select("doc_id", c("source").alias("author")))


QUERIES = {
    "vocab_overlap": lambda s, d: _r(evaluation.vocab_overlap(*_pair(s, d)), "vocab_overlap"),
    "sentence_structure": lambda s, d: _r(evaluation.feature_scores(*_pair(s, d)).select("id", "structure_similarity"), "structure_similarity"),
    "rhetorical_score": lambda s, d: _r(evaluation.feature_scores(*_pair(s, d)).select("id", "rhetorical_score"), "rhetorical_score"),
    "style_features": lambda s, d: _r(evaluation.feature_scores(*_pair(s, d)).select("id", "style_features"), "style_features"),
    "ngram_tfidf": lambda s, d: _r(evaluation.ngram_similarity(*_pair(s, d)), "ngram_similarity"),
    "style_overall": lambda s, d: evaluation.style(*_pair(s, d)).select("id", F.round("overall_similarity", 5).alias("overall_similarity")),
    "content_quality": _scores,
    "output_evaluation": lambda s, d: evaluation.evaluate(*_pair(s, d)).select("id", "author", *[F.round(k, 5).alias(k) for k in ("consistency_score", "overall_quality", "overall_score")]),
    "eval_report": lambda s, d: evaluation.report(evaluation.evaluate(*_pair(s, d))),
    "eval_author_report": lambda s, d: evaluation.author_report(evaluation.evaluate(*_pair(s, d))),
    "stratified_split": _split,
    "prepared_sets": lambda s, d: (lambda made: made[1].join(made[2], "author"))(evaluation.prepare(corpus(s, d).select("doc_id", c("content").alias("response"), F.struct(c("source").alias("author")).alias("metadata")))),
    "plain_split": lambda s, d: evaluation.plain_split(corpus(s, d).select("doc_id")),
    "split_quality": lambda s, d: evaluation.split_balance(_split(s, d)),
    "split_summary": lambda s, d: evaluation.split_summary(_split(s, d)),
    "author_counts": lambda s, d: corpus(s, d).groupBy("author").agg(F.count("*").alias("n")),
    "cosine_mean": lambda s, d: vectors.mean_similarity(load(s, d, "embeddings"), load(s, d, "embeddings"), "label"),
    "cosine_topk": lambda s, d: vectors.nearest(load(s, d, "embeddings"), load(s, d, "embeddings").where("vec_id % 20 = 0")),
    "near_dups": lambda s, d: curation.near_duplicates(corpus(s, d)),
    "ocr_ratio": lambda s, d: corpus(s, d).select("doc_id", F.round(quality.ocr_rate(c("content")), 6).alias("rate"), (quality.ocr_rate(c("content")) > 0.05).alias("faulty")),
    "quality_filter": lambda s, d: curation.by_quality(corpus(s, d)).select("doc_id", "quality_score", "kept"),
}

_TEXTS = "SELECT conv_id * 1000 + turn AS id, 'author ' || (conv_id % 4) AS author, CASE WHEN conv_id % 3 = 0 THEN 'Brothers and sisters, I know that God will help. ' ELSE '' END || text AS text, role FROM conversations"
_W = lambda x: rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')"
_SENT = lambda x: rf"string_split(regexp_replace({x}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"
_FEATS = f"""f AS (SELECT *, coalesce(list_avg(n), 0) AS avg_length, coalesce(list_var_pop(n), 0) AS length_variance, coalesce(list_avg(list_transform(w, lambda x: length(x))), 0) AS avg_word_length, coalesce(len(list_distinct(w)) / nullif(len(w), 0), 0) AS type_token_ratio,
    len(w) / len(n) AS avg_sentence_length, coalesce(len(regexp_extract_all(text, '[.,!?;:]')) / nullif(length(text), 0), 0) AS punctuation_density, {', '.join(f"len(regexp_extract_all(lower(text), '{p}')) AS p{i}" for i, p in enumerate(quality.RHETORIC))}
    FROM (SELECT *, {_W('text')} AS w, list_transform({_SENT('text')}, lambda s: len({_W('s')})) AS n FROM ({_TEXTS})))""".replace("list_var_pop(n)", "(list_avg(list_transform(n, lambda x: x * x)) - list_avg(n) * list_avg(n))")
_ALL = ["avg_length", "length_variance", *evaluation.FEATURES, *[f"p{i}" for i in range(8)]]
_CMP = f"WITH {_FEATS}, r AS (SELECT author, {', '.join(f'avg({x}) AS r_{x}' for x in _ALL)} FROM f WHERE role = 'user' GROUP BY author), g AS (SELECT f.*, r.* EXCLUDE (author) FROM f JOIN r ON f.author = r.author WHERE role = 'assistant')"
_STRUCT = "((1 - abs(avg_length - r_avg_length) / greatest(r_avg_length, 1)) + (1 - abs(length_variance - r_length_variance) / greatest(r_length_variance, 1))) / 2"
_RHET = "(" + " + ".join(f"CASE WHEN r_p{i} > 0 THEN least(p{i} / r_p{i}, 2) / 2 WHEN p{i} = 0 THEN 1 ELSE 0 END" for i in range(8)) + ") / 8"
_STYLE = "list_avg(list_filter([" + ", ".join(f"CASE WHEN r_{x} > 0 THEN greatest(0, 1 - abs({x} - r_{x}) / r_{x}) END" for x in evaluation.FEATURES) + "], lambda x: x IS NOT NULL))"
_VOCAB = f"""v AS (SELECT DISTINCT author, unnest({_W('lower(text)')}) AS w FROM ({_TEXTS}) WHERE role = 'user'), vs AS (SELECT author, count(*) AS size FROM v GROUP BY author),
    vg AS (SELECT DISTINCT id, author, unnest({_W('lower(text)')}) AS w FROM ({_TEXTS}) WHERE role = 'assistant'), vh AS (SELECT id, count(*) AS hits FROM vg JOIN v USING (author, w) GROUP BY id),
    vo AS (SELECT t.id, coalesce(hits / size, 0) AS vocab_overlap FROM ({_TEXTS}) t LEFT JOIN vh ON t.id = vh.id LEFT JOIN vs ON t.author = vs.author WHERE role = 'assistant')"""
_NG = rf"""nw AS (SELECT id, author, role, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM ({_TEXTS})),
    nt AS (SELECT id, author, role, unnest(list_concat(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]), list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS term FROM nw),
    nr AS (SELECT author, term, count(*) AS rn FROM nt WHERE role = 'user' GROUP BY ALL), ngn AS (SELECT id, author, term, count(*) AS gn FROM nt WHERE role = 'assistant' GROUP BY ALL),
    nb AS (SELECT id, term, max(rn) AS rn, max(gn) AS gn FROM (SELECT t.id, nr.term, rn, 0 AS gn FROM (SELECT id, author FROM nw WHERE role = 'assistant') t JOIN nr ON t.author = nr.author UNION ALL SELECT id, term, 0, gn FROM ngn) GROUP BY ALL),
    nk AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY rn + gn DESC, term) AS k, ln(3.0 / (1 + (rn > 0)::INT + (gn > 0)::INT)) + 1 AS idf FROM nb),
    ns AS (SELECT id, coalesce(sum(rn * idf * gn * idf) / nullif(sqrt(sum(rn * idf * rn * idf) * sum(gn * idf * gn * idf)), 0), 0) AS ngram_similarity FROM nk WHERE k <= 1000 GROUP BY id),
    ng AS (SELECT t.id, coalesce(ngram_similarity, 0) AS ngram_similarity FROM ({_TEXTS}) t LEFT JOIN ns ON t.id = ns.id WHERE role = 'assistant')"""
_OVERALL = f"{_CMP}, {_VOCAB}, {_NG}, o AS (SELECT g.id, g.author, g.text, vocab_overlap * 0.25 + {_STRUCT} * 0.25 + {_RHET} * 0.2 + ngram_similarity * 0.2 + {_STYLE} * 0.1 AS overall_similarity FROM g JOIN vo ON g.id = vo.id JOIN ng ON g.id = ng.id)"
_QUAL = lambda src: f"""(SELECT *, CASE WHEN nw = 0 THEN 0 ELSE (readability + coherence + completeness + grammar_quality) / 4 END AS overall_quality FROM (SELECT *, len(w) AS nw, 1 / (1 + len(w) / len(s) / 20 + coalesce(list_avg(list_transform(w, lambda x: length(x))), 0) / 6) AS readability,
    CASE WHEN len(s) < 2 THEN 1 ELSE coalesce(list_avg(list_filter(list_transform(range(1, len(s)), lambda i: len(list_intersect(sw[i], sw[i + 1])) / nullif(len(list_distinct(list_concat(sw[i], sw[i + 1]))), 0)), lambda x: x IS NOT NULL)), 0) END AS coherence,
    (CASE WHEN regexp_matches(regexp_replace(text, '\\s+$', ''), '[.!?]$') THEN 1 ELSE 0.5 END) * 0.4 + least(len(w) / 50, 1) * 0.4 + (CASE WHEN len(s) >= 2 THEN 1 ELSE 0.7 END) * 0.2 AS completeness,
    (CASE WHEN regexp_matches(text, '\\p{{Lu}}') THEN 0.3 ELSE 0 END) + (CASE WHEN regexp_matches(text, '[.,!?;:]') THEN 0.3 ELSE 0 END) + len(list_filter(s, lambda x: regexp_matches(x, '^\\p{{Lu}}'))) / len(s) * 0.4 AS grammar_quality
    FROM (SELECT *, {_W('text')} AS w, {_SENT('text')} AS s, list_transform({_SENT('text')}, lambda x: list_distinct({_W('lower(x)')})) AS sw FROM {src})))"""  # noqa: E731
_EVAL = f"{_OVERALL}, ev AS (SELECT id, author, overall_similarity, overall_similarity AS consistency_score, overall_quality, overall_similarity * 0.5 + overall_quality * 0.3 + overall_similarity * 0.2 AS overall_score FROM {_QUAL('o')})"
_SPLIT = "SELECT doc_id, author, CASE WHEN n > 1 AND k <= ceil(n * 0.15) THEN 'validation' ELSE 'train' END AS split FROM (SELECT doc_id, source AS author, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY md5('42|' || doc_id), doc_id) AS k FROM documents)"
_BALANCE = f"SELECT author, count(*) FILTER (WHERE split = 'train') AS train_count, count(*) FILTER (WHERE split = 'validation') AS val_count, round(count(*) FILTER (WHERE split = 'validation') / count(*), 6) AS val_ratio FROM ({_SPLIT}) GROUP BY author"
_COS = "list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"
_SETS = r"sets AS (SELECT doc_id, list_sort(list_distinct(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''))) AS words FROM documents), classes AS (SELECT words, min(doc_id) AS class_id, count(*) AS size FROM sets GROUP BY words)"

ORACLES = {
    "vocab_overlap": f"WITH {_VOCAB} SELECT id, round(vocab_overlap, 6) AS vocab_overlap FROM vo",
    "sentence_structure": f"{_CMP} SELECT id, round({_STRUCT}, 6) AS structure_similarity FROM g",
    "rhetorical_score": f"{_CMP} SELECT id, round({_RHET}, 6) AS rhetorical_score FROM g",
    "style_features": f"{_CMP} SELECT id, round({_STYLE}, 6) AS style_features FROM g",
    "ngram_tfidf": f"WITH {_NG} SELECT id, round(ngram_similarity, 6) AS ngram_similarity FROM ng",
    "style_overall": f"{_OVERALL} SELECT id, round(overall_similarity, 5) AS overall_similarity FROM o",
    "content_quality": f"SELECT doc_id, {', '.join(f'round({k}, 6)::DOUBLE AS {k}' for k in ('readability', 'coherence', 'completeness', 'grammar_quality', 'overall_quality'))} FROM {_QUAL('documents')}",
    "output_evaluation": f"{_EVAL} SELECT id, author, {', '.join(f'round({k}, 5) AS {k}' for k in ('consistency_score', 'overall_quality', 'overall_score'))} FROM ev",
    "eval_report": f"{_EVAL} SELECT {', '.join(f'round(avg({k}), 6) AS avg_{k}' for k in ('overall_similarity', 'overall_quality', 'consistency_score', 'overall_score'))}, {', '.join(f'round(stddev_pop({k}), 6) AS std_{k}' for k in ('overall_similarity', 'overall_quality', 'consistency_score'))}, round(min(overall_score), 6) AS min_score, round(max(overall_score), 6) AS max_score, round(max(overall_score) - min(overall_score), 6) AS score_span, count(*) AS total_evaluations, count(*) FILTER (WHERE overall_score >= 0.8) AS excellent, count(*) FILTER (WHERE overall_score >= 0.6 AND overall_score < 0.8) AS good, count(*) FILTER (WHERE overall_score >= 0.4 AND overall_score < 0.6) AS acceptable, count(*) FILTER (WHERE overall_score < 0.4) AS poor FROM ev",
    "eval_author_report": f"{_EVAL} SELECT author, round(avg(overall_score), 6) AS avg_score, round(stddev_pop(overall_score), 6) AS score_std, count(*) AS sample_count FROM ev GROUP BY author",
    "stratified_split": _SPLIT,
    "prepared_sets": f"SELECT b.*, responses, characters FROM ({_BALANCE}) b JOIN (SELECT source AS author, count(*) AS responses, sum(length(text))::BIGINT AS characters FROM documents GROUP BY source) USING (author)",
    "plain_split": "SELECT doc_id, CASE WHEN ('0x' || substr(md5('42|' || doc_id), 1, 8))::BIGINT / 4294967296 < 0.1 THEN 'validation' ELSE 'train' END AS split FROM documents",
    "split_quality": _BALANCE,
    "split_summary": f"SELECT sum(train_count + val_count)::BIGINT AS total_documents, sum(train_count)::BIGINT AS train_documents, sum(val_count)::BIGINT AS validation_documents, round(sum(val_count) / sum(train_count + val_count), 6) AS actual_ratio, count(*) AS total_authors, count(*) FILTER (WHERE train_count > 0) AS authors_in_train, count(*) FILTER (WHERE val_count > 0) AS authors_in_validation, count(*) FILTER (WHERE train_count > 0 AND val_count > 0) AS authors_in_both FROM ({_BALANCE})",
    "author_counts": "SELECT author, count(*) AS n FROM (SELECT CASE doc_id % 4 WHEN 0 THEN 'Russell M. Nelson' WHEN 1 THEN 'Dieter F. Uchtdorf' WHEN 2 THEN 'Jeffrey R. Holland' ELSE source END AS author FROM documents) GROUP BY author",
    "cosine_mean": f"SELECT a.label AS left_key, b.label AS right_key, round(avg({_COS}), 6) AS mean_similarity FROM embeddings a, embeddings b GROUP BY ALL",
    "cosine_topk": f"SELECT query_id, rank, vec_id, round(s, 6) AS similarity FROM (SELECT a.vec_id AS query_id, b.vec_id, {_COS} AS s, (row_number() OVER (PARTITION BY a.vec_id ORDER BY {_COS} DESC, b.vec_id))::INT AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id) WHERE rank <= 5",
    "near_dups": f"""WITH {_SETS}, w AS (SELECT class_id, len(words) AS n, size, unnest(words) AS w FROM classes),
        p AS (SELECT a.class_id, b.class_id AS other, any_value(b.size) AS size, count(*) AS shared, any_value(a.n) AS na, any_value(b.n) AS nb FROM w a JOIN w b ON a.w = b.w AND a.class_id <> b.class_id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) GROUP BY a.class_id, b.class_id),
        l AS (SELECT class_id, sum(size)::BIGINT AS n, min(other) AS other FROM p WHERE shared / (na + nb - shared) >= 0.8 GROUP BY class_id)
        SELECT s.doc_id, c.class_id, size - 1 + coalesce(n, 0) AS n_links, least(CASE WHEN s.doc_id <> c.class_id THEN c.class_id END, other) AS nearest_id FROM sets s JOIN classes c ON s.words = c.words LEFT JOIN l ON c.class_id = l.class_id""",
}

# word boundaries by runs of word characters, as SQL knows only those of ASCII: a line with two short words is one sign
_RUNS = lambda x: rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"
_OCR = rf"""(len(list_filter({_RUNS('text')}, lambda w: regexp_matches(w, '^[a-z]+[0-9]+[a-z]+$') OR regexp_matches(w, '^[A-Z]{{3,}}$'))) + len(regexp_extract_all(text, '[^\p{{L}}\p{{N}}_\s]{{3,}}'))
    + len(list_filter(string_split(text, chr(10)), lambda l: len(list_filter({_RUNS('l')}, lambda w: length(w) <= 2)) >= 2))) / nullif(len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')), 0)"""
_SCORED = f"SELECT doc_id, round((CASE WHEN coalesce(rate, 0) > 0.05 THEN 0 ELSE 0.4 END) + readability * 0.3 + completeness * 0.2 + grammar_quality * 0.1, 6) AS quality_score FROM (SELECT *, {_OCR} AS rate FROM {_QUAL('documents')})"
ORACLES |= {
    "ocr_ratio": f"SELECT doc_id, round({_OCR}, 6) AS rate, {_OCR} > 0.05 AS faulty FROM documents",
    "quality_filter": f"SELECT doc_id, quality_score, quality_score >= 0.7 AS kept FROM ({_SCORED})",
}

"""Queries: classification, prompts and training examples."""

from __future__ import annotations


from pyspark.sql import functions as F

from vellum.functions import classify, prompts
from vellum.functions.base import strip
from vellum.operators import training
from vellum.plans import duck
from vellum.plans.chunking import BUDGET
from vellum.tables import CORPUS, corpus, load

c = F.col


def _spoken(s, d):
    """Documents with keyword-bearing lead-ins, since the invented texts hold none; every fifth has none."""
    lead = F.expr(f"case doc_id % 7 {' '.join(f'when {i} then {duck.lit(t)}' for i, t in enumerate(LEADS))} else '' end")
    return corpus(s, d).withColumn("content", F.concat(lead, c("content"))).withColumn("title", F.when(c("doc_id") % 11 == 0, "A Prayer of Witness").when(c("doc_id") % 11 == 1, "The Doctrine of Truth").otherwise(c("title")))


LEADS = ["I know that faith and family matter. I testify of it. ", "We thank thee, heavenly father, in the name of Jesus. amen ", "First learn, second ponder, third teach. Brothers and sisters, let me suggest service. ", "When i was young i remember years ago. I learned that mercy helps. ", "The doctrine of truth is eternal; revelation gives direction. "]
_SPOKEN = f"""SELECT doc_id, author, date, source, CASE doc_id % 11 WHEN 0 THEN 'A Prayer of Witness' WHEN 1 THEN 'The Doctrine of Truth' ELSE title END AS title,
    CASE doc_id % 7 {' '.join(f'WHEN {i} THEN {duck.lit(t)}' for i, t in enumerate(LEADS))} ELSE '' END || content AS content FROM ({CORPUS})"""


def _conversations(s, d):
    asked = load(s, d, "conversations").where("role = 'user'")
    who = F.element_at(F.array(*[F.lit(p[0]) for p in prompts.PROFILES], F.lit("Ann Author")), (c("conv_id") % 4 + 1).cast("int"))
    docs = asked.select("conv_id", "turn", who.alias("author"), F.lit("Conversation about gospel topics").alias("title"), F.lit("Recent").alias("date"), c("text").alias("content"))
    return prompts.generate(docs, c("content"), "conversation").select("conv_id", "turn", "author", "prompt")


QUERIES = {
    "classify_content": lambda s, d: _spoken(s, d).select("doc_id", classify.content_type(c("title"), c("content")).alias("content_type")),
    "classify_scores": lambda s, d: _spoken(s, d).select("doc_id", F.lower("title").alias("t"), F.lower("content").alias("x")).select("doc_id", *[v.alias(k) for k, v in classify.type_scores(c("t"), c("x")).items()]),
    "classify_simple": lambda s, d: _spoken(s, d).select("doc_id", classify.simple_type(c("title"), c("content")).alias("content_type")),
    "topic_extract": lambda s, d: _spoken(s, d).select("doc_id", classify.topic(c("content")).alias("topic")),
    "type_histogram": lambda s, d: _spoken(s, d).select(classify.content_type(c("title"), c("content")).alias("content_type")).groupBy("content_type").agg(F.count("*").alias("n")).withColumn("template_name", F.coalesce(*[F.when(c("content_type") == k, v) for k, v in prompts.TEMPLATE_OF.items()])),
    "speaker_context": lambda s, d: prompts.with_context(corpus(s, d).select("doc_id", "author")),
    "template_select": lambda s, d: prompts.generate(_spoken(s, d)).select("doc_id", "content_type", c("level").alias("want"), "template_name", "template_level"),
    "template_table": lambda s, d: prompts.selection(s).select("content_type", "want", "template_name"),
    "prompt_generate": lambda s, d: prompts.generate(_spoken(s, d)).select("doc_id", "template_name", "prompt"),
    "prompt_validate": lambda s, d: prompts.generate(_spoken(s, d)).select("doc_id", F.array_join(prompts.prompt_issues(c("prompt")), "; ").alias("issues"), F.length("prompt").alias("length"), prompts.estimated_tokens(c("prompt")).alias("estimated_tokens")),
    "template_validate": lambda s, d: prompts.templates(s).select("name", F.array_join(prompts.template_issues(c("template")), "; ").alias("issues"), (F.size(prompts.template_issues(c("template"))) == 0).alias("is_valid"), F.coalesce(*[F.when(c("level") == k, v) for k, v in prompts.COMPLEXITY.items()]).alias("complexity_score")),
    "template_suggest": lambda s, d: prompts.templates(s).select("name", F.array_join(F.concat(F.transform(prompts.template_issues(c("template")), lambda x: F.concat(F.lit("Fix: "), x)), F.when(c("level") == "simple", F.array(F.lit("Consider adding more context for better training"))).when(c("level") == "advanced", F.array(F.lit("Ensure sufficient examples for complex patterns"))).otherwise(F.array().cast("array<string>"))), "; ").alias("suggestions")),
    "template_metrics": lambda s, d: prompts.templates(s).select("name", F.length("template").alias("length"), prompts.n_words(c("template")).alias("word_count"), F.regexp_count("template", F.lit(r"\{")).alias("variable_count"), "mode", F.array_join("content_types", ",").alias("content_types")),
    "difficulty_progression": lambda s, d: prompts.templates(s).groupBy("level").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("ord", "name"))), lambda x: x["name"]), ",").alias("names")),
    "conversation_prompt": _conversations,
    "prompt_effectiveness": lambda s, d: training.effectiveness(_spoken(s, d)),
    "prompt_effectiveness_summary": lambda s, d: training.effectiveness_summary(_spoken(s, d)),
    "training_examples": lambda s, d: training.examples(_spoken(s, d), "paragraph_aware", BUDGET, "\n").select("doc_id", "prompt", "response", "metadata.*"),
    "pipeline_report": lambda s, d: training.pipeline_report(_spoken(s, d), training.examples(_spoken(s, d), "paragraph_aware", BUDGET, "\n")),
}

_TEMPLATES = "(VALUES " + ", ".join(f"({i}, {duck.lit(n)}, {duck.lit(lv)}, [{', '.join(map(duck.lit, cts))}], {str(nc).upper()}, {duck.lit(m)}, {duck.lit(t)})" for i, (n, lv, cts, nc, m, t) in enumerate(prompts.TEMPLATES)) + ") AS t(ord, name, level, content_types, needs_context, mode, template)"
_PROFILES = "(VALUES " + ", ".join("(" + ", ".join(duck.lit(x) for x in (n, lv, st, ", ".join(ph[:3]), ", ".join(pa[:2]), ", ".join(to[:3]))) + ")" for n, lv, st, ph, pa, to in prompts.PROFILES) + ") AS p(speaker, level, speaking_style, common_phrases, rhetorical_patterns, topic_expertise)"
_LEVEL = lambda x: f"list_position(['simple', 'moderate', 'complex', 'advanced'], {x})"
_SELECTION = f"""SELECT content_type, want, arg_min(name, {{'d': abs({_LEVEL('level')} - {_LEVEL('want')}), 'o': ord}}) AS template_name FROM {_TEMPLATES},
    (SELECT unnest([{', '.join(map(duck.lit, [*classify.RULES, 'general', 'conversation', 'interview']))}]) AS content_type), (SELECT unnest(['simple', 'moderate', 'complex', 'advanced']) AS want)
    WHERE list_contains(content_types, content_type) OR list_contains(content_types, 'general') GROUP BY ALL"""
_SIMPLE = """CASE WHEN contains(lower(title), 'testimony') OR contains(lower(title), 'witness') THEN 'testimony' WHEN contains(lower(title), 'pray') THEN 'prayer'
    WHEN contains(lower(content), 'i know') OR contains(lower(content), 'i testify') THEN 'testimony' WHEN contains(lower(content), 'heavenly father') OR contains(lower(content), 'amen') THEN 'prayer' ELSE 'general' END"""
_CONTEXT = ", ".join(f"coalesce({k}, {duck.lit(v)}) AS {k}" for k, v in prompts.DEFAULT_CONTEXT.items())
_LEVELLED = f"SELECT x.*, coalesce(level, 'moderate') AS level, {_CONTEXT}, speaker IS NOT NULL AS has_profile FROM"
_PARTIAL = "CASE WHEN length(content) > 200 THEN substr(content, 1, 200) || '...' ELSE content END"


def _fill(template: str, question: str) -> str:
    values = {k: k for k in prompts.VARIABLES} | {"question": question, "partial_text": _PARTIAL}
    return duck.fill(template, values)


_VERBS = lambda x, vs: "(" + " OR ".join(f"contains(lower({x}), {duck.lit(v)})" for v in vs) + ")"
_ISSUES = lambda x: f"array_to_string(list_filter([CASE WHEN length({x}) < 50 THEN 'Prompt too short' WHEN length({x}) > 2000 THEN 'Prompt too long' END, CASE WHEN contains({x}, '{{') AND contains({x}, '}}') THEN 'Unfilled template variables detected' END, CASE WHEN NOT {_VERBS(x, prompts.PROMPT_VERBS)} THEN 'No clear instruction found' END], lambda i: i IS NOT NULL), '; ')"
_TISSUES = f"list_filter([CASE WHEN length(template) < 50 THEN 'Template too short' WHEN length(template) > 2000 THEN 'Template too long' END, CASE WHEN NOT contains(template, '{{author}}') THEN 'Missing required variable: {{author}}' END, CASE WHEN NOT {_VERBS('template', prompts.TEMPLATE_VERBS)} THEN 'Template lacks clear instruction' END], lambda i: i IS NOT NULL)"
_ASKED = "'Can you share your thoughts about ' || topic || '?'"
_DRAWN = f"""WITH x AS ({_SPOKEN}), y AS (SELECT *, {_SIMPLE} AS content_type, {duck.topic_of('lower(content)')} AS topic FROM x), z AS ({_LEVELLED} y AS x LEFT JOIN {_PROFILES} ON author = speaker), sel AS ({_SELECTION}),
    w AS (SELECT z.*, sel.template_name, t.template, t.needs_context, t.level AS template_level FROM z JOIN sel ON z.content_type = sel.content_type AND z.level = sel.want JOIN {_TEMPLATES} ON t.name = sel.template_name),
    v AS (SELECT *, {_fill('template', _ASKED)} AS p1, {_fill(duck.lit(prompts.TEMPLATES[0][5]), _ASKED)} AS p0 FROM w),
    g AS (SELECT *, CASE WHEN {_ISSUES('p1')} = '' OR (needs_context AND contains({_ISSUES('p1')}, 'Unfilled')) THEN p1 ELSE p0 END AS prompt FROM v)"""
_TRAINING = {**prompts.TRAINING_TEMPLATES, **{t[0]: t[5] for t in prompts.TEMPLATES}}
_PICK = "CASE content_type " + " ".join(f"WHEN {duck.lit(k)} THEN {duck.lit(_TRAINING[v])}" for k, v in prompts.TEMPLATE_OF.items()) + " END"
_EXAMPLES = f"""WITH {duck.paragraph_chunks(BUDGET).replace(CORPUS, _SPOKEN)}, r AS (SELECT doc_id, unnest(range(len(chunks)))::INT AS chunk_id, len(chunks)::INT AS total_chunks, unnest(chunks) AS content FROM chunks),
    q AS (SELECT r.*, d.author, d.title, d.date, d.source, len({duck.words('r.content')})::INT AS token_count, lower(d.title) AS lt, lower(r.content) AS lc FROM r JOIN docs d ON r.doc_id = d.doc_id),
    ty AS (SELECT *, {duck.type_of('lt', 'lc')} AS content_type, {duck.topic_of('lc')} AS topic FROM q), z AS ({_LEVELLED} ty AS x LEFT JOIN {_PROFILES} ON author = speaker),
    e AS (SELECT doc_id, {_fill(_PICK, "'{question}'")} AS prompt, content AS response, author, title, date, source, chunk_id, total_chunks, token_count, content_type, 'auto_selected' AS template_used FROM z)"""

ORACLES = {
    "classify_content": f"SELECT doc_id, {duck.type_of('t', 'x')} AS content_type FROM (SELECT doc_id, lower(title) AS t, lower(content) AS x FROM ({_SPOKEN}))",
    "classify_scores": "SELECT doc_id, " + ", ".join("(" + " + ".join([f"3 * contains(t, {duck.lit(k)})::INT" for k in a] + [duck.count("x", k) for k in b] + [f"2 * {duck.regex_count('x', p)}" for p in r]) + f")::INT AS {n}" for n, (a, b, r) in classify.RULES.items()) + f" FROM (SELECT doc_id, lower(title) AS t, lower(content) AS x FROM ({_SPOKEN}))",
    "classify_simple": f"SELECT doc_id, {_SIMPLE} AS content_type FROM ({_SPOKEN})",
    "topic_extract": f"SELECT doc_id, {duck.topic_of('lower(content)')} AS topic FROM ({_SPOKEN})",
    "type_histogram": f"SELECT content_type, count(*) AS n, CASE content_type " + " ".join(f"WHEN {duck.lit(k)} THEN {duck.lit(v)}" for k, v in prompts.TEMPLATE_OF.items()) + f" END AS template_name FROM (SELECT {duck.type_of('t', 'x')} AS content_type FROM (SELECT lower(title) AS t, lower(content) AS x FROM ({_SPOKEN}))) GROUP BY content_type",
    "speaker_context": f"SELECT doc_id, author, coalesce(level, 'moderate') AS level, {_CONTEXT}, speaker IS NOT NULL AS has_profile FROM ({CORPUS}) LEFT JOIN {_PROFILES} ON author = speaker",
    "template_select": f"{_DRAWN} SELECT doc_id, content_type, level AS want, template_name, template_level FROM g",
    "template_table": _SELECTION,
    "prompt_generate": f"{_DRAWN} SELECT doc_id, template_name, prompt FROM g",
    "prompt_validate": f"{_DRAWN} SELECT doc_id, {_ISSUES('prompt')} AS issues, length(prompt)::INT AS length, round(len({duck.words('prompt')}) * 1.3::DOUBLE, 6) AS estimated_tokens FROM g",
    "template_validate": f"SELECT name, array_to_string({_TISSUES}, '; ') AS issues, len({_TISSUES}) = 0 AS is_valid, (CASE level WHEN 'simple' THEN 0.25 WHEN 'moderate' THEN 0.5 WHEN 'complex' THEN 0.75 ELSE 1 END)::DOUBLE AS complexity_score FROM {_TEMPLATES}",
    "template_suggest": f"SELECT name, array_to_string(list_concat(list_transform({_TISSUES}, lambda i: 'Fix: ' || i), CASE level WHEN 'simple' THEN ['Consider adding more context for better training'] WHEN 'advanced' THEN ['Ensure sufficient examples for complex patterns'] ELSE [] END), '; ') AS suggestions FROM {_TEMPLATES}",
    "template_metrics": f"SELECT name, length(template)::INT AS length, len({duck.words('template')})::INT AS word_count, (length(template) - length(replace(template, '{{', '')))::INT AS variable_count, mode, array_to_string(content_types, ',') AS content_types FROM {_TEMPLATES}",
    "difficulty_progression": f"SELECT level, string_agg(name, ',' ORDER BY ord) AS names FROM {_TEMPLATES} GROUP BY level",
    "conversation_prompt": f"""WITH q AS (SELECT conv_id, turn, text AS content, [{', '.join(duck.lit(p[0]) for p in prompts.PROFILES)}, 'Ann Author'][conv_id % 4 + 1] AS author, 'Conversation about gospel topics' AS title, 'Recent' AS date FROM conversations WHERE role = 'user'),
        y AS (SELECT *, {duck.topic_of('lower(content)')} AS topic FROM q), z AS ({_LEVELLED} y AS x LEFT JOIN {_PROFILES} ON author = speaker),
        v AS (SELECT *, {_fill(duck.lit(prompts.TEMPLATES[1][5]), 'content')} AS p1, {_fill(duck.lit(prompts.TEMPLATES[0][5]), 'content')} AS p0 FROM z)
        SELECT conv_id, turn, author, CASE WHEN {_ISSUES('p1')} = '' OR contains({_ISSUES('p1')}, 'Unfilled') THEN p1 ELSE p0 END AS prompt FROM v""",
    "prompt_effectiveness": f"""{_DRAWN} SELECT dimension, value, count(*) AS n FROM (SELECT unnest(['content_type', 'template', 'difficulty', 'speaker']) AS dimension, unnest([content_type, template_name, template_level, author]) AS value FROM g) GROUP BY ALL""",
    "prompt_effectiveness_summary": f"{_DRAWN} SELECT count(*) AS total_documents, count(DISTINCT content_type) AS classification_coverage, count(DISTINCT template_name) AS template_diversity, count(DISTINCT author) AS speaker_coverage, count(DISTINCT author) FILTER (WHERE has_profile) AS supported_speakers FROM g",
    "training_examples": f"{_EXAMPLES} SELECT * FROM e",
    "pipeline_report": f"{_EXAMPLES} SELECT (SELECT count(*) FROM documents) AS input_documents, count(*) AS examples, round(count(*) / (SELECT count(*) FROM documents), 6) AS expansion_ratio, round(avg(length(prompt)), 6) AS avg_prompt_length, round(avg(length(response)), 6) AS avg_response_length, count(DISTINCT content_type) AS content_type_coverage, count(DISTINCT template_used) AS template_diversity FROM e",
}

def _braced():
    """Titles, those of even documents with what looks like keys."""
    return F.when(F.col("doc_id") % 2 == 0, F.concat("title", F.lit(" {author} {theme}"))).otherwise(F.col("title"))


_OPEN = ["By {author}: {title}", "{author} on {theme} in {title}", "{theme} and {mood} by {author}"]


QUERIES |= {
    "prompt_missing_keys": lambda s, d: corpus(s, d).select("doc_id", prompts.fill_open(F.get(F.array(*map(F.lit, _OPEN)), F.col("doc_id").cast("int") % 3), {"author": F.when(F.col("doc_id") % 5 > 0, F.col("author")), "title": _braced()}).alias("prompt")),
    "prompt_factory": lambda s, d: prompts.training_prompts(corpus(s, d), "simple_completion"),
    "instruction_prompt": lambda s, d: corpus(s, d).select("doc_id", prompts.instruction(F.col("author"), F.col("title"), F.col("source"), F.col("content")).alias("text")),
    "leader_topics": lambda s, d: prompts.reflections(s, "Elder David A. Bednar", ["faith", "repentance"]),
    "padded_ids": lambda s, d: corpus(s, d).select("doc_id", prompts.padded(F.transform(F.split("content", " "), F.length), 512, 7).alias("x")).select("doc_id", F.size("x.input_ids").alias("n"), F.aggregate("x.attention_mask", F.lit(0), lambda a, y: a + y).alias("used"), F.array_join("x.input_ids", ",").alias("ids"), (F.col("x.labels") == F.col("x.input_ids")).alias("same")),
    "pipeline_histograms": lambda s, d: training.histograms(training.examples(_spoken(s, d), "paragraph_aware", BUDGET, "\n")),
}
_FILL = lambda t: duck.fill(duck.lit(t), {"author": "coalesce(CASE WHEN doc_id % 5 > 0 THEN author END, '[author]')", "title": "CASE WHEN doc_id % 2 = 0 THEN title || ' {author} {theme}' ELSE title END"})
ORACLES |= {
    "prompt_missing_keys": f"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN {_FILL(_OPEN[0])} WHEN 1 THEN {_FILL(_OPEN[1].replace('{theme}', '[theme]'))} ELSE {duck.lit(_OPEN[2])} || chr(10) || chr(10) || '[Missing template variable: ''theme'']' END AS prompt FROM ({CORPUS})",
    "prompt_factory": f"SELECT doc_id, 'Complete the following text in ' || author || {duck.lit("'s style:")} || chr(10) || chr(10) || chr(34) || CASE WHEN length(content) > 200 THEN substr(content, 1, 200) || '...' ELSE content END || chr(34) || chr(10) || chr(10) || 'Continue in ' || author || {duck.lit("'s voice:")} || chr(10) || chr(10) AS prompt FROM ({CORPUS})",
    "instruction_prompt": f"SELECT doc_id, 'Instruction:' || chr(10) || 'Write in the literary style of ' || author || ', based on a document titled \"' || title || '\" written on ' || source || '.' || chr(10) || chr(10) || 'Response:' || chr(10) || content || chr(10) AS text FROM ({CORPUS})",
    "leader_topics": "SELECT t AS Topic, 'Write a brief reflection on ' || t || ' in the style of Elder David A. Bednar. Conclude with a single, clear message..' AS prompt FROM (VALUES ('faith'), ('repentance')) v(t)",
    "padded_ids": "SELECT doc_id, 512 AS n, least(len(w), 512)::INT AS used, array_to_string(list_transform(range(1, 513), lambda i: coalesce(length(w[i]), 7)), ',') AS ids, true AS same FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)",
    "pipeline_histograms": f"{_EXAMPLES} SELECT 'content_type' AS dimension, content_type AS value, count(*) AS n FROM e GROUP BY 2 UNION ALL SELECT 'template', template_used, count(*) FROM e GROUP BY 2",
}

QUERIES["prompt_levels"] = lambda s, d: prompts.training_prompts(_spoken(s, d), level="complex")
ORACLES["prompt_levels"] = f"{_DRAWN.replace('z.level = sel.want', duck.lit('complex') + ' = sel.want')} SELECT doc_id, prompt FROM g"

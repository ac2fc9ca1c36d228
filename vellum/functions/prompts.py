"""Prompt templates, speaker profiles, filling and validation."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from vellum.functions import classify
from vellum.functions.base import let, n_words

LEVELS = ("simple", "moderate", "complex", "advanced")
COMPLEXITY = {"simple": 0.25, "moderate": 0.5, "complex": 0.75, "advanced": 1.0}
MIN_LENGTH, MAX_LENGTH = 50, 2000
PARTIAL = 200

# fixed values: (name, level, content types, needs context, mode, text), in the order of ties
TEMPLATES = [
    ("simple_completion", "simple", ["general", "sermon"], False, "completion", "Complete the following text in {author}'s style:\n\n\"{partial_text}\"\n\nContinue in {author}'s voice:\n\n"),
    ("conversation", "moderate", ["conversation", "teaching"], True, "conversation", 'You are {author}. A member approaches you after conference and asks: "{question}"\n\nRespond as {author} would, incorporating their characteristic {speaking_style} approach:\n\n{author}: '),
    ("speaker_adapted", "complex", ["sermon", "teaching", "doctrinal"], True, "style_transfer", "Write a passage on {topic} in {author}'s distinctive style, incorporating their characteristic phrases: {common_phrases} and rhetorical approach.\n\nContext: Drawing from {author}'s expertise in {topic_expertise} and their {speaking_style} delivery style.\n\nKey characteristics to include:\n- Rhetorical patterns: {rhetorical_patterns}\n- Speaking style: {speaking_style}\n\nPassage on {topic} in {author}'s voice:\n\n"),
    ("interview", "advanced", ["interview", "conversation"], True, "conversation", "In an interview setting, {author} is asked: \"{question}\"\n\nDrawing from their experience with {topic_expertise} and their {speaking_style} approach, provide {author}'s thoughtful response:\n\nInterviewer: {question}\n\n{author}: "),
    ("instruction_following", "advanced", ["teaching", "doctrinal"], True, "instruction", "As {author}, provide guidance on {topic} by following this specific structure:\n\n1. Begin with a characteristic opening phrase\n2. Share a relevant personal insight or scripture\n3. Provide practical application\n4. Close with testimony or invitation\n\nTopic: {topic}\nSpeaking style: {speaking_style}\nUse these characteristic elements: {rhetorical_patterns}\n\n{author}'s structured response:\n\n"),
    ("testimony", "moderate", ["testimony", "personal_story"], True, "style_transfer", "Share a testimony about {topic} in the style of {author}, reflecting their characteristic way of bearing witness.\n\nContext: Incorporate {author}'s {speaking_style} approach and use elements from: {common_phrases}\n\nPersonal testimony about {topic} in {author}'s voice:\n\n"),
    ("complex_testimony", "complex", ["testimony", "doctrinal", "general"], True, "style_transfer", "Provide a profound testimony about {topic} in {author}'s distinctive style, incorporating deep doctrinal understanding and personal conviction.\n\nAdvanced Context:\n- Author: {author} with {speaking_style} delivery\n- Rhetorical approach: {rhetorical_patterns}\n- Signature elements: {common_phrases}\n- Doctrinal expertise: {topic_expertise}\n\nCraft a testimony that demonstrates both personal witness and doctrinal depth about {topic}:\n\n"),
    ("prayer", "moderate", ["prayer"], False, "style_transfer", "Offer a prayer in the reverent style of {author}, reflecting their characteristic approach to communion with Heavenly Father.\n\nContext: Drawing from the spirit of their devotional style and {speaking_style} approach\n\nPrayer in {author}'s devotional style:\n\n"),
]
# fixed values: templates of the training pipeline beside those above
TRAINING_TEMPLATES = {
    "style_mimicry": 'Generate a passage in the distinctive literary style of {author}, incorporating their characteristic tone, vocabulary, and rhetorical patterns.\n\nContext: Based on "{title}" from {date}\n\nYour response should capture {author}\'s unique voice:',
    "completion": "Complete the following passage in {author}'s authentic style:\n\nPartial text: {partial_text}\n\nContinuation in {author}'s voice:",
    "topical_response": 'Write a response about {topic} in the style of {author}, drawing inspiration from their approach in "{title}".\n\nResponse:',
}
# fixed values: the training template of each content type
TEMPLATE_OF = {"sermon": "style_mimicry", "testimony": "testimony", "prayer": "prayer", "teaching": "style_mimicry", "doctrinal": "topical_response", "personal_story": "testimony", "general": "style_mimicry"}
# fixed values: (name, level, style, phrases, patterns, topics)
PROFILES = [
    ("Russell M. Nelson", "complex", "authoritative and caring", ["I know that", "The Lord has taught", "My dear brothers and sisters", "I testify that", "May I suggest", "Consider this"], ["structured numbered points", "medical analogies", "scriptural citations", "personal experiences", "direct challenges"], ["revelation", "prophetic guidance", "temple work", "family proclamation"]),
    ("Dieter F. Uchtdorf", "moderate", "warm and relatable", ["Brothers and sisters", "Let me share", "From my experience", "This I know", "May I invite you", "Sometimes we"], ["aviation analogies", "storytelling", "gentle questions", "personal vulnerability", "universal experiences"], ["faith", "hope", "patience", "spiritual growth", "grace"]),
    ("Jeffrey R. Holland", "advanced", "passionate and direct", ["I bear witness", "With all my heart", "My beloved brothers and sisters", "I promise you", "Never give up", "Christ loves you"], ["emotional appeals", "passionate testimony", "scriptural stories", "direct challenges", "personal assurance"], ["atonement", "testimony", "discipleship", "trials", "faith"]),
]
# fixed values: what a speaker without a profile has
DEFAULT_CONTEXT = {"speaking_style": "authoritative and caring", "common_phrases": "My dear brothers and sisters", "rhetorical_patterns": "clear teaching", "topic_expertise": "gospel principles"}
# fixed values: words that make an instruction, in templates and in prompts
TEMPLATE_VERBS = ["write", "generate", "complete", "respond", "share", "offer"]
PROMPT_VERBS = TEMPLATE_VERBS[:4]

VARIABLES = ("author", "title", "date", "topic", "question", "speaking_style", "common_phrases", "rhetorical_patterns", "topic_expertise", "partial_text")


def templates(spark: SparkSession) -> DataFrame:
    rows = [(i, *t) for i, t in enumerate(TEMPLATES)]
    return spark.createDataFrame(rows, "ord int, name string, level string, content_types array<string>, needs_context boolean, mode string, template string")


def profiles(spark: SparkSession) -> DataFrame:
    """Speakers with the parts of their profiles that prompts use: three phrases, two patterns, three topics."""
    rows = [(n, lv, st, ", ".join(ph[:3]), ", ".join(pa[:2]), ", ".join(to[:3])) for n, lv, st, ph, pa, to in PROFILES]
    return spark.createDataFrame(rows, "speaker string, level string, speaking_style string, common_phrases string, rhetorical_patterns string, topic_expertise string")


def with_context(docs: DataFrame) -> DataFrame:
    """Speaker context by author, with defaults; the profiles are a fixed handful of rows."""
    joined = docs.join(F.broadcast(profiles(docs.sparkSession)), F.col("author") == F.col("speaker"), "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in DEFAULT_CONTEXT.items()} | {"has_profile": F.col("speaker").isNotNull(), "level": F.coalesce("level", F.lit("moderate"))}).drop("speaker")


def selection(spark: SparkSession) -> DataFrame:
    """The template of each (content type, level): of its type or general, nearest level, first named. Fixed size."""
    index = lambda c: F.array_position(F.array(*map(F.lit, LEVELS)), c)
    kinds = spark.createDataFrame([(c, lv) for c in [*classify.RULES, "general", "conversation", "interview"] for lv in LEVELS], "content_type string, want string")
    fits = F.expr("array_contains(content_types, content_type) or array_contains(content_types, 'general')")
    ranked = kinds.join(F.broadcast(templates(spark)), fits).withColumn("n", F.row_number().over(W.partitionBy("content_type", "want").orderBy(F.abs(index(F.col("level")) - index(F.col("want"))), "ord")))
    return ranked.where("n = 1").select("content_type", "want", F.col("name").alias("template_name"), "template", "needs_context", F.col("level").alias("template_level"))


def _filled(template: Column, values: dict[str, Column], other: Callable[[Column], Column]) -> Column:
    """A template with each {key} replaced in one pass, so that keys in the values stay as they are; `other` gives unknown keys."""
    keys, parts = F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), F.lit(1)), F.split(template, r"\{\w+\}")

    def value(k: Column) -> Column:
        out = other(k)
        for name, v in values.items():
            out = F.when(k == name, F.coalesce(v, F.lit(f"[{name}]"))).otherwise(out)
        return out

    made = let(parts, lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(keys, lambda k, i: F.concat(value(k), F.get(p, i + 1))), "")))
    return F.when(F.contains(template, F.lit("{")), made).otherwise(template)


def fill(template: Column, values: dict[str, Column]) -> Column:
    """Replaces {key} by its value, a null value by [key]; keys that aren't given stay."""
    return _filled(template, values, lambda k: F.concat(F.lit("{"), k, F.lit("}")))


def fill_text(text: str, values: dict[str, Column]) -> Column:
    """`fill` of a text that is known beforehand: its parts and the values side by side, without a pattern for each row."""
    parts = re.split(r"\{(\w+)\}", text, flags=re.ASCII)
    shown = lambda k: F.coalesce(values[k], F.lit(f"[{k}]")) if k in values else F.lit(f"{{{k}}}")
    return F.concat(*[shown(x) if i % 2 else F.lit(x) for i, x in enumerate(parts)])


def fill_open(template: Column, values: dict[str, Column]) -> Column:
    """Fills a template of any keys; one that isn't given becomes [key], and with more the template stays, with a note on the first."""
    keys = F.array_distinct(F.regexp_extract_all(template, F.lit(r"\{(\w+)\}"), F.lit(1)))
    missing = F.filter(keys, lambda k: ~k.isin(*values)) if values else keys
    noted = F.concat(template, F.lit("\n\n[Missing template variable: '"), F.get(missing, F.lit(0)), F.lit("']"))
    return F.when(F.size(missing) <= 1, _filled(template, values, lambda k: F.concat(F.lit("["), k, F.lit("]")))).otherwise(noted)


def training_prompts(docs: DataFrame, template_name: str | None = None, level: str | None = None) -> DataFrame:
    """(doc_id, prompt) of `docs` (doc_id, author, title, date, content): the engine's prompt for each chunk, by a named template or the best.

    The best one is that of `level`, where given, else of the speaker's own.
    """
    return generate(docs, template_name=template_name, level=level).select("doc_id", "prompt")


def instruction(author: Column, title: Column, date: Column, chunk: Column) -> Column:
    """The literal instruction and response of one chunk."""
    # fixed value
    text = 'Instruction:\nWrite in the literary style of %s, based on a document titled "%s" written on %s.\n\nResponse:\n%s\n'
    return F.format_string(text, author, title, date, chunk)


# fixed values: leaders that reflections may be asked of
LEADERS = ("Elder Jeffrey R. Holland", "President Russell M. Nelson", "Elder David A. Bednar")


def reflections(spark: SparkSession, leader: str, topics: str | list[str]) -> DataFrame:
    """(Topic, prompt) for a text on each topic in the style of a leader; other leaders are refused."""
    if leader not in LEADERS:
        raise ValueError(f"Leader '{leader}' not available. Choose from: {list(LEADERS)}")
    names = [topics] if isinstance(topics, str) else list(dict.fromkeys(topics))
    rows = spark.createDataFrame([(t,) for t in names], "Topic string")
    # fixed value
    return rows.withColumn("prompt", F.format_string(f"Write a brief reflection on %s in the style of {leader}. Conclude with a single, clear message..", "Topic"))


def padded(ids: Column, size: int = 512, pad: int = 0) -> Column:
    """(input_ids, attention_mask, labels): ids cut or padded on the right to `size`; labels are the ids, padding too."""
    kept = F.slice(F.concat(ids, F.array_repeat(F.lit(pad).cast("int"), size)), 1, size)
    mask = F.slice(F.concat(F.transform(ids, lambda _: F.lit(1)), F.array_repeat(F.lit(0), size)), 1, size)
    return F.struct(kept.alias("input_ids"), mask.alias("attention_mask"), kept.alias("labels"))


def partial(text: Column) -> Column:
    return F.when(F.length(text) > PARTIAL, F.concat(F.substring(text, 1, PARTIAL), F.lit("..."))).otherwise(text)


def _any(text: Column, words: list[str]) -> Column:
    return F.greatest(*[F.contains(F.lower(text), F.lit(w)) for w in words])


def _length_issue(text: Column, what: str) -> Column:
    return F.when(F.length(text) < MIN_LENGTH, f"{what} too short").when(F.length(text) > MAX_LENGTH, f"{what} too long")


def template_issues(template: Column) -> Column:
    return F.array_compact(F.array(_length_issue(template, "Template"), F.when(~F.contains(template, F.lit("{author}")), "Missing required variable: {author}"), F.when(~_any(template, TEMPLATE_VERBS), "Template lacks clear instruction")))


def prompt_issues(prompt: Column) -> Column:
    left = F.contains(prompt, F.lit("{")) & F.contains(prompt, F.lit("}"))
    return F.array_compact(F.array(_length_issue(prompt, "Prompt"), F.when(left, "Unfilled template variables detected"), F.when(~_any(prompt, PROMPT_VERBS), "No clear instruction found")))


def generate(docs: DataFrame, question: Column | None = None, template_name: str | None = None, level: str | None = None) -> DataFrame:
    """`docs` (author, title, date, content) with content_type, level, topic, template_name and prompt.

    The template is that of the content type and the speaker's level, or the `level` given, unless named; a prompt that fails
    validation is written anew from the simple one, unless only what a context template leaves open is wrong.
    """
    if level is not None and level not in LEVELS:
        raise ValueError(f"level must be one of {', '.join(LEVELS)}")
    spark = docs.sparkSession
    author, title, date = (F.coalesce(F.col(c), F.lit(v)) for c, v in (("author", "Unknown Author"), ("title", "Untitled"), ("date", "Unknown Date")))
    typed = with_context(docs.withColumns({"author": author, "title": title, "date": date})).withColumns({"content_type": classify.simple_type(F.col("title"), F.col("content")), "topic": classify.topic(F.col("content"))})
    if template_name is None:
        picked = typed.join(F.broadcast(selection(spark)), ["content_type"], "left").where(F.col("want") == (F.col("level") if level is None else F.lit(level)))
    else:
        name, own, _, needs, _, text = next((t for t in TEMPLATES if t[0] == template_name), TEMPLATES[0])
        picked = typed.withColumns({"template_name": F.lit(name), "template": F.lit(text), "needs_context": F.lit(needs), "template_level": F.lit(own)})
    asked = F.concat(F.lit("Can you share your thoughts about "), F.col("topic"), F.lit("?"))
    values = {k: F.col(k) for k in VARIABLES if k not in ("question", "partial_text")} | {"question": asked if question is None else question, "partial_text": partial(F.col("content"))}
    drawn = picked.withColumns({"_prompt": fill(F.col("template"), values), "_simple": fill(F.lit(TEMPLATES[0][5]), values)})
    issues = prompt_issues(F.col("_prompt"))
    keep = (F.size(issues) == 0) | (F.col("needs_context") & F.array_contains(issues, "Unfilled template variables detected"))
    return drawn.withColumn("prompt", F.when(keep, F.col("_prompt")).otherwise(F.col("_simple"))).drop("_prompt", "_simple")


def training_prompt(title: Column, author: Column, date: Column, content: Column, content_type: Column, context: dict[str, Column]) -> Column:
    """Prompt of the training pipeline: the template of the content type, filled."""
    texts = TRAINING_TEMPLATES | {t[0]: t[5] for t in TEMPLATES}
    values = {"title": title, "author": author, "date": date, "partial_text": partial(content)} | context

    def filled(name: str) -> Column:
        text = texts[name]
        return let(classify.topic(content), lambda t: fill_text(text, values | {"topic": t})) if "{topic}" in text else fill_text(text, values)

    kinds = {v: [k for k in TEMPLATE_OF if TEMPLATE_OF[k] == v] for v in TEMPLATE_OF.values() if v != "style_mimicry"}
    return F.coalesce(*[F.when(content_type.isin(ks), filled(v)) for v, ks in kinds.items()], filled("style_mimicry"))


def estimated_tokens(prompt: Column) -> Column:
    return F.round(n_words(prompt) * F.lit(1.3).cast("double"), 6)

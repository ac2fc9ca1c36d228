"""Pieces of DuckDB SQL that oracles share, written apart from the Spark side."""

from __future__ import annotations

from vellum.functions import classify
from vellum.tables import CORPUS

NL = "chr(10)"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def words(x: str) -> str:
    return rf"list_filter(string_split_regex({x}, '\s+'), lambda w: w <> '')"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sentences(x: str) -> str:
    return rf"string_split(regexp_replace({x}, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1))"


def count(x: str, part: str) -> str:
    return f"((length({x}) - length(replace({x}, {lit(part)}, ''))) // {len(part)})"


def regex_count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {lit(pattern)}))"


def fill(template: str, values: dict[str, str]) -> str:
    """A template cut at its keys, with a value after each piece but the last: what values hold isn't looked at again."""
    keys, parts = rf"regexp_extract_all({template}, '\{{(\w+)\}}', 1)", rf"string_split_regex({template}, '\{{\w+\}}')"
    cases = " ".join(f"WHEN {lit(k)} THEN {v}" for k, v in values.items())
    return f"({parts}[1] || array_to_string(list_transform({keys}, lambda k, i: (CASE k {cases} ELSE '{{' || k || '}}' END) || {parts}[i + 1]), ''))"


def packed(source: str, keys: str, parts: str, budget: int, separator: str, name: str, count: str = "") -> str:
    """CTEs that pack the list `parts` of `source` greedily; the last is `name` (keys, chunks)."""
    n = count or f"len({words('x')})"
    return f"""
{name}_p AS (SELECT {keys}, {parts} AS parts FROM {source}),
{name}_n AS (SELECT {keys}, parts, list_transform(parts, lambda x: {n}) AS ns FROM {name}_p),
{name}_s AS (SELECT {keys}, parts, list_reduce(list_prepend({{'st': [1], 'n': 0, 'i': 1}}, list_transform(ns, lambda k: {{'st': [0], 'n': k::INTEGER, 'i': 0}})),
    lambda a, b: CASE WHEN a.n = 0 OR a.n + b.n <= {budget} THEN {{'st': a.st, 'n': a.n + b.n, 'i': a.i + 1}} ELSE {{'st': list_append(a.st, a.i), 'n': b.n, 'i': a.i + 1}} END).st AS st FROM {name}_n),
{name} AS (SELECT {keys}, list_filter(list_transform(st, lambda b, i: {strip(f"array_to_string(list_slice(parts, b, coalesce(st[i + 1], len(parts) + 1) - 1), {separator})")}), lambda c: c <> '') AS chunks FROM {name}_s)"""


def paragraph_chunks(budget: int, delimiter: str = "chr(10)") -> str:
    """CTEs down to `chunks` (doc_id, chunks): paragraph-aware chunks of the corpus."""
    paras = f"list_filter(list_transform(string_split(content, {delimiter}), lambda p: {strip('p')}), lambda p: p <> '')"
    return f"""docs AS ({CORPUS}),{packed('docs', 'doc_id', paras, budget, 'chr(10) || chr(10)', 'pp')},
units AS (SELECT doc_id, u, unnest(chunks) AS c, unnest(range(len(chunks))) AS u FROM pp),
big AS (SELECT doc_id, u, c FROM units WHERE len({words('c')}) > {budget}),{packed('big', 'doc_id, u', sentences('c'), budget, "' '", 'sp')},
flat AS (SELECT doc_id, u, chunks FROM sp UNION ALL SELECT doc_id, u, [c] FROM units WHERE len({words('c')}) <= {budget}),
chunks AS (SELECT doc_id, flatten(list(chunks ORDER BY u)) AS chunks FROM flat GROUP BY doc_id)""".replace("SELECT doc_id, u, unnest", "SELECT doc_id, unnest")


def type_of(title: str, content: str) -> str:
    """Content type of lower-case title and content columns."""
    scores = []
    for name, (titles, keywords, patterns) in classify.RULES.items():
        parts = [f"3 * contains({title}, {lit(k)})::INT" for k in titles] + [count(content, k) for k in keywords] + [f"2 * {regex_count(content, p)}" for p in patterns]
        scores.append(f"{{'s': {' + '.join(parts)}, 'n': {lit(name)}}}")
    best = f"list_reduce([{', '.join(scores)}], lambda a, b: CASE WHEN b.s > a.s THEN b ELSE a END)"
    return f"(SELECT CASE WHEN _b.s > 0 THEN _b.n ELSE 'general' END FROM (SELECT {best} AS _b))"


def topic_of(content: str) -> str:
    scores = [f"{{'s': {' + '.join(count(content, k) for k in ks)}, 'n': {lit(t)}}}" for t, ks in classify.TOPICS.items()]
    best = f"list_reduce([{', '.join(scores)}], lambda a, b: CASE WHEN b.s > a.s THEN b ELSE a END)"
    return f"(SELECT CASE WHEN _b.s > 0 THEN _b.n ELSE 'gospel principles' END FROM (SELECT {best} AS _b))"

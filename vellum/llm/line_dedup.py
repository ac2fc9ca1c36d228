"""Line deduplication by content-defined chunks of lines, in DataFrame functions only.

Each line is hashed (60 bits of MD5, which DuckDB can compute as well). A cyclic-polynomial rolling hash over
the last two line hashes is taken at each line, and a chunk ends where it is a local maximum: that depends on
four neighbouring lines alone, so an insertion moves no boundary but those beside it, and chunks have two
lines at least. A chunk that occurs more than once in the corpus stays at its first occurrence and is removed
from all others. Equality is decided on bytes: chunks meet by a 64-bit hash, the least and the greatest
content of each hash are compared, and where they differ the contents themselves are the key.

Contents are shuffled once, after each task has merged its own copies, and the texts once more to be
rewritten; hot chunks shrink to one row a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import Scratch

#: Chunk hashes shared by different contents are looked up by broadcast up to so many.
BROADCAST_HASHES = 100_000
#: Words from which a single line counts as a passage in `drop_repeated_passages`.
LONG_LINE = 50

_LINE_HASH = "cast(conv(substring(md5(l), 1, 15), 16, 10) as bigint)"
_ROTATED = "shiftleft(coalesce(get(lh, i - 1), 0L) & 576460752303423487L, 1) | shiftrightunsigned(coalesce(get(lh, i - 1), 0L), 59)"


def _chunked(docs: DataFrame, key: list[str]) -> DataFrame:
    """`key` columns of `docs` and _chunks, the texts of its chunks and their numbers of lines in order (null for a null text)."""
    lines = docs.withColumn("_lines", F.expr(r"split(text, '\n', -1)"))
    hashed = lines.withColumn("_lh", F.expr(f"transform(_lines, l -> {_LINE_HASH})"))
    rolled = hashed.withColumn("_r", F.expr(f"transform(_lh, (h, i) -> ({_ROTATED.replace('lh', '_lh')}) ^ h)"))
    # the first lines of chunks: 0 and what follows a local maximum that leaves two lines at least
    starts = """
        if(size(_r) < 4, array(0), concat(array(0), transform(filter(sequence(1, size(_r) - 3),
            i -> get(_r, i) > get(_r, i - 1) and get(_r, i) >= get(_r, i + 1)), i -> i + 1)))"""
    begun = rolled.withColumn("_starts", F.expr(starts))
    end = "coalesce(get(_starts, j + 1), size(_lines))"
    chunks = f"transform(_starts, (s, j) -> struct(array_join(slice(_lines, s + 1, {end} - s), '\n') as body, {end} - s as n))"
    return begun.select(*key, F.expr(f"if(text is null, null, {chunks})").alias("_chunks"))


def _occurrences(chunked: DataFrame) -> DataFrame:
    """(_id, _th, pos, chunk, h) of the chunks that may be removed: of two lines at least and not blank.

    The outer form of explode keeps the optimizer from pushing a copy of the whole chunking into a filter.
    """
    rows = chunked.select("_id", "_th", F.posexplode_outer("_chunks").alias("pos", "c")).select("_id", "_th", "pos", F.col("c.body").alias("chunk"), F.col("c.n").alias("n"))
    long = rows.where("n >= 2 and trim(replace(chunk, '\n', '')) <> ''")
    return long.select("_id", "_th", "pos", "chunk", F.xxhash64("chunk").alias("h"))


def _removals(occurrences: DataFrame, scratch: Scratch) -> DataFrame:
    """(_id, _th, removed): the positions of repeated chunks, but for their first occurrences."""
    place = F.struct("_id", "_th", "pos")
    by_hash = occurrences.groupBy("h").agg(F.min("chunk").alias("a"), F.max("chunk").alias("b"), F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeated = scratch.write(by_hash.select("h", "first", (F.col("a") != F.col("b")).alias("clash")), "repeated")
    clean = occurrences.select("_id", "_th", "pos", "h").join(repeated.where("not clash").select("h", "first"), "h")
    out = clean.where(~place.eqNullSafe(F.col("first"))).select("_id", "_th", "pos")
    clashes = repeated.where("clash").select("h")
    if n := clashes.count():  # different contents under one hash: group by the bytes themselves
        inside = occurrences.join(F.broadcast(clashes) if n <= BROADCAST_HASHES else clashes, "h", "left_semi")
        firsts = inside.groupBy("chunk").agg(F.min(place).alias("first"))
        exact = inside.join(firsts, "chunk").where(~place.eqNullSafe(F.col("first")))
        out = out.unionByName(exact.select("_id", "_th", "pos"))
    return out.groupBy("_id", "_th").agg(F.collect_set("pos").alias("removed"))


def dedup_lines(docs: DataFrame, counts: bool = False) -> DataFrame:
    """`docs` with repeated chunks of lines taken out of `text`; with `counts`, also n_chunks and n_removed.

    The first occurrence, which stays, is that of the smallest doc_id (null below all), then by the order in
    the text. Rows that repeat both doc_id and text are one document and come out alike. Null texts stay
    null, empty and one-line texts stay as they are, chunks of blank lines are never removed; a document
    that consists of repeated chunks alone becomes empty. Other columns pass through, whatever their names.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), "text")
    removals = _removals(_occurrences(_chunked(keyed, ["_id", "_th"])), scratch).withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    # the text is shuffled; chunks are found again behind the join rather than shuffled beside it
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), "text")
    joined = whole.join(removals, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left")
    cut = _chunked(joined.select("_row", "removed", "text"), ["_row", "removed"])
    kept = "transform(array_except(sequence(0, size(_chunks) - 1), removed), j -> get(_chunks, j).body)"
    text = F.expr(f"if(removed is null, _row.text, array_join({kept}, '\n'))")
    columns = [text.alias(n) if n == "text" else F.col(f"_row.`{n}`").alias(n) for n in docs.columns]
    if counts:
        columns += [F.expr("greatest(size(_chunks), 0)").alias("n_chunks"), F.expr("coalesce(size(removed), 0)").alias("n_removed")]
    return cut.select(*columns)


def _units(docs: DataFrame) -> DataFrame:
    """(_id, _th, pos, last, h): two lines in a row, blank ones between them left out, and single long lines; h is a digest of 128 bits.

    Those whose lines are all in _gone are left out.
    """
    lined = docs.withColumn("_lines", F.expr(r"split(text, '\n', -1)"))
    told = lined.withColumn("_at", F.expr(r"filter(sequence(0, size(_lines) - 1), i -> trim(get(_lines, i)) <> '')"))
    pairs = r"""if(size(_at) < 2, array(), transform(sequence(0, size(_at) - 2), j -> named_struct('pos', get(_at, j), 'last', get(_at, j + 1),
        'h', unhex(md5(concat(get(_lines, get(_at, j)), '\n', get(_lines, get(_at, j + 1))))))))"""
    words = r"size(split(trim(get(_lines, i)), '\\s+'))"
    longs = f"transform(filter(_at, i -> length(get(_lines, i)) >= {2 * LONG_LINE - 1} and {words} >= {LONG_LINE}), i -> named_struct('pos', i, 'last', i, 'h', unhex(md5(get(_lines, i)))))"
    rows = told.where("text is not null").select("_id", "_th", F.explode_outer(F.expr(f"filter(concat({pairs}, {longs}), u -> not (array_contains(_gone, u.pos) and array_contains(_gone, u.last)))")).alias("u"))
    return rows.where("u is not null").select("_id", "_th", "u.pos", "u.last", "u.h")


def _marked(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """_row of `docs` and _gone, the numbers of the lines that lie in chunks that `dedup_lines` removes; written once."""
    keyed = docs.select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"), "text")
    removals = _removals(_occurrences(_chunked(keyed, ["_id", "_th"])), scratch).withColumnsRenamed({"_id": "_rid", "_th": "_rth"})
    whole = _whole(docs).withColumn("text", F.col("_row.text"))
    joined = whole.join(removals, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left")
    cut = _chunked(joined.select("_row", "removed", "text"), ["_row", "removed"])
    # the chunk of each line, in the order of lines
    of_line = "flatten(transform(_chunks, (c, j) -> array_repeat(j, c.n)))"
    gone = f"if(removed is null, cast(array() as array<int>), filter(transform({of_line}, (j, i) -> if(array_contains(removed, j), i, null)), i -> i is not null))"
    return scratch.write(cut.select("_row", F.expr(gone).alias("_gone")), "marked")


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))


def drop_repeated_passages(docs: DataFrame, counts: bool = False) -> DataFrame:
    """`docs` without repeated chunks of lines, and without the repeated runs that chunks miss.

    First go the chunks that `dedup_lines` removes. Then, of the lines that are left, every two lines in a row,
    and every single line of LONG_LINE words, that occur more than once stay at their first occurrence (in the
    order of `dedup_lines`) and go from all others, whatever stands beside them. Two lines of which a chunk has
    taken one still count as a run: a run isn't broken by what chunks take out of it. Those that lie in removed
    chunks whole need no looking up, as they have occurred before and go anyway. The first occurrence of a
    line never goes by a run, as no pair that holds it can have occurred before. With `counts`, also n_chunk_lines and
    n_run_lines, the lines that each step took. Other rows and columns are as in `dedup_lines`.
    """
    scratch = Scratch(docs.sparkSession, "passages")
    marked = _marked(docs, scratch)
    place = F.struct("_id", "_th", "pos")
    units = _units(marked.select(F.col("_row.doc_id").alias("_id"), F.xxhash64("_row.text").alias("_th"), F.col("_row.text").alias("text"), "_gone"))
    repeated = scratch.write(units.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1").select("h", "first"), "repeated_runs")
    later = units.join(repeated, "h").where(~place.eqNullSafe(F.col("first")))
    spans = later.groupBy(F.col("_id").alias("_rid"), F.col("_th").alias("_rth")).agg(F.collect_set(F.struct("pos", "last")).alias("spans"))
    removals = spans.select("_rid", "_rth", F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.pos, s.last))))").alias("removed"))
    whole = marked.select("_row", "_gone", F.col("_row.doc_id").alias("_id"), F.xxhash64("_row.text").alias("_th"))
    joined = whole.join(removals, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_th") == F.col("_rth")), "left")
    cut = joined.withColumn("_lines", F.expr(r"split(_row.text, '\n', -1)")).withColumn("_out", F.expr("array_union(_gone, coalesce(removed, cast(array() as array<int>)))"))
    kept = "transform(array_except(sequence(0, size(_lines) - 1), _out), i -> get(_lines, i))"
    text = F.expr(rf"if(size(_out) = 0, _row.text, array_join({kept}, '\n'))")
    columns = [text.alias(n) if n == "text" else F.col(f"_row.`{n}`").alias(n) for n in docs.columns]
    if counts:
        columns += [F.expr("size(_gone)").alias("n_chunk_lines"), F.expr("size(_out) - size(_gone)").alias("n_run_lines")]
    return cut.select(*columns)


ORACLE = """
WITH l AS (
    SELECT doc_id, i, line, len(ls) AS n, ('0x' || substr(md5(line), 1, 15))::BIGINT AS h
    FROM (SELECT doc_id, ls, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), r AS (
    SELECT *, xor((coalesce(lag(h) OVER w, 0) & 576460752303423487) * 2 + (coalesce(lag(h) OVER w, 0) >> 59), h) AS r FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), b AS (
    SELECT *, CASE WHEN i BETWEEN 1 AND n - 3 AND r > lag(r) OVER w AND r >= lead(r) OVER w THEN 1 ELSE 0 END AS ends FROM r WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), c AS (
    SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b
), g AS (
    SELECT doc_id, chunk, string_agg(line, chr(10) ORDER BY i) AS body, count(*) AS n FROM c GROUP BY ALL
), k AS (
    SELECT *, (n >= 2 AND trim(replace(body, chr(10), '')) <> '' AND row_number() OVER (PARTITION BY body, n >= 2 ORDER BY doc_id, chunk) > 1) AS removed FROM g
)
SELECT doc_id, coalesce(string_agg(body, chr(10) ORDER BY chunk) FILTER (WHERE NOT removed), '') AS text,
       count(*)::INTEGER AS n_chunks, (count(*) FILTER (WHERE removed))::INTEGER AS n_removed
FROM k GROUP BY doc_id
"""

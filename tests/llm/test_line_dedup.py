from vellum.llm import line_dedup


def line_hash(line):
    return int(__import__("hashlib").md5(line.encode()).hexdigest()[:15], 16)


def slow_chunks(text):
    lines = text.split("\n")
    h = [line_hash(x) for x in lines]
    r = []
    for i in range(len(h)):
        before = h[i - 1] if i else 0
        r.append((((before & (2**59 - 1)) << 1) | before >> 59) ^ h[i])
    starts = [0] + [i + 1 for i in range(1, len(lines) - 2) if r[i] > r[i - 1] and r[i] >= r[i + 1]]
    return [lines[a:b] for a, b in zip(starts, [*starts[1:], len(lines)], strict=True)]


def slow(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for chunk in slow_chunks(text) if text is not None else []:
            body = "\n".join(chunk)
            if len(chunk) >= 2 and body.replace("\n", "").strip(" "):
                if body in seen:
                    continue
                seen.add(body)
            kept.append(body)
        out[doc_id] = None if text is None else "\n".join(kept)
    return out


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == slow(rows)
    assert line_dedup.dedup_lines(docs).columns == docs.columns


def test_shifted_passage(spark):
    passage = "\n".join(f"line {i} of what many share" for i in range(40))
    rows = [(i, "\n".join(f"own {i} {k}" for k in range(i + 1)) + "\n" + passage + f"\nend {i}") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert got == slow(rows) and passage in got[0]
    assert all(sum("many share" in x for x in got[i].split("\n")) <= 12 for i in range(1, 12))


def test_odd_rows_and_clashing_hashes(spark, monkeypatch):
    rows = [(1, None, 5), (2, "", 5), (3, "one line", 6), (4, "one line", 6), (None, "a\nb", 7), (5, "a\nb", 7), (6, "\n \n", 8), (7, "\n \n", 8), (8, "c\nd", 9), (9, "c\nd", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _chunks int")
    want = slow([(a, b) for a, b, _ in rows])
    got = line_dedup.dedup_lines(docs).collect()
    assert {r.doc_id: r.text for r in got} == want and want[5] == "" and want[7] == "\n \n"
    assert sorted(r._chunks for r in got) == sorted(c for *_, c in rows)
    plain = line_dedup._occurrences
    from pyspark.sql import functions as F

    monkeypatch.setattr(line_dedup, "_occurrences", lambda c: plain(c).withColumn("h", F.lit(1).cast("long")))
    assert {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()} == want
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_repeated_rows_are_one_document(spark):
    docs = spark.createDataFrame([(1, "a\nb"), (1, "a\nb"), (2, "a\nb")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in line_dedup.dedup_lines(docs).collect()) == [(1, "a\nb"), (1, "a\nb"), (2, "")]


def test_short_shared_runs(spark):
    import corpus_pipeline

    long = " ".join(f"word{k}" for k in range(60))
    runs = [[f"run {n} line {k} of {n}" for k in range(n)] for n in (2, 3, 4, 5)] + [[long]]
    rows = [(i, "\n".join(x for n, run in enumerate(runs) for x in (f"own {i} {n} a", f"own {i} {n} b", *run)) + f"\nend {i}\nonce {i}\n\nshared line") for i in range(6)]
    rows += [(6, None), (7, ""), (8, "shared line"), (None, "odd 1\n\nodd 2"), (None, "odd 1\n\nodd 2"), (9, "odd 1\nodd 2\nodd 3")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = corpus_pipeline.drop_repeated_lines(spark, docs, None).collect()
    got = {r.doc_id: r.text for r in out}
    assert len(out) == len(rows) and got[0] == rows[0][1]
    for i in range(1, 6):
        own = "\n".join(x for n in range(5) for x in (f"own {i} {n} a", f"own {i} {n} b"))
        assert got[i] == f"{own}\nend {i}\nonce {i}\n\nshared line"
    assert got[6] is None and got[7] == "" and got[8] == "shared line" and got[None] == "odd 1\n\nodd 2" and got[9] == "odd 3"


def test_chunks_go_first_and_runs_take_the_rest(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: r for r in line_dedup.drop_repeated_passages(docs, counts=True).collect()}
    by_chunks = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(docs, counts=True).collect()}
    first, gone = {}, {}
    for i in sorted(rows):  # every two lines in a row, and long lines, by definition
        lines = rows[i].split("\n")
        told = [k for k, x in enumerate(lines) if x.strip(" ")]
        units = [(a, b, f"{lines[a]}\n{lines[b]}") for a, b in zip(told, told[1:], strict=False)] + [(k, k, lines[k]) for k in told if len(lines[k].split()) >= line_dedup.LONG_LINE]
        gone[i] = {k for a, b, x in sorted(units) if first.setdefault(x, (i, a)) != (i, a) for k in range(a, b + 1)}
    seen = set()
    for i in sorted(rows):
        lines, taken, at = rows[i].split("\n"), set(), 0
        for chunk in slow_chunks(rows[i]):
            body = "\n".join(chunk)
            if len(chunk) >= 2 and body.replace("\n", "").strip(" "):
                if body in seen:
                    taken |= set(range(at, at + len(chunk)))
                seen.add(body)
            at += len(chunk)
        assert got[i].text == "\n".join(x for k, x in enumerate(lines) if k not in taken | gone[i]), i
        assert got[i].n_chunk_lines == len(taken) and got[i].n_run_lines == len(gone[i] - taken)
        assert (got[i].n_chunk_lines > 0) == (by_chunks[i] > 0)
    assert sum(r.n_chunk_lines for r in got.values()) > 0 and sum(r.n_run_lines for r in got.values()) > 0

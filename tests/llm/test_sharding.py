import zlib

import numpy as np
from pyspark.sql import functions as F
from vellum.llm import sharding


def test_flow_moves_the_fewest_bytes():
    rng = np.random.default_rng(2)
    for n in (1, 2, 5, 16):
        supply = [int(x) for x in rng.integers(0, 1000, n)]
        demand = sharding.capacities_of(sum(supply), n)
        flow = sharding.min_cost_flow(supply, demand)
        assert all(sum(v for (i, _), v in flow.items() if i == k) == supply[k] for k in range(n))
        assert all(sum(v for (_, j), v in flow.items() if j == k) == demand[k] for k in range(n))
        assert sum(v for (i, j), v in flow.items() if i != j) == sum(max(0, a - b) for a, b in zip(supply, demand, strict=True))


def check(rows, docs):
    assert sorted((r.doc_id for r in rows), key=str) == sorted((d.doc_id for d in docs), key=str)
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    return [sum(r.size for r in by.get(s, [])) for s in range(16)]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    have = docs.collect()
    rows = sharding.shard(docs).collect()
    sizes = check(rows, have)
    assert max(sizes) - min(sizes) < 0.002 * sum(sizes)
    text = {d.doc_id: d.text for d in have}
    home = {}
    for r in rows:
        data = text[r.doc_id].encode()
        assert r.size == len(data) + 1 and r.text_crc32 == zlib.crc32(data) and 0 <= r.shard < 16
        assert home.setdefault(data, r.shard) == r.shard


def test_a_group_larger_than_a_shard(spark):
    rows = [(i, "the same text" if i % 3 == 0 else f"text {i} " + "x" * (i % 50), 1) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    sizes = check(sharding.shard(docs).collect(), docs.collect())
    assert max(sizes) - min(sizes) < 0.01 * sum(sizes)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "a")], "doc_id long, text string")
    rows = sharding.shard(docs).collect()
    check(rows, docs.collect())
    assert sorted(r.size for r in rows) == [1, 1, 1, 2]
    assert sharding.shard(docs.limit(0)).count() == 0


def test_files_are_rewritten(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t" * (i % 97), 0 if i < 700 else i % 4) for i in range(1000)], "doc_id long, text string, shard int")
    docs.write.partitionBy("shard").parquet(f"{tmp_path}/old")
    report = sharding.reshard_files(spark, f"{tmp_path}/old", f"{tmp_path}/new", shards=4)
    out = spark.read.parquet(f"{tmp_path}/new")
    sizes = [r.s for r in out.selectExpr("shard", "length(text) + 1 as n").groupBy("shard").sum("n").toDF("shard", "s").collect()]
    assert out.count() == 1000 and max(sizes) - min(sizes) < 300 and report["kept"] == []


def test_kept_shards_and_columns_of_any_name(spark, tmp_path):
    # shards 2 and 3 are as large as they should be, 0 gives to 1
    rows = [(i, "x" * 9, i, "own", s) for s, n in enumerate((60, 40, 50, 50)) for i in range(1000 * s, 1000 * s + n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _h long, _block string, shard int").withColumn("_old", F.col("doc_id") * 2)
    docs.write.partitionBy("shard").parquet(f"{tmp_path}/old")
    report = sharding.reshard_files(spark, f"{tmp_path}/old", f"{tmp_path}/new", shards=4)
    out = spark.read.parquet(f"{tmp_path}/new")
    assert report["kept"] == [2, 3] and report["moved_bytes"] == 100
    assert sorted(map(tuple, out.select("doc_id", "text", "_h", "_block", "_old").collect())) == sorted((i, t, h, b, 2 * i) for i, t, h, b, _ in rows)
    assert [r[1] for r in out.groupBy("shard").count().orderBy("shard").collect()] == [50] * 4


def test_documents_as_files(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs.withColumn("shard", (F.col("doc_id") % 7).cast("int")).write.partitionBy("shard").parquet(f"{tmp_path}/old")
    report = sharding.reshard_files(spark, f"{tmp_path}/old", f"{tmp_path}/new")
    out = spark.read.parquet(f"{tmp_path}/new")
    assert sorted(map(tuple, out.select(docs.columns).collect())) == sorted(map(tuple, docs.collect()))
    sizes = [r.s for r in out.groupBy("shard").agg(F.sum(F.octet_length("text") + 1).alias("s")).collect()]
    assert len(sizes) == 16 and max(sizes) - min(sizes) < 0.02 * sum(sizes) and report["moved_bytes"] < 0.65 * sum(sizes)


def test_rows_that_repeat_in_all_columns_are_dealt_out(spark):
    for key in (None, 5):
        docs = spark.createDataFrame([(key, "the very same text")] * 2000, "doc_id long, text string").repartition(3)
        rows = sharding.shard(docs).collect()
        check(rows, docs.collect())
        counts = [sum(r.shard == s for r in rows) for s in range(16)]
        assert max(counts) - min(counts) <= 1


def test_files_of_no_shard_and_of_repeated_rows(spark, tmp_path):
    rows = [(None if i % 2 else 3, "the same", None if i % 5 == 0 else i % 3) for i in range(900)] + [(i, f"t{i}", 0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    docs.write.partitionBy("shard").parquet(f"{tmp_path}/old")
    sharding.reshard_files(spark, f"{tmp_path}/old", f"{tmp_path}/new", shards=4)
    out = spark.read.parquet(f"{tmp_path}/new")
    assert sorted(map(repr, out.select("doc_id", "text").collect())) == sorted(map(repr, docs.select("doc_id", "text").collect()))
    sizes = [r.s for r in out.groupBy("shard").agg(F.sum(F.octet_length("text") + 1).alias("s")).orderBy("shard").collect()]
    assert len(sizes) == 4 and out.where("shard is null").isEmpty() and max(sizes) - min(sizes) < 60

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from adjudika.llm import sharding
from adjudika.llm.queries import QUERIES, SQL


def address(i):
    return f"{int(hashlib.md5(('' if i is None else str(i)).encode()).hexdigest()[:15], 16):060b}"


def check(rows, limit, assigned):
    """Whole rows, prefixes that don't nest, full shards only where one row is longer, and no needless split."""
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes) for r in assigned) == sorted((-1 if i is None else i, len((t or "").encode())) for i, t in rows)
    shards = defaultdict(list)
    for r in assigned:
        shards[r.shard].append(r)
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    totals = {s: sum(r.n_bytes for r in held) for s, held in shards.items()}
    for s, held in shards.items():
        assert {(r.shard_bytes, r.shard_rows) for r in held} == {(totals[s], len(held))}
        assert totals[s] <= limit or len(held) == 1
        assert all(address(r.doc_id).startswith(s[:60]) for r in held)
        if s:
            assert sum(n for t, n in totals.items() if t.startswith(s[:-1])) > limit
    return totals


def test_splits_until_it_fits(spark, docs_of, monkeypatch, tmp_path):
    monkeypatch.setattr(sharding, "BITS", 4)
    rows = [(i, "é" * (i * 37 % 200)) for i in range(400)] + [(None, "n" * 50), (None, None), (500, ""), (501, None), (502, "x" * 5000)]
    rows += [(7, "same" * 20)] * 60 + [(8, f"other {i}" * 9) for i in range(40)]
    docs_of(rows).withColumn("cell", F.lit(1)).withColumn("shard", F.lit(2)).write.parquet(str(tmp_path / "d"))
    assigned = sharding.assign(spark.read.parquet(str(tmp_path / "d")), 900)
    assert {r.cell for r in assigned.collect()} == {1}
    totals = check(rows, 900, assigned.collect())
    assert max(map(len, totals)) > 60  # the repeated row goes on into the second half of the address
    assert check(rows, 10**9, sharding.assign(docs_of(rows), 10**9).collect()) == {"": sum(len((t or "").encode()) for _, t in rows)}
    assert sharding.assign(docs_of(rows).limit(0), 900).count() == 0


def test_written_shards(spark, docs_of, tmp_path):
    rows = [(i, "t" * 100) for i in range(50)]
    sharding.write_shards(docs_of(rows), str(tmp_path / "s"), 1000)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r.doc_id for r in back.collect()) == list(range(50))
    check(rows, 1000, back.withColumn("shard", F.expr("substring(shard, 2)")).collect())


def test_no_row_is_lost_when_the_scan_is_split_otherwise(spark, docs_of, tmp_path):
    rows = [(7, "same text " * 20)] * 4_000
    path = str(tmp_path / "d")
    docs_of(rows, 1).write.option("parquet.block.size", 4_096).parquet(path)
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.minPartitionNum", "spark.sql.files.maxPartitionBytes") if spark.conf.get(k, None)}
    try:
        for now, then in (("1", "16"), ("16", "1")):
            spark.conf.set("spark.sql.files.minPartitionNum", now)
            assigned = sharding.assign(spark.read.parquet(path), 50_000)
            spark.conf.set("spark.sql.files.minPartitionNum", then)
            check(rows, 50_000, assigned.collect())
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        for k, v in before.items():
            spark.conf.set(k, v)


def test_a_row_without_a_bucket_raises(spark, docs_of, tmp_path):
    path = str(tmp_path / "d")
    docs_of([(i, "t" * 100) for i in range(50)]).write.parquet(path)
    docs = spark.read.parquet(path)
    other = sharding.addressed(docs_of([(1_000, "x")]), ["doc_id"]).select(sharding.ADDRESS, sharding.BYTES)
    found = sharding.directory(other, 10**6)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sharding, "directory", lambda slim, limit: found)
        with pytest.raises(Exception, match="has no shard"):
            sharding.assign(docs, 10**6).collect()


def test_query_and_sql(spark):
    import duckdb

    path = "/root/testdata/sf0.01"
    got = QUERIES["op10_sharding"](spark, path)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = con.sql(SQL["op10_sharding"]).fetchall()
    assert sorted(map(tuple, got.select("doc_id", "shard", "shard_bytes", "shard_rows", "n_bytes").collect())) == sorted(want)

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import sharding
from eventflow.llm.queries import QUERIES


def check(rows, n, shards):
    by_shard = {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by_shard.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())


def test_odd_rows(odd, odd_rows, nothing):
    placed = sharding.shard(odd, shards=5, rows=3)
    assert [c for c in placed.columns if c.lower() == "shard"] == ["shard"]
    check(placed.collect(), len(odd_rows), 5)
    rows = [(r.doc_id, r.text) for r in placed.collect()]
    assert Counter(rows) == Counter((i, t) for i, t, *_ in odd_rows)
    assert sharding.shard(nothing).collect() == []


def test_same_result_in_any_order_and_other_seeds(spark):
    df = spark.range(500).withColumn("text", F.lit("same"))
    one = {r.id: (r.shard, r.slot) for r in sharding.shard(df, rows=32).collect()}
    two = {r.id: (r.shard, r.slot) for r in sharding.shard(df.orderBy(F.desc("id")).repartition(7), rows=32).collect()}
    other = {r.id: (r.shard, r.slot) for r in sharding.shard(df, seed=1, rows=32).collect()}
    assert one == two and one != other


def test_every_slot_is_as_likely(spark):
    df, seen = spark.range(12), Counter()
    for seed in range(60):
        for r in sharding.shard(df, shards=3, seed=seed, rows=2).collect():
            seen[r.id % 3, r.shard] += 1
    expected = 60 * 12 / 9
    assert sum((n - expected) ** 2 / expected for n in seen.values()) < 30


def test_matrix_has_the_sums_of_both_sides():
    counts = np.array([5, 0, 17, 3, 40, 1, 9])
    columns = np.array([25, 25, 25])
    before = np.concatenate([[0], np.cumsum(counts)])
    total = np.zeros(3, np.int64)
    for s, n in enumerate(counts):
        where, sent = sharding.matrix_row(s, before, columns, 3)
        assert sent.sum() == n
        total[where] += sent
    assert (total == columns).all()


def test_draws_beyond_numpys_limit(monkeypatch):
    columns = np.array([3_000, 1_000, 4_000, 2_000])
    rng = np.random.default_rng(1)
    exact = np.array([rng.multivariate_hypergeometric(columns, 2_000) for _ in range(3000)])
    monkeypatch.setattr(sharding, "NUMPY_LIMIT", 0)
    ours = np.array([sharding.draw(rng, columns, 2_000) for _ in range(3000)])
    assert (ours.sum(1) == 2_000).all()
    assert ours.mean(0) == pytest.approx(exact.mean(0), rel=0.01)
    assert ours.std(0) == pytest.approx(exact.std(0), rel=0.1)
    monkeypatch.undo()
    huge = np.array([30_000_000_000, 10_000_000_000])
    assert sharding.draw(rng, huge, 4_000_000_000).sum() == 4_000_000_000


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["op4_sharding"](spark, sf)
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = got.collect()
    check(rows, 200, 8)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    import zlib
    for r in rows:
        assert (r["size"], r.text_crc32) == (len(docs[r.doc_id].encode()) + 1, zlib.crc32(docs[r.doc_id].encode()))
        assert r.law == "rows" and r.grown_shard is None

from __future__ import annotations

import math

import numpy as np
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from eventflow.llm import hard_negatives
from eventflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, label int, embedding array<float>"


def brute(rows, every, positives=5, negatives=3):
    seen = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))
        if row not in seen:
            seen.append(row)
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    best_first = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for a in seen:
        if a[0] is None or a[0] % every:
            continue
        near = sorted(((score(a, b), b[0]) for b in seen if b[1] == a[1] and b[0] != a[0]), key=best_first)[:positives]
        for s, p in near:
            far = [(t, b[0]) for b in seen if b[1] != a[1] and 50 * s <= 100 * (t := score(a, b)) <= 95 * s]
            out += [(a[0], p, k + 1, n, s, t) for k, (t, n) in enumerate(sorted(far, key=best_first)[:negatives])]
    return sorted(out, key=repr)


def result(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_query_against_sql(spark):
    assert differences(QUERIES["op12_hard_negatives"](spark, SF), duck(SF), ORACLES["op12_hard_negatives"]) == []


@pytest.mark.parametrize("size, width", [(1.0, 5), (3e6, 3), (1.0, 2500)])
def test_scores_are_exact(size, width):
    rng = np.random.default_rng(3)
    a, b = (np.floor(256 * size * rng.uniform(-1, 1, (n, width))).astype(np.int64) for n in (7, 11))
    squared = max(float((x.astype(float) ** 2).sum(1).max()) for x in (a, b))
    primes = hard_negatives.primes_for(squared)
    got = hard_negatives.Residues(a, primes).scores(hard_negatives.Residues(b, primes))
    assert got.tolist() == [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]


def test_scores_at_the_end_of_their_range():
    a = np.array([[2**30, 2**30, 1], [-(2**30), -(2**30), 5]])
    primes = hard_negatives.primes_for(float((a.astype(float) ** 2).sum(1).max()))
    got = hard_negatives.Residues(a, primes).scores(hard_negatives.Residues(a, primes))
    assert got.tolist() == [[2**61 + 1, -(2**61) + 5], [-(2**61) + 5, 2**61 + 25]]
    with pytest.raises(ValueError):
        hard_negatives.primes_for(2.0**62)


def test_against_brute_force(spark, chance, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)  # several blocks of anchors
    rows = []
    for i in range(400):
        v = [chance.choice([-1, 0, 1, 2]) / 4 + chance.choice([0, 0, 0.3]) for _ in range(4)]
        rows.append((i, chance.randrange(3), v))
    common = [0.5, 0.5, 0.5, 0.5]
    rows += [(1000 + i, i % 3, common) for i in range(150)]  # a third have one vector: ties everywhere
    rows += [(5, None, common), (6, 1, None), (7, 1, [0.1, None]), (10, 1, [float("nan")] * 4), (15, 1, [float("inf")] * 4)]
    rows += [(None, 1, common), (2000, 1, [0.5, 0.5]), (2005, 2, []), (20, 2, [9.0, 0.0, 0.0, 0.0]), rows[3], rows[10], rows[10]]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"rid": F.lit("x"), "windows": F.lit(1), "cell": F.lit(2), "Score": F.lit(3)})
    got = result(hard_negatives.hard_negatives(df.repartition(7), F.col("vec_id") % 10 == 0))
    assert got == brute(rows, 10)
    few = result(hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, positives=2, negatives=40))
    assert few == brute(rows, 10, 2, 40)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.hard_negatives(empty, F.col("vec_id") % 10 == 0).collect() == []
    lonely = spark.createDataFrame([(10, 1, [1.0]), (11, 2, [1.0])], SCHEMA)
    assert hard_negatives.hard_negatives(lonely, F.col("vec_id") % 10 == 0).collect() == []

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import nn_descent
from eventflow.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, node int"


def by_hand(rows, threshold=0.93):
    """vec_id -> (links, smallest id reached), all pairs."""
    good = [(i, np.array(v, np.float32).astype(float), c) for i, v, c, *_ in rows
            if c is not None and v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = {i: 0 for i, *_ in rows}, {i: i for i, *_ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for label in {c for *_, c in good}:
        own = [(i, v / np.linalg.norm(v)) for i, v, c in good if c == label]
        x = np.array([v for _, v in own])
        for a, b in zip(*np.nonzero(x @ x.T >= threshold)):
            if a < b:
                i, j = own[a][0], own[b][0]
                links[i], links[j] = links[i] + 1, links[j] + 1
                small, large = sorted((root(i), root(j)))
                parent[large] = small
    return {i: (links[i], root(i)) for i in links}


def vectors(n=600, dim=24, seed=3):
    """Noise, pairs, a chain, a dense group larger than the lists, and exact copies."""
    rng = np.random.default_rng(seed)
    rows = [rng.standard_normal(dim) for _ in range(n)]
    rows += [rows[i] + 0.15 * rng.standard_normal(dim) for i in range(0, 60)]
    centre = rng.standard_normal(dim)
    rows += [centre + 0.12 * rng.standard_normal(dim) for _ in range(90)]
    rows += [rows[5]] * 40
    return [(i, [float(x) for x in v], i % 2 if i < n else None if i % 50 == 0 else int(i) % 2, "x", 1) for i, v in enumerate(rows)]


def check(got, rows):
    expected = by_hand(rows)
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == expected[r.vec_id], r.vec_id
        assert r.kept == (r.vec_id == r.component_id)


def test_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 32)
    rows = vectors()
    check(nn_descent.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_links_between_tight_clumps(spark, monkeypatch):
    """Lists that are full of a clump's own vectors hide the links to the next clump."""
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 1)
    rng = np.random.default_rng(5)
    axes = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    near = 0.955 * axes[0] + np.sqrt(1 - 0.955**2) * axes[1]  # of the first clump
    centres = [axes[0], near, *axes[2:8]]
    rows = [list(map(float, c + 0.008 * rng.standard_normal(40))) for c in centres for _ in range(40)]
    rows += [list(map(float, v)) for v in rng.standard_normal((300, 40))]
    rows = [(i, v, 0, "", 0) for i, v in enumerate(rows)]
    expected = by_hand(rows)
    assert expected[0][0] > 60 and expected[79][1] == 0 and expected[80][1] == 80
    check(nn_descent.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def path(n_axes, per_axis, seed=2):
    """Points along a path from axis to axis, one component whose links are sparse."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n_axes - 1):
        for t in np.linspace(0, np.pi / 2, per_axis, endpoint=False):
            v = 0.004 * rng.standard_normal(32)
            v[i] += np.cos(t)
            v[i + 1] += np.sin(t)
            rows.append(list(map(float, v)))
    return rows


def test_blocks_of_a_long_component_prune_one_another(spark, monkeypatch):
    """Twice the vectors, about twice the pairs of blocks and rows that are exchanged for them."""
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    monkeypatch.setattr(nn_descent, "PART", 100)  # pivots meet the members in several parts
    pairs, blocks = [], []
    for axes in (11, 21):
        rows = [(i, 0, "0", 32, v, 1) for i, v in enumerate(path(axes, 40))]
        members = spark.createDataFrame(rows, "node bigint, component bigint, label string, dim int, vec array<double>, copies bigint")
        dealt, near = nn_descent._blocks(members, int(0.93 * nn_descent.SCALE))
        assert dealt.select("node").distinct().count() == dealt.count() == len(rows)
        pairs.append(near.count())
        blocks.append(dealt.select("block").distinct().count())
    assert blocks[1] < 2.6 * blocks[0] and pairs[1] < 2.8 * pairs[0] and pairs[1] < 0.25 * blocks[1] ** 2


def test_a_long_component_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "BLOCK", 16)
    monkeypatch.setattr(nn_descent, "PART", 100)
    rows = [(i, v, 0, "", 0) for i, v in enumerate(path(7, 60))]
    check(nn_descent.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_too_low_a_recall_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "audit", lambda *_: 0.5)
    with pytest.raises(RuntimeError, match="0.500"):
        nn_descent.near_duplicates(spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0)], SCHEMA))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0, "", 0), (2, [], 0, "", 0), (3, [0.0, 0.0], 0, "", 0), (4, [1.0, None], 0, "", 0), (5, [nan, 1.0], 0, "", 0),
            (6, [inf, 1.0], 0, "", 0), (7, [1.0, 2.0], None, "", 0), (8, [1.0, 2.0], 0, "", 0), (9, [2.0, 4.0], 0, "", 0),
            (10, [1.0, 2.0], 1, "", 0), (11, [1.0, 2.0], 0, "", 0), (12, [-1.0, -2.0], 0, "", 0), (13, [1e-30, 2e-30], 0, "", 0),
            (14, [1e30, 2e30], 0, "", 0), (15, [1.0, 2.0, 3.0], 0, "", 0)]
    got = {r.vec_id: r for r in nn_descent.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert {i: r.n_links for i, r in got.items()} == {i: 4 if i in (8, 9, 11, 13, 14) else 0 for i in range(1, 16)}
    assert all(r.component_id == (8 if i in (8, 9, 11, 13, 14) else i) for i, r in got.items())
    repeated = spark.createDataFrame([rows[7], rows[7], (None, [1.0, 2.0], 0, "", 0)], SCHEMA)
    assert [(r.n_links, r.component_id) for r in nn_descent.near_duplicates(repeated).orderBy("vec_id").collect()] == [(0, None), (1, 8), (1, 8)]
    assert nn_descent.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_descent_improves_the_first_lists(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "TREES", 1)
    monkeypatch.setattr(nn_descent, "CELL", 16)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((800, 12))
    df = spark.createDataFrame([(i, 0, 12, [float(c) for c in v], 1) for i, v in enumerate(x)],
                               "node bigint, label int, dim int, vec array<double>, copies bigint").cache()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosines = unit @ unit.T
    np.fill_diagonal(cosines, -2)
    true = [set(np.argsort(-row)[:10].tolist()) for row in cosines]

    def recall(lists):
        return sum(len(true[r.node] & {e.v for e in r.nbrs}) for r in lists.collect()) / 8000

    first, last = recall(nn_descent.first_lists(df, 10, 1)), recall(nn_descent.descend(df, 10, 1))
    assert last > 0.8 > 0.4 > first


def test_audit_sees_what_is_missing(spark):
    rows = [(i, [1.0, i / 1000], 0, "", 0) for i in range(50)]
    nodes = spark.createDataFrame(rows, SCHEMA).select(
        F.col("vec_id").alias("node"), "label", F.lit(2).alias("dim"), F.col("embedding").alias("vec"), F.lit(1).cast("bigint").alias("copies"))
    half = spark.createDataFrame([(i, 49 if i < 25 else 0) for i in range(50)], "node bigint, links bigint")
    assert nn_descent.audit(nodes, half, 0.93) == pytest.approx(0.5)


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check(QUERIES["op7_embedding_near_dedup"](spark, sf).collect(), rows)

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from eventflow.llm import conversation_trie
from eventflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, every=20, most=3):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=lambda y: y[:2])] for c, x in own.items()}
    built = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % (most + 1) if every else 0
        built[c] = (own.get(c - c % every, [])[:h] if every else []) + x[h:]
    members = {}
    for c, x in built.items():
        for d in range(len(x) + 1):
            members.setdefault(tuple(x[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        w = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + w
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=repr)


def test_query_against_sql(spark):
    assert differences(QUERIES["op11_conversation_trie"](spark, SF), duck(SF), ORACLES["op11_conversation_trie"]) == []


def some(chance, n=120):
    rows = []
    for c in range(-3, n):
        for t in range(chance.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, t if t else None, chance.choice(["user", "user", None]), chance.choice(["a b", "a", "", None, " c\td\x0be ", "é  x"])))
    for c in (500, 501, 502, 503):  # copies, and a long one with a third of all rows
        rows += [(c, t, "user", "same words") for t in range(6)]
    rows += [(700, t, "user", f"turn {t % 7}") for t in range(len(rows) // 2)]
    return rows


@pytest.mark.parametrize("local", [1, 3, 40, conversation_trie.LOCAL])
def test_against_brute_force(spark, chance, monkeypatch, local):
    rows = some(chance, 40 if local < 3 else 120)
    monkeypatch.setattr(conversation_trie, "TOGETHER", 50)
    monkeypatch.setattr(conversation_trie, "SLOT", 16)
    monkeypatch.setattr(conversation_trie, "PIECE", 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"depth": F.lit("x"), "Node": F.lit(1), "conv": F.lit(2), "size": F.lit(3)})
    assert result(conversation_trie.conversation_trie(df.repartition(5), local=local)) == brute(rows)


def test_as_they_are_and_repeated_rows(spark, chance):
    rows = some(chance, 30)
    rows += [(3, 1, "user", "again"), (3, 1, "user", "again"), (None, 1, "user", "nobody's")]
    rows = [r for r in rows if r[0] != 3 or r[3] == "again"]
    got = conversation_trie.conversation_trie(spark.createDataFrame(rows, SCHEMA), every=None)
    assert result(got) == brute(rows, None)


def test_no_rows_and_turnless(spark):
    assert conversation_trie.conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    lonely = [(c, 0, "user", "x") for c in (41, 42, 43, 44)]  # no conversation 40: those with h > 0 have no turn
    assert result(conversation_trie.conversation_trie(spark.createDataFrame(lonely, SCHEMA))) == brute(lonely)


@pytest.mark.parametrize("kind", ["chain", "star", "random"])
def test_centroids_in_a_task(kind):
    rng = np.random.default_rng(4)
    n = 700
    up = np.array([0] + [{"chain": i - 1, "star": 0, "random": rng.integers(max(0, i - 20), i)}[kind] for i in range(1, n)])
    values = rng.integers(-5, 9, (n, 2))
    want, size, depth = values.copy(), np.ones(n, np.int64), np.zeros(n, np.int64)
    for i in range(n - 1, 0, -1):
        want[up[i]] += want[i]
        size[up[i]] += size[i]
    for i in range(1, n):
        depth[i] = depth[up[i]] + 1
    sums = values.copy()
    conversation_trie.split_here(np.zeros(n, np.int64), up.astype(np.int64), depth, size, values, sums)
    assert sums.tolist() == want.tolist()

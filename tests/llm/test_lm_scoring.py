from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflow.llm import lm_scoring
from eventflow.llm.queries import QUERIES


def words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"]


def model_by_hand(rows, training, tuning):
    """Counts of all training rows, and the weights fitted on the exact held-out events of the tuning rows."""
    def counted(some):
        single, pairs = Counter(), Counter()
        for _, t in some:
            w = words(t)
            single.update(w)
            pairs.update(zip(["\n", *w], w))
        return single, pairs

    trained = [r for r in rows if training(r[0])]
    (single, pairs), (s, p) = counted(trained), counted([r for r in trained if not tuning(r[0])])
    n, known, estimated = sum(single.values()), len(single), sum(s.values())
    bucket = lambda c: min(lm_scoring.CONTEXTS - 1, math.frexp(c)[1]) if c else 0
    events = Counter()
    for i, t in trained:
        if tuning(i):
            w = words(t)
            for u, v in zip(["\n", *w], w):
                events[bucket(s[u]), p[u, v] / max(1, s[u]), s[v] / max(1, estimated)] += 1
    weights = {b: [0.4, 0.4, 0.2] if b else [0, 0.8, 0.2] for b in range(lm_scoring.CONTEXTS)}
    for _ in range(lm_scoring.ROUNDS if events else 0):
        sums = {b: [0.0] * 3 for b in weights}
        for (b, f2, f1), k in events.items():
            parts = [x * y for x, y in zip(weights[b], (f2, f1, 1 / (known + 1)))]
            for j in range(3):
                sums[b][j] += k * parts[j] / sum(parts)
        overall = [sum(sums[b][j] for b in sums if b) + 1e-9 for j in range(3)]
        for b in weights:
            new = [sums[b][j] + lm_scoring.SHARED_EVENTS * overall[j] / sum(overall) for j in range(3)]
            new = [0.0 if not b else new[0], new[1] + 1e-9, new[2] + 1e-9]
            weights[b] = [x / sum(new) for x in new]

    def score(text):
        w, total, base = words(text), 0.0, 0.0
        for u, v in zip(["\n", *w], w):
            a, b, c = weights[bucket(single[u])]
            total += math.log10(a * pairs[u, v] / max(1, single[u]) + b * single[v] / max(1, n) + c / (known + 1))
            base += math.log10((single[v] + 1) / (n + known + 1))
        return len(w), sum(single[v] > 0 for v in w), n, base, total

    return score


@pytest.mark.parametrize("block, bucket", [(3_000_000, 2_000_000), (50, 100)])
def test_odd_rows_by_hand(odd, odd_rows, monkeypatch, block, bucket):
    monkeypatch.setattr(lm_scoring, "BUCKET_KEYS", bucket)
    train, tune = (lambda i: i is not None and i % 5 != 2), (lambda i: i % 5 == 3)
    score = model_by_hand([(i, t) for i, t, *_ in odd_rows], train, tune)
    got = lm_scoring.score(odd, F.col("doc_id") % 5 != 2, F.col("doc_id") % 5 == 3, block_tokens=block).collect()
    assert len(got) == len(odd_rows)
    texts = {i: t for i, t, *_ in odd_rows}
    for r in got:
        n, known, trained, base, total = score(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (not train(r.doc_id), n, known, trained)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(total, rel=0.03, abs=0.3)  # held-out events are counted in steps


def test_probabilities_add_up_to_one():
    weights = lm_scoring.learn_weights([(3, 1, -8, 50), (3, -4, -8, 90), (5, -1, -20, 400), (0, 1, -6, 7), (2, 1, 1, 9)], 0.001)
    assert weights.sum(1) == pytest.approx(np.ones(len(weights)))
    assert (weights >= 0).all() and (weights[:, 2] > 0).all() and weights[0, 0] == 0
    assert weights[5, 0] > weights[3, 0]


def test_packed_lists(chance):
    for bits in (3, 20, 63):
        keys = np.array(sorted({chance.getrandbits(bits) for _ in range(50)}), np.uint64)
        assert (lm_scoring.unpack_keys(lm_scoring.pack_keys(keys)) == keys).all()
    counts = np.array([0, 1, 254, 255, 256, 10**12, 3])
    assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(counts), len(counts)) == counts).all()


def test_no_training_rows_and_no_rows(odd, odd_rows, nothing):
    got = lm_scoring.score(odd, F.lit(False), F.lit(False)).collect()
    assert len(got) == len(odd_rows) and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert all(r.base_score == 0 and math.isfinite(r.score) for r in got)
    assert lm_scoring.score(nothing, F.lit(True), F.lit(True)).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i, _ in docs}
    score = model_by_hand(docs, lambda i: fold[i] != 2, lambda i: fold[i] == 3)
    texts, rows = dict(docs), QUERIES["op6_lm_scoring"](spark, sf).collect()
    assert len(rows) == len(docs)
    gain = n_held = 0
    for r in rows:
        n, known, trained, base, total = score(texts[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[r.doc_id] == 2, n, known, trained)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score == pytest.approx(total, rel=0.02, abs=0.3)
        if r.held_out:
            gain, n_held = gain + r.score - r.base_score, n_held + n
    assert gain / n_held > 0.3  # held-out words are likelier than in the base

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from eventflow.llm import toxicity
from eventflow.llm.queries import QUERIES

BAD = ("idiot", "moron", "scumlike", "scumming")


def by_hand(scores):
    """All maximal segments, by their definition: the best of all, then left and right of it."""
    best = None
    for a in range(len(scores)):
        for b in range(a + 1, len(scores) + 1):
            s = sum(scores[a:b])
            if s > 0 and (best is None or s > best[2] + 1e-12):
                best = (a, b, s)
    if best is None:
        return []
    a, b, s = best
    right = [(x + b, y + b, z) for x, y, z in by_hand(scores[b:])]
    return by_hand(scores[:a]) + [best] + right


def test_segments_are_all_maximal_ones(chance):
    for _ in range(300):
        scores = [chance.choice((-3, -2, -1, 1, 2, 3)) + chance.random() / 100 for _ in range(chance.randint(0, 12))]
        got = [(a, b, round(s, 9)) for a, b, s in toxicity.segments(scores)]
        assert got == [(a, b, round(s, 9)) for a, b, s in by_hand(scores)]


def test_word_never_seen_has_the_odds_of_its_stem():
    model = toxicity.Model({"scum*": (40, 0), "scumm*": (20, 0), "scumming": (20, 0), "the": (50, 450)}, 50, 450)
    assert model.odds("scumzzz") == model.odds("scum*") > 2
    assert model.odds("never") == 0 and abs(model.odds("the")) < 0.2
    assert model.odds("scumming") <= toxicity.CERTAIN


def test_clean_word_under_a_toxic_stem_scores_nothing():
    counts = {"bom*": (110, 20), "bombast": (60, 0), "bomente": (0, 5), "bombast*": (0, 3), "zzz": (0, 40), "bomb": (50, 8)}
    model = toxicity.Model(counts, 200, 900)
    assert model.odds("bomwxyz") == model.odds("bom*") >= toxicity.NOISE
    assert model.odds("bomente") == 0 and model.odds("zzz") == 0 and "zzz" not in model.scores
    assert model.word_scores(["bomente", "zzz"]) == [-toxicity.DRIFT] * 2
    assert model.odds("bombast") > model.odds("bomb") - 3 and model.odds("bomb") >= toxicity.NOISE


def test_the_table_holds_what_differs_from_its_stem(chance):
    letters = "abcd"
    counts = {"".join(chance.choices(letters, k=chance.randint(2, 8))): (chance.randint(0, 6), chance.randint(0, 6)) for _ in range(500)}
    for word, (t, c) in list(counts.items()):
        for n in toxicity.PREFIXES:
            if n < len(word):
                a, b = counts.get(word[:n] + "*", (0, 0))
                counts[word[:n] + "*"] = (a + t, b + c)
    model = toxicity.Model(counts, 300, 500)
    assert all(v != model._inherited(k.rstrip("*")) for k, v in model.scores.items())
    assert all(model.odds(k) == 0 for k, (t, _) in counts.items() if not t and not k.endswith("*"))
    assert len(model.scores) < len(counts)


def test_learning_from_documents_with_columns_of_any_name(spark, chance):
    docs, labels = corpus(spark, chance, 100)
    plain = toxicity.learn(docs, labels)
    named = toxicity.learn(docs.selectExpr("*", "1 AS y", "2 AS id", "'x' AS fold", "3 AS word", "4 AS __id2"), labels)
    assert plain.scores == named.scores


def corpus(spark, chance, n=400):
    rows, labels = [], []
    for i in range(n):
        words = [f"w{chance.randint(0, 200)}" for _ in range(chance.randint(5, 120))]
        bad = i % 5 == 0
        if bad:
            for _ in range(4):
                words.insert(chance.randint(0, len(words)), chance.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_documents(spark, chance, odd, odd_rows, nothing):
    docs, labels = corpus(spark, chance)
    model = toxicity.learn(docs, labels.where("doc_id % 2 = 0").unionByName(
        spark.createDataFrame([(None, 1), (3, None)], "doc_id bigint, toxic int")))
    got = toxicity.score(docs.where("doc_id % 2 = 1"), model).join(labels, "doc_id").collect()
    assert all((r.score >= 0.7) == bool(r.toxic) for r in got)
    toxic = [r for r in got if r.toxic]
    for r in toxic:
        assert r.passages
        found = "".join(r.text[p.start : p.stop] for p in r.passages)
        assert any(b in found for b in BAD)
        assert all(p.expected < toxicity.SIGNIFICANT for p in r.passages)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.text in (None, "", " \t\n ")}
    assert len(same) == 1 and same.pop() < 0.5
    assert [c for c in toxicity.score(odd, model).columns if c == "score"] == ["score"]
    assert toxicity.score(nothing, model).collect() == []


@pytest.mark.parametrize("label", [None, 0, 1])
def test_one_class_or_none(spark, chance, label):
    docs, labels = corpus(spark, chance, 60)
    model = toxicity.learn(docs, labels.where(F.lit(label is not None) & (F.col("toxic") == (label or 0))))
    scores = {r.score for r in toxicity.score(docs, model).collect()}
    assert all(0 <= s <= 1 and not math.isnan(s) for s in scores)


def test_same_model_whatever_the_order(spark, chance):
    docs, labels = corpus(spark, chance, 150)
    one = toxicity.learn(docs, labels)
    two = toxicity.learn(docs.orderBy(F.rand(3)).repartition(5), labels.orderBy(F.desc("doc_id")))
    assert one.scores == two.scores and one.rate == pytest.approx(two.rate)
    assert one.weights == pytest.approx(two.weights, rel=1e-6)


def test_query_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = QUERIES["op3_toxicity"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in rows}
    assert n[1, 1] / (n[1, 1] + n.get((1, 0), 0)) > 0.85
    assert n.get((0, 1), 0) / (n[0, 0] + n.get((0, 1), 0)) < 0.01

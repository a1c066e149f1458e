from __future__ import annotations

import re

import pytest
from compare import differences, duck

from eventflow.llm import decontamination
from eventflow.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, window):
    """{(doc_id, text): (n_words, n_hit, items, spans)}"""
    cut = {}
    for item, text in items:
        w = words(text)
        for at in range(max(1, len(w) - window + 1) if w else 0):
            cut.setdefault(tuple(w[at : at + window]), set()).add(str(item) if item is not None else "")
    out = []
    for doc, text in docs:
        w, covered, seen = words(text), set(), set()
        for n in {len(c) for c in cut}:
            for at in range(len(w) - n + 1):
                if (hit := tuple(w[at : at + n])) in cut:
                    covered |= set(range(at, at + n))
                    seen |= cut[hit]
        spans = []
        for k in sorted(covered):
            if spans and spans[-1][1] == k:
                spans[-1] = (spans[-1][0], k + 1)
            else:
                spans.append((k, k + 1))
        out.append((doc, len(w), len(covered), tuple(sorted(seen)), tuple(spans)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.doc_id, r.n_words, r.n_hit, tuple(r["items"]), tuple((s.start, s.stop) for s in r.spans)) for r in df.collect()), key=repr)


def test_query_against_sql(spark):
    assert differences(QUERIES["op13_decontamination"](spark, SF), duck(SF), ORACLES["op13_decontamination"]) == []


@pytest.mark.parametrize("most", [decontamination.BROADCAST_ROWS, 0])
def test_against_brute_force(spark, chance, most):
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünï", "É", "é", "the"]

    def text(n):
        return "".join(chance.choice(vocabulary) + chance.choice([" ", ", ", "\n", " - "]) for _ in range(n))

    items = [(i, text(chance.randint(0, 14))) for i in range(40)] + [(7, "The w1"), (None, "the É w2 w3"), (90, None), (91, " - ")]
    items += [items[3], items[3]]
    docs = [(i, text(chance.randint(0, 60)) + (items[chance.randrange(40)][1] or "").upper() * chance.randint(0, 2)) for i in range(120)]
    docs += [docs[5], (None, docs[6][1]), (5, None), (3, "")]
    got = decontamination.decontaminate(
        spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"),
        window=6, shingle=3, most=most,
    )
    assert result(got) == brute(docs, items, 6)


def test_hot_passage_and_case(spark):
    passage = " ".join(f"p{i}" for i in range(30))
    docs = [(i, f"x{i} " + passage.upper() + f" y{i}") for i in range(300)] + [(1000, passage.replace("p15", "q"))] + [(1001, "clean words " * 50)]
    items = [(f"id{i}", passage) for i in range(11)]
    df, it = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id string, text string")
    got = result(decontamination.decontaminate(df, it))
    assert got == brute(docs, items, 10)


def test_odd_rows_and_no_rows(spark, odd, odd_rows, nothing):
    items = spark.createDataFrame([(1, "same words here same words here same words here same"), (2, "word"), (3, None), (4, "")], "item_id bigint, text string")
    got = decontamination.decontaminate(odd, items)
    rows = [(i, t) for i, t, *_ in odd_rows]
    assert result(got) == brute(rows, [(1, "same words here same words here same words here same"), (2, "word")], 10)
    assert decontamination.decontaminate(nothing, items).collect() == []
    assert {r.n_hit for r in decontamination.decontaminate(odd, items.limit(0)).collect()} == {0}
    assert {r.n_hit for r in decontamination.decontaminate(odd, items.where("item_id > 2")).collect()} == {0}


def test_no_python_in_the_plan(spark):
    plan = QUERIES["op13_decontamination"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from eventflow.llm import merkle
from eventflow.llm.merkle import Tree
from eventflow.llm.queries import QUERIES

LONG = "\n".join(f"Paragraph {i} says something, and then more of it. It ends here {i * i}." for i in range(120))


def test_paragraphs_give_the_text_back(chance):
    texts = ["", "\n", "a", LONG, "x" * 5000, "...!!", "é, ü\r\n\x0b z. " * 50]
    texts += ["".join(chance.choices("ab .,!\n\r|é", k=chance.randint(0, 400))) for _ in range(300)]
    assert all("".join(merkle.paragraphs(t)) == t for t in texts)


def test_roots_tell_texts_apart_and_fingerprints_round_trip(chance):
    texts = {"", " ", "a", "a ", "A", "a\n", LONG, LONG + ".", LONG.replace("Paragraph 7 ", "Paragraph 07 ")}
    trees = [Tree(t) for t in texts]
    assert len({t.root for t in trees}) == len(texts)
    for t in trees:
        again = Tree.parse(str(t))
        assert (again.root, again.sections) == (t.root, t.sections)
    assert str(Tree(LONG)) == str(Tree("".join(LONG)))


def test_likeness_and_place_of_an_edit():
    at = LONG.index("Paragraph 60")
    edited = LONG[:at] + "Inserted words here.\n" + LONG[at:]
    a, b = Tree(LONG), Tree(edited)
    assert 0.9 < merkle.likeness(a, b) == merkle.likeness(b, a) < 1
    assert merkle.edits(b, a) == [(at, at + len("Inserted words here.\n"))]
    assert merkle.edits(a, a) == [] and merkle.likeness(a, a) == 1.0
    assert merkle.likeness(a, Tree("Nothing of it.")) < 0.05
    assert merkle.likeness(Tree(""), Tree("")) == 1.0 and merkle.likeness(Tree(""), a) == 0.0


def test_equal_sections_are_not_entered():
    a, b = Tree(LONG), Tree(LONG + "\nOne more.")
    left, right = merkle._unmatched(a, b)
    assert sum(left.values()) <= len(a.sections[-1][1]) and sum(right.values()) < 40


def test_compare_columns(spark, odd, odd_rows, nothing):
    marked = merkle.fingerprint(merkle.fingerprint(odd, name="a"), name="b")
    got = merkle.compare(marked, "a", "b", "same", "where").collect()
    assert len(got) == len(odd_rows) and all(r.same == 1.0 and r["where"] == [] for r in got)
    by_text = {r.text: r.a for r in got}
    assert all(r.a == by_text[r.text] for r in got) and by_text[None] == by_text[""]
    assert len(set(by_text.values())) == len(by_text) - 1
    row = merkle.compare(spark.createDataFrame([(None, str(Tree("a")))], "a string, b string"), "a", "b").first()
    assert row.likeness is None and row.edits == []
    assert merkle.fingerprint(nothing).collect() == []


@pytest.mark.parametrize("bucket", [4, 4096])
def test_next_documents_by_hand(spark, odd, odd_rows, nothing, monkeypatch, bucket):
    monkeypatch.setattr(merkle.with_neighbour, "__defaults__", (bucket,))
    once = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {i: t or "" for i, t, *_ in odd_rows if i is not None}
    order = sorted(texts, reverse=True)
    got = {r.doc_id: r for r in merkle.edited_pairs(once).collect()}
    assert got.keys() == texts.keys()
    for i, doc_id in enumerate(order):
        text, after = texts[doc_id], texts[order[(i + 1) % len(order)]]
        third, r = len(text) // 3, got[doc_id]
        edited = text[: len(text) - third] + after[:third]
        assert (r.n_chars, r.edited_text) == (len(text), edited)
        assert (r.fingerprint, r.edited_fingerprint) == (str(Tree(text)), str(Tree(edited)))
        assert r.near_edited == merkle.likeness(Tree(text), Tree(edited))
        assert r.near_next == merkle.likeness(Tree(text), Tree(after))
    assert merkle.edited_pairs(odd).count() == len(odd_rows)
    assert merkle.edited_pairs(nothing).collect() == []
    assert merkle.edited_pairs(once.limit(1)).first().near_next == 1.0


def test_positions(spark):
    borders = sorted({i * i for i in range(40)})
    keys = spark.range(-3, 1600).unionByName(spark.createDataFrame([(None,)], "id bigint"))
    got = keys.select("id", merkle._position(borders, F.col("id")).alias("p")).collect()
    assert all(r.p == (0 if r.id is None else sum(b <= r.id for b in borders)) for r in got)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in QUERIES["op10_document_fingerprints"](spark, sf).collect()}
    assert len(got) == len(docs)
    nearer = 0
    for i, (doc_id, text) in enumerate(docs):
        after, third = docs[(i + 1) % len(docs)][1], len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        assert got[doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert (got[doc_id].fingerprint == got[doc_id].edited_fingerprint) == (text == edited)
        nearer += got[doc_id].near_edited > got[doc_id].near_next
    assert nearer > 0.95 * len(docs)

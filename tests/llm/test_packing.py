from __future__ import annotations

import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventflow.llm import bpe_codec, packing
from eventflow.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")


def encoder():
    with open(PATH, encoding="utf-8") as f:
        return packing.ByteEncoder(*packing.ByteEncoder.parts(f.read()))


def library_ids(texts):
    found = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    return [[*e.ids, 0] for e in found]


def check(pieces, documents, sequence):
    """Every id of every document in one piece, sequences without gaps, all full but the last."""
    parts, places = defaultdict(list), defaultdict(list)
    for p in pieces:
        parts[p.doc_id].append(p)
        places[p.sequence_id].append((p.offset, p.length))
        assert p.length > 0 and p.doc_tokens == len(documents[p.doc_id])
    assert parts.keys() == documents.keys()
    for doc_id, own in parts.items():
        own.sort(key=lambda p: p.start)
        ids = [i for p in own for i in np.frombuffer(p.ids, "<u4").tolist()]
        assert ids == documents[doc_id]
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
    assert sorted(places) == list(range(len(places)))
    for sequence_id, own in places.items():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == sequence or sequence_id == len(places) - 1


def test_ids_of_every_character_and_of_random_texts(chance):
    texts = ["a" + chr(c) + " b" + chr(c) + " " for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(chance.choices("aabb'sthe1 2é  \n\t", k=chance.randint(0, 30))) for _ in range(4000)]
    texts += [bytes(chance.randrange(256) for _ in range(20)).decode("latin1") for _ in range(2000)]
    texts += ["a<|endoftext|> b<|x", "<|endoftext|>", "x" * 20_000]
    own = encoder()
    assert [np.frombuffer(b, own.type).tolist() for b in own.encode(texts)] == library_ids(texts)


def test_every_token_encodes_to_itself():
    """So the ranks alone decide all merges."""
    with open(PATH, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocabulary = bpe_codec.Vocabulary(model["vocab"], [tuple(m) for m in model["merges"]], "")
    assert len(vocabulary.proposals) == len(model["vocab"])


def test_odd_rows(odd, odd_rows, nothing):
    once = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    texts = {i: t for i, t, *_ in odd_rows if i is not None}
    documents = dict(zip(texts, library_ids([t or "" for t in texts.values()])))
    for sequence, window in ((1024, 4096), (64, 64)):
        check(packing.pack(once, PATH, sequence=sequence, window=window).collect(), documents, sequence)
    every = packing.pack(odd, PATH)
    n = every.agg(F.sum("length")).first()[0]
    assert n == sum(len(i) for i in library_ids([t or "" for _, t, *_ in odd_rows]))
    assert packing.pack(nothing, PATH).collect() == []


def proportions(layout, queues):
    k = np.arange(layout.windows)
    return np.stack([layout.place(k + 1, np.full(len(k), q)) - layout.place(k, np.full(len(k), q)) for q in range(queues)], 1)


def test_every_window_has_the_mixture_and_deficits_are_carried():
    totals = np.array([1_000_003, 50_021, 333_333])
    layout = packing.Layout(totals, totals / totals.sum(), 1000)
    taken = proportions(layout, 3)
    assert (taken.sum(0) == totals).all()
    assert np.abs(taken[:-1] - 1000 * totals / totals.sum()).max() <= 1.000001
    assert np.abs(np.cumsum(taken, 0)[:-1] - np.outer(np.arange(1, len(taken)), 1000 * totals / totals.sum())).max() < 1.000001


def test_given_mixture_and_ends_of_queues():
    layout = packing.Layout(np.array([10_000, 2_000, 500]), np.array([0.5, 0.5, 0.0]), 1000)
    taken = proportions(layout, 3)
    assert (taken[:4, :2] == 500).all() and (taken[:12, 2] == 0).all()
    assert (taken[4:12, 0] == 1000).all() and taken[:, 2].sum() == 500


def test_mixture_of_sources(spark):
    rows = [(i, "one two three four five six seven " * 20, "a" if i % 4 else "b") for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = packing.pack(df, PATH, mixture={"a": 0.5, "b": 0.5}, sequence=128, window=1024)
    first = got.where("window_id < 2").groupBy("source").agg(F.sum("length").alias("n")).collect()
    assert {r.source: r.n for r in first} == {"a": 1024, "b": 1024}


def test_more_sources_than_queues(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    monkeypatch.setattr(packing, "POOLS", 2)
    rows = [(i, f"text number {i} " * (i % 7), f"s{i % 20}") for i in range(100)]
    documents = dict(zip(range(100), library_ids([t for _, t, _ in rows])))
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6), PATH, sequence=64, window=256)
    check(got.collect(), documents, 64)


def test_every_named_source_has_its_share_of_each_window(spark, monkeypatch):
    """More named sources than queues of their own for others: none of them is pooled."""
    monkeypatch.setattr(packing, "MAX_QUEUES", 3)
    monkeypatch.setattr(packing, "POOLS", 2)
    rows = [(i, "one two three four five six seven " * (3 + i % 5), f"s{i % 60}") for i in range(1800)]
    mixture = {f"s{j}": 1 / 40 for j in range(40)}
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5), PATH, mixture=mixture, sequence=64, window=4000)
    first = got.where("window_id < 5").groupBy("window_id", "source").agg(F.sum("length").alias("n")).collect()
    assert {r.source for r in first} == set(mixture) and {r.n for r in first} == {100}
    documents = dict(zip(range(1800), library_ids([t for _, t, _ in rows])))
    check(got.collect(), documents, 64)


def test_pooled_sources_alternate(spark, monkeypatch):
    monkeypatch.setattr(packing, "MAX_QUEUES", 1)
    monkeypatch.setattr(packing, "POOLS", 1)
    rows = [(i, "one two three four five six seven " * 4, f"s{i % 10}") for i in range(2000)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(40), PATH, sequence=64, window=16_384)
    per_window = got.where("window_id < 3").groupBy("window_id").agg(F.countDistinct("source").alias("n")).collect()
    assert min(r.n for r in per_window) == 10


@pytest.mark.parametrize("n, padded", [(1, 1), (512, 512), (700, 1024), (1024, 1024)])
def test_padding(spark, n, padded):
    assert spark.range(1).select(packing.padded_length(F.lit(n).cast("bigint"))).first()[0] == padded


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = dict(zip(texts, library_ids(list(texts.values()))))
    rows = QUERIES["op5_packing"](spark, sf).collect()
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert (zlib.crc32(part.tobytes()), r.doc_tokens) == (r.ids_crc32, len(ids[r.doc_id]))
    assert sum(r.length for r in rows) == sum(map(len, ids.values()))
    assert len({r.sequence_id for r in rows}) == -(-sum(map(len, ids.values())) // 1024)

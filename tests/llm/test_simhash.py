from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from eventflow.llm import simhash
from eventflow.llm.components import connected_components
from eventflow.llm.queries import QUERIES


def fingerprint_by_hand(text, words=4):
    import re

    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    tokens = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not tokens:
        return 0
    shingles = [" ".join(tokens[i : i + words]) for i in range(max(1, len(tokens) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(fingerprints, ids, radius):
    """Smallest id reachable from each, by comparing all pairs."""
    numbers = np.array(fingerprints, np.uint64)
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in np.flatnonzero(np.bitwise_count(numbers[i] ^ numbers) <= radius):
            a, b = sorted((root(i), root(int(j))), key=lambda r: ids[r])
            parent[b] = a
    return [ids[root(i)] for i in range(len(ids))]


def test_fingerprints(chance):
    texts = ["", " \t", "one", "One two", "a b c d", "a b c d e", "Ünï ΑΣ ß x y z K", "x\x1cy\x85z w", "A B C D " * 50]
    texts += [" ".join(chance.choices("abcdefgh", k=chance.randint(1, 60))) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint(t, 4) & (1 << 64) - 1 == fingerprint_by_hand(t)


def test_spark_hashes_alike(spark):
    row = spark.createDataFrame([("a b c dé",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] & (1 << 64) - 1 == xxhash.xxh64_intdigest("a b c dé".encode(), 42)


@pytest.mark.parametrize("bucket, block", [(2_000_000, 4096), (30_000, 16)])
@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_against_all_pairs(spark, monkeypatch, radius, bucket, block):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(radius)
    numbers = {0, (1 << 64) - 1}
    for _ in range(25):
        at = rng.getrandbits(64)
        for _ in range(6):  # chains with steps around the radius
            numbers.add(at)
            for b in rng.sample(range(64), rng.randint(1, radius + 1)):
                at ^= 1 << b
    numbers = sorted(numbers)
    signed = [n - (1 << 64) if n >> 63 else n for n in numbers]
    df = spark.createDataFrame([(n,) for n in signed], "fp bigint")
    edges = simhash.links(df, radius)
    assert all((a ^ b).bit_count() <= radius for a, b in [(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in edges.collect()])
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert [got.get(s, s) for s in signed] == components_by_hand(numbers, signed, radius)


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.links(spark.createDataFrame([(1,)], "fp bigint"), 3)


@pytest.mark.parametrize("fingerprints, variants", [(1, 1), (300, 2081), (10**7, 2081), (10**9, 2081)])
def test_packed_codes(fingerprints, variants):
    codes = simhash.Codes(fingerprints, variants)
    rng = np.random.default_rng(1)
    low = (codes.buckets // 2) * codes.span
    values = np.sort(rng.integers(low, min(low + codes.span, 1 << codes.bits), 500, dtype=np.uint64))
    values[3] = values[2]
    assert (codes.unpack(codes.pack(values, codes.buckets // 2), codes.buckets // 2) == values).all()


def test_components_of_paths_stars_and_noise(spark, chance):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3), (200, 201), (201, 200)]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    expected = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 150)} | {200: 200, 201: 200}
    assert {r.node: r.component for r in got} == expected and len(got) == len(expected)
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_odd_rows(odd, odd_rows, nothing):
    got = simhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    fingerprints = [fingerprint_by_hand(t) for _, t, *_ in odd_rows]
    ids = [10**9 if i is None else i for i, *_ in odd_rows]
    expected = sorted(zip(ids, fingerprints, components_by_hand(fingerprints, ids, 4)))
    big = lambda x: 10**9 if x is None else x
    assert sorted((big(r.doc_id), r.fp & (1 << 64) - 1, big(r.component_id)) for r in got) == expected
    assert simhash.near_duplicates(nothing).collect() == []


def test_query_against_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    fingerprints = [fingerprint_by_hand(t) for _, t in docs]
    reached = components_by_hand(fingerprints, [d for d, _ in docs], 4)
    expected = {(d, f"{f:016x}", c) for (d, _), f, c in zip(docs, fingerprints, reached)}
    assert {tuple(r) for r in QUERIES["op8_simhash_near_dedup"](spark, sf).collect()} == expected

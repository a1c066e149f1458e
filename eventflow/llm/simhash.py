"""Operator 8: SimHash near-dedup by meeting in the middle.

Two fingerprints at most `radius` bits apart have a common variant at most radius / 2 bits from each.
So every fingerprint emits all its variants within half the radius, variants are exchanged, and
fingerprints that meet in one are linked. Two that share a variant are never further apart than the
radius, so a star around the smallest of them links a meeting of any size without its pairs.

A fingerprint has thousands of variants and few of them meet another, so they are exchanged in two
steps. First only a short code of each goes out, sorted and stored as differences: about two bytes a
variant. Codes that occur once are done with. For the others the variant itself follows, once per block
of fingerprints, and is matched exactly; every link is verified by its bit distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window as W, functions as F

from eventflow.llm.common import append_columns, arrow_batch, struct, text_or_empty, written
from eventflow.llm.components import connected_components

BITS = 64
SEED = 42
#: Fingerprints whose variants one task holds at a time.
BLOCK = 2048
#: Variant codes that one bucket of the exchange gets, about.
BUCKET = 2_000_000
#: Values of the short code for each variant there is, at least (as a power of two).
SLACK_BITS = 7


# --- fingerprints ---------------------------------------------------------------------------

def fingerprint(text: str, words: int, seed: int = SEED) -> int:
    """Majority of each bit over the hashes of the text's shingles, as a signed 64-bit number."""
    tokens = text.encode().lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    hashed = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        votes = np.array([hashed(joined, seed)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(tokens) - words + 1].tolist(), ends[words - 1 :].tolist())
        votes = np.fromiter((hashed(joined[a:b], seed) for a, b in spans), np.uint64, len(tokens) - words + 1)
    counts = np.zeros(BITS, np.int64)
    for first in range(0, len(votes), 1 << 15):
        part = votes[first : first + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(votes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(df: DataFrame, text: str = "text", words: int = 4, seed: int = SEED, name: str = "fp") -> DataFrame:
    """df with the fingerprint of the whole text, a long. Null and empty texts have fingerprint zero."""

    def start():
        return lambda batch: {name: [fingerprint(t or "", words, seed) for t in batch.column(text).to_pylist()]}

    return append_columns(df, start, f"`{name}` bigint")


# --- variants -------------------------------------------------------------------------------

def masks(radius: int) -> np.ndarray:
    """All bit patterns with at most `radius` bits."""
    out = [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(BITS), k)]
    return np.array(out, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Codes:
    """Short codes of variants, their buckets, and sorted codes as differences in few bytes."""

    def __init__(self, fingerprints: int, variants: int):
        self.total = max(1, fingerprints * variants)
        self.bits = min(BITS, math.ceil(math.log2(self.total)) + SLACK_BITS)
        self.buckets = max(1, math.ceil(self.total / BUCKET))
        self.span = -(-(1 << self.bits) // self.buckets)
        gap = (1 << self.bits) / min(self.total, BLOCK * variants)
        self.width = next((w for w in (2, 3) if gap < 1 << 8 * w - 2), 4)

    def of(self, variants: np.ndarray) -> np.ndarray:
        return mix(variants) >> np.uint64(BITS - self.bits)

    def pack(self, codes: np.ndarray, bucket: int) -> bytes:
        """Sorted codes of a bucket: steps from one to the next, a full step where one isn't enough."""
        full = (1 << 8 * self.width) - 1
        steps = np.diff(codes, prepend=np.uint64(bucket * self.span))
        more, rest = steps // np.uint64(full), steps % np.uint64(full)
        out = np.full(len(steps) + int(more.sum()), full, np.uint32)
        out[np.arange(len(steps)) + np.cumsum(more).astype(np.int64)] = rest
        return out.astype("<u4").view(np.uint8).reshape(-1, 4)[:, : self.width].tobytes()

    def unpack(self, data: bytes, bucket: int) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8).reshape(-1, self.width)
        wide = np.zeros((len(raw), 4), np.uint8)
        wide[:, : self.width] = raw
        steps = wide.view("<u4")[:, 0]
        at = np.cumsum(steps, dtype=np.uint64) + np.uint64(bucket * self.span)
        return at[steps != (1 << 8 * self.width) - 1]


def _send_codes(codes: Codes, half: int):
    schema = struct("bucket int, block int, codes binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = masks(half)
        for batch in batches:
            for block, fps in zip(batch.column("block").to_pylist(), batch.column("fps")):
                own = fps.values.to_numpy().view(np.uint64)
                out = np.empty((len(flips), len(own)), np.uint64)
                for i, flip in enumerate(flips):
                    out[i] = codes.of(own ^ flip)
                sent = out.reshape(-1)
                sent.sort()
                bounds = np.searchsorted(sent, np.arange(codes.buckets + 1, dtype=np.uint64) * np.uint64(codes.span))
                some = np.flatnonzero(np.diff(bounds))
                for first in range(0, len(some), 64):
                    part = some[first : first + 64]
                    yield arrow_batch({
                        "bucket": part, "block": [block] * len(part),
                        "codes": [codes.pack(sent[bounds[b] : bounds[b + 1]], int(b)) for b in part],
                    }, schema)

    return run, schema


def _met_codes(codes: Codes):
    """Per bucket: codes that occur twice or more go back to the blocks that sent them."""
    schema = struct("block int, bucket int, codes binary")

    def meet(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        lists = [codes.unpack(c, bucket) for c in table.column("codes").to_pylist()]
        every = np.concatenate(lists)
        every.sort()
        twice = every[1:][every[1:] == every[:-1]]
        twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])] if len(twice) else twice
        blocks, found = [], []
        for block, own in zip(table.column("block").to_pylist(), lists):
            at = np.minimum(np.searchsorted(own, twice), len(own) - 1)
            if (hit := own[at] == twice).any():
                blocks.append(block)
                found.append(codes.pack(twice[hit], bucket))
        return pa.Table.from_batches([arrow_batch({"block": blocks, "bucket": [bucket] * len(blocks), "codes": found}, schema)])

    return meet, schema


def _send_variants(codes: Codes, half: int):
    """Per block: stars of the fingerprints that meet inside it, and one row for each variant to match outside."""
    schema = struct("variant bigint, a bigint, b bigint")
    low = np.uint64((1 << 22) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = masks(half)
        for batch in batches:
            for fps, met in zip(batch.column("fps"), batch.column("met").to_pylist()):
                own = fps.values.to_numpy().view(np.uint64)
                wanted = np.concatenate([codes.unpack(m["codes"], m["bucket"]) for m in sorted(met, key=lambda m: m["bucket"])])
                maybe = np.zeros(1 << 22, bool)
                maybe[wanted & low] = True
                variants, owners = [], []
                for flip in flips:
                    variant = own ^ flip
                    code = codes.of(variant)
                    some = np.flatnonzero(maybe[code & low])
                    at = np.minimum(np.searchsorted(wanted, code[some]), len(wanted) - 1)
                    some = some[wanted[at] == code[some]]
                    variants.append(variant[some])
                    owners.append(own[some])
                variant, owner = np.concatenate(variants), np.concatenate(owners)
                order = np.lexsort((owner, variant))
                variant, owner = variant[order], owner[order]
                new = np.concatenate([[True], variant[1:] != variant[:-1]]) if len(variant) else np.zeros(0, bool)
                hub = owner[new][np.cumsum(new) - 1] if len(variant) else owner
                star = np.stack([hub[~new], owner[~new]], axis=1)
                star = star[np.lexsort((star[:, 1], star[:, 0]))]
                star = star[np.concatenate([[True], (star[1:] != star[:-1]).any(1)])] if len(star) else star
                none = pa.nulls(len(star), pa.int64())
                yield arrow_batch({"variant": none, "a": star[:, 0].view(np.int64), "b": star[:, 1].view(np.int64)}
                                  if len(star) else {"variant": [], "a": [], "b": []}, schema)
                yield arrow_batch({
                    "variant": variant[new].view(np.int64), "a": owner[new].view(np.int64),
                    "b": pa.nulls(int(new.sum()), pa.int64()),
                }, schema)

    return run, schema


def links(distinct: DataFrame, radius: int, fp: str = "fp") -> DataFrame:
    """Edges (a, b) between distinct fingerprints that connect all pairs at most `radius` (an even number) bits apart."""
    if radius % 2:
        raise ValueError("the radius must be even: at half of an odd one, two that meet may be too far apart")
    half = radius // 2
    count = distinct.count()
    blocks = max(1, math.ceil(count / BLOCK))
    codes = Codes(count, len(masks(half)))
    grouped = written(
        distinct.groupBy(F.pmod(F.xxhash64(fp), F.lit(blocks)).cast("int").alias("block"))
        .agg(F.sort_array(F.collect_list(fp)).alias("fps")),
        "fingerprints", slim=True,
    )
    dealt = grouped.repartition(blocks, "block")
    send, sent_schema = _send_codes(codes, half)
    meet, met_schema = _met_codes(codes)
    met = dealt.mapInArrow(send, sent_schema).groupBy("bucket").applyInArrow(meet, met_schema)
    met = written(met.groupBy("block").agg(F.collect_list(F.struct("bucket", "codes")).alias("met")), "codes", slim=True)
    send, variant_schema = _send_variants(codes, half)
    found = grouped.join(met, "block").repartition(blocks, "block").mapInArrow(send, variant_schema)
    # a variant is owned by each block once at most; the stars of a block have no variant and stay as they are
    inside = F.col("variant").isNull()
    hub = F.min("a").over(W.partitionBy(inside, F.when(inside, F.xxhash64("a", "b")).otherwise(F.col("variant"))))
    stars = found.select(
        F.when(inside, F.col("a")).otherwise(hub).alias("a"), F.when(inside, F.col("b")).otherwise(F.col("a")).alias("b")
    ).where("a != b").distinct()
    return stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def components(marked: DataFrame, radius: int) -> DataFrame:
    """fp, component, component_id: for each distinct fingerprint of `marked` (doc_id, fp) a fingerprint that stands
    for its component, and the component's smallest id, null if it has none."""
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    stars = connected_components(links(nodes.select("fp"), radius), "a", "b")
    reach = (
        stars.join(nodes, stars["node"] == nodes["fp"]).groupBy("component").agg(F.min("first").alias("component_id"))
    )
    linked = stars.join(reach, "component").select(F.col("node").alias("fp"), "component", "component_id")
    named = nodes.join(linked, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "first").alias("component_id")
    )
    # a table of its own, so that Spark can split the documents of a hot fingerprint over tasks
    return written(named, "named", slim=True)


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 4, radius: int = 4, seed: int = SEED
) -> DataFrame:
    """doc_id, fp (long), component_id: the smallest id that can be reached by links of at most `radius` bits.

    Shingles of `words` words, lower-cased A-Z, split at ASCII white space; a shorter text is one shingle,
    and a null, empty or blank text has fingerprint zero and is linked like any other. Equal texts share
    a fingerprint and so a component; they are one node here however many they are. Repeated rows stay
    rows; a null id is never the smallest unless the component has no other. Other columns are left out,
    and an empty table gives no rows.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    marked = written(fingerprints(rows, "text", words, seed).select("doc_id", "fp"), "marked", slim=True)
    return marked.join(components(marked, radius), "fp").select("doc_id", "fp", "component_id")

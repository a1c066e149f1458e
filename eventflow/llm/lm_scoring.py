"""Operator 6: language-model scores by deleted interpolation.

The probability of a word is a mixture of its maximum-likelihood estimates after the word before, on its
own, and uniformly. The weights depend on how often the context was seen, in buckets of powers of two,
and are learned by expectation-maximisation on counts of documents held out from the estimates.

Counts cover all training documents and are never brought together in one place. Documents are read once
into blocks of tokens; a block asks for the counts of its distinct words and word pairs, each once and in
packed lists; a bucket of keys adds up what all blocks have counted and answers each list in its order.
So what is exchanged is a few bytes per distinct pair of a block, never a row per token, and a frequent
word costs one entry per block.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from eventflow.llm.common import arrow_batch, remainder, scratch, struct, text_or_empty

#: Tokens of a block, about; a longer document is a block of its own.
BLOCK_TOKENS = 3_000_000
#: Keys a bucket gets from all blocks, about.
BUCKET_KEYS = 2_000_000
#: Context frequencies are told apart by powers of two up to this one.
CONTEXTS = 48
#: Steps of an octave in which held-out events are counted.
STEPS = 4
ROUNDS = 100
#: What every bucket of contexts takes over from all of them, in events.
SHARED_EVENTS = 20.0
#: Stands for the end of a document; white space, so no word.
END = b"\n"


def tokens(text: str) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return text.encode().lower().split()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# --- packed lists ---------------------------------------------------------------------------

def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences of as few bytes as the largest needs."""
    steps = np.diff(keys, prepend=np.uint64(0))
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return bytes([width]) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(-1, width)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :width] = raw
    return np.cumsum(wide.view("<u8")[:, 0], dtype=np.uint64)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte for each count, and eight more for those that do not fit."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<u8").tobytes()


def unpack_counts(data: bytes, size: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, count=size).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<u8", offset=size).astype(np.int64)
    return counts


# --- blocks ---------------------------------------------------------------------------------

class Block:
    """Tokens of some documents as local word numbers, word 0 being the end."""

    def __init__(self) -> None:
        self.local: dict[bytes, int] = defaultdict(count().__next__)
        self.local[END]  # noqa: B018
        self.ids: list[np.ndarray] = []
        self.doc_ids: list = []
        self.held: list[bool] = []
        self.sizes: list[int] = []
        self.total = 0

    def add(self, doc_id, held: bool, text: str) -> None:
        own = tokens(text)
        own.append(END)
        self.ids.append(np.fromiter(map(self.local.__getitem__, own), np.uint32, len(own)))
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.sizes.append(len(own))
        self.total += len(own)

    def row(self, block: int, tuning: bool) -> dict:
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.local), np.uint64, len(self.local))
        trained = sum(n for n, h in zip(self.sizes, self.held) if not h)
        return {"block": block, "tuning": tuning, "doc_ids": self.doc_ids, "held": self.held, "sizes": self.sizes,
                "tokens": self.total, "trained": trained, "words": hashes.astype("<u8").tobytes(),
                "ids": np.concatenate(self.ids).astype("<u4").tobytes()}


def _blocks(df: DataFrame, doc_id: str, text: str, training: Column, tuning: Column, block_tokens: int) -> DataFrame:
    rows = df.select(
        F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"),
        F.coalesce(~training, F.lit(True)).alias("held"), F.coalesce(training & tuning, F.lit(False)).alias("tuning"),
    )
    schema = T.StructType([
        *struct("block bigint, tuning boolean").fields,
        T.StructField("doc_ids", T.ArrayType(df.schema[doc_id].dataType)),
        *struct("held array<boolean>, sizes array<int>, tokens bigint, trained bigint, words binary, ids binary").fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        open_blocks = {False: Block(), True: Block()}

        def out(kind: bool) -> pa.RecordBatch:
            nonlocal number
            row = open_blocks[kind].row(number, kind)
            number, open_blocks[kind] = number + 1, Block()
            return arrow_batch({k: [v] for k, v in row.items()}, schema)

        for batch in batches:
            for doc, value, held, tuned in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "held", "tuning"))):
                open_blocks[tuned].add(doc, held, value)
                if open_blocks[tuned].total >= block_tokens:
                    yield out(tuned)
        for kind in (False, True):
            if open_blocks[kind].total:
                yield out(kind)

    path = scratch(df.sparkSession, "blocks")
    rows.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


class Keys:
    """The distinct words and pairs of a block: sorted keys, and the key of each token."""

    def __init__(self, words: bytes, ids: bytes, sizes: list[int]):
        self.words = mix(np.frombuffer(words, "<u8") + np.uint64(1))
        self.ids = np.frombuffer(ids, "<u4").astype(np.int64)
        self.sizes = np.array(sizes, np.int64)
        self.before = np.concatenate([[0], self.ids[:-1]])  # documents end in word 0, so each starts behind one
        pair_of = mix(self.words[self.before] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.ids])
        order = np.argsort(pair_of)
        new = np.concatenate([[True], pair_of[order][1:] != pair_of[order][:-1]])
        self.pairs = pair_of[order][new]
        self.pair = np.empty(len(order), np.int64)
        self.pair[order] = np.cumsum(new) - 1
        self.word_order = np.argsort(self.words)
        self.place = np.empty(len(self.words), np.int64)
        self.place[self.word_order] = np.arange(len(self.words))
        self.sorted_words = self.words[self.word_order]

    def lists(self, buckets: int) -> Iterator[tuple[int, int, slice]]:
        """(kind, bucket, which of the sorted keys): kind 1 for words, 2 for pairs."""
        edges = np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)
        for kind, keys in ((1, self.sorted_words), (2, self.pairs)):
            bounds = [0, *np.searchsorted(keys, edges).tolist(), len(keys)]
            for bucket, (a, b) in enumerate(zip(bounds, bounds[1:])):
                if b > a:
                    yield kind, bucket, slice(a, b)

    def counts(self, answers: list[dict], buckets: int, field: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each token how often it was counted, its context, and both together."""
        found = {1: np.zeros(len(self.words), np.int64), 2: np.zeros(len(self.pairs), np.int64)}
        by_list = {(r["kind"], r["bucket"]): r[field] for r in answers}
        for kind, bucket, part in self.lists(buckets):
            found[kind][part] = unpack_counts(by_list[kind, bucket], part.stop - part.start)
        word = found[1][self.place]
        return word[self.ids], word[self.before], found[2][self.pair]


def _ask(buckets: int):
    schema = struct("bucket int, block bigint, kind int, tuning boolean, keys binary, counts binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                keys = Keys(row["words"], row["ids"], row["sizes"])
                counted = np.repeat(~np.array(row["held"], bool), keys.sizes)
                sums = {1: np.bincount(keys.place[keys.ids[counted]], minlength=len(keys.words)),
                        2: np.bincount(keys.pair[counted], minlength=len(keys.pairs))}
                every = {1: keys.sorted_words, 2: keys.pairs}
                out = [(b, row["block"], k, row["tuning"], pack_keys(every[k][p]), pack_counts(sums[k][p]))
                       for k, b, p in keys.lists(buckets)]
                yield arrow_batch(dict(zip(schema.names, map(list, zip(*out)))), schema)

    return run, schema


def _answer():
    """Per bucket and kind: what estimates and tuning documents have counted, for every list in its order."""
    schema = struct("block bigint, kind int, bucket int, estimated binary, trained binary, known bigint")

    def run(table: pa.Table) -> pa.Table:
        kind, bucket = table.column("kind")[0].as_py(), table.column("bucket")[0].as_py()
        keys = [unpack_keys(k) for k in table.column("keys").to_pylist()]
        sizes = list(map(len, keys))
        counts = np.concatenate([unpack_counts(c, n) for c, n in zip(table.column("counts").to_pylist(), sizes)])
        tuning = np.repeat(np.array(table.column("tuning").to_pylist(), bool), sizes)
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        new = np.concatenate([[True], every[order][1:] != every[order][:-1]])
        group = np.empty(len(order), np.int64)
        group[order] = np.cumsum(new) - 1
        trained = np.bincount(group, weights=counts).astype(np.int64)
        estimated = np.bincount(group, weights=counts * ~tuning).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).tolist()
        parts = [group[a:b] for a, b in zip(bounds, bounds[1:])]
        answers = {
            "block": [*table.column("block").to_pylist(), -1], "kind": [kind] * (len(parts) + 1),
            "bucket": [bucket] * (len(parts) + 1),
            "estimated": [*(pack_counts(estimated[p]) for p in parts), b""],
            "trained": [*(pack_counts(trained[p]) for p in parts), b""],
            "known": [0] * len(parts) + [int((trained > 0).sum())],
        }
        return pa.Table.from_batches([arrow_batch(answers, schema)])

    return run, schema


# --- mixture --------------------------------------------------------------------------------

def context_bucket(seen: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else one more than the whole power of two."""
    return np.where(seen > 0, np.minimum(CONTEXTS - 1, np.frexp(seen.astype(float))[1]), 0)


def learn_weights(events: list[tuple[int, int, int, int]], uniform: float) -> np.ndarray:
    """Weights (pair, word, uniform) by context bucket, by expectation-maximisation.

    Events: context bucket, the pair's and the word's estimate in steps of an octave (1 for none), count.
    """
    weights = np.tile([0.4, 0.4, 0.2], (CONTEXTS, 1))
    weights[0] = [0.0, 0.8, 0.2]
    if not events:
        return weights
    context, pair, word, n = (np.array(c) for c in zip(*events))
    likely = np.stack([np.where(pair > 0, 0.0, 2.0 ** (pair / STEPS)), np.where(word > 0, 0.0, 2.0 ** (word / STEPS)),
                       np.full(len(n), uniform)], axis=1)
    for _ in range(ROUNDS):
        share = likely * weights[context]
        share *= (n / np.maximum(share.sum(1), 1e-300))[:, None]
        sums = np.stack([np.bincount(context, share[:, i], CONTEXTS) for i in range(3)], axis=1)
        overall = sums[1:].sum(0) + 1e-9
        weights = sums + SHARED_EVENTS * overall / overall.sum()
        weights[0, 0] = 0.0
        weights += 1e-9 * np.array([0.0, 1.0, 1.0])
        weights /= weights.sum(1, keepdims=True)
    return weights


def _log_steps(part: np.ndarray, whole: np.ndarray | float) -> np.ndarray:
    share = np.where(part > 0, part, 1) / np.maximum(whole, 1)
    return np.where(part > 0, np.minimum(0, np.rint(STEPS * np.log2(share))), 1).astype(np.int64)


def score(
    df: DataFrame, training: Column, tuning: Column, doc_id: str = "doc_id", text: str = "text",
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row.

    `training` says which rows are learned from, `tuning` which of those fit the weights; the counts the
    scores use are of all training rows. Scores are base-10 logarithms of a text's probability, its end
    included; the base is the add-one estimate of single words. A row where `training` is null is held out.
    Null and empty texts are their end alone. Repeated rows are learned from and scored each. Without
    training rows all words are unknown; an empty table gives no rows. Other columns are left out.
    """
    spark = df.sparkSession
    blocks = _blocks(df, doc_id, text, training, tuning, block_tokens)
    total = blocks.agg(F.sum("tokens").alias("t"), F.sum("trained").alias("n"),
                       F.sum(F.expr("CASE WHEN tuning THEN 0 ELSE trained END")).alias("e")).first()
    n_trained, n_estimated = total.n or 0, total.e or 0
    buckets = max(1, math.ceil((total.t or 0) / BUCKET_KEYS))

    ask, asked = _ask(buckets)
    answer, answered = _answer()
    path = scratch(spark, "counts")
    (blocks.select("block", "tuning", "held", "sizes", "words", "ids").mapInArrow(ask, asked)
     .groupBy("bucket", "kind").applyInArrow(answer, answered).write.option("compression", "zstd").parquet(path))
    counts = spark.read.schema(answered).parquet(path)
    known = counts.where("block = -1 AND kind = 1").agg(F.sum("known")).first()[0] or 0

    def with_counts(some: DataFrame, field: str) -> DataFrame:
        lists = counts.where("block >= 0").groupBy("block").agg(F.collect_list(F.struct("kind", "bucket", field)).alias("answers"))
        return some.join(lists, "block")

    # held-out events of the tuning documents, against the counts of the others
    events_schema = struct("context int, pair int, word int, n bigint")

    def held_out_events(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = Keys(row["words"], row["ids"], row["sizes"])
            word, context, pair = keys.counts(row["answers"], buckets, "estimated")
            events = np.stack([context_bucket(context), _log_steps(pair, context), _log_steps(word, n_estimated)], axis=1)
            code = (events[:, 0] * 4096 + events[:, 1] + 2048) * 4096 + events[:, 2] + 2048
            code.sort()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
            each, n = code[first], np.diff(np.append(first, len(code)))
            yield arrow_batch({"context": each // 4096 // 4096, "pair": each // 4096 % 4096 - 2048,
                               "word": each % 4096 - 2048, "n": n}, events_schema)

    tuned = with_counts(blocks.where("tuning"), "estimated").select("block", "sizes", "words", "ids", "answers")
    events = tuned.mapInArrow(held_out_events, events_schema).groupBy("context", "pair", "word").agg(F.sum("n").alias("n"))
    # the table is bounded by its grid: CONTEXTS buckets times the steps of both estimates
    weights = learn_weights([(r.context, r.pair, r.word, r.n) for r in events.collect()], 1 / (known + 1))

    id_type = df.schema[doc_id].dataType
    schema = T.StructType([T.StructField("doc_id", id_type), *struct(
        "held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    ).fields])

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = Keys(row["words"], row["ids"], row["sizes"])
            word, context, pair = keys.counts(row["answers"], buckets, "trained")
            w = weights[context_bucket(context)]
            chance = w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * word / max(n_trained, 1) + w[:, 2] / (known + 1)
            starts = np.concatenate([[0], np.cumsum(keys.sizes)[:-1]])
            yield arrow_batch({
                "doc_id": row["doc_ids"], "held_out": row["held"], "n_tokens": keys.sizes,
                "n_known": np.add.reduceat((word > 0).astype(np.int64), starts), "train_tokens": [n_trained] * len(starts),
                "base_score": np.add.reduceat(np.log10((word + 1) / (n_trained + known + 1)), starts),
                "score": np.add.reduceat(np.log10(chance), starts),
            }, schema)

    return with_counts(blocks, "trained").select("block", "doc_ids", "held", "sizes", "words", "ids", "answers").mapInArrow(scores, schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def folds(doc_id: str = "doc_id") -> tuple[Column, Column]:
    """Training rows, and those of them that tune the weights: by the checksum of the id, modulo 7."""
    return remainder(doc_id, 7) != 2, remainder(doc_id, 7) == 3

"""Operator 5: mixture-controlled packing by deficit round-robin over source queues.

All tokens are laid out in windows. In each window every source's queue is served its quantum, the
window's tokens times the source's share of the mixture; what a quantum leaves over in fractions of a
token is the queue's deficit and is carried into the next window. An exhausted queue gives its share to
the others. Documents are cut where a quantum or a sequence ends, so that only the last sequence of the
corpus can be short.

A queue's position after any window follows from the queues' totals alone. Each task therefore knows
the carried deficits at its own place, and the layout needs no pass over windows: one map-side pass
makes the token ids, sums per block and source become the blocks' places in the queues, and a second
map-side pass cuts the pieces. Token ids are never shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from tokenizers import Tokenizer

from eventflow.llm.common import arrow_batch, slices, struct, text_or_empty, written
from eventflow.llm.text_units import BYTES, UNSETTLED

SEQUENCE = 1024
#: Tokens in a window: 64 sequences.
WINDOW = 64 * SEQUENCE
#: Queues of their own for this many sources, those with the most tokens, and for all that a mixture names; the others
#: share POOLS queues, in which their blocks alternate. No source is dropped. It bounds the table of totals that every task gets.
MAX_QUEUES = 1000
POOLS = 24
#: The splitting rule of this kind of byte-level vocabulary: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteEncoder:
    """Token ids of whole texts as little-endian bytes, as the tokenizer file says.

    The same vocabulary as ranks gives the same ids faster: a byte-level vocabulary whose ids follow the
    order of its merges and whose tokens all encode to themselves leaves no choice of merge. Texts with
    characters that another version of Unicode may see differently are left to the file's own library.
    """

    def __init__(self, definition: str, ranks: dict[bytes, int], special: dict[str, int]):
        self.definition, self.special = definition, special
        self.ranked = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.type = np.dtype("<u2" if max([*ranks.values(), *special.values()]) < 1 << 16 else "<u4")

    @classmethod
    def parts(cls, definition: str) -> tuple[str, dict[bytes, int], dict[str, int]]:
        """What an encoder is made of, read from the file once and not by every worker."""
        spec = json.loads(definition)
        vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in spec["model"]["merges"]]
        if made != sorted(made):
            raise ValueError("the vocabulary's ids do not follow its merges")
        return definition, {bytes(map(BYTES.__getitem__, t)): i for t, i in vocab.items() if t not in special}, special

    @cached_property
    def library(self) -> Tokenizer:
        return Tokenizer.from_str(self.definition)

    def _ids(self, text: str) -> np.ndarray:
        if not text.isascii() and UNSETTLED.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.type)
        if self.cut is None or "<|" not in text:
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype(self.type)
        pieces = [[self.special[p]] if p in self.special else self.ranked.encode_ordinary(p) for p in self.cut.split(text)]
        return np.array([i for piece in pieces for i in piece], self.type)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text and then id 0, which ends a document."""
        end = np.zeros(1, self.type).tobytes()
        return [self._ids(t).tobytes() + end for t in texts]


class Layout:
    """Where each token of each queue goes, from the queues' totals and weights."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray, window: int = WINDOW):
        self.totals, self.window = totals.astype(np.int64), window
        self.weights = np.where(weights > 0, weights, np.finfo(float).tiny * 1e30)
        self.total = int(self.totals.sum())
        self.windows = -(-self.total // window)
        # rounds of service after which each queue is empty, and the tokens served by then
        ends = self.totals / self.weights
        at = np.unique(np.concatenate([[0.0], ends]))
        served = np.array([np.minimum(self.totals, self.weights * v).sum() for v in at])
        self.rounds, self.served = at, served

    def place(self, window: np.ndarray, queue: np.ndarray) -> np.ndarray:
        """Tokens of the queue that all windows before the given one have taken, whole tokens only."""
        rounds = np.interp(window.astype(float) * self.window, self.served, self.rounds)
        taken = np.floor(np.minimum(self.totals[queue], self.weights[queue] * rounds)).astype(np.int64)
        return np.where(window >= self.windows, self.totals[queue], np.where(window <= 0, 0, taken))

    def window_of(self, queue: np.ndarray, position: np.ndarray) -> np.ndarray:
        guess = np.interp(position / self.weights[queue], self.rounds, self.served) / self.window
        window = np.clip(guess.astype(np.int64), 0, max(0, self.windows - 1))
        while (late := self.place(window, queue) > position).any():
            window -= late
        while (early := self.place(window + 1, queue) <= position).any():
            window += early
        return window

    def global_position(self, window: np.ndarray, queue: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Place in the whole corpus: windows one after the other, in each the queues one after the other."""
        out = np.empty(len(window), np.int64)
        every = np.arange(len(self.totals))
        distinct, back = np.unique(window, return_inverse=True)
        step = max(1, 2_000_000 // max(1, len(every)))
        for first in range(0, len(distinct), step):
            ks = distinct[first : first + step]
            before = self.place(ks[:, None], every[None, :])
            inside = self.place(ks[:, None] + 1, every[None, :]) - before
            start = before.sum(1)[:, None] + np.cumsum(inside, axis=1) - inside
            rows = np.flatnonzero((back >= first) & (back < first + step))
            k, q = back[rows] - first, queue[rows]
            out[rows] = start[k, q] + position[rows] - before[k, q]
        return out


def tokenized(df: DataFrame, path: str, doc_id: str, text: str, source: str) -> DataFrame:
    """One row per document with its ids and its place among its block's tokens of the same source.

    A block is what one task read. The rows are written to the shared folder, so that blocks stay as they are.
    """
    with open(path, encoding="utf-8") as f:
        parts = df.sparkSession.sparkContext.broadcast(ByteEncoder.parts(f.read()))
    id_type = df.schema[doc_id].dataType.simpleString()
    schema = struct(f"doc_id {id_type}, source string, block int, block_start bigint, n bigint, ids binary")
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"),
        text_or_empty(text).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, block, places = ByteEncoder(*parts.value), TaskContext.get().partitionId(), {}
        for batch in slices(batches):
            ids = encoder.encode(batch.column("text").to_pylist())
            sizes = [len(i) // encoder.type.itemsize for i in ids]
            starts = []
            for name, n in zip(batch.column("source").to_pylist(), sizes):
                starts.append(places.get(name, 0))
                places[name] = starts[-1] + n
            yield arrow_batch({
                "doc_id": batch.column("doc_id"), "source": batch.column("source"),
                "block": [block] * len(ids), "block_start": starts, "n": sizes, "ids": ids,
            }, schema)

    return written(rows.mapInArrow(run, schema), "tokens")


def pack(
    df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", source: str = "source",
    mixture: dict[str, float] | None = None, sequence: int = SEQUENCE, window: int = WINDOW,
) -> DataFrame:
    """Pieces of all documents: doc_id, source, start, length, ids (little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, window_id, sequence_length.

    `mixture` gives sources their share of each window; without it every source has its share of the
    corpus, so that all queues end together. A source the mixture does not name waits for the others'
    ends. Null texts are empty, and an empty document is its end token alone; a null source is the queue ''.
    Long documents are cut into as many pieces as needed. Queues keep the order of the input, so ties need
    no rule; repeated rows are packed each. An empty table gives no pieces. Other columns are not looked at.
    """
    spark = df.sparkSession
    tokens = tokenized(df, path, doc_id, text, source)
    sums = written(tokens.groupBy("source", "block").agg(F.sum("n").alias("n")), "sums", slim=True)
    by_source = sums.groupBy("source").agg(F.sum("n").alias("n"))
    named = F.col("source").isin(list(mixture)) if mixture else F.lit(False)
    most = by_source.where(~named).orderBy(F.desc("n"), "source").limit(MAX_QUEUES)
    own = [(r.source, r.n) for part in (by_source.where(named), most) for r in part.collect()]
    names = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(own)], "source string, own int")
    queue = F.coalesce("own", F.lit(len(own)) + F.pmod(F.xxhash64("source"), F.lit(POOLS))).cast("int")
    placed = sums.join(F.broadcast(names), "source", "left").withColumn("queue", queue)
    before = F.sum("n").over(W.partitionBy("queue").orderBy("block", "source")) - F.col("n")
    places = written(placed.select("source", "block", "queue", before.alias("before")), "places", slim=True)

    totals = np.array([n for _, n in own] + [0] * POOLS, np.int64)
    for r in placed.where(F.col("own").isNull()).groupBy("queue").agg(F.sum("n").alias("n")).collect():
        totals[r.queue] = r.n
    if mixture is None:
        weights = totals / max(1, totals.sum())
    else:
        weights = np.array([mixture.get(s, 0.0) for s, _ in own] + [0.0] * POOLS)
    layout = spark.sparkContext.broadcast(Layout(totals, weights, window))
    with open(path, encoding="utf-8") as f:
        width = 2 if Tokenizer.from_str(f.read()).get_vocab_size() <= 1 << 16 else 4

    id_type = tokens.schema["doc_id"].dataType.simpleString()
    schema = struct(
        f"doc_id {id_type}, source string, start bigint, length bigint, ids binary, doc_tokens bigint,"
        " sequence_id bigint, offset bigint, window_id bigint, sequence_length bigint"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield _cut(batch, layout.value, schema, width, sequence)

    joined = tokens.join(places, ["source", "block"])
    return joined.select(
        "doc_id", "source", "n", "ids", "queue", (F.col("before") + F.col("block_start")).alias("at")
    ).mapInArrow(run, schema)


def _cut(batch: pa.RecordBatch, layout: Layout, schema, width: int, sequence: int) -> pa.RecordBatch:
    n = batch.column("n").to_numpy()
    queue = batch.column("queue").to_numpy().astype(np.int64)
    at = batch.column("at").to_numpy()
    # cut where the queue's quantum of a window ends
    first, last = layout.window_of(queue, at), layout.window_of(queue, at + n - 1)
    doc, window = _spread(first, last)
    q = queue[doc]
    begin = np.maximum(at[doc], layout.place(window, q))
    end = np.minimum(at[doc] + n[doc], layout.place(window + 1, q))
    doc, window, q, begin, end = (x[end > begin] for x in (doc, window, q, begin, end))
    place = layout.global_position(window, q, begin)
    # and where a sequence ends
    part, number = _spread(place // sequence, (place + end - begin - 1) // sequence)
    left = np.maximum(place[part], number * sequence)
    right = np.minimum((place + end - begin)[part], (number + 1) * sequence)
    start = begin[part] + left - place[part] - at[doc[part]]
    owner = doc[part]
    ids = batch.column("ids").to_pylist()
    kind = "<u2" if width == 2 else "<u4"
    wide = [np.frombuffer(i, kind).astype("<u4") for i in ids]
    lengths = right - left
    return arrow_batch({
        "doc_id": batch.column("doc_id").take(pa.array(owner)), "source": batch.column("source").take(pa.array(owner)),
        "start": start, "length": lengths,
        "ids": [wide[d][s : s + k].tobytes() for d, s, k in zip(owner.tolist(), start.tolist(), lengths.tolist())],
        "doc_tokens": n[owner], "sequence_id": number, "offset": left - number * sequence, "window_id": window[part],
        "sequence_length": np.minimum(sequence, layout.total - number * sequence),
    }, schema)


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row all numbers from first to last: the row's index, and the number."""
    counts = last - first + 1
    row = np.repeat(np.arange(len(first)), counts)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]


def padded_length(sequence_length: str | Column, sequence: int = SEQUENCE) -> Column:
    """Tokens of a sequence with its padding: none at a power of two, else up to `sequence`."""
    n = F.col(sequence_length) if isinstance(sequence_length, str) else sequence_length
    return F.when(F.bit_count(n) == 1, n).otherwise(F.lit(sequence)).cast("long")

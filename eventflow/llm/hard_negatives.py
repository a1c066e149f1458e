"""Operator 12: hard-negative mining over exact integer scores, by residue-number-system matrix products.

Components become whole numbers. Scores of all rows with all anchors are computed block by block: for each
of a few small primes the matrices of residues are multiplied in float32, where every sum is exact, and
the residues of the product are put together by Chinese remaindering (balanced mixed-radix digits, which
give the sign too). The number of primes follows from the longest vector in the table. A first pass finds
each anchor's positives, a second one the best rows inside each positive's window of scores.

A task holds one block of anchors and lets rows stream past it in the order of their ids, keeping only the
best few of each anchor. Rows are sent once per block of anchors, anchors once per group of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventflow.llm.common import arrow_batch, struct, written

#: With centred residues up to 125, sums of CHUNK products stay below 2^24, where float32 is exact.
PRIMES = (251, 241, 239, 233, 229, 227, 223, 211, 199)
CHUNK = 1024
#: Anchors held by a task, rows multiplied with them at once, and rows that stream past them in one task at most.
ANCHORS = 1024
ROWS = 512
GROUP_ROWS = 1 << 20
MOST_TASKS = 1 << 16
#: Squared length of quantised vectors from which scores might not fit into 62 bits.
LONGEST = 2.0**62
NO_ID = np.iinfo(np.int64).max
LEAST = np.iinfo(np.int64).min


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """x modulo an odd p, between -(p-1)/2 and (p-1)/2."""
    half = p // 2
    return (x + half) % p - half


def primes_for(squared: float) -> tuple[int, ...]:
    """Primes whose product exceeds twice the largest possible score."""
    if squared >= LONGEST:
        raise ValueError(f"quantised vectors of squared length {squared:.3g}: scores would not fit into 62 bits")
    product = 1
    for i, p in enumerate(PRIMES):
        product *= p
        if product > 2.001 * squared + 3:
            return PRIMES[: i + 1]
    raise AssertionError("too few primes")


class Residues:
    """The residues of a matrix of whole numbers (rows of int64) for each prime, as float32."""

    def __init__(self, matrix: np.ndarray, primes: tuple[int, ...]):
        self.primes = primes
        self.parts = [centred(matrix, p).astype(np.float32) for p in primes]

    def scores(self, other: Residues) -> np.ndarray:
        """Exact inner products of all rows of both."""
        value = weight = None
        for p, a, b in zip(self.primes, self.parts, other.parts):
            product = _product(a, b, p)
            if value is None:
                value, weight = centred(product, p).astype(np.int64), p
                continue
            digit = centred((product - value % p) * pow(weight, -1, p), p)
            value += digit * np.int64(weight)
            weight *= p
        return value


def _product(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    """a times b transposed, modulo p: float32 products over at most CHUNK components at a time."""
    total = 0
    for at in range(0, max(1, a.shape[1]), CHUNK):
        part = (a[:, at : at + CHUNK] @ b[:, at : at + CHUNK].T).astype(np.int32)
        total = (total + part) % p
    return total


class Best:
    """The k best (score, id) of each slot; of equal scores the smaller ids. Ids must come in ascending order."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.scores = np.full((slots, k), LEAST)
        self.ids = np.full((slots, k), NO_ID)
        self.n = np.zeros(slots, np.int64)

    def offer(self, slots: np.ndarray, scores: np.ndarray, wanted: np.ndarray, ids: np.ndarray) -> None:
        """One row of scores per slot, one column per id. A slot that is full takes only better scores."""
        if not self.k:
            return
        wanted &= scores > self.scores[slots, -1][:, None]
        row, column = np.nonzero(wanted)
        if not len(row):
            return
        touched, place = np.unique(row, return_inverse=True)
        old = slots[touched]
        held = np.arange(self.k)[None, :] < self.n[old][:, None]
        at = np.concatenate([np.nonzero(held)[0], place])
        score = np.concatenate([self.scores[old][held], scores[row, column]])
        key = np.concatenate([self.ids[old][held], ids[column]])
        order = np.lexsort((key, -score, at))
        at, score, key = at[order], score[order], key[order]
        first = np.searchsorted(at, np.arange(len(old)))
        rank = np.arange(len(at)) - first[at]
        keep = rank < self.k
        at, rank = at[keep], rank[keep]
        self.scores[old[at], rank], self.ids[old[at], rank] = score[keep], key[keep]
        self.n[old] = np.bincount(at, minlength=len(old))

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """slot, id, score of all that is held."""
        slot, place = np.nonzero(np.arange(self.k)[None, :] < self.n[:, None])
        return slot, self.ids[slot, place], self.scores[slot, place]


def matrix(vectors: pa.Array, width: int, scale: int) -> np.ndarray:
    """Whole numbers floor(scale * x), one row per vector; shorter vectors end in zeros."""
    out = np.zeros((len(vectors), width), np.int64)
    sizes = np.diff(vectors.offsets.to_numpy())
    values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    row = np.repeat(np.arange(len(vectors)), sizes)
    start = np.cumsum(sizes) - sizes
    out[row, np.arange(len(values)) - np.repeat(start, sizes)] = values
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(cell, kind, at most ROWS rows of them); the first rows of a cell in small steps, so that few get past the next."""
    seen, done = None, 0
    for batch in batches:
        cell, kind = (batch.column(c).to_numpy() for c in ("cell", "kind"))
        borders = np.flatnonzero((np.diff(cell) != 0) | (np.diff(kind) != 0)) + 1
        for start, stop in zip([0, *borders], [*borders, len(cell)]):
            at, now = start, (cell[start], kind[start])
            if now != seen:
                seen, done = now, 0
            while at < stop:
                size = min(stop - at, ROWS if done >= 64 else 32)
                yield int(cell[start]), int(kind[start]), batch.slice(at, size)
                at, done = at + size, done + size


class Cell:
    """A block of anchors, and what is best for them so far."""

    def __init__(self, parts: list[pa.RecordBatch], setting: dict, keep: int):
        joined = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        self.rid, self.id, self.label = (joined.column(c).to_numpy() for c in ("rid", "id", "label"))
        self.setting = setting
        self.residues = Residues(matrix(joined.column("vector"), setting["width"], setting["scale"]), setting["primes"])
        windows = joined.column("windows").to_pylist()
        self.windows = max((len(w) for w in windows if w is not None), default=0)
        self.best = Best(len(self.rid) * max(1, self.windows), keep)
        if self.windows:
            low, high = setting["low"], setting["high"]
            self.low, self.high = np.full((self.windows, len(windows)), 1), np.full((self.windows, len(windows)), 0)
            for i, w in enumerate(windows):
                for j, score in enumerate(w):
                    self.low[j, i], self.high[j, i] = -(-low * score // 100), high * score // 100

    def offer(self, rows: pa.RecordBatch) -> None:
        ids, label = rows.column("id").to_numpy(), rows.column("label").to_numpy()
        vectors = matrix(rows.column("vector"), self.setting["width"], self.setting["scale"])
        scores = self.residues.scores(Residues(vectors, self.setting["primes"]))
        same = self.label[:, None] == label[None, :]
        slots = np.arange(len(self.rid))
        if not self.windows:
            self.best.offer(slots, scores, same & (self.id[:, None] != ids[None, :]), ids)
        for j in range(self.windows):
            inside = ~same & (scores >= self.low[j][:, None]) & (scores <= self.high[j][:, None])
            self.best.offer(j * len(slots) + slots, scores, inside, ids)

    def result(self, schema) -> pa.RecordBatch:
        slot, ids, scores = self.best.found()
        return arrow_batch({
            "rid": self.rid[slot % len(self.rid)], "place": (slot // len(self.rid)).astype(np.int32),
            "id": pa.array(ids, mask=ids == NO_ID), "score": scores,
        }, schema)


def _best(anchors: DataFrame, rows: DataFrame, groups: tuple[int, int], setting: dict, keep: int) -> DataFrame:
    """(rid of the anchor, place of the window, id, score): the `keep` best rows of each anchor, or of each of its windows."""
    blocks, parts = groups
    mine = F.xxhash64("rid", F.lit(1))
    block, part = F.pmod(mine, F.lit(blocks)), F.pmod(mine, F.lit(parts))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))
    held = anchors.withColumn("part", numbers(parts)).select(
        (block * parts + F.col("part")).alias("cell"), F.lit(0).alias("kind"), "rid", "id", "label", "vector", "windows")
    stream = rows.withColumn("block", numbers(blocks)).select(
        (F.col("block") * parts + part).alias("cell"), F.lit(1).alias("kind"), "rid", "id", "label", "vector",
        F.expr("CAST(NULL AS array<bigint>)").alias("windows"))
    tasks = min(blocks * parts, MOST_TASKS)
    dealt = held.unionByName(stream).repartitionById(tasks, (F.col("cell") % tasks).cast("int")).sortWithinPartitions("cell", "kind", "id")
    schema = struct("rid bigint, place int, id bigint, score bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, cell = None, [], None
        for number, kind, piece in _runs(batches):
            if number != now:
                if cell is not None:
                    yield cell.result(schema)
                now, parts, cell = number, [], None
            if kind == 0:
                parts.append(piece)
                continue
            if cell is None and parts:
                cell = Cell(parts, setting, keep)
            if cell is not None:
                cell.offer(piece)
        if cell is not None:
            yield cell.result(schema)

    found = dealt.mapInArrow(run, schema)
    best_first = Window.partitionBy("rid", "place").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= keep)


def hard_negatives(
    df: DataFrame, anchor: Column, row_id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `anchor` says which rows are anchors. An anchor's positives are its best other rows of the same label; for
    each positive the best rows of other labels are returned whose score is between `low` and `high` per cent
    of the positive's. Scores are inner products of floor(scale * x); higher ones come first, of equal ones the
    smaller id, null ids last. A row with another id is another row. Rows with a null label, a null vector or a
    null or non-finite component take no part; shorter vectors count as ending in zeros, rows repeated whole
    count once, and of different rows with one id each takes part. An anchor without positives, or a positive
    without rows in its window, gives no row; an empty table gives none. Ids and labels are whole numbers.
    Other columns are not looked at. Vectors so long that scores could leave 62 bits are an error.
    """
    usable = F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < math.inf)), F.lit(False))
    rows = written(
        df.select(F.col(row_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"),
                  F.coalesce(anchor, F.lit(False)).alias("anchor"))
        .where(F.col("label").isNotNull() & usable).distinct().withColumn("id", F.coalesce("id", F.lit(int(NO_ID)))), "vectors", slim=True, number="rid",
    )
    whole = F.transform("vector", lambda x: F.floor(x.cast("double") * scale).cast("double"))
    squared = F.aggregate(whole, F.lit(0.0), lambda total, x: total + x * x)
    n, n_anchors, longest, width = rows.agg(
        F.count("*"), F.count(F.when(F.col("anchor"), 1)), F.max(squared), F.max(F.size("vector"))).first()
    setting = {"scale": scale, "primes": primes_for(longest or 0.0), "width": width or 0, "low": low, "high": high}
    blocks = max(1, -(-n_anchors // ANCHORS))
    parts = max(-(-n // GROUP_ROWS), -(-2 * df.sparkSession.sparkContext.defaultParallelism // blocks), 1)
    rows, anchors = rows.drop("anchor"), rows.where("anchor").drop("anchor")
    near = written(_best(anchors.withColumn("windows", F.expr("CAST(NULL AS array<bigint>)")), rows, (blocks, parts), setting, positives),
                   "positives", slim=True)
    scores = near.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("windows"))
    far = _best(anchors.join(scores, "rid"), rows, (blocks, parts), setting, negatives)
    pairs = near.select("rid", (F.col("rank") - 1).alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["rid", "place"]).join(anchors.select("rid", F.col("id").alias("anchor_id")), "rid").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))

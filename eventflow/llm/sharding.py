"""Operator 4: a uniform shuffle into shards of exact size, by a hypergeometric communication matrix.

Rows are dealt to sources by a hash of their content and counted. How many rows of each source go to
each cell of each shard is then drawn exactly as a uniform permutation of all rows would have it: a
matrix whose row sums are the sources' counts and whose column sums are the cells' sizes. Each source
permutes its rows over the cells locally, the rows are exchanged once, and each cell is permuted again.
As all sizes are known beforehand, slots need no count afterwards.

The matrix is never stored: the sources are halved again and again, each half's share of every column
is drawn with a seed of its own, and a task follows the halves down to its source.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from eventflow.llm.common import arrow_batch, struct

#: Rows of a source and of a cell, about, until there are MOST of them; from then on they grow.
ROWS = 2048
#: Most sources, and most cells of all shards: it bounds the counts that every task gets.
MOST = 65_536
#: numpy draws from fewer things than this.
NUMPY_LIMIT = 1_000_000_000


def _large(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Hypergeometric draw by inversion around the mode, for numbers numpy does not take."""
    total = good + bad
    mean, spread = n * good / total, math.sqrt(n * good / total * bad / total * (total - n) / max(1, total - 1))
    first = max(0, n - bad, int(mean - 12 * spread) - 2)
    last = min(n, good, int(mean + 12 * spread) + 2)
    k = np.arange(first, last, dtype=float)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    chances = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(chances, rng.random() * chances[-1]))


def draw(rng: np.random.Generator, columns: np.ndarray, n: int) -> np.ndarray:
    """How many of n things drawn without replacement fall into each column."""
    total = int(columns.sum())
    if total < NUMPY_LIMIT:
        return rng.multivariate_hypergeometric(columns, n, method="marginals")
    if len(columns) == 1:
        return np.array([n], np.int64)
    half = len(columns) // 2
    good = int(columns[:half].sum())
    left = _large(rng, good, total - good, n)
    return np.concatenate([draw(rng, columns[:half], left), draw(rng, columns[half:], n - left)])


def matrix_row(source: int, before: np.ndarray, columns: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The columns a source sends rows to, and how many. `before`: rows of all earlier sources, and in the end all."""
    low, high, where = 0, len(before) - 1, np.arange(len(columns))
    while high - low > 1:
        middle = (low + high) // 2
        rng = np.random.default_rng([seed, low, high])
        left = draw(rng, columns, int(before[middle] - before[low]))
        if source < middle:
            columns, high = left, middle
        else:
            columns, low = columns - left, middle
        some = columns > 0
        columns, where = columns[some], where[some]
    return where, columns


def _parts(rows: int, parts: int) -> np.ndarray:
    """Sizes of parts at most one apart."""
    return rows // parts + (np.arange(parts) < rows % parts)


def shard(df: DataFrame, shards: int = 8, seed: int = 0, rows: int = ROWS) -> DataFrame:
    """df with `shard` (int) and `slot` (long, without gaps from 0 in each shard).

    Shards differ by one row at most, and every way to put the rows in the slots is as likely as any
    other. The same rows and seed give the same result whatever order they are read in; rows equal in
    every column are interchangeable. Nulls, empty and very long texts are values like any other. An
    empty table stays empty; input columns named shard or slot are replaced. Columns of type map cannot
    tell rows apart here.
    """
    df = df.drop(*[c for c in df.columns if c.lower() in ("shard", "slot")])
    kept = df.columns
    told = [F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.MapType)] or [F.lit(0)]

    def hashed(i: int) -> Column:
        return F.xxhash64(F.lit(seed).cast("long"), F.lit(i), *told)

    total = df.count()
    sources = max(1, min(MOST, math.ceil(total / rows)))
    source = F.pmod(hashed(0), F.lit(sources)).cast("int")
    counts = np.zeros(sources, np.int64)
    for r in df.groupBy(source.alias("source")).count().collect():  # MOST rows at most
        counts[r["source"]] = r["count"]
    cells = max(1, min(MOST // shards, math.ceil(total / rows / shards)))
    columns = np.concatenate([_parts(int(n), cells) for n in _parts(total, shards)])
    shared = df.sparkSession.sparkContext.broadcast((np.concatenate([[0], np.cumsum(counts)]), columns))

    schema = T.StructType([*df.schema.fields, *struct("__order bigint, __cell int").fields])

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, columns = shared.value
        at, targets = -1, np.zeros(0, np.int64)
        for batch in batches:
            own, cell = batch.column("__source").to_numpy(), np.empty(batch.num_rows, np.int64)
            bounds = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
            for first, last in zip(bounds, bounds[1:]):
                if last > first and own[first] != at:
                    at = int(own[first])
                    where, sent = matrix_row(at, before, columns, seed)
                    targets = np.random.default_rng([seed, at]).permutation(np.repeat(where, sent))
                cell[first:last], targets = targets[: last - first], targets[last - first :]
            yield arrow_batch({c: batch.column(c) for c in [*kept, "__order"]} | {"__cell": cell}, schema)

    dealt = (
        df.withColumns({"__source": source, "__order": hashed(1)})
        .repartition(sources, "__source").sortWithinPartitions("__source", "__order").mapInArrow(permute, schema)
    )
    in_shard, cell = F.expr(f"__cell DIV {cells}"), F.col("__cell") % cells
    size = F.lit(total // shards) + (in_shard < total % shards).cast("long")
    start = cell * F.floor(size / cells) + F.least(cell, size % cells)
    again = F.row_number().over(W.partitionBy("__cell").orderBy(F.xxhash64("__order", F.lit(seed), F.lit(2)), "__order"))
    return dealt.select(
        *[F.col(f"`{c}`") for c in kept], in_shard.cast("int").alias("shard"),
        (start + again - 1).cast("long").alias("slot"),
    )

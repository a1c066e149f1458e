"""The greedy pass over sorted times, in tasks: at most one time per interval passes, the next one when the
interval is over since the last that did.

What a stretch of times does to whoever comes into it is a function of the last time that passed before it:
the first time one interval after that one passes, and a chain from there ends at some last time. Only times
of the stretch's first interval (and the one behind it) can be that entry, and neighbouring entries mostly end
alike, so the function is a short list of steps. `summaries` gives that list per stretch, `carries` runs
through a key's lists in their order, and `passing` scans each stretch from what it is given.

Rows come sorted, a task holds one block of them at a time, and all of it is linear in the rows. The module
imports nothing of this package and is shipped by value.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Times that are summed up at once.
CHUNK = 1 << 20


def steps(times: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(tops, exits) for sorted different times: who may pass from some time on, up to tops[i], ends at exits[i]."""
    n = len(times)
    after = np.searchsorted(times, times + width)
    jump = np.where(after < n, after, np.arange(n))
    while True:
        further = jump[jump]
        if np.array_equal(further, jump):
            break
        jump = further
    entries = min(n, int(np.searchsorted(times, times[0] + width)) + 1)
    exits = times[jump[:entries]]
    ends = np.append(exits[1:] != exits[:-1], True)
    return times[:entries][ends], exits[ends]


def entered(last: int | None, tops, exits, width: int) -> int | None:
    """The last time that passed behind a stretch with these steps."""
    if last is None:
        return int(exits[0])
    at = int(np.searchsorted(tops, last + width))
    return int(exits[at]) if at < len(tops) else last


def chain(times: np.ndarray, last: int | None, width: int) -> tuple[list[int], int | None]:
    """The times that pass, and the last one."""
    passed, at = [], 0 if last is None else int(np.searchsorted(times, last + width))
    while at < len(times):
        last = int(times[at])
        passed.append(last)
        at = int(np.searchsorted(times, last + width))
    return passed, last


def runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """Pieces of batches within which the named columns stay the same; whether one starts a new run. Null equals null."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        differs = np.zeros(batch.num_rows - 1, bool)
        for column in map(batch.column, names):
            a, b = column[1:], column[:-1]
            unequal = pc.fill_null(pc.not_equal(a, b), False)
            differs |= np.asarray(pc.or_(unequal, pc.xor(pc.is_null(a), pc.is_null(b))))
        borders = [0, *(np.flatnonzero(differs) + 1).tolist(), batch.num_rows]
        for start, stop in zip(borders, borders[1:]):
            piece = batch.slice(start, stop - start)
            now = tuple(piece.column(c)[0].as_py() for c in names)
            yield now != before or before is None, piece
            before = now


def summaries(key: str, width: int, schema: pa.Schema, chunk: int = CHUNK):
    """Over rows (key, slot, t) sorted by all three: (key, slot, chunk, tops, exits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first, number, out = [], None, 0, []

        def close():
            times = np.concatenate(held)
            tops, exits = steps(times[np.append(True, times[1:] != times[:-1])], width)
            out.append((first.column(key)[0], first.column("slot")[0].as_py(), number, tops, exits))

        for new, piece in runs(batches, [key, "slot"]):
            if held and (new or sum(map(len, held)) >= chunk):
                close()
                held, number = [], 0 if new else number + 1
            if not held:
                first = piece.slice(0, 1)
            held.append(piece.column("t").to_numpy())
            if len(out) >= 1000:
                yield _rows(out, schema)
                out = []
        if held:
            close()
        if out:
            yield _rows(out, schema)

    return run


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) if i else pa.array([x.as_py() for x, *_ in rows], f.type)
                                       for i, f in enumerate(schema)], schema=schema)


def carries(key: str, width: int, schema: pa.Schema):
    """Over a key's summaries in their order: (key, slot, t), the last time that passed before each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for new, piece in runs(batches, [key]):
            if new:
                last = None
            out = []
            for slot, number, tops, exits in zip(*(piece.column(c) for c in ("slot", "chunk", "tops", "exits"))):
                if last is not None and number.as_py() == 0:
                    out.append((piece.column(key)[0], slot.as_py(), last))
                last = entered(last, tops.values.to_numpy(), exits.values.to_numpy(), width)
            if out:
                yield _rows(out, schema)

    return run


def passing(key: str, width: int, schema: pa.Schema):
    """Over rows (key, slot, kind, t) sorted by all four, kind 0 for what is carried into a slot: the times that pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, False
        for new, piece in runs(batches, [key, "slot", "kind"]):
            if piece.column("kind")[0].as_py() == 0:
                last, carried = piece.column("t")[0].as_py(), True
                continue
            if new and not carried:
                last = None
            carried = False
            passed, last = chain(piece.column("t").to_numpy(), last, width)
            if passed:
                yield _rows([(piece.column(key)[0], t) for t in passed], schema)

    return run

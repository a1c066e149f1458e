"""State transitions of the keyed processors, the only Python that runs in streaming tasks of this package.

The module imports nothing of this package and is shipped by value, so the workers need no copy.

The greedy rate limit has two levels. The alerts of a key wait in blocks of an eighth of the interval, each
block a state of its own that is only ever appended to; when the watermark has passed a block it is read once
and handed on. Behind that, a key is one number, the last alert let through, which is forgotten once nothing
can arrive that it bears on. So a key with very many alerts is spread over its blocks, each alert is touched
twice, and answers come up to a block later than the watermark would allow them.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Times handed on in one row.
TOGETHER = 65_536
#: Earlier than any event, in microseconds.
BEFORE = np.iinfo(np.int64).min
#: What is kept of a bucket of traces.
TRACES = pa.schema([("traceid", pa.string()), ("bits", pa.int64()), ("last", pa.int64()), ("closed", pa.bool_())])


class BlockTimes(StatefulProcessor):
    """The alert times of one block of one key, handed on in order when the watermark has passed the block."""

    def __init__(self, block_us: int) -> None:
        self.block_us = block_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.times = handle.getListState("times", "us LONG")
        self.armed = handle.getValueState("armed", "ms LONG")

    def handleInputRows(self, key, rows, timerValues):
        for frame in rows:
            self.times.appendList([(int(us),) for us in frame["us"].unique()])
        if not self.armed.exists():
            end = (int(key[1]) + 1) * self.block_us // 1000 + 1
            self.handle.registerTimer(end)
            self.armed.update((end,))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        times = np.unique(np.fromiter((row[0] for row in self.times.get()), np.int64))
        self.times.clear()
        self.armed.clear()
        at = pd.Timestamp(timerValues.getCurrentWatermarkInMs(), unit="ms")
        parts = [times[i : i + TOGETHER] for i in range(0, len(times), TOGETHER)]
        yield pd.DataFrame({"key": [key[0]] * len(parts), "times": parts, "at": [at] * len(parts)})

    def close(self) -> None:
        pass


class GreedyChain(StatefulProcessor):
    """The last alert of a key that was let through. Its blocks arrive in their order."""

    def __init__(self, width_us: int, block_us: int) -> None:
        self.width_us, self.block_us = width_us, block_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us LONG")
        self.armed = handle.getValueState("armed", "ms LONG")

    def _forget_at(self, last: int) -> int:
        """When all blocks that this alert bears on have been handed on."""
        return (last + self.width_us + self.block_us) // 1000 + 2

    def handleInputRows(self, key, rows, timerValues):
        last = self.last.get()[0] if self.last.exists() else None
        passed = []
        for times in sorted((t for frame in rows for t in frame["times"]), key=lambda t: t[0]):
            at = 0 if last is None else int(np.searchsorted(times, last + self.width_us))
            while at < len(times):
                last = int(times[at])
                passed.append(last)
                at = int(np.searchsorted(times, last + self.width_us))
        if passed:
            self.last.update((last,))
            if not self.armed.exists():
                self.handle.registerTimer(self._forget_at(last))
                self.armed.update((self._forget_at(last),))
            yield pd.DataFrame({"key": [key[0]] * len(passed), "us": passed})
        else:
            yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        forget = self._forget_at(self.last.get()[0])
        if forget <= timerValues.getCurrentWatermarkInMs():
            self.last.clear()
            self.armed.clear()
        else:  # another one was let through meanwhile
            self.handle.registerTimer(forget)
            self.armed.update((forget,))
        yield pd.DataFrame()

    def close(self) -> None:
        pass


class PreviousMean(StatefulProcessor):
    """Mean score of a topic's last closed window. Windows reach it in the order of their ends."""

    def __init__(self, delta: float) -> None:
        self.delta = delta

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "mean DOUBLE")

    def handleInputRows(self, key, rows, timerValues):
        closed = pd.concat(list(rows)).sort_values("window_start")
        before = self.last.get()[0] if self.last.exists() else float("nan")
        closed["previous_mean"] = closed["mean_score"].shift(1, fill_value=before)
        self.last.update((float(closed["mean_score"].iloc[-1]),))
        moved = closed[(closed["mean_score"] - closed["previous_mean"]).abs() > self.delta]
        yield moved[["topic", "window_start", "posts", "mean_score", "previous_mean"]]

    def close(self) -> None:
        pass


def _numbered(ids: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of each id among the distinct ones, and these in the order they first appear in."""
    coded = ids.dictionary_encode(null_encoding="encode")
    return coded.indices.to_numpy(), coded.dictionary


def _fold(at: np.ndarray, us: np.ndarray, bits: np.ndarray, last: np.ndarray, seen: np.ndarray) -> None:
    """Add events to the latest times and bits of the traces they are of."""
    np.maximum.at(last, at, us)
    np.bitwise_or.at(seen, at, bits)


def combined(batches):
    """Rows (traceid, us, bits) of each batch as one per trace: the latest time, all bits. Before any exchange, so
    that many events of one trace are few rows."""
    for batch in batches:
        if batch.num_rows:
            at, ids = _numbered(batch.column("traceid"))
            last, seen = np.full(len(ids), BEFORE), np.zeros(len(ids), np.int64)
            _fold(at, batch.column("us").to_numpy(), batch.column("bits").to_numpy(), last, seen)
            yield pa.RecordBatch.from_arrays([ids, pa.array(last), pa.array(seen)], ["traceid", "us", "bits"])


class TraceEnd(StatefulProcessor):
    """One row per trace, when it has ended: its bits, and the state the first matching rule gives them.

    A trace has ended `settle` after its last event if its state is final, else `idle` after it. Its number then
    stays for `remember`, so that a latecomer is no new trace, and is forgotten for good.

    The key is a bucket of traces, which are kept as one Arrow table and worked on together: a call of the state
    and of the timers is far dearer than the work on a trace. A bucket has one timer, at or before its first trace's.
    """

    def __init__(self, rules: list, settle_ms: int, idle_ms: int, remember_ms: int) -> None:
        self.rules, self.settle_ms, self.idle_ms, self.remember_ms = rules, settle_ms, idle_ms, remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bucket = handle.getValueState("bucket", "traces BINARY, alarm LONG")

    def rule(self, bits: int) -> tuple[str, bool]:
        return next((name, ended) for name, needed, against, ended in self.rules if bits & needed == needed and not bits & against)

    def ruled(self, bits: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """State of each trace, whether that is final, and when the trace has ended if nothing more comes."""
        distinct, at = np.unique(bits, return_inverse=True)
        found = [self.rule(b) for b in distinct.tolist()]
        names, final = np.array([n for n, _ in found], object)[at], np.array([e for _, e in found], bool)[at]
        return names, final, last // 1000 + np.where(final, self.settle_ms, self.idle_ms) + 1

    def traces(self) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, int | None]:
        kept = self.bucket.get()
        if kept is None:
            return pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), None
        table = pa.ipc.read_record_batch(pa.py_buffer(bytes(kept[0])), TRACES)
        return table["traceid"], *[table[c].to_numpy(zero_copy_only=False) for c in ("bits", "last", "closed")], kept[1]

    def keep(self, ids: pa.Array, bits: np.ndarray, last: np.ndarray, closed: np.ndarray, alarm: int | None) -> None:
        due = self.ruled(bits, last)[2] + np.where(closed, self.remember_ms, 0)
        first = int(due.min())
        if alarm is None or first < alarm:
            if alarm is not None:
                self.handle.deleteTimer(alarm)
            self.handle.registerTimer(first)
            alarm = first
        table = pa.RecordBatch.from_arrays([ids, pa.array(bits), pa.array(last), pa.array(closed)], schema=TRACES)
        self.bucket.update((table.serialize().to_pybytes(), alarm))

    def handleInputRows(self, key, rows, timerValues):
        said = [frame[frame["traceid"].notna()] for frame in rows]
        if any(len(frame) for frame in said):
            ids, bits, last, closed, alarm = self.traces()
            known = len(ids)
            at, ids = _numbered(pa.concat_arrays([ids, *[pa.array(frame["traceid"], pa.string()) for frame in said]]))
            at, new = at[known:], len(ids) - known
            bits, last = np.append(bits, np.zeros(new, np.int64)), np.append(last, np.full(new, BEFORE))
            closed = np.append(closed, np.zeros(new, bool))
            us, seen = (np.concatenate([frame[c].to_numpy(np.int64) for frame in said]) for c in ("us", "bits"))
            late = closed[at]  # their trace was answered
            _fold(at[~late], us[~late], seen[~late], last, bits)
            self.keep(ids, bits, last, closed, alarm)
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        ids, bits, last, closed, _ = self.traces()
        names, final, due = self.ruled(bits, last)
        out = ~closed & (due <= now)
        closed = closed | out
        stays = ~closed | (due + self.remember_ms > now)
        if stays.any():
            self.keep(ids.filter(pa.array(stays)), bits[stays], last[stays], closed[stays], None)
        else:
            self.bucket.clear()
        yield pd.DataFrame() if not out.any() else pd.DataFrame({
            "traceid": ids.filter(pa.array(out)).to_pandas(), "state": names[out], "us": last[out],
            "ended": np.where(final[out], "settled", "idle").astype(object)})

    def close(self) -> None:
        pass

"""Operator 9: secret scans by grammar inference.

Fixed patterns find the usual credentials. What they find is a labelled set from which the formats are
learned: the values of each kind become a prefix tree whose statistically compatible states are merged,
until a probabilistic automaton is left. Every other run of credential characters is then scored by its
likelihood under these automata against that under a chain learned from all ordinary runs, which adds
values of the same make that stand where no pattern looks.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from eventflow.llm.common import append_columns, arrow_batch, struct, written

# The kinds in their order, their patterns, the group whose length counts, and its least length.
KINDS = ("assign", "access", "hex")
LEARNED = "format"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
PATTERNS = {
    "assign": (ASSIGN, 2, 12),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 18),
    "hex": (re.compile(r"[0-9a-f]{16,}"), 0, 16),  # greedy, so a match is a whole run of 16 or more
}
#: Runs that are scored. Shorter ones say too little.
RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Character classes the automata read; characters of a class count as equally likely.
CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", *"+/_.=-")
CLASS = {c: i for i, chars in enumerate(CLASSES) for c in chars}
UNIFORM = [-math.log(len(chars)) for chars in CLASSES]
END = len(CLASSES)
#: Numbers of the characters of runs, from one on, and of all other bytes.
WIDTH = len(CLASS) + 1
CODE = np.zeros(256, np.int64)
CODE[[ord(c) for c in CLASS]] = np.arange(1, WIDTH)
#: Distinct labelled values of a kind that the formats are learned from.
EXAMPLES = 600
#: Longer labelled values are learned in pieces of at most this length.
LONGEST = 256
#: Characters of a run, of what a fixed pattern leaves of one, and of a stretch that scores by itself, at least.
SHORTEST = 16
#: Confidence of the test that two states differ.
ALPHA = 0.05
#: Likelihood of what an automaton has never seen.
UNSEEN = math.log(1e-5)
#: An added value is this much likelier (in logarithms) as a credential, and than nearly all ordinary runs.
MARGIN = 12.0
QUANTILE = 0.999
#: Bins of the scores above the margin, for each doubling.
BINS = 64


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, stop, kind) of the fixed patterns' matches, stop exclusive, in code points.

    A span is the whole match, so that of an assignment covers its name as well as its value.
    """
    out = []
    for kind, (pattern, group, least) in PATTERNS.items():
        out += [(m.start(), m.end(), kind) for m in pattern.finditer(text) if m.end(group) - m.start(group) >= least]
    return out


def values(text: str) -> Iterator[tuple[str, str]]:
    """(kind, value) of all labelled credentials, and ("", run) of the other runs."""
    taken = []
    for kind, (pattern, group, least) in PATTERNS.items():
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                taken.append(m.span())
                yield kind, m[group]
    for start, stop in free_runs(text, taken):
        yield "", text[start:stop]


def free_runs(text: str, taken: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """(start, stop) of what the taken ranges leave of each run, in one sweep over both."""
    held: list[list[int]] = []
    for a, b in sorted(taken):
        if held and a <= held[-1][1]:
            held[-1][1] = max(held[-1][1], b)
        else:
            held.append([a, b])
    i = 0
    for m in RUN.finditer(text):
        at, stop = m.span()
        while i < len(held) and held[i][1] <= at:
            i += 1
        while i < len(held) and held[i][0] < stop:
            if held[i][0] - at >= SHORTEST:
                yield at, held[i][0]
            at = max(at, held[i][1])
            if held[i][1] > stop:
                break
            i += 1
        if stop - at >= SHORTEST:
            yield at, stop


def pieces(value: str) -> list[str]:
    """The whole value in pieces of about equal length."""
    n = math.ceil(len(value) / LONGEST)
    return [value[len(value) * i // n : len(value) * (i + 1) // n] for i in range(n)]


def symbols(value: str) -> list[int]:
    return [CLASS[c] for c in value]


def cells(runs: list[str]) -> np.ndarray:
    """The cell of each character of the runs: it and the two before it, which a run does not have at its start."""
    code = CODE[np.frombuffer("\n\n".join(["", *runs]).encode(), np.uint8)]
    return ((code[:-2] * WIDTH + code[1:-1]) * WIDTH + code[2:])[code[2:] > 0]


# --- probabilistic automata -----------------------------------------------------------------

class Automaton:
    """A probabilistic automaton inferred from words over CLASSES by merging states of their prefix tree."""

    def __init__(self, words: Iterable[list[int]]):
        self.passed, self.ended = [0], [0]
        self.next: list[dict[int, int]] = [{}]
        self.count: list[dict[int, int]] = [{}]
        for word in words:
            state = 0
            for symbol in word:
                self.passed[state] += 1
                self.count[state][symbol] = self.count[state].get(symbol, 0) + 1
                if symbol not in self.next[state]:
                    self.next[state][symbol] = len(self.next)
                    self.passed.append(0), self.ended.append(0), self.next.append({}), self.count.append({})
                state = self.next[state][symbol]
            self.passed[state] += 1
            self.ended[state] += 1
        self._merge()
        self._settle()

    def _alike(self, a: int, b: int) -> bool:
        """No difference in how the two states end or go on, here or further down, beyond chance."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.passed[a], self.passed[b]
            if not n or not m:
                continue
            bound = math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if bound >= 1:
                continue
            if abs(self.ended[a] / n - self.ended[b] / m) > bound:
                return False
            for symbol in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a].get(symbol, 0) / n - self.count[b].get(symbol, 0) / m) > bound:
                    return False
                if symbol in self.next[a] and symbol in self.next[b]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the automaton at a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.passed[a] += self.passed[b]
            self.ended[a] += self.ended[b]
            for symbol, n in self.count[b].items():
                self.count[a][symbol] = self.count[a].get(symbol, 0) + n
                if symbol in self.next[a]:
                    todo.append((self.next[a][symbol], self.next[b][symbol]))
                else:
                    self.next[a][symbol] = self.next[b][symbol]

    def _merge(self) -> None:
        kept = [0]
        settled = {0}
        while True:
            front = [(self.passed[t], -t, s, x) for s in kept for x, t in self.next[s].items() if t not in settled]
            if not front:
                break
            _, _, source, symbol = max(front)
            state = self.next[source][symbol]
            for other in kept:
                if self._alike(other, state):
                    self.next[source][symbol] = other
                    self._fold(other, state)
                    break
            else:
                kept.append(state)
                settled.add(state)
        self.kept = kept

    def _settle(self) -> None:
        """Only the kept states, with logarithms of likelihoods."""
        place = {s: i for i, s in enumerate(self.kept)}
        self.move = [{x: place[t] for x, t in self.next[s].items()} for s in self.kept]
        self.log = []
        for s in self.kept:
            n = self.passed[s] + 1
            self.log.append({x: math.log(k / n) for x, k in self.count[s].items()} | {END: math.log((self.ended[s] + 0.01) / n)})
        del self.passed, self.ended, self.next, self.count, self.kept

    def likelihood(self, word: list[int]) -> float:
        """Logarithm of the word's likelihood, characters within their classes included."""
        state, total = 0, 0.0
        for symbol in word:
            total += self.log[state].get(symbol, UNSEEN) + UNIFORM[symbol]
            state = self.move[state].get(symbol, 0)
        return total + self.log[state][END]

    def stretches(self, word: list[int], usual: list[float], least: float) -> Iterator[tuple[float, int, int]]:
        """(score, start, stop) of disjoint stretches whose likelihood is above `usual` by more than `least`.

        One pass: a stretch starts anew with a character that is worth more as a first one than behind what came
        before, and ends at its best once it lost MARGIN.
        """
        start = at = state = 0
        gain, best, stop = 0.0, -math.inf, 0
        first = self.log[0]
        while at < len(word):
            symbol = word[at]
            step = UNIFORM[symbol] - usual[at]
            on, fresh = gain + self.log[state].get(symbol, UNSEEN), first.get(symbol, UNSEEN)
            if on < fresh:
                if best > least:
                    yield best, start, stop
                    if stop < at:  # what came behind its end may be part of another
                        start = at = stop
                        state, gain, best = 0, 0.0, -math.inf
                        continue
                start, on, state, best = at, fresh, 0, -math.inf
            gain = on + step
            state = self.move[state].get(symbol, 0)
            at += 1
            whole = gain + self.log[state][END]
            if at - start >= SHORTEST and whole > best:
                best, stop = whole, at
            if at == len(word) or gain < best - MARGIN:
                if best > least:
                    yield best, start, stop
                    at = stop
                start, state, gain, best = at, 0, 0.0, -math.inf


class Chain:
    """Second-order chain over single characters of ordinary runs, from the counts of its cells."""

    def __init__(self, counts: np.ndarray):
        n = counts.reshape(-1, WIDTH)[:, 1:]
        self.log = np.zeros((len(n), WIDTH))
        self.log[:, 1:] = np.log((n + 0.5) / (n.sum(1, keepdims=True) + 0.5 * len(CLASS)))
        self.log = self.log.reshape(-1)

    def steps(self, run: str) -> list[float]:
        """Logarithms of the likelihoods of the run's characters."""
        return self.log[cells([run])].tolist()


class Formats:
    """The learned formats and the score from which a run counts as a credential."""

    def __init__(self, examples: dict[str, list[str]], chain: Chain, least: float = MARGIN):
        self.automata = {k: Automaton(sorted(map(symbols, v))) for k, v in sorted(examples.items()) if v}
        self.chain = chain
        self.least = least
        logs = [state for a in self.automata.values() for state in a.log]
        self.likeliest = [max((s.get(c, UNSEEN) for s in logs), default=UNSEEN) + UNIFORM[c] for c in range(END)]

    def _bound(self, word: list[int], usual: list[float]) -> float:
        """No stretch of the run scores more: its characters where they are likeliest, the best sum of neighbours."""
        best = gain = 0.0
        likeliest = self.likeliest
        for symbol, common in zip(word, usual):
            gain += likeliest[symbol] - common
            if gain < 0.0:
                gain = 0.0
            elif gain > best:
                best = gain
        return best

    def score(self, run: str) -> float:
        """How much likelier the run, or a stretch of it, is as a credential of the best fitting kind than as an
        ordinary run; what is no more than MARGIN is not told apart."""
        return max((score for score, _, _ in self.stretches(run, MARGIN)), default=-math.inf)

    def stretches(self, run: str, least: float) -> list[tuple[float, int, int]]:
        """(score, start, stop) of the disjoint stretches that score more than `least`, or of the whole run if it
        does and is hardly worse than its best stretch."""
        if not self.automata:
            return []
        word, usual = symbols(run), self.chain.steps(run)
        if self._bound(word, usual) <= least:
            return []
        whole = max(a.likelihood(word) for a in self.automata.values()) - sum(usual)
        some = [x for a in self.automata.values() for x in a.stretches(word, usual, least)]
        if whole > least and whole > max((x[0] for x in some), default=whole) - MARGIN:
            return [(whole, 0, len(run))]
        kept: list[tuple[float, int, int]] = []
        for score, start, stop in sorted(some, reverse=True):
            at = bisect.bisect(kept, start, key=lambda x: x[1])
            if (not at or kept[at - 1][2] <= start) and (at == len(kept) or stop <= kept[at][1]):
                kept.insert(at, (score, start, stop))
        return kept

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        found = base_spans(text)
        taken = [(a, b) for a, b, _ in found]
        for a, b in free_runs(text, taken):
            found += [(a + start, a + stop, LEARNED) for _, start, stop in self.stretches(text[a:b], self.least)]
        order = {kind: i for i, kind in enumerate((*KINDS, LEARNED))}
        return sorted(found, key=lambda s: (s[0], order[s[2]], s[1]))


def learn(df: DataFrame, text: str = "text", examples: int = EXAMPLES, ordinary: int | None = None) -> Formats:
    """The formats of a corpus, from `examples` distinct credentials of each kind and all other runs.

    The values with the smallest hashes over all rows are taken, whatever the order of the rows: each task
    keeps no more than it could contribute. The chain and the score that nearly no ordinary run exceeds
    are those of all ordinary runs, as often as they occur; `ordinary` is accepted and has no effect. Null
    and empty texts contribute nothing, and neither does an empty table, whose formats add no spans.
    """
    schema = struct("kind string, hash string, value string, cell int, n bigint")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, list] = {k: [] for k in KINDS}
        known: dict[str, set] = {k: set() for k in KINDS}
        counts = np.zeros(WIDTH**3, np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                runs = []
                for kind, whole in values(t or ""):
                    if not kind:
                        runs.append(whole)
                        continue
                    for value in pieces(whole):
                        if value in known[kind]:
                            continue
                        rank = int(hashlib.md5(value.encode()).hexdigest(), 16)
                        if len(kept[kind]) < examples:
                            heapq.heappush(kept[kind], (-rank, value))
                        elif -rank > kept[kind][0][0]:
                            known[kind].discard(heapq.heapreplace(kept[kind], (-rank, value))[1])
                        else:
                            continue
                        known[kind].add(value)
                if runs:
                    np.add.at(counts, cells(runs), 1)
        rows = [(kind, f"{-rank:032x}", value, None, None) for kind, heap in kept.items() for rank, value in heap]
        if rows:
            yield arrow_batch(dict(zip(schema.names, map(list, zip(*rows)))), schema)
        some = np.flatnonzero(counts)
        none = pa.nulls(len(some), pa.string())
        yield arrow_batch({"kind": none, "hash": none, "value": none, "cell": some, "n": counts[some]}, schema)

    # as a table: taking each kind's values must not scan the texts again
    found = written(df.select(text).mapInArrow(gather, schema), "values", slim=True)
    taken = _take(found.where(F.col("kind").isNotNull()).select("kind", "hash", "value").distinct(), examples)
    counts = np.zeros(WIDTH**3, np.int64)  # a row for each cell at most
    sums = found.where(F.col("cell").isNotNull()).groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    counts[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
    formats = Formats(taken, Chain(counts))
    if formats.automata:
        formats.least = _usual(df, formats, text)
    return formats


def _usual(df: DataFrame, formats: Formats, text: str) -> float:
    """The score that all but a share of 1 - QUANTILE of the ordinary runs stay within, MARGIN at least.

    From a histogram of the scores of all ordinary runs, in bins about a hundredth wide; the first holds
    what is no more than the margin.
    """
    shared = df.sparkSession.sparkContext.broadcast(formats)
    schema = struct("bin int, n bigint")

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, bins = shared.value, Counter()
        for batch in batches:
            for t in batch.column(0).to_pylist():
                for kind, run in values(t or ""):
                    if not kind:
                        score = model.score(run)
                        bins[math.ceil(BINS * math.log2(score / MARGIN)) if score > MARGIN else 0] += 1
        yield arrow_batch({"bin": list(bins), "n": list(bins.values())}, schema)

    bins = df.select(text).mapInArrow(rank, schema).groupBy("bin").agg(F.sum("n").alias("n")).collect()
    at = int(QUANTILE * sum(r.n for r in bins))
    for r in sorted(bins):
        at -= r.n
        if at < 0:
            return MARGIN * 2 ** (r.bin / BINS)
    return MARGIN


def _take(found: DataFrame, limit: int) -> dict[str, list[str]]:
    parts = [found.where(F.col("kind") == kind).orderBy("hash").limit(limit) for kind in KINDS]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    out: dict[str, list[str]] = {kind: [] for kind in KINDS}
    for r in whole.collect():
        out[r.kind].append(r.value)
    return out


def cleaned(text: str, found: list[tuple[int, int, str]], mark: str) -> str:
    """The text with each span replaced by the mark; overlapping spans become one."""
    out, at = [], 0
    for start, stop, _ in sorted(found):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, stop)
    return "".join([*out, text[at:]])


def scan(df: DataFrame, formats: Formats, text: str = "text", spans: str = "spans", mark: str | None = None) -> DataFrame:
    """df with all secrets of the whole text: an array of (start, stop, kind), stop exclusive, in code points.

    Sorted by start, then kind as listed. Kinds are those of the fixed patterns, and "format" for what the
    learned formats add; the latter never overlap the former. With a `mark` the text comes back with every
    span replaced by it. Null and empty texts have no secrets and stay as they are. Repeated rows stay,
    empty tables stay empty, and an input column named as the spans is replaced.
    """
    shared = df.sparkSession.sparkContext.broadcast(formats)

    def start():
        model = shared.value

        def work(batch):
            texts = batch.column(text).to_pylist()
            found = [model.spans(t or "") for t in texts]
            out = {spans: [[{"start": a, "stop": b, "kind": k} for a, b, k in s] for s in found]}
            if mark is not None:
                out[text] = [cleaned(t, s, mark) if s else t for t, s in zip(texts, found)]
            return out

        return work

    kind = f"`{spans}` array<struct<start: bigint, stop: bigint, kind: string>>"
    if mark is None:
        return append_columns(df, start, kind)
    kept = [c for c in df.columns if c.lower() != spans.lower()]
    return append_columns(df, start, f"{kind}, `{text}` string").select(*[f"`{c}`" for c in kept], f"`{spans}`")


def listing(spans: str | Column, kinds: tuple[str, ...] = (*KINDS, LEARNED)) -> Column:
    """The spans of these kinds as text: kind:start:stop, comma-joined in their order."""
    kept = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def count(spans: str | Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

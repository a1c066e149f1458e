"""Operator 10: document fingerprints as Merkle trees over paragraphs and sections.

A text is cut into paragraphs (lines, and long lines at the ends of their phrases), runs of paragraphs
into sections (where the content itself says so, so that an edit moves no later border), and sections
into the document. Every node's hash is made of its children's: equal roots mean equal texts,
and where roots differ, only branches that differ are followed to find the edits.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from eventflow.llm.common import append_columns, arrow_batch, slices, struct, text_or_empty

#: Lines of more characters are cut at punctuation, and what has none in PIECE characters without regard to it.
LINE = 40
PIECE = 64
#: A section ends behind a paragraph whose hash falls into one of this many classes.
PARAGRAPH_CLASSES = 8
#: Documents of one bucket of the order by id, about.
BUCKET_ROWS = 4096
MOST_BUCKETS = 16_384
PHRASE = re.compile(r"[^.!?,;:|]{1,%d}[.!?,;:|]*\s*|[.!?,;:|]+\s*" % PIECE)


def paragraphs(text: str) -> list[str]:
    """The text in pieces that joined give it back."""
    out = []
    for line in text.splitlines(keepends=True):
        if len(line) <= LINE:
            out.append(line)
        else:
            out += PHRASE.findall(line)
    return out


class Tree:
    """root, sections [(hash, [(paragraph hash, length)])]; hashes are 32-bit numbers, the root is of SHA-256."""

    def __init__(self, text: str):
        self.sections: list[tuple[int, list[tuple[int, int]]]] = []
        section: list[tuple[int, int]] = []
        for p in paragraphs(text):
            leaf = xxhash.xxh32_intdigest(p.encode())
            section.append((leaf, len(p)))
            if leaf % PARAGRAPH_CLASSES == 0:
                self._close(section)
                section = []
        if section:
            self._close(section)
        whole = b"".join(h.to_bytes(4, "big") for h, _ in self.sections)
        self.root = hashlib.sha256(whole + hashlib.sha256(text.encode()).digest()).hexdigest()[:32]

    def _close(self, section: list[tuple[int, int]]) -> None:
        node = xxhash.xxh32_intdigest(b"".join(h.to_bytes(4, "big") for h, _ in section))
        self.sections.append((node, section))

    def __str__(self) -> str:
        """root, then each section as hash=paragraph:length+paragraph:length, all hashes in hex."""
        nodes = ("%08x=%s" % (h, "+".join("%08x:%d" % leaf for leaf in leaves)) for h, leaves in self.sections)
        return " ".join([self.root, *nodes])

    @classmethod
    def parse(cls, fingerprint: str) -> Tree:
        tree = cls.__new__(cls)
        tree.root, *nodes = fingerprint.split(" ")
        tree.sections = []
        for node in nodes:
            name, _, leaves = node.partition("=")
            pairs = (leaf.split(":") for leaf in leaves.split("+"))
            tree.sections.append((int(name, 16), [(int(h, 16), int(n)) for h, n in pairs]))
        return tree


def _unmatched(a: Tree, b: Tree) -> tuple[Counter, Counter]:
    """Paragraphs with their lengths in sections that only one side has: equal branches are not entered."""
    left, right = Counter(h for h, _ in a.sections), Counter(h for h, _ in b.sections)
    sides = []
    for tree, surplus in ((a, left - right), (b, right - left)):
        leaves: Counter = Counter()
        for name, section in tree.sections:
            if surplus[name]:
                surplus[name] -= 1
                leaves.update(section)
        sides.append(leaves)
    return sides[0], sides[1]


def likeness(a: Tree, b: Tree) -> float:
    """Characters in paragraphs that both have, of all characters of the larger text: 1 for equal texts."""
    if a.root == b.root:
        return 1.0
    size = max(sum(n for _, s in tree.sections for _, n in s) for tree in (a, b))
    left, right = _unmatched(a, b)
    lost = max(sum(n * k for (_, n), k in x.items()) for x in (left - right, right - left))
    return max(0.0, min(1 - 1e-9, 1 - lost / size)) if size else 0.0


def edits(a: Tree, b: Tree) -> list[tuple[int, int]]:
    """Character ranges of `a` whose paragraphs `b` does not have, neighbours joined."""
    if a.root == b.root:
        return []
    left, right = _unmatched(a, b)
    missing, out, at = left - right, [], 0
    for _, section in a.sections:
        for leaf in section:
            if missing[leaf] > 0:
                missing[leaf] -= 1
                if out and out[-1][1] == at:
                    out[-1] = (out[-1][0], at + leaf[1])
                else:
                    out.append((at, at + leaf[1]))
            at += leaf[1]
    return out


def fingerprint(df: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """df with the Merkle tree of the whole text as a string that starts with its root.

    Null and empty texts have the tree without sections. Equal texts have equal fingerprints, other texts
    other roots. Texts of any length are covered whole; repeated rows stay, empty tables stay empty, and an
    input column of that name is replaced.
    """

    def start():
        return lambda batch: {name: [str(Tree(t or "")) for t in batch.column(text).to_pylist()]}

    return append_columns(df, start, f"`{name}` string")


def compare(df: DataFrame, a: str, b: str, name: str = "likeness", where: str = "edits") -> DataFrame:
    """df with the likeness (0 to 1) of two fingerprint columns, and the ranges of `a` that differ from `b`.

    A null fingerprint is like nothing: null likeness, no ranges.
    """

    def start():
        def one(x, y):
            return (None, []) if x is None or y is None else (likeness(s := Tree.parse(x), t := Tree.parse(y)), edits(s, t))

        def work(batch):
            found = [one(x, y) for x, y in zip(batch.column(a).to_pylist(), batch.column(b).to_pylist())]
            return {name: [f[0] for f in found],
                    where: [[{"start": s, "stop": e} for s, e in f[1]] for f in found]}

        return work

    return append_columns(df, start, f"`{name}` double, `{where}` array<struct<start: bigint, stop: bigint>>")


def with_neighbour(df: DataFrame, doc_id: str, rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """The rows in buckets by descending id, each bucket also with the first row of the one after it.

    Columns: bucket, extra (true for that first row), and df's. The last bucket is followed by the first.
    Borders come from approximate quantiles of the ids, so there are at most MOST_BUCKETS of them; only
    the borders' ids and the buckets' first ids reach the driver.
    """
    total = df.count()
    parts = max(1, min(MOST_BUCKETS, -(-total // rows)))
    borders = sorted(set(df.approxQuantile(doc_id, [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    borders = [int(x) for x in borders]
    key = F.col(doc_id)
    bucket = (F.lit(len(borders)) - _position(borders, key)).cast("int")
    firsts = {r.bucket: r.first for r in df.groupBy(bucket.alias("bucket")).agg(F.max(key).alias("first")).collect()}
    held = sorted(firsts)
    pairs = [(firsts[b], held[i - 1]) for i, b in enumerate(held)]
    heads = df.sparkSession.createDataFrame(pairs, "__first bigint, __to int")
    copies = df.join(F.broadcast(heads), key.eqNullSafe(F.col("__first"))).drop("__first")
    # rows that share the first id all go along; the first of them in the order is the one that counts
    own = df.withColumns({"bucket": bucket, "extra": F.lit(False)})
    return own.unionByName(copies.withColumnsRenamed({"__to": "bucket"}).withColumn("extra", F.lit(True))), len(held)


def _position(borders: list[int], key: Column) -> Column:
    """How many borders are below the key or equal to it; a null key is below all."""
    if not borders:
        return F.lit(0)
    step = math.isqrt(len(borders)) + 1
    groups = [borders[i : i + step] for i in range(0, len(borders), step)]

    def upto(numbers: Column) -> Column:
        return F.size(F.filter(numbers, lambda b: b <= key))

    group = upto(_longs([g[0] for g in groups]))
    every = F.expr("array(" + ",".join("array(" + ",".join(f"{b}L" for b in g) + ")" for g in groups) + ")")
    inside = (group - 1) * step + upto(F.element_at(every, group))
    return F.when(key.isNull(), 0).when(group == 0, 0).otherwise(inside)


def _longs(numbers: list[int]) -> Column:
    return F.expr("array(" + ",".join(f"{n}L" for n in numbers) + ")")


def edited_pairs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_text, fingerprint, edited_fingerprint, near_edited, near_next, edits.

    The next document has the next smaller id, the one after the last is the first; rows of equal id come
    in the order of a hash of their text and null ids come last. The edited text has its last third
    replaced by as many characters from the start of the next document, or all it has. A single document
    is its own next. Null texts are empty; other columns are not looked at; an empty table gives no rows. Ids are
    whole numbers, or texts of them.
    """
    rows = df.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text")
    )
    spread, buckets = with_neighbour(rows, "doc_id")
    order = F.xxhash64("text")
    sorted_rows = (
        spread.withColumn("__order", order).repartitionById(max(1, buckets), "bucket")
        .sortWithinPartitions("bucket", "extra", F.desc_nulls_last("doc_id"), "__order", "text")
        .select("bucket", "extra", "doc_id", "text")
    )
    schema = struct(
        "doc_id bigint, n_chars bigint, edited_text string, fingerprint string, edited_fingerprint string,"
        " near_edited double, near_next double, edits array<struct<start: bigint, stop: bigint>>"
    )

    def flat(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            yield from zip(*(batch.column(c).to_pylist() for c in ("bucket", "extra", "doc_id", "text")))

    def results(batches: Iterator[pa.RecordBatch]):
        for _, group in groupby(flat(batches), key=lambda r: r[0]):
            before = None  # (doc_id, text, tree) that waits for its next
            for _, extra, key, value in group:
                tree = Tree(value)
                if before is not None:
                    yield _compared(*before, value, tree)
                if extra:
                    break
                before = key, value, tree

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for row in results(batches):
            held.append(row)
            if len(held) == 500:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return sorted_rows.mapInArrow(run, schema)


def _compared(key, text: str, tree: Tree, after: str, next_tree: Tree) -> tuple:
    third = len(text) // 3
    edited = text[: len(text) - third] + after[:third]
    edited_tree = Tree(edited)
    where = [{"start": a, "stop": b} for a, b in edits(tree, edited_tree)]
    return (key, len(text), edited, str(tree), str(edited_tree), likeness(tree, edited_tree), likeness(tree, next_tree), where)


def _batch(rows: list[tuple], schema) -> pa.RecordBatch:
    return arrow_batch(dict(zip(schema.names, map(list, zip(*rows)))), schema)

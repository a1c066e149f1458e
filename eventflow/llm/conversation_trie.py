"""Operator 11: the prefix trie of conversations, rolled up by centroid decomposition.

A node is a different sequence of first turns, known by sums of strong hashes of its (depth, turn) pairs, which
grow along a conversation as a running sum. Sums over subtrees come from a centroid decomposition of the
parent edges. In every component at once, the nodes with more than half of the component below them form
the path from its top down to its centroid; the total below the centroid is added along that path, the path's
sizes shrink by the centroid's, and what hangs below the centroid becomes components of its own. Each split at
least halves a component, so that depth and degree of the trie do not matter.

Large components are split with joins and aggregates. Those of at most LOCAL nodes are finished in tasks,
many at a time, by the same steps over arrays.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, functions as F

from eventflow.llm.common import arrow_batch, struct, written
from eventflow.operators.ordered import numbered, running_sum

#: A component of at most so many nodes is finished within a task, and a task works on about so many components' nodes at once.
LOCAL = 4096
TOGETHER = 50_000
#: Turns of a conversation that are ordered by one task.
SLOT = 4096
#: Characters of ids that are sent in one piece.
PIECE = 65_536
WORDS_BETWEEN = r"[\x20\x09-\x0D]+"
WIDE = "decimal(38,0)"


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(text, WORDS_BETWEEN), "")).cast("bigint")


def turns(df: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, i, said, words): turns numbered from 1 in each conversation, each as the hash of its role and text."""
    role, text = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    slim = df.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"),
        F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256).alias("said"), n_words(text).alias("words"))
    return numbered(slim, ["conv"], ["turn", "said"], "i", slot=SLOT).select("conv", F.col("i").cast("bigint").alias("i"), "said", "words")


def shared_starts(each: DataFrame, every: int, most: int) -> DataFrame:
    """(conv, depth, said, words): conversations whose first h = crc32(id) % (most + 1) turns are replaced.

    They come from the conversation with the next smaller id that `every` divides, as many as it has.
    """
    ids = each.groupBy("conv").agg(F.count("*").alias("n")).select(
        "conv", "n", F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most + 1)).alias("h"), (F.col("conv") - F.col("conv") % every).alias("base"))
    heads = each.where(F.col("i") <= most).select(F.col("conv").alias("base"), F.col("i").alias("depth"), "said", "words")
    copied = ids.where("h > 0").join(heads, "base").where("depth <= h").select("conv", "depth", "said", "words")
    given = ids.select(F.col("conv").alias("base"), F.col("n").alias("there"))
    short = ids.join(given, "base", "left").select(
        F.col("conv"), (F.col("h") - F.least("h", F.coalesce("there", F.lit(0)))).alias("short")).where("short > 0")
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(most + 1))
    own = each.where(F.col("i") > h).join(short, "conv", "left").select(
        "conv", (F.col("i") - F.coalesce("short", F.lit(0))).alias("depth"), "said", "words")
    return copied.unionByName(own)


def _node(depth: Column, x: Column, y: Column) -> Column:
    return F.md5(F.concat_ws(",", depth.cast("string"), x.cast(WIDE).cast("string"), y.cast(WIDE).cast("string")))


def paths(rows: DataFrame) -> DataFrame:
    """(conv, depth, node, parent, words): the nodes that each conversation passes below the root."""
    mixed = rows.withColumns({k: F.xxhash64(F.lit(k), "depth", "said").cast(WIDE) for k in ("p", "q")}).drop("said")
    sums = running_sum(mixed, ["conv"], ["depth"], {"x": F.col("p"), "y": F.col("q")}, slot=SLOT)
    depth, x, y = F.col("depth"), F.col("x"), F.col("y")
    return sums.select("conv", "depth", _node(depth, x, y).alias("node"), _node(depth - 1, x - F.col("p"), y - F.col("q")).alias("parent"), "words")


ROOT = hashlib.md5(b"0,0,0").hexdigest()


# rollup -------------------------------------------------------------------------------------------------------------


def split_here(comp: np.ndarray, up: np.ndarray, depth: np.ndarray, size: np.ndarray, values: np.ndarray, sums: np.ndarray) -> None:
    """Decomposes all components of a forest to the end, in place; rows are nodes.

    comp: the index of the node's top; up: that of its parent, its own at a top; size: nodes of its subtree
    within the component; sums: starts as the values and becomes the subtree's sums.
    """
    live = np.arange(len(comp))
    while len(live):
        total = size[comp[live]]
        heavy = live[2 * size[live] > total]
        heavy = heavy[np.lexsort((depth[heavy], comp[heavy]))]
        last = np.append(comp[heavy][1:] != comp[heavy][:-1], True)
        centroids = heavy[last]
        of = np.zeros(len(comp), np.int64)
        of[comp[centroids]] = centroids
        centre = of[comp[live]]
        stop = (live == comp[live]) | (live == centre) | (up[live] == centre)
        jump = np.arange(len(comp))
        jump[live] = np.where(stop, live, up[live])
        while True:
            further = jump[jump[live]]
            if np.array_equal(further, jump[live]):
                break
            jump[live] = further
        top = jump[live]
        below = (top != comp[live]) | (live == centre)
        parts = np.zeros_like(values)
        np.add.at(parts, comp[live][below], values[live][below])
        shrink = np.zeros(len(comp), np.int64)
        shrink[comp[centroids]] = size[centroids]
        sums[heavy] += parts[comp[heavy]]
        sums[centroids] -= values[centroids]
        path = heavy[~last]
        size[path] -= shrink[comp[path]]
        comp[live] = np.where(below, top, comp[live])
        live = live[live != centre]


def _finish(small: DataFrame, names: Sequence[str]) -> DataFrame:
    """(node, sums) of components that are small enough for a task."""
    schema = struct("node string, " + ", ".join(f"{n} bigint" for n in names))

    def solve(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        column = lambda c: table.column(c).to_numpy(zero_copy_only=False)
        node = pa.array(table.column("node"))
        index = lambda c: np.array(pa.compute.index_in(table.column(c), value_set=node).fill_null(-1))
        comp, own = index("comp"), np.arange(len(node))
        up = np.where(comp == own, own, index("parent"))
        values = np.stack([column(f"v_{n}") for n in names], 1).astype(np.int64)
        sums = np.stack([column(f"s_{n}") for n in names], 1).astype(np.int64)
        split_here(comp.astype(np.int64), up.astype(np.int64), column("depth"), column("size").astype(np.int64).copy(), values, sums)
        return arrow_batch({"node": node} | {n: sums[:, i] for i, n in enumerate(names)}, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, last = [], 0, None
        for batch in batches:
            comp = batch.column("comp")
            borders = [0, *(np.flatnonzero(np.array(pa.compute.not_equal(comp[1:], comp[:-1]))) + 1).tolist()]
            for start, stop in zip(borders, [*borders[1:], batch.num_rows]):
                if rows >= TOGETHER and comp[start] != last:
                    yield solve(held)
                    held, rows = [], 0
                held.append(batch.slice(start, stop - start))
                rows, last = rows + stop - start, comp[start]
        if held:
            yield solve(held)

    columns = ["comp", "node", "parent", "depth", "size", *[f"{k}_{n}" for n in names for k in "vs"]]
    return small.select(*columns).repartition("comp").sortWithinPartitions("comp").mapInArrow(run, schema)


def rollup(nodes: DataFrame, ways: DataFrame, names: Sequence[str], local: int = LOCAL) -> DataFrame:
    """(node, sums over the subtree of each of the columns `names`).

    nodes: node, parent (null at a top), depth, conv (one conversation that passes the node), size (nodes of its
    subtree), top (of its tree) and the summed columns, whole numbers; ways: conv, depth, node, parent for
    every node a conversation passes, which tells what lies above a node without following edges.
    """
    state = nodes.select("node", "parent", "depth", "conv", "size", F.col("top").alias("comp"), *[F.col(n).cast("bigint").alias(f"v_{n}") for n in names],
                         *[F.col(n).cast("bigint").alias(f"s_{n}") for n in names])
    # as a table: a column that Spark knows to be constant would make the joins on it cross joins
    state, finished, small = written(state, "forest", slim=True), [], []
    while True:
        tops = state.where(F.col("node") == F.col("comp")).select("comp", F.col("size").alias("total"))
        state = written(state.join(tops, "comp"), "components", slim=True)
        small.append(state.where(F.col("total") <= local))
        state = state.where(F.col("total") > local)
        heavy = 2 * F.col("size") > F.col("total")
        centres = written(
            state.where(heavy).groupBy("comp").agg(F.max(F.struct("depth", "node", "size")).alias("c")).select(
                "comp", F.col("c.depth").alias("c_depth"), F.col("c.node").alias("c_node"), F.col("c.size").alias("c_size")),
            "centroids", slim=True)
        if centres.isEmpty():
            break
        placed = state.join(centres, "comp")
        above = placed.where(F.col("depth") <= F.col("c_depth")).withColumns(
            {"below": F.col("node") == F.col("c_node"), "next": F.col("comp")})
        step = ways.select("conv", (F.col("depth") - 1).alias("c_depth"), F.col("node").alias("w_node"), F.col("parent").alias("w_parent"))
        deeper = placed.where(F.col("depth") > F.col("c_depth")).join(step, ["conv", "c_depth"]).withColumn(
            "below", F.col("w_parent") == F.col("c_node")).withColumn("next", F.when(F.col("below"), F.col("w_node")).otherwise(F.col("comp")))
        moved = written(above.unionByName(deeper.drop("w_node", "w_parent")), "split", slim=True)
        parts = moved.where("below").groupBy("comp").agg(*[F.sum(f"v_{n}").alias(f"t_{n}") for n in names])
        centre = F.col("node") == F.col("c_node")
        added = moved.join(parts, "comp").withColumns(
            {f"s_{n}": F.col(f"s_{n}") + F.when(heavy, F.col(f"t_{n}") - F.when(centre, F.col(f"v_{n}")).otherwise(F.lit(0))).otherwise(F.lit(0)) for n in names}
            | {"size": F.col("size") - F.when(heavy & ~centre, F.col("c_size")).otherwise(F.lit(0))})
        added = written(added.select(*[c for c in state.columns if c not in ("comp", "total")], F.col("next").alias("comp"), centre.alias("centre")), "added", slim=True)
        finished.append(added.where("centre").select("node", *[F.col(f"s_{n}").alias(n) for n in names]))
        state = added.where(~F.col("centre")).drop("centre")
    return reduce(DataFrame.unionByName, [*finished, _finish(reduce(DataFrame.unionByName, small), names)])


# digests of ordered ids ---------------------------------------------------------------------------------------------


def id_digests(ends: DataFrame) -> DataFrame:
    """(node, digest): SHA-256 over a node's ids in ascending order, comma-joined.

    Ids are sorted and joined to pieces by ranges of (node, id), so that a node with very many is spread; only
    the digest itself, which has to see the pieces in order, is one task's for a node, a piece at a time.
    """
    piece_schema, schema = struct("node string, first bigint, piece string"), struct("node string, digest string")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, texts, length = None, 0, [], 0
        for batch in batches:
            out = []
            for name, number in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
                if texts and (name != node or length >= PIECE):
                    out.append((node, first, ",".join(texts)))
                    texts, length = [], 0
                if not texts:
                    node, first = name, number
                texts.append(str(number))
                length += len(texts[-1]) + 1
            if out:
                yield arrow_batch(dict(zip(piece_schema.names, map(list, zip(*out)))), piece_schema)
        if texts:
            yield arrow_batch({"node": [node], "first": [first], "piece": [",".join(texts)]}, piece_schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for name, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist()):
                if name == node:
                    state.update(b"," + piece.encode())
                    continue
                if state is not None:
                    out.append((node, state.hexdigest()))
                node, state = name, hashlib.sha256(piece.encode())
            if out:
                yield arrow_batch(dict(zip(schema.names, map(list, zip(*out)))), schema)
        if state is not None:
            yield arrow_batch({"node": [node], "digest": [state.hexdigest()]}, schema)

    pieces = ends.select("node", "conv").repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(pack, piece_schema)
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, schema)


# the trie -----------------------------------------------------------------------------------------------------------


def trie(each: DataFrame, conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of (conv, depth, said, words) rows, depths from 1 without gaps.

    Columns: node, parent (hashes), conv_id (smallest member), depth, parent_conv_id (null at the root), n_convs,
    n_children, n_leaves and saved_tokens over the subtree, ends_sha256. `conversations` (conv) names all members,
    also those without a turn. No members, no rows.
    """
    ways = written(paths(each), "paths", slim=True)
    below = ways.groupBy("node").agg(
        F.min("conv").alias("conv"), F.count("*").alias("n_convs"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.max("words").alias("words"))
    root = conversations.agg(F.min("conv").alias("conv"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), "conv", "n_convs", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("string").alias("parent"), F.lit(0).cast("bigint").alias("words"))
    nodes = written(below.unionByName(root), "nodes", slim=True)
    # a node is counted for the smallest of its members: these own the last part of their way, and each node
    # on it has all owned nodes that are not above it in its subtree
    owned = nodes.where("depth > 0").groupBy("conv").agg(F.count("*").alias("owned"), F.max("depth").alias("length"))
    sizes = ways.join(owned, "conv").groupBy("node").agg(
        F.sum(F.least(F.col("owned"), F.col("length") - F.col("depth") + 1)).alias("size"))
    children = nodes.where(F.col("parent").isNotNull()).groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    all_nodes = F.lit(None).cast("bigint")
    full = nodes.join(sizes, "node", "left").join(children, "node", "left").select(
        "node", "parent", "depth", "conv", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("size", all_nodes).alias("size"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
    full = written(full, "nodes", slim=True)
    count = full.count()
    forest = full.select(
        "node", "parent", "depth", "conv", F.coalesce("size", F.lit(count)).alias("size"), F.lit(ROOT).alias("top"),
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), "saved_tokens")
    sums = rollup(forest, ways.select("conv", "depth", "node", "parent"), ["n_leaves", "saved_tokens"], local)
    last = ways.groupBy("conv").agg(F.max_by("node", "depth").alias("node"))
    ends = conversations.select("conv").join(last, "conv", "left").select("conv", F.coalesce("node", F.lit(ROOT)).alias("node"))
    parents = full.select(F.col("node").alias("parent"), F.col("conv").alias("parent_conv_id"))
    return (
        full.drop("saved_tokens", "size").join(sums, "node").join(id_digests(ends), "node", "left").join(parents, "parent", "left")
        .select("node", "parent", F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                F.coalesce("digest", F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    )


def conversation_trie(
    df: DataFrame, every: int | None = 20, most: int = 3, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
    text: str = "text", local: int = LOCAL,
) -> DataFrame:
    """The trie of all conversations; see `trie` for its columns.

    Turns are ordered by turn, null first, equal ones by a hash of what was said. A null role or text counts as
    empty, rows without a conversation are left out, a repeated row is a repeated turn. With `every`, a
    conversation starts with turns of another one (`shared_starts`); without it, each is taken as it is. Texts
    are read whole, other columns are not looked at, and an empty table gives no rows.
    """
    each = written(turns(df, conv_id, turn, role, text), "turns", slim=True)
    conversations = each.select("conv").distinct()
    rows = shared_starts(each, every, most) if every else each.withColumnRenamed("i", "depth")
    return trie(rows, conversations, local)

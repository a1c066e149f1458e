"""Operator 7: near-duplicate vectors by NN-descent.

Every vector keeps a list of its nearest neighbours so far. The first lists come from cells of random
hyperplanes; then each vector introduces its neighbours, both ways, to one another, and lists are
improved until few change. A list all of whose entries are links may hide more of them: the components
of such lists are compared exactly, block against block, within and with one another, but for blocks too
far apart to hold a link. The share of all links that was found is audited against brute force for a
sample; missed by too much, the search is repeated with longer lists, and in the end it is an error. Only pairs whose cosine was computed in double precision become links.

Equal vectors are one node with a number of copies, so copies never fill a list or a cell.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from eventflow.llm.common import arrow_batch, struct, written
from eventflow.llm.components import connected_components
from eventflow.llm.simhash import mix

#: Neighbours in a list at first.
NEIGHBOURS = 10
#: Hyperplane trees of the first lists, and vectors in a cell, about. Larger cells are dealt into chunks.
TREES, CELL = 6, 128
CODE_BITS = 30
#: Vectors that a pivot introduces to each other at once.
CHUNK = 64
ROUNDS = 4
#: Lists are settled once this share of their entries is new in a round.
SETTLED = 0.005
#: Vectors of a block when links are counted exactly.
BLOCK = 512
#: Pivots that a component's vectors are dealt by, about, at most, and vectors that meet them in one task.
PIVOTS, PART = 4096, 32_768
#: Vectors whose links are audited, at most, the share of links to find, and attempts at it.
AUDIT, TARGET, ATTEMPTS = 1024, 0.97, 3
#: Cosines are kept in whole billionths, rounded down, so that equal pairs compare equal.
SCALE = 1_000_000_000
ENTRY = "array<struct<q: bigint, v: bigint>>"


def usable(embedding: str, label: str) -> Column:
    """A label, and a vector of finite components that are not all zero."""
    x = F.col(embedding)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(x, lambda c: c != 0), F.lit(False))


def _unit(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Rows of unit length in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.floor((a @ b.T) * SCALE).astype(np.int64)


def _best(q: np.ndarray, ids: np.ndarray, k: int) -> list[list[dict]]:
    """For each row the k entries of largest q, of equal ones those with the largest id."""
    out = []
    for row in q:
        some = np.flatnonzero(row > np.iinfo(np.int64).min)
        if len(some) > k:
            some = some[np.argpartition(-row[some], k - 1)[:k]]
        out.append([{"q": int(row[i]), "v": int(ids[i])} for i in some])
    return out


def _longest(lists: Column, k: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(F.flatten(lists)), asc=False), 1, k)


def first_lists(nodes: DataFrame, k: int, seed: int) -> DataFrame:
    """(node, nbrs): each vector's best k among those in its cells, TREES of hyperplanes and one at random."""
    codes = struct("node bigint, tree int, code bigint")

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, dims = batch.column("node").to_numpy(), batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                x = _unit(batch.column("vec").take(pa.array(rows)))
                for tree in range(TREES):
                    planes = np.random.default_rng([seed, tree, int(dim)]).standard_normal((int(dim), CODE_BITS))
                    bits = (x @ planes > 0).astype(np.int64)
                    yield arrow_batch({"node": ids[rows], "tree": [tree] * len(rows),
                                       "code": bits @ (1 << np.arange(CODE_BITS)[::-1])}, codes)
                # and cells at random, which connect those of the hyperplanes
                anyhow = mix(ids[rows].view(np.uint64) + np.uint64(seed)) >> np.uint64(64 - CODE_BITS)
                yield arrow_batch({"node": ids[rows], "tree": [TREES] * len(rows), "code": anyhow.astype(np.int64)}, codes)

    coded = nodes.select("node", "dim", "vec").mapInArrow(cells, codes)
    sizes = nodes.groupBy("label", "dim").agg(F.count("*").alias("n"))
    bits = F.least(F.lit(CODE_BITS), F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("n") / CELL)))).cast("int")
    placed = (
        coded.join(nodes.select("node", "label", "dim"), "node").join(sizes, ["label", "dim"])
        .withColumn("cell", F.floor(F.col("code") / F.pow(F.lit(2.0), CODE_BITS - bits)))
        .select("node", "label", "dim", "tree", "cell")
    )
    crowds = placed.groupBy("label", "dim", "tree", "cell").agg(F.count("*").alias("crowd"))
    chunk = F.pmod(F.xxhash64("node", "tree", F.lit(seed)), F.ceil(F.col("crowd") / (2 * CELL))).cast("int")
    dealt = placed.join(crowds, ["label", "dim", "tree", "cell"]).withColumn("chunk", chunk).drop("crowd")
    lists = struct(f"node bigint, nbrs {ENTRY}")

    def within(table: pa.Table) -> pa.Table:
        ids, x = table.column("node").to_numpy(), _unit(table.column("vec"))
        q = _cosines(x, x)
        np.fill_diagonal(q, np.iinfo(np.int64).min)
        return pa.Table.from_batches([arrow_batch({"node": ids, "nbrs": _best(q, ids, k)}, lists)])

    met = (
        dealt.join(nodes.select("node", "vec"), "node")
        .groupBy("label", "dim", "tree", "cell", "chunk").applyInArrow(within, lists)
    )
    return met.groupBy("node").agg(_longest(F.collect_list("nbrs"), k).alias("nbrs"))


def _introduce(nodes: DataFrame, graph: DataFrame, k: int) -> DataFrame:
    """(node, nbrs): better neighbours found among neighbours of neighbours."""
    edges = graph.select("node", F.explode("nbrs").alias("x"), "fresh").select(
        "node", F.col("x.v").alias("v"), F.array_contains("fresh", F.col("x.v")).alias("new")
    )
    both = edges.select(F.col("node").alias("pivot"), F.col("v").alias("node"), "new").unionByName(
        edges.select(F.col("v").alias("pivot"), "node", "new")
    ).groupBy("pivot", "node").agg(F.max("new").alias("new"))
    crowds = both.groupBy("pivot").agg(F.count("*").alias("crowd"), F.max("new").alias("any")).where("any")
    chunk = F.pmod(F.xxhash64("node", "pivot"), F.ceil(F.col("crowd") / CHUNK)).cast("int")
    worst = F.when(F.size("nbrs") >= k, F.element_at("nbrs", -1)["q"]).otherwise(F.lit(-2 * SCALE)).alias("worst")
    members = nodes.select("node", "vec").join(graph.select("node", worst), "node")
    groups = both.join(crowds, "pivot").select("pivot", chunk.alias("chunk"), "node", "new").join(members, "node")
    lists = struct(f"node bigint, nbrs {ENTRY}")

    def among(table: pa.Table) -> pa.Table:
        ids, new = table.column("node").to_numpy(), table.column("new").to_numpy(zero_copy_only=False)
        worst = table.column("worst").to_numpy()
        x = _unit(table.column("vec"))
        q = _cosines(x, x)
        useless = ~(new[:, None] | new[None, :]) | (q <= worst[:, None]) | (ids[:, None] == ids[None, :])
        q[useless] = np.iinfo(np.int64).min
        some = np.flatnonzero((~useless).any(1))
        return pa.Table.from_batches([arrow_batch({"node": ids[some], "nbrs": _best(q[some], ids, k)}, lists)])

    return groups.groupBy("pivot", "chunk").applyInArrow(among, lists)


def descend(nodes: DataFrame, k: int, seed: int) -> DataFrame:
    """(node, nbrs): the k nearest neighbours found for every vector that has others of its label."""
    ids = F.transform("nbrs", lambda e: e["v"])
    graph = written(first_lists(nodes, k, seed).withColumn("fresh", ids), "neighbours", slim=True)
    for _ in range(ROUNDS):
        found = _introduce(nodes, graph, k)
        merged = (
            graph.select("node", "nbrs", ids.alias("before")).unionByName(
                found.select("node", "nbrs", F.lit(None).cast("array<bigint>").alias("before")))
            .groupBy("node").agg(_longest(F.collect_list("nbrs"), k).alias("nbrs"), F.max("before").alias("before"))
        )
        graph = written(merged.select("node", "nbrs", F.array_except(ids, "before").alias("fresh")), "neighbours", slim=True)
        changed = graph.agg(F.sum(F.size("fresh")).alias("new"), F.sum(F.size("nbrs")).alias("every")).first()
        if not changed.every or changed.new < SETTLED * changed.every:
            break
    return graph.select("node", "nbrs")


def _cells(members: DataFrame) -> DataFrame:
    """members with the cell of each, that of the nearest of its component's pivots (a node).

    A component of one block is one cell. A larger one has about as many pivots as blocks, PIVOTS at most, drawn by
    a hash; its members meet them in parts of PART, so that no task gets a whole component.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    sized = members.join(sizes, "component")
    small = sized.where(F.col("n") <= BLOCK).withColumn("cell", F.col("first")).drop("n", "first")
    large = sized.where(F.col("n") > BLOCK)
    parts = F.ceil(F.col("n") / PART)
    wanted = F.least(F.ceil(F.col("n") / BLOCK), F.lit(PIVOTS))
    drawn = (F.pmod(F.xxhash64("node", F.lit(1)), F.col("n")) < wanted) | (F.col("node") == F.col("first"))
    pivots = large.where(drawn).select(
        F.col("component").alias("of"), F.col("node").alias("pivot"), F.col("vec").alias("place"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("with"))
    rows = large.withColumn("part", F.pmod(F.xxhash64("node", F.lit(2)), parts)).drop("n", "first")
    schema = T.StructType([*members.schema.fields, T.StructField("cell", T.LongType())])
    kept = members.columns

    def nearest(table: pa.Table, pivots: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.Table.from_batches([], schema=to_arrow_schema(schema))
        order = np.argsort(pivots.column("pivot").to_numpy())
        y, names = _unit(pivots.column("place"))[order], pivots.column("pivot").to_numpy()[order]
        x = _unit(table.column("vec"))
        best = np.concatenate([np.argmax(x[i : i + BLOCK] @ y.T, axis=1) for i in range(0, len(x), BLOCK)])
        return pa.Table.from_batches([arrow_batch({c: table.column(c).combine_chunks() for c in kept} | {"cell": names[best]}, schema)])

    met = rows.groupBy("component", "part").cogroup(pivots.groupBy("of", "with")).applyInArrow(nearest, schema)
    return small.select(*schema.names).unionByName(met)


def _blocks(members: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Members dealt by place into blocks of their component, and all pairs (i, j), i <= j, of blocks that may hold a link.

    A block has a centre and a radius, as angles. Angles obey the triangle inequality, so blocks further
    apart than both radii and the threshold's angle hold no link between them. Nothing else is left out.
    """
    near_each_other = written(_cells(members), "cells", slim=True)
    crowds = near_each_other.groupBy("component", "cell").agg(F.count("*").alias("crowd"))
    chunk = F.pmod(F.xxhash64("node"), F.ceil(F.col("crowd") / BLOCK))
    dealt = written(
        near_each_other.join(crowds, ["component", "cell"])
        .withColumn("block", F.struct("component", F.xxhash64("cell", chunk).alias("part"))).drop("cell", "crowd"),
        "members", slim=True,
    )
    rings = struct("label string, dim int, block struct<component: bigint, part: bigint>, centre array<double>, radius double")
    angle = math.acos(min(1.0, max(-1.0, least / SCALE))) + 1e-6  # and some for rounding

    def ring(table: pa.Table) -> pa.Table:
        x = _unit(table.column("vec"))
        centre = x.sum(0)
        size = np.sqrt(centre @ centre)
        centre = centre / size if size > 1e-9 else x[0]
        radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
        return pa.Table.from_batches([arrow_batch({
            "label": table.column("label")[:1].to_pylist(), "dim": table.column("dim")[:1].to_pylist(),
            "block": table.column("block")[:1].to_pylist(), "centre": [centre], "radius": [radius]}, rings)])

    around = written(
        dealt.select(F.col("label").cast("string").alias("label"), "dim", "block", "vec")
        .groupBy("block").applyInArrow(ring, rings), "blocks", slim=True)
    # the blocks themselves are compared tile against tile
    tiles = around.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("tiles"))
    placed = around.join(tiles, ["label", "dim"]).withColumn("own", F.pmod(F.xxhash64("block"), F.col("tiles")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "dim", F.least("own", "other").alias("s"), F.greatest("own", "other").alias("t"),
        (F.col("own") <= F.col("other")).alias("first"), "block", "centre", "radius",
    )
    near = struct("i struct<component: bigint, part: bigint>, j struct<component: bigint, part: bigint>")

    def compare(table: pa.Table) -> pa.Table:
        blocks = [(b["component"], b["part"]) for b in table.column("block").to_pylist()]
        x, radius = _unit(table.column("centre")), table.column("radius").to_numpy()
        first = np.flatnonzero(table.column("first").to_numpy(zero_copy_only=False))
        same = table.column("s")[0].as_py() == table.column("t")[0].as_py()
        second = first if same else np.setdiff1d(np.arange(len(blocks)), first)
        apart = np.arccos(np.clip(x[first] @ x[second].T, -1, 1))
        close = apart <= radius[first][:, None] + radius[second][None, :] + angle
        pairs = [sorted((blocks[first[a]], blocks[second[b]])) for a, b in zip(*np.nonzero(close)) if not same or a <= b]
        return pa.Table.from_batches([arrow_batch({
            side: [{"component": p[n][0], "part": p[n][1]} for p in pairs] for n, side in enumerate(("i", "j"))}, near)])

    return dealt, met.groupBy("label", "dim", "s", "t").applyInArrow(compare, near)


def _count_blocks(members: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(node, links): all links among the members, whatever their components, counted block against block;
    and (a, b): links that connect components. members: component, node, label, dim, vec, copies.
    """
    dealt, near = _blocks(members, least)
    sides = near.select("i", "j", F.explode(F.array_distinct(F.array("i", "j"))).alias("block"))
    pairs = sides.join(dealt.select("block", "node", "vec", "copies"), "block").select(
        "i", "j", (F.col("block") == F.col("i")).alias("first"), "node", "vec", "copies")
    counts = struct("node bigint, links bigint, a bigint, b bigint")

    def rows(ids, links) -> pa.RecordBatch:
        none = pa.nulls(len(ids), pa.int64())
        return arrow_batch({"node": ids, "links": links, "a": none, "b": none}, counts)

    def count(table: pa.Table) -> pa.Table:
        ids, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        first = table.column("first").to_numpy(zero_copy_only=False)
        x = _unit(table.column("vec"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        if i == j:
            linked = _cosines(x, x) >= least
            np.fill_diagonal(linked, False)
            return pa.Table.from_batches([rows(ids, linked @ copies)])
        linked = _cosines(x[first], x[~first]) >= least
        out = [rows(ids[first], linked @ copies[~first]), rows(ids[~first], copies[first] @ linked)]
        if i["component"] != j["component"] and linked.any():
            # one link is enough, as both components are connected
            a, b = np.unravel_index(linked.argmax(), linked.shape)
            out.append(arrow_batch({"node": [None], "links": [None], "a": [ids[first][a]], "b": [ids[~first][b]]}, counts))
        return pa.Table.from_batches(out)

    found = written(pairs.groupBy("i", "j").applyInArrow(count, counts), "crowds", slim=True)
    return (
        found.where(F.col("node").isNotNull()).groupBy("node").agg(F.sum("links").alias("links")),
        found.where(F.col("a").isNotNull()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")),
    )


def links(nodes: DataFrame, threshold: float, k: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """(node, links), links to other nodes counted with their copies; and the edges (a, b) that were found."""
    least = math.ceil(round(threshold * SCALE, 3))
    graph = written(descend(nodes, k, seed), "graph", slim=True)
    entries = graph.select("node", F.explode("nbrs").alias("x")).where(F.col("x.q") >= least)
    edges = written(
        entries.select(F.least("node", "x.v").alias("a"), F.greatest("node", "x.v").alias("b")).distinct(), "links", slim=True
    )
    groups = connected_components(edges, "a", "b")
    full = graph.where((F.size("nbrs") >= k) & (F.element_at("nbrs", -1)["q"] >= least)).select("node")
    crowded = groups.join(full, "node").select("component").distinct()
    # a link that no list holds has saturated lists at both ends, and so its ends are members
    members = groups.join(crowded, "component").join(nodes, "node")
    exact, across = _count_blocks(members, least)
    if not across.isEmpty():
        groups = connected_components(edges.unionByName(across), "a", "b")
    sides = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    listed = sides.join(nodes.select(F.col("node").alias("other"), "copies"), "other").groupBy("node").agg(
        F.sum("copies").alias("listed"))
    return written(
        listed.join(exact, "node", "left").select("node", F.coalesce("links", "listed").alias("links")), "counted", slim=True
    ), groups


def audit(nodes: DataFrame, counted: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """The share of the links of a sample of vectors that was found, against all vectors in blocks."""
    least = math.ceil(round(threshold * SCALE, 3))
    # the sample is bounded, and so is what every task gets
    asked = nodes.orderBy(F.xxhash64("node"), "node").limit(sample).select("node", "label", "dim", "vec")
    rows = [(r.node, r.label, r.dim, r.vec) for r in asked.collect()]
    if not rows:
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast(rows)
    counts = struct("node bigint, links bigint")

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict = {}
        for node, label, dim, vec in shared.value:
            groups.setdefault((label, dim), []).append((node, vec))
        asked = {g: (np.array([n for n, _ in s]), _unit(pa.array([v for _, v in s]))) for g, s in groups.items()}
        for batch in batches:
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            where: dict = {}
            for i, g in enumerate(zip(labels, dims)):
                if g in asked:
                    where.setdefault(g, []).append(i)
            for g, some in where.items():
                part = batch.take(pa.array(some))
                linked = _cosines(asked[g][1], _unit(part.column("vec"))) >= least
                linked &= asked[g][0][:, None] != part.column("node").to_numpy()[None, :]
                yield arrow_batch({"node": asked[g][0], "links": linked @ part.column("copies").to_numpy()}, counts)

    true = nodes.select("node", "label", "dim", "vec", "copies").mapInArrow(brute, counts).groupBy("node").agg(
        F.sum("links").alias("true"))
    both = true.join(counted, "node", "left").agg(
        F.sum("true").alias("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0)))).alias("found")).first()
    return both.found / both.true if both.true else 1.0


def near_duplicates(
    df: DataFrame, threshold: float = 0.93, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label",
    k: int = NEIGHBOURS, seed: int = 7,
) -> DataFrame:
    """vec_id, n_links, component_id, kept, audited_recall for every row.

    Vectors are compared only if their labels are equal and they have as many components. Rows without a
    label, and vectors that are null, empty, zero or hold null or non-finite components, link with nothing
    and are their own component. Equal vectors of a label are linked to each other. The component is the
    smallest id that links reach; kept is whether the row's id is that one. Repeated rows are vectors of
    their own. An empty table gives no rows; other columns are left out. RuntimeError if the audit still
    finds too few links after the last attempt.
    """
    rows = df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("vec"), F.col(label).alias("label"))
    good = usable("vec", "label")
    nodes = written(
        rows.where(good & F.col("vec_id").isNotNull()).groupBy("label", "vec")
        .agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
        .select("node", "label", F.size("vec").alias("dim"), "vec", "copies"),
        "vectors", slim=True,
    )
    for attempt in range(ATTEMPTS):
        counted, groups = links(nodes, threshold, k << attempt, seed + attempt)
        found = audit(nodes, counted, threshold)
        if found >= TARGET:
            break
    else:
        raise RuntimeError(f"op7: {found:.3f} of the audited links were found in {ATTEMPTS} attempts, fewer than {TARGET}")
    named = written(
        nodes.join(counted, "node", "left").join(groups, "node", "left").select(
            "label", "vec", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        ), "named", slim=True)
    linked = rows.where(good & F.col("vec_id").isNotNull()).join(named, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~good | F.col("vec_id").isNull()).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        F.lit(found).alias("audited_recall"),
    )

"""Operator 13: benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

An item of a benchmark is cut into windows of `window` words; a window is the ordered set of its shingles.
To hold a window whole, a document must hold all of them, so of the shingles ordered by rarity a prefix of
one is all that has to be joined: the rarest over all documents. A document position that holds it gives a
start for the window; starts that leave the document at either end fall to the positional and length
bounds, and the rest are verified word by word.

One pass over a written table of the documents' words leaves the positions that hold a shingle of any item.
The shingles are counted there, and the prefixes joined. The items' side is sent to all tasks if it has at
most BROADCAST_ROWS rows, and joined by an exchange of narrow rows otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.llm.common import text_or_empty, written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What stands between words: everything in ASCII but digits and letters.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Rows of two numbers and a few small ones that every task may hold.
BROADCAST_ROWS = 400_000


def words(text: Column) -> Column:
    """The text's words, A-Z in lower case; a null text has none."""
    plain = F.octet_length(text) == F.length(text)  # lower() touches other letters than A-Z too
    lowered = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))
    return F.array_remove(F.split(lowered, BETWEEN), "")


def _placed(table: DataFrame, key: str, length: int, shortest: int) -> DataFrame:
    """(key, n, at, shingle) for each position of the rows of at least `shortest` words.

    A shingle is the hash of the `length` words from its position on. The words' hashes are laid beside
    themselves, shifted, and hashed together behind the explode, where code is compiled.
    """
    whole = table.where(F.size("words") >= max(shortest, length))
    hashed = whole.select(key, F.size("words").alias("n"), F.transform("words", lambda word: F.xxhash64(word)).alias("h"))
    shifted = [F.slice("h", i + 1, F.col("n")).alias(f"h{i}") for i in range(length)]
    rows = hashed.select(key, "n", F.posexplode(F.arrays_zip(*shifted)).alias("at", "of"))
    return rows.where(F.col("at") + length <= F.col("n")).select(
        key, "n", "at", F.xxhash64(F.lit(length), *[F.col("of")[f"h{i}"] for i in range(length)]).alias("shingle"))


def item_windows(items: DataFrame, window: int, item_id: str = "item_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The different windows (wid, words), and which items have them (wid, item_id as text, null as empty).

    An item of fewer words is one window, an item without words has none. Repeated items count once.
    """
    cut = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item_id"), words(text_or_empty(text)).alias("all"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("all") - window))
    each = cut.where(F.size("all") > 0).select("item_id", "all", F.explode(starts).alias("from")).select(
        "item_id", F.slice("all", F.col("from") + 1, window).alias("words"))
    windows = written(each.select("words").distinct(), "windows", slim=True, number="wid")
    return windows, written(each.join(windows, "words").select("wid", "item_id").distinct(), "window-items", slim=True)


def _small(df: DataFrame, most: int) -> DataFrame:
    """df with a hint to broadcast it, if it has at most so many rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def prefixes(every: DataFrame, counts: DataFrame) -> DataFrame:
    """(wid, length, shingle, off, size): of each window that can occur at all its rarest shingle.

    every: wid, size (the window's words), length, shingle and off (its place in the window); counts: how many
    positions of the whole table hold a shingle. Ties go to the smaller hash. A window has to be held whole, so
    that of its shingles in this order one is necessary; a window with a shingle that no document has can't occur.
    """
    ranked = every.join(counts, ["length", "shingle"], "left").groupBy("wid", "length", "size").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "shingle", "off")).alias("rarest"))
    return ranked.where("rarest.count > 0").select("wid", "length", "size", "rarest.shingle", "rarest.off")


def hits(table: DataFrame, windows: DataFrame, shingle: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """(key, hits array of start, n, wid): where windows stand in the rows of `table` (key, words), verified."""
    length = F.least(F.lit(shingle), F.size("words"))
    lengths = sorted(r.length for r in windows.select(length.alias("length")).distinct().collect())  # at most `shingle` values
    if not lengths:
        return table.select("key", F.expr("CAST(NULL AS array<struct<start: int, n: int, wid: bigint>>)").alias("hits")).limit(0)
    every = written(reduce(DataFrame.unionByName, [
        _placed(windows.where(length == k), "wid", k, 1).select("wid", F.col("n").alias("size"), F.lit(k).alias("length"), "shingle", F.col("at").alias("off"))
        for k in lengths
    ]), "window-shingles", slim=True)
    wanted = _small(every.select("length", "shingle").distinct(), most)
    shortest = windows.agg(F.min(F.size("words"))).first()[0]
    # the one pass over all words; what it leaves are positions of the items' shingles
    matched = written(reduce(DataFrame.unionByName, [
        _placed(table, "key", k, shortest).withColumn("length", F.lit(k)).join(wanted, ["length", "shingle"]) for k in lengths
    ]), "positions", slim=True)
    first = written(prefixes(every, matched.groupBy("length", "shingle").count()), "prefixes")
    start = F.col("at") - F.col("off")
    candidates = (
        matched.join(_small(first, most), ["length", "shingle"]).where((start >= 0) & (start + F.col("size") <= F.col("n")))
        .select("key", start.alias("start"), F.col("size").alias("n"), "wid")
        .join(windows.select("wid", F.col("words").alias("wanted")), "wid")
    )
    listed = written(candidates.groupBy("key").agg(F.collect_list(F.struct("start", "n", "wid", "wanted")).alias("candidates")), "candidates", slim=True)
    true = F.filter("candidates", lambda c: F.slice(F.col("words"), c["start"] + 1, c["n"]) == c["wanted"])
    # most documents have no candidates, and their words need not move
    some = table.select("key", "words").join(_small(listed.select("key"), most), "key", "left_semi")
    found = some.join(listed, "key").select(
        "key", F.transform(true, lambda c: F.struct(c["start"], c["n"], c["wid"])).alias("hits"))
    return found.where(F.size("hits") > 0)


def decontaminate(
    docs: DataFrame, items: DataFrame, window: int = 10, shingle: int = 5, doc_id: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text", most: int = BROADCAST_ROWS,
) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans: one row per row of `docs`.

    n_hit counts the words inside any occurrence of any item's window, spans are their ranges of word
    numbers (start, stop; touching ones joined), items the ids of all items with an occurring window as
    sorted texts. Null and empty texts have no words and no hits; rows with a null or a repeated id stay
    rows of their own. Without items nothing is hit; an empty table gives no rows. Other columns of either
    table are not looked at. Texts of any length are read whole.
    """
    table = written(docs.select(F.col(doc_id).alias("doc_id"), words(text_or_empty(text)).alias("words")), "document-words", number="key")
    windows, of = item_windows(items, window, item_id, item_text)
    found = hits(table, windows, shingle, most)
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["n"] - 1)))))
    starts = F.filter("covered", lambda x, i: (i == 0) | (F.get(F.col("covered"), i - 1) != x - 1))
    stops = F.filter("covered", lambda x, i: (i == F.size("covered") - 1) | (F.get(F.col("covered"), i + 1) != x + 1))
    marked = written(
        found.select("key", covered.alias("covered"), F.array_sort(F.array_distinct(F.col("hits.wid"))).alias("wids")).select(
            "key", "wids", F.size("covered").cast("bigint").alias("n_hit"),
            F.zip_with(starts, stops, lambda a, b: F.struct(a.alias("start"), (b + 1).alias("stop"))).alias("spans")),
        "document-hits", slim=True,
    )
    # documents with the same windows have the same items, so each set of windows is looked up once
    sets = marked.select("wids").distinct().select("wids", F.explode("wids").alias("wid")).join(of, "wid")
    named = sets.groupBy("wids").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    results = marked.join(named, "wids").select("key", "n_hit", "spans", "items")
    return table.select("doc_id", "key", F.size("words").cast("bigint").alias("n_words")).join(results, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.expr("CAST(array() AS array<string>)")).alias("items"),
        F.coalesce("spans", F.expr("CAST(array() AS array<struct<start: int, stop: int>>)")).alias("spans"),
    )

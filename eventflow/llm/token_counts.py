"""Operator 2: token counts from a two-tier lookup on the map side.

A text falls into pre-tokens: runs that no vocabulary piece can cross, so that their token counts add
up. The first tier is a compact table of the corpus's most frequent pre-tokens and their lengths, which
every task gets; the second is a cache in each Python worker for the rest, filled by encoding. Pre-tokens
are never shuffled: what is exchanged to find the frequent ones are sketches of bounded size.
"""

from __future__ import annotations

import re

import numpy as np
import sentencepiece
from pyspark.sql import Column, DataFrame, functions as F

from eventflow.llm.common import BoundedCache, append_columns, text_or_empty

#: Pre-tokens in the shared table; with MAX_KEY below it is a few MB at most, whatever the corpus.
TABLE_SIZE = 32_768
#: Longer pre-tokens are left to the second tier. In characters.
MAX_KEY = 24
#: Items that a sketch follows; it bounds what one task sends.
SKETCH_ITEMS = 4 * TABLE_SIZE
#: Sketches are combined in groups first, so that no task reads those of all partitions.
GROUPS = 64
#: Pre-tokens a Python worker remembers.
CACHE_SIZE = 200_000
BLANKS = " ▁"
PRE_TOKEN = re.compile(f"[{BLANKS}]*[^{BLANKS}\\n]+|[{BLANKS}]+|\\n")


def check_splits(processor: sentencepiece.SentencePieceProcessor) -> None:
    """Fail unless blanks occur only at the start of pieces and line breaks in none."""
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if "▁" in piece.lstrip("▁") or "\n" in piece and not processor.is_byte(i):
            raise ValueError(f"piece {i} of the model crosses pre-tokens")


def frequent_pre_tokens(df: DataFrame, text: str, size: int = TABLE_SIZE) -> list[str]:
    """About the most frequent pre-tokens of all rows, from sketches of bounded size.

    The table only decides which pre-tokens are looked up rather than encoded, never a count.
    """
    pre_token = F.explode(F.expr(rf"regexp_extract_all(`__t`, '[ ]?[^ \n]+', 0)")).alias("pre_token")
    sketches = (
        df.select(text_or_empty(text).alias("__t"), F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("g"))
        .select("g", pre_token)
        .where(F.length("pre_token") <= MAX_KEY)
        .groupBy("g").agg(F.expr(f"approx_top_k_accumulate(pre_token, {SKETCH_ITEMS})").alias("sketch"))
    )
    # one group, but by a column: a global aggregate would also start on partitions without sketches, and fail
    top = sketches.groupBy(F.floor(F.col("g") / GROUPS).alias("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {SKETCH_ITEMS})").alias("sketch")
    )
    rows = top.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {size})")).alias("x")).select("x.item")
    return [r.item for r in rows.collect()]


class Counter:
    """Token counts of whole texts: the shared table first, then the worker's cache, then encoding."""

    def __init__(self, model: bytes, keys: str, lengths: bytes):
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        split = keys.split("\n") if keys else []
        self.table = dict(zip(split, np.frombuffer(lengths, np.uint16).tolist()))
        self.cache = BoundedCache(CACHE_SIZE)

    def lengths(self, pre_tokens: list[str]) -> list[int]:
        """Tokens of each. Behind a line break no blank is added and nothing merges, which costs two tokens."""
        ids = self.processor.encode(["\n" + p for p in pre_tokens], num_threads=1)
        return [len(i) - 2 for i in ids]

    def count(self, texts: list[str]) -> list[int]:
        # sentencepiece puts a blank before every text that is not empty
        split = [PRE_TOKEN.findall(" " + t) if t else [] for t in texts]
        table, cache = self.table, self.cache
        first = [list(map(table.get, pre_tokens)) for pre_tokens in split]
        missed = [[p for p, n in zip(ps, ns) if n is None] for ps, ns in zip(split, first)]
        unseen = list({p for ps in missed for p in ps if p not in cache})
        fresh = dict(zip(unseen, self.lengths(unseen))) if unseen else {}
        out = []
        for ns, ps in zip(first, missed):
            known = sum(n for n in ns if n is not None)
            out.append(known + sum(fresh[p] if p in fresh else cache[p] for p in ps))
        cache.add(fresh)
        return out


def token_counts(df: DataFrame, path: str, text: str = "text", n_tokens: str = "n_tokens") -> DataFrame:
    """df with the number of tokens the SentencePiece model gives the whole text, a long.

    No begin or end tokens; control symbols inside a text are ordinary text. Null and empty texts have
    none. Rows are independent, so ties and repeated rows keep their own counts and an empty table stays
    empty. An input column named as the result is replaced; all others stay.
    """
    with open(path, "rb") as f:
        model = f.read()
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    check_splits(processor)
    keys = [k for k in frequent_pre_tokens(df, text) if k and "▁" not in k and "\n" not in k]
    lengths = np.array(Counter(model, "", b"").lengths(keys) if keys else [], np.uint16)
    shared = df.sparkSession.sparkContext.broadcast((model, "\n".join(keys), lengths.tobytes()))

    def start():
        counter = Counter(*shared.value)
        return lambda batch: {n_tokens: counter.count([t or "" for t in batch.column(text).to_pylist()])}

    return append_columns(df, start, f"`{n_tokens}` bigint")


def over_limit(n_tokens: str | Column, limit: int) -> Column:
    return (F.col(n_tokens) if isinstance(n_tokens, str) else n_tokens) > limit

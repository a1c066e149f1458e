"""Joins that spread a hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def lookup(rows: DataFrame, facts: DataFrame, keys: Sequence[str], spread_by: Column, how: str = "inner") -> DataFrame:
    """Join rows to facts with one row per key, with the rows of one key spread over many tasks.

    The few facts are repeated once per salt; the rows are not. There are as many salts as shuffle
    partitions, so one key can reach every task. Where the facts are small enough Spark broadcasts them by
    their measured size and the salt costs nothing.
    """
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = facts.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = rows.withColumn("__salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
    named = salted.select(
        *[F.col(k).alias(f"__f{i}") for i, k in enumerate(keys)], F.col("__salt").alias("__fsalt"),
        *[c for c in facts.columns if c not in keys],
    )
    cond = spread["__salt"] == named["__fsalt"]
    for i, k in enumerate(keys):
        cond = cond & spread[k].eqNullSafe(named[f"__f{i}"])
    return spread.join(named, cond, how).drop("__salt", "__fsalt", *[f"__f{i}" for i in range(len(keys))])

"""Changes in cluster metadata observed over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from eventflow.operators.ordered import DAY, previous

NO_LEADER = -1
PARTITION = ("topic", "partition")
ORDER = ("observed_at",)


def leader_changes(
    df: DataFrame, keys: Sequence[str] = PARTITION, order: Sequence[str] = ORDER, slot: float = DAY
) -> DataFrame:
    """Observations whose leader differs from the one before; no leader counts as -1. The first
    observation of a partition is no change."""
    seen = df.select(*keys, *order, F.coalesce("leader", F.lit(NO_LEADER)).alias("new_leader"))
    return previous(seen, keys, order, {"old_leader": "new_leader"}, slot).filter(
        "old_leader IS NOT NULL AND old_leader <> new_leader"
    )


def isr_changes(
    df: DataFrame, as_set: bool = False, keys: Sequence[str] = PARTITION, order: Sequence[str] = ORDER,
    slot: float = DAY,
) -> DataFrame:
    """Changes of the in-sync replica list. Order matters unless `as_set`."""
    isr = F.array_sort("isr") if as_set else F.col("isr")
    seen = df.select(*keys, *order, F.array_join(isr.cast("array<string>"), ",").alias("new_isr"))
    return previous(seen, keys, order, {"old_isr": "new_isr"}, slot).filter(
        "old_isr IS NOT NULL AND old_isr <> new_isr"
    )


def failover_time(
    changes: DataFrame, keys: Sequence[str] = PARTITION, order: Sequence[str] = ORDER, slot: float = DAY
) -> DataFrame:
    """Milliseconds since the previous leader change of the partition; null on the first one."""
    time = order[0]
    gaps = previous(changes, keys, order, {"last_change": time}, slot)
    return gaps.withColumn("gap_ms", F.unix_millis(time) - F.unix_millis("last_change")).drop("last_change")


def cluster_state(df: DataFrame, keys: Sequence[str] = PARTITION, order: Sequence[str] = ORDER) -> DataFrame:
    """Latest leader and replica lists per partition; a missing leader reads 'NONE'."""
    fields = [c for c in ("leader", "isr", "replicas") if c in df.columns]
    latest = F.max_by(F.struct(*fields), F.struct(*order))
    state = df.groupBy(*keys).agg(latest.alias("s"), F.max(order[0]).alias(order[0]))
    lists = [
        F.array_join(F.col("s")[c].cast("array<string>"), ",").alias(c) for c in fields if c != "leader"
    ]
    return state.select(
        *keys, order[0], F.coalesce(F.col("s.leader").cast("string"), F.lit("NONE")).alias("leader"), *lists,
    )

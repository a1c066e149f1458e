"""Delivery and loss accounting by replication and acknowledgement setting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.operators.metrics import latency_counts, summarize_latencies
from eventflow.schemas import DELIVERY_RESULT

CONFIG = ("rf", "acks")

# --- fixed values: the tested (rf, acks) configurations -------------------------------------
ALL_CONFIGS = ((3, "all"), (3, "1"), (3, "0"), (2, "all"), (2, "1"), (2, "0"), (1, "1"), (1, "0"))
FAULT_CONFIGS = ((3, "all"), (3, "0"), (1, "1"), (1, "0"))
# --------------------------------------------------------------------------------------------


def add_loss(df: DataFrame) -> DataFrame:
    """Loss, rates and verdict from attempted / sent / failed / consumed counts.

    A fault run loses what was attempted but not consumed, a baseline run what was acknowledged
    but not consumed; never below zero. Both rates are over the attempts.
    """
    base = F.when(F.col("phase") == "FAULT", F.col("attempted")).otherwise(F.col("sent"))
    rate = lambda part, none: F.when(
        F.col("attempted") > 0, part * 100.0 / F.col("attempted")
    ).otherwise(F.lit(none))
    return (
        df.withColumn("lost", F.greatest(base - F.col("consumed"), F.lit(0).cast("bigint")))
        .withColumns({
            "loss_rate": rate(F.col("lost"), 0.0),
            "delivery_rate": rate(F.col("consumed"), 100.0),
            "verdict": verdict(F.col("lost"), F.col("failed")),
        })
    )


def verdict(lost: Column, failed: Column) -> Column:
    return (
        F.when((lost == 0) & (failed == 0), "PERFECT")
        .when((lost == 0) & (failed > 0), "SURVIVED")
        .otherwise("DATA LOSS")
    )


def delivery_result(df: DataFrame) -> DataFrame:
    """One row per configuration and phase."""
    counts = df.groupBy(*CONFIG, "phase").agg(
        F.count(F.lit(1)).alias("attempted"), F.count_if("acked").alias("sent"),
        F.count_if(~F.col("acked")).alias("failed"), F.count_if("consumed").alias("consumed"),
    )
    return add_loss(counts)


def delivery_result_with_latency(df: DataFrame, latency: str = "latency_ms", time: str = "cb_ts") -> DataFrame:
    """`delivery_result` plus throughput and floor-index percentiles, still in one pass."""
    by = [*CONFIG, "phase"]
    counts = latency_counts(
        df.withColumn("ok", F.col("acked")), by, latency, time,
        {"attempted": F.lit(True), "consumed": F.col("consumed")},
    )
    return add_loss(summarize_latencies(counts, by, "floor", extra=("attempted", "consumed")))


def report_rows(results: DataFrame) -> DataFrame:
    """Results under the names of `schemas.DELIVERY_RESULT`, as they are persisted."""
    names = {"failed": "sendFailed", "lost": "dropped", "loss_rate": "dropRate"}
    renamed = results.withColumnsRenamed(names)
    return renamed.select(
        *[F.col(f.name).cast(f.dataType) for f in DELIVERY_RESULT.fields if f.name in renamed.columns]
    )


def config_matrix(results: DataFrame, configs: DataFrame) -> DataFrame:
    """Report over every configuration of `configs`. An empty one has zero counts, lost nothing and
    delivered all of it."""
    counts = ("attempted", "sent", "failed", "consumed", "lost")
    joined = configs.join(results, [c for c in configs.columns], "left")
    empty = {name: 0 for name in counts} | {"loss_rate": 0.0, "delivery_rate": 100.0}
    return joined.fillna(empty).withColumn("tested", F.col("verdict").isNotNull())


def union_phases(baseline: DataFrame, fault: DataFrame) -> DataFrame:
    """Both result lists in one, tagged by phase."""
    return baseline.withColumn("phase", F.lit("BASELINE")).unionByName(
        fault.withColumn("phase", F.lit("FAULT"))
    )


def first_match(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r"))
    return picked.select(*keys, "__r.*")


def compare_phases(results: DataFrame, order: Sequence[str] = ("attempted",)) -> DataFrame:
    """Fault results next to the first baseline result of the same configuration; fault rows
    without a baseline are left out. The baseline loss is the computed one."""
    cols = ("consumed", "lost", "verdict")
    base = first_match(results.filter("phase = 'BASELINE'"), CONFIG, order)
    fault = results.filter("phase = 'FAULT'")
    return fault.select(*CONFIG, *[F.col(c).alias(f"fault_{c}") for c in cols]).join(
        base.select(*CONFIG, *[F.col(c).alias(f"base_{c}") for c in cols]), list(CONFIG)
    )


def offset_reset_report(df: DataFrame, cutoff: Column, time: str = "time") -> DataFrame:
    """What a subscriber that attaches at `cutoff` receives under each start policy.

    `earliest` replays the backlog and loses nothing of it; `latest` loses the whole backlog. Both
    losses are computed from one pass.
    """
    t = F.col(time)
    counts = df.agg(
        F.count(F.lit(1)).alias("published"), F.count_if(t <= cutoff).alias("sent_while_down"),
        F.count_if(t > cutoff).alias("after"),
    )
    policies = F.array(
        F.struct(F.lit("earliest").alias("policy"), (F.col("sent_while_down") + F.col("after")).alias("received")),
        F.struct(F.lit("latest").alias("policy"), F.col("after").alias("received")),
    )
    return counts.withColumn("p", F.explode(policies)).select(
        "p.policy", "sent_while_down", "p.received", (F.col("published") - F.col("p.received")).alias("lost")
    )


def partition_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("consumer", "part").agg(F.count(F.lit(1)).alias("records"))


def group_totals(df: DataFrame, group: str) -> DataFrame:
    return df.groupBy(F.col(group).alias("consumer_group"), "consumer").agg(
        F.count(F.lit(1)).alias("records")
    )

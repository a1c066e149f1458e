"""Reconciliation of what should be on the log with what is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.functions.scalar import document, field
from eventflow.operators.routing import lookup


def lost_messages(sent: DataFrame, consumed: DataFrame, sent_key: str, consumed_key: str) -> DataFrame:
    """Keys that were sent but never consumed, with the number of sends.

    One grouped union, combined map-side: neither many sends nor many deliveries of one key pile up.
    """
    key = sent_key
    both = sent.select(F.col(sent_key).alias(key), F.lit(1).alias("s"), F.lit(0).alias("c")).unionByName(
        consumed.select(F.col(consumed_key).alias(key), F.lit(0).alias("s"), F.lit(1).alias("c"))
    )
    return (
        both.groupBy(key)
        .agg(F.sum("s").alias("sends"), F.sum("c").alias("deliveries"))
        .filter("sends > 0 AND deliveries = 0")
        .drop("deliveries")
    )


def outbox_relay(outbox: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of the durable outbox that are not on the log yet, by event id.

    Ids are unique in the outbox; the log may repeat them, so it is reduced to distinct ids first.
    """
    seen = log.select(F.col("id").alias("__seen")).distinct()
    return outbox.join(seen, F.col("id") == F.col("__seen"), "left_anti")


def notification_audit(commands: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Commands and outcome events per (trace, notification type), flagged when no outcome exists.

    Both sides go through one grouped union instead of a join: one shuffle, combined map-side.
    """
    keys = ("traceid", "notification_type")
    both = commands.select(*keys, F.lit(1).alias("c"), F.lit(0).alias("o")).unionByName(
        outcomes.select(*keys, F.lit(0).alias("c"), F.lit(1).alias("o"))
    )
    return (
        both.groupBy(*keys)
        .agg(F.sum("c").alias("commands"), F.sum("o").alias("outcomes"))
        .filter("commands > 0")
        .withColumn("missing", F.col("outcomes") == 0)
    )


def dead_letter_recovery(dead: DataFrame, log: DataFrame, progressed: Column) -> DataFrame:
    """Per dead-lettered trace: how often the start failed, the last reason, and whether the trace
    progressed afterwards. `dead` carries `value` (the original message) and `reason`."""
    original = document(F.col("value"))
    failures = dead.select(
        "traceid", "time", "id", "reason", field(original, "type").alias("original_type"),
        F.lit(False).alias("progress"),
    )
    progress = log.filter(progressed).select(
        "traceid", "time", "id", F.lit(None).cast("string").alias("reason"),
        F.lit(None).cast("string").alias("original_type"), F.lit(True).alias("progress"),
    )
    failed = ~F.col("progress")
    return (
        failures.unionByName(progress)
        .groupBy("traceid")
        .agg(
            F.count_if(failed).alias("failures"),
            F.max(F.when(failed, F.struct("time", "id", "reason", "original_type"))).alias("last"),
            F.max(F.when(F.col("progress"), F.col("time"))).alias("progress_at"),
        )
        .filter("failures > 0")
        .select(
            "traceid", "failures", F.col("last.original_type").alias("original_type"),
            F.col("last.reason").alias("reason"),
            F.coalesce(F.col("progress_at") > F.col("last.time"), F.lit(False)).alias("recovered"),
        )
    )


def best_effort_loss(state: DataFrame, log: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Business successes without their event on the log.

    `state` has (traceid, outcome); `expected` maps an outcome to the event type it should have
    published. Publishing is best-effort, so such rows are events lost on the way.
    """
    wanted = state.filter(F.col("outcome").isin(*expected)).select(
        "traceid", lookup(F.col("outcome"), expected).alias("type"), F.lit(True).alias("wanted")
    )
    found = log.filter(F.col("type").isin(*set(expected.values()))).select(
        "traceid", "type", F.lit(False).alias("wanted")
    )
    return (
        wanted.unionByName(found)
        .groupBy("traceid", "type")
        .agg(F.count_if("wanted").alias("successes"), F.count_if(~F.col("wanted")).alias("events"))
        .filter("successes > 0 AND events = 0")
        .select("traceid", F.col("type").alias("missing_type"), "successes")
    )



"""Latency, throughput, progress and resource statistics per label.

Raw samples are reduced to counts per (label, value) before anything is ordered, so percentiles
never gather samples: the running window sees one row per distinct latency, which whole
milliseconds bound by the longest latency, however many samples a label has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.operators.joins import lookup
from eventflow.operators.ordered import DAY, HOUR, running_sum

PERCENTILES = (50, 95, 99)


def _ms(time: Column) -> Column:
    return F.unix_millis(time)


# --- counting -------------------------------------------------------------------------------

def send_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Acknowledged and failed sends. A send whose `ok` is null is unresolved and counts as neither."""
    return df.groupBy(*by).agg(
        F.count_if("ok").alias("sent"), F.count_if(~F.col("ok")).alias("failed")
    )


def throughput(sent: Column, elapsed_seconds: Column) -> Column:
    """Messages per second; 0 when no time has passed."""
    return F.when(elapsed_seconds > 0, sent / elapsed_seconds).otherwise(F.lit(0.0))


def success_rate(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Percent of resolved sends that succeeded; null when nothing was resolved."""
    return send_counts(df, by).withColumn(
        "success_rate",
        F.try_divide(F.col("sent") * 100.0, (F.col("sent") + F.col("failed")).cast("double")),
    )


def event_type_counts(df: DataFrame, time: str = "time", extra: Sequence[str] = ()) -> DataFrame:
    """Events per type and day (and further columns, such as the source)."""
    return df.groupBy("type", F.to_date(time).alias("day"), *extra).agg(F.count(F.lit(1)).alias("events"))


# --- latency --------------------------------------------------------------------------------

def latency_counts(
    df: DataFrame, by: Sequence[str], value: str = "latency_ms", time: str | None = "cb_ts",
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Counts per label and latency: the one pass over the samples that every summary builds on."""
    aggs = [F.count_if("ok").alias("__ok"), F.count_if(~F.col("ok")).alias("__failed")]
    if time:
        aggs += [F.min(_ms(F.col(time))).alias("__first"), F.max(_ms(F.col(time))).alias("__last")]
    aggs += [F.count_if(cond).alias(name) for name, cond in (extra or {}).items()]
    return df.groupBy(*by, F.col(value).alias("__x")).agg(*aggs)


def _rank_hit(kind: str, percentile: int, total: Column, cumulative: Column) -> Column:
    """True from the requested rank on. Two definitions exist and differ when n*p is whole:
    'nearest' takes element ceil(p/100*n), 'floor' the element at 0-based index floor(n*p)."""
    share = F.lit(percentile / 100.0)
    if kind == "nearest":
        return cumulative >= F.greatest(F.ceil(share * total), F.lit(1))
    if kind == "floor":
        return cumulative > F.least(F.floor(total * share), total - 1)
    raise ValueError(f"unknown percentile kind: {kind}")


def summarize_latencies(
    counts: DataFrame, by: Sequence[str], kind: str = "nearest", include_failed: bool = False,
    extra: Sequence[str] = (), timed: bool = True, slot: float | None = None,
) -> DataFrame:
    """Fold `latency_counts` into one row per label. Pass a slot of the values where a label may have
    more distinct ones than one task should order."""
    weight = F.col("__ok") + F.col("__failed") if include_failed else F.col("__ok")
    weight = F.when(F.col("__x").isNotNull(), weight).otherwise(F.lit(0))
    ranked = running_sum(
        counts.withColumn("__n", weight), by, ["__x"], {"__cum": F.col("__n")}, slot, {"__total": "__cum"}
    )
    present = F.col("__n") > 0
    value = F.when(present, F.col("__x"))
    elapsed = (F.max("__last") - F.min("__first")) / 1000.0 if timed else None
    aggs = [F.sum("__ok").alias("sent"), F.sum("__failed").alias("failed")]
    if timed:
        aggs += [elapsed.alias("elapsed_s"), throughput(F.sum("__ok"), elapsed).alias("throughput")]
    # div truncates toward zero; nullif keeps an empty label from dividing by zero
    aggs.append(F.expr("coalesce(sum(__x * __n) div nullif(sum(__n), 0), 0L)").alias("avg_ms"))
    aggs += [F.min(value).alias("min_ms"), F.max(value).alias("max_ms")]
    for p in PERCENTILES:
        hit = present & _rank_hit(kind, p, F.col("__total"), F.col("__cum"))
        aggs.append(F.coalesce(F.min(F.when(hit, F.col("__x"))), F.lit(0)).alias(f"p{p}"))
    aggs += [F.sum(name).alias(name) for name in extra]
    return ranked.groupBy(*by).agg(*aggs)


def run_summary(
    df: DataFrame, by: Sequence[str], kind: str = "nearest", include_failed: bool = False,
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Counts, throughput, truncated mean, extrema and percentiles per label."""
    counts = latency_counts(df, by, extra=extra)
    return summarize_latencies(counts, by, kind, include_failed, tuple(extra or {}))


def floor_percentiles(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Percentiles by floor index over acknowledged sends; labels without a latency give no row."""
    summary = summarize_latencies(latency_counts(df, by, time=None), by, "floor", timed=False)
    return summary.filter("sent > 0").select(*by, *[f"p{p}" for p in PERCENTILES])


def compare_by_setting(df: DataFrame, setting: str) -> DataFrame:
    """Summary per setting value; here the latency of failed sends counts too."""
    return run_summary(df, [setting], include_failed=True)


def load_scaling(df: DataFrame, threads: str = "threads") -> DataFrame:
    """Summary per thread count with the share of sends that could be read back."""
    summary = run_summary(df, [threads], extra={"consumed": F.col("consumed")})
    total = F.col("sent") + F.col("failed")
    return summary.withColumn(
        "verified_ratio", F.try_divide(F.col("consumed").cast("double"), total.cast("double"))
    )


def _starts(df: DataFrame, by: Sequence[str], time: str) -> DataFrame:
    return df.groupBy(*by).agg(F.min(_ms(F.col(time))).alias("__start"))


def latency_since_start(
    df: DataFrame, by: Sequence[str], time: str = "cb_ts", slot_ms: float = HOUR * 1000
) -> DataFrame:
    """Summary where the latency of a record is its time since the first record of its label. These
    values spread over the whole run, so a label is cut into slots of them."""
    ticks = df.groupBy(*by, _ms(F.col(time)).alias("__ms")).agg(
        F.count_if("ok").alias("__ok"), F.count_if(~F.col("ok")).alias("__failed")
    )
    timed = lookup(ticks, _starts(df, by, time), by, F.col("__ms")).withColumns({
        "__x": F.col("__ms") - F.col("__start"), "__first": F.col("__ms"), "__last": F.col("__ms"),
    })
    return summarize_latencies(timed, by, slot=slot_ms)


# --- throughput over time -------------------------------------------------------------------

def per_second_counts(
    df: DataFrame, by: Sequence[str], time: str = "cb_ts", width_ms: int = 1000
) -> DataFrame:
    """Acknowledgements per whole `width_ms` since the first record of the label, by callback time."""
    ticks = (
        df.filter("ok").groupBy(*by, _ms(F.col(time)).alias("__ms")).agg(F.count(F.lit(1)).alias("__n"))
    )
    bucket = F.floor((F.col("__ms") - F.col("__start")) / F.lit(width_ms))
    return (
        lookup(ticks, _starts(df, by, time), by, F.col("__ms"))
        .groupBy(*by, bucket.alias("bucket"))
        .agg(F.sum("__n").alias("acks"))
    )


def throughput_stats(buckets: DataFrame, by: Sequence[str], dense: bool = False) -> DataFrame:
    """Mean, minimum and maximum over the non-empty buckets; `dense` counts the empty ones up to
    the last bucket as zeros."""
    n = F.max("bucket") + 1 if dense else F.count(F.lit(1))
    low = F.when(n > F.count(F.lit(1)), F.lit(0)).otherwise(F.min("acks")) if dense else F.min("acks")
    return buckets.groupBy(*by).agg(
        n.cast("bigint").alias("buckets"), (F.sum("acks") / n).alias("avg_acks"),
        low.cast("bigint").alias("min_acks"), F.max("acks").alias("max_acks"),
    )


def progress_samples(df: DataFrame, by: Sequence[str], time: str, width: str = "5 seconds") -> DataFrame:
    """Processed count and its running total at the end of each non-empty interval."""
    counts = df.groupBy(*by, F.window(time, width).end.alias("sampled_at")).agg(
        F.count(F.lit(1)).alias("processed")
    )
    return running_sum(counts, by, ["sampled_at"], {"total": F.col("processed")}, DAY)


def progress_marks(
    df: DataFrame, by: Sequence[str], time: str, every: int = 1000, first: bool = True,
    slot: float = HOUR,
) -> DataFrame:
    """Time at which every `every`-th record of a label (and record 1 if `first`) was processed.

    Marks are read off the running totals per timestamp, so no record is numbered one by one.
    """
    counts = df.groupBy(*by, F.col(time).alias("at")).agg(F.count(F.lit(1)).alias("__n"))
    totals = running_sum(counts, by, ["at"], {"__total": F.col("__n")}, slot)
    before = F.col("__total") - F.col("__n")
    low = (F.floor(before / every) + 1) * every
    high = F.floor(F.col("__total") / every) * every
    marks = F.when(low <= high, F.sequence(low, high, F.lit(every).cast("bigint"))).otherwise(
        F.array().cast("array<bigint>")
    )
    if first and every > 1:
        marks = F.when(before == 0, F.array_append(marks, F.lit(1).cast("bigint"))).otherwise(marks)
    return totals.select(*by, "at", F.explode(marks).alias("record"))


def consumer_lag(
    produced: DataFrame, processed: DataFrame, by: Sequence[str], time: str, width: str = "5 seconds"
) -> DataFrame:
    """Backlog after each interval: everything produced so far less everything processed so far."""
    moves = produced.select(*by, F.col(time).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("c")).unionByName(
        processed.select(*by, F.col(time).alias("t"), F.lit(0).alias("p"), F.lit(1).alias("c"))
    )
    counts = moves.groupBy(*by, F.window("t", width).end.alias("at")).agg(
        F.sum("p").alias("__p"), F.sum("c").alias("__c")
    )
    totals = running_sum(counts, by, ["at"], {"produced": F.col("__p"), "processed": F.col("__c")}, DAY)
    return totals.select(
        *by, "at", "produced", "processed", (F.col("produced") - F.col("processed")).alias("lag")
    )


# --- resources ------------------------------------------------------------------------------

def resource_summary(df: DataFrame, by: Sequence[str], time: str = "ts") -> DataFrame:
    """CPU over the valid samples (negative means unknown), heap over all of them in whole MB."""
    valid = F.when(F.col("cpu_load") >= 0, F.col("cpu_load"))
    mb = 1024 * 1024
    folded = df.groupBy(*by).agg(
        F.coalesce(F.avg(valid), F.lit(0.0)).alias("avg_cpu"),
        F.coalesce(F.max(valid), F.lit(0.0)).alias("peak_cpu"),
        F.sum("heap_used").alias("__sum"), F.count(F.lit(1)).alias("samples"),
        F.max("heap_used").alias("__peak"), F.min_by("heap_max", time).alias("__max"),
    )
    return folded.select(
        *by, "samples", "avg_cpu", "peak_cpu",
        F.expr(f"__sum div samples div {mb}").alias("avg_heap_mb"),
        F.expr(f"__peak div {mb}").alias("peak_heap_mb"), F.expr(f"__max div {mb}").alias("max_heap_mb"),
    )

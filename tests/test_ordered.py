"""The block form must equal the plain window, whatever the group sizes."""

from __future__ import annotations

import pytest
from pyspark.sql import Window, functions as F

from eventflow.operators import ordered

KEYS, ORDER = ["k"], ["t", "id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, a null group, and a run of equal times."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
    )
    return spark.range(6000).select(
        key.alias("k"), F.when(F.col("id") % 6 == 0, 7).otherwise(F.hash("id") % 500).alias("t"), "id",
        F.when(F.hash("id", F.lit(3)) % 4 == 0, F.col("id")).alias("v"),
    ).persist()


@pytest.fixture(scope="module")
def window():
    return Window.partitionBy("k").orderBy("t", "id")


def same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("slot", [1, 37, 10_000])
def test_numbered(skewed, window, slot):
    same(ordered.numbered(skewed, KEYS, ORDER, "n", slot),
         skewed.withColumn("n", F.row_number().over(window).cast("bigint")))


@pytest.mark.parametrize("slot", [1, 37, 10_000])
def test_previous(skewed, window, slot):
    same(ordered.previous(skewed, KEYS, ORDER, {"pv": "v", "pid": "id"}, slot),
         skewed.withColumns({"pv": F.lag("v").over(window), "pid": F.lag("id").over(window)}))


@pytest.mark.parametrize("slot", [1, 37, 10_000, None])
def test_next_known(skewed, window, slot):
    same(ordered.next_known(skewed, KEYS, ORDER, F.col("v"), "nv", slot),
         skewed.withColumn("nv", F.first("v", True).over(window.rowsBetween(0, Window.unboundedFollowing))))


@pytest.mark.parametrize("slot", [1, 37, 10_000, None])
def test_running_sum_and_total(skewed, window, slot):
    expected = skewed.withColumns({
        "s": F.coalesce(F.sum("v").over(window.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)),
        "total": F.coalesce(F.sum("v").over(Window.partitionBy("k")), F.lit(0)),
    })
    same(ordered.running_sum(skewed, KEYS, ORDER, {"s": F.col("v")}, slot, {"total": "s"}), expected)


def test_null_and_time_order(spark):
    rows = [("a", None, 1), ("a", "2024-01-01 00:10:00", 2), ("a", "2024-01-01 00:50:00", 3), ("a", "2024-01-03 00:00:00", 4)]
    df = spark.createDataFrame(rows, "k STRING, t STRING, id BIGINT").withColumn("t", F.col("t").cast("timestamp"))
    for slot in (60, ordered.HOUR, ordered.DAY):
        got = ordered.previous(ordered.numbered(df, ["k"], ["t", "id"], "n", slot), ["k"], ["t", "id"], {"p": "id"}, slot)
        assert [(r.id, r.n, r.p) for r in got.orderBy("id").collect()] == [(1, 1, None), (2, 2, 1), (3, 3, 2), (4, 4, 3)]


def test_a_hot_group_is_spread_over_its_slots(skewed):
    placed = ordered.in_slots(skewed.filter("k = 'hot'"), KEYS, ORDER, 10)
    assert placed.select("__group").distinct().count() > 40


def test_building_a_query_runs_nothing(spark, skewed):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "")
    try:
        df = ordered.previous(ordered.numbered(skewed, KEYS, ORDER, "n", 10), KEYS, ORDER, {"p": "n"}, 10)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    same(df.select("id", "p"), skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")).cast("bigint"))
         .select("id", F.lag("n").over(Window.partitionBy("k").orderBy("t", "id")).alias("p")))


def test_one_shuffle_of_the_rows(spark, tmp_path):
    spark.range(1000).selectExpr("id % 7 AS k", "id AS t", "id").write.parquet(str(tmp_path / "rows"))
    df = ordered.numbered(spark.read.parquet(str(tmp_path / "rows")), ["k"], ["t"], "n", 100)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the rows by group and slot; the second read is combined before its shuffles, of a row per slot each
    assert text.count("Exchange hashpartitioning") <= 4 and text.count("partial_sum") == 1 and text.count("Scan parquet") == 2
    assert "ReadSchema: struct<k:bigint,t:bigint>" in text


def test_empty(spark):
    empty = spark.createDataFrame([], "k STRING, t INT, id BIGINT, v BIGINT")
    assert ordered.numbered(empty, KEYS, ORDER, "n", 5).isEmpty()
    assert ordered.previous(empty, KEYS, ORDER, {"p": "v"}, 5).isEmpty()

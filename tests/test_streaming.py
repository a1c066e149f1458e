"""Stream = batch, over several files so that state crosses micro-batches."""

from __future__ import annotations

import os
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventflow.functions.scalar import field
from eventflow.operators import envelope, routing, saga, signals
from eventflow.operators.rate_limit import rate_limit
from eventflow.plans import adapters as views
from eventflow.plans.catalog import QUERIES
from eventflow.schemas import LOG_RECORD
from eventflow.streaming import pipelines, upsert

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def split_bus(spark, tmp_path_factory):
    """The test log cut into four files by time, and the same as a stream of one file at a time."""
    bus = views.bus(spark, SF)
    root = str(tmp_path_factory.mktemp("bus"))
    for i in range(4):
        day = F.dayofmonth("time")
        part = bus.filter((day >= 1 + 8 * i) & (day < 9 + 8 * i)).coalesce(1)
        part.write.mode("append").parquet(root)
    stream = spark.readStream.schema(bus.schema).option("maxFilesPerTrigger", 1).parquet(root)
    return bus, stream


def same(a, b):
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_signup_state(split_bus):
    bus, stream = split_bus
    same(pipelines.run_update(saga.signup_state(stream), "t-state", ["traceid"]), saga.signup_state(bus))


def test_sessions(split_bus):
    bus, stream = split_bus
    closing = pipelines.Closing(stream, "time")
    out = pipelines.run_append(pipelines.signup_state_sessions(closing.stream, "2 days"), "t-sessions", closing)
    same(out.select("traceid", "state"), saga.signup_state(bus))


def test_dedup(split_bus):
    bus, stream = split_bus
    twice = stream.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).drop("n")
    same(pipelines.run_append(pipelines.dedup(twice), "t-dedup").select("id", "type"), bus.select("id", "type"))


def test_dedup_across_batches(spark, split_bus, tmp_path):
    bus, _ = split_bus
    for i in range(2):
        bus.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(bus.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    same(pipelines.run_append(pipelines.dedup(stream, "time", "60 days"), "t-dedup2").select("id", "type"), bus.select("id", "type"))
    assert pipelines.dedup(bus.unionByName(bus)).count() == bus.count()


def test_topic_counts(split_bus):
    bus, stream = split_bus
    posts = lambda df: df.select(F.col("time").alias("ts"), F.col("type").alias("topic"))
    counts = signals.topic_counts(posts(stream).withWatermark("ts", "20 days"), "1 day", "6 hours")
    out = pipelines.run_update(counts, "t-topics", ["topic", "window_start"])
    same(out.select("topic", "window_start", "posts"),
         signals.topic_counts(posts(bus), "1 day", "6 hours").select("topic", "window_start", "posts"))


def with_untimed(spark, bus, tmp_path, n):
    """The stream with some more rows whose time is null."""
    folder = str(tmp_path / "untimed")
    bus.limit(n).withColumn("time", F.lit(None).cast("timestamp")).write.parquet(folder)
    return spark.readStream.schema(bus.schema).parquet(folder)


def test_payment_timeouts(spark, split_bus, tmp_path):
    bus, stream = split_bus
    closing = pipelines.Closing(stream.unionByName(with_untimed(spark, bus, tmp_path, 9)), "time")
    out = pipelines.run_append(pipelines.payment_timeouts(closing.stream, "6 hours", "10 days"), "t-timeouts", closing)
    same(out, saga.request_outcome(bus, "6 hours").select("traceid", "id", "type", "outcome", "outcome_id"))


def test_rate_limit(spark, split_bus, tmp_path):
    bus, stream = split_bus
    closing = pipelines.Closing(stream.unionByName(with_untimed(spark, bus, tmp_path, 9)), "time")
    out = pipelines.run_append(pipelines.rate_limit_stream(closing.stream, "type", "time", 6 * 3600, "10 days"), "t-limit", closing)
    same(out, rate_limit(bus, "type", "time", 6 * 3600))


def test_sentiment_spike(split_bus):
    bus, stream = split_bus
    scored = lambda df: df.select(F.col("type").alias("topic"), F.col("time").alias("ts"), (F.col("k") % 7 - 3).alias("score"))
    closing = pipelines.Closing(scored(stream), "ts")
    out = pipelines.run_append(pipelines.sentiment_spike_stream(closing.stream, "1 day", delay="10 days"), "t-spikes", closing)
    rounded = lambda df: df.select("topic", "window_start", "posts", F.round("mean_score", 9), F.round("previous_mean", 9))
    batch = rounded(signals.sentiment_spike(scored(bus), "1 day"))
    assert batch.count() > 20
    same(rounded(out), batch)


def test_choreography_waits_for_late_decisions(spark, split_bus, tmp_path):
    bus, stream = split_bus
    parsed = lambda df: df.withColumn("data", F.to_variant_object(F.struct("tier")))
    decided = bus.groupBy("traceid").agg((F.count("*") % 2 == 0).alias("payment_success"), F.max("time").alias("decided_at"))
    expected = pipelines.choreography(parsed(bus), decided.drop("decided_at")).select("key", "value")
    for i in range(3):  # decisions come in three files, whatever the order of their requests
        decided.filter(F.pmod(F.xxhash64("traceid"), F.lit(3)) == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "decided"))
    decisions = spark.readStream.schema(decided.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "decided"))
    out = pipelines.run_append(pipelines.choreography(parsed(stream), decisions, delay="60 days"), "t-choreography")
    same(out.select("key", "value"), expected)


def test_update_of_no_rows(spark, split_bus, tmp_path):
    bus, _ = split_bus
    bus.limit(0).write.parquet(str(tmp_path / "none"))
    stream = spark.readStream.schema(bus.schema).parquet(str(tmp_path / "none"))
    assert pipelines.run_update(saga.signup_state(stream), "t-none", ["traceid"]).count() == 0


def test_start_or_dead_letter(spark, split_bus, tmp_path):
    """One bad request of many is dead-lettered alone; a good one is started once, at the second try for some."""
    bus, stream = split_bus
    requests = routing.ingress_filter(stream.withColumn("value", F.col("id")))
    bad, slow = F.col("id").cast("int") % 10 == 3, F.col("id").cast("int") % 10 == 4
    tries = {}

    def start(batch):
        ids = frozenset(r.id for r in batch.select("id").collect())
        again = any(ids < other for other in tries)
        tries[ids] = again
        failing = bad if again else bad | slow
        batch.filter(~failing).select("id").write.mode("append").parquet(str(tmp_path / "started"))
        return batch.filter(failing).select("id", F.lit("engine down").alias("reason"))

    sink = pipelines.start_sink(start, str(tmp_path / "dead"), pause_seconds=0)
    requests.writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(sink).start().awaitTermination()
    started = spark.read.parquet(str(tmp_path / "started"))
    dead = envelope.parse_envelope(envelope.event_type(spark.read.schema(LOG_RECORD).json(str(tmp_path / "dead"))))
    wanted = routing.ingress_filter(bus)
    same(started, wanted.filter(~bad).select("id"))
    same(dead.select(field(F.col("data"), "originalMessage").alias("id")), wanted.filter(bad).select("id"))
    assert {r.type for r in dead.select("type").distinct().collect()} == {"ProcessStartFailedEvent"}
    assert {r.reason for r in dead.select(field(F.col("data"), "reason").alias("reason")).distinct().collect()} == {"engine down"}
    assert dead.filter(F.col("time") < F.current_timestamp() - F.expr("INTERVAL 1 HOUR")).isEmpty()


def test_start_that_always_raises(spark, split_bus, tmp_path):
    bus, _ = split_bus
    requests = routing.ingress_filter(bus.withColumn("value", F.col("id"))).limit(5)

    def start(batch):
        raise RuntimeError("down")

    pipelines.start_sink(start, str(tmp_path / "dead"), pause_seconds=0)(requests, 0)
    assert spark.read.schema(LOG_RECORD).json(str(tmp_path / "dead")).count() == 5


@pytest.fixture(scope="module")
def shuffled(tmp_path_factory):
    """The test events in 24 files whose modification times do not follow event time."""
    root = tmp_path_factory.mktemp("shuffled")
    events = pq.read_table(f"{SF}/events.parquet").sort_by("ts")
    (root / "events.parquet").mkdir()
    order = list(range(24))
    random.Random(1).shuffle(order)
    for at, i in enumerate(order):
        first, stop = len(events) * i // 24, len(events) * (i + 1) // 24
        path = root / "events.parquet" / f"{i:02}.parquet"
        pq.write_table(events.slice(first, stop - first), path)
        os.utime(path, (1_700_000_000 + at, 1_700_000_000 + at))
    return str(root)


@pytest.mark.parametrize("name", [
    "dedup_stream", "topic_counts_stream", "payment_timeouts_stream", "rate_limited_alerts_stream", "sentiment_spike_stream",
    "signup_sessions_stream", "choreography_stream", "account_state_stream"])
def test_files_in_any_order(spark, shuffled, name):
    got, expected = QUERIES[name](spark, shuffled), QUERIES[name](spark, SF)
    assert not expected.isEmpty()
    same(got, expected)


# --- upserts ------------------------------------------------------------------------------------

def accounts_of(bus):
    return bus.withColumn("account", F.concat(F.lit("u"), F.col("user_id").cast("string")))


def test_upserts_equal_the_batch_answer(spark, split_bus, tmp_path):
    bus, stream = split_bus
    table = upsert.account_table(spark, str(tmp_path / "t"), accounts_of(bus), buckets=5)
    handled = []

    def handle(batch, batch_id):
        handled.append(batch_id)
        table.sink(upsert.account_states)(batch, batch_id)

    accounts_of(stream).writeStream.trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).foreachBatch(handle).start().awaitTermination()
    assert len(handled) >= 4
    names = ["account", "tier", "active", "updated_at"]
    same(upsert.account_view(table.read()).select(names), saga.account_state(accounts_of(bus)).select(names))
    some = spark.createDataFrame([("u1",), ("u7",), ("nobody",)], "account string")
    same(table.get(some), table.read().join(some, "account", "left_semi"))


def test_a_replayed_or_broken_batch_changes_nothing(spark, split_bus, tmp_path, monkeypatch):
    bus, _ = split_bus
    events = accounts_of(bus)
    parts = [events.filter(F.pmod(F.xxhash64("id"), F.lit(3)) == i) for i in range(3)]
    table = upsert.account_table(spark, str(tmp_path / "t"), events, buckets=3)
    sink = table.sink(upsert.account_states)
    sink(parts[0], 0)
    sink(parts[1], 1)
    after_one = table.read().collect()
    # batch 2 dies behind its data and before its manifest: nothing of it is seen
    with monkeypatch.context() as broken:
        broken.setattr(spark, "createDataFrame", lambda *a, **b: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.upsert(upsert.account_states(parts[2]), 2)
    assert sorted(map(str, table.read().collect())) == sorted(map(str, after_one))
    for _ in range(2):
        sink(parts[2], 2)
    names = ["account", "tier", "active", "updated_at"]
    whole = saga.account_state(events).select(names)
    same(upsert.account_view(table.read()).select(names), whole)
    sink(parts[0].limit(0), 3)  # an empty batch
    assert table.prune(keep=1) > 0
    same(upsert.account_view(table.read()).select(names), whole)
    assert table._batches() == [3]
    with pytest.raises(ValueError):
        upsert.account_table(spark, str(tmp_path / "t"), events, buckets=4).read()


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, n long").schema
    table = upsert.KeyedTable(spark, str(tmp_path / "t"), ["k"], schema, {"n": F.max}, buckets=16)
    table.upsert(spark.createDataFrame([(f"k{i}", i) for i in range(200)] + [(None, 1)], schema), 0)
    table.upsert(spark.createDataFrame([("k5", 1000), ("k5", 3), (None, 7)], schema), 1)
    assert len(table.manifest()) == 16 and 1 <= sum(w == 1 for w in table.manifest().values()) <= 2
    found = {r.k: r.n for r in table.read().collect()}
    assert found == {f"k{i}": i for i in range(200)} | {"k5": 1000, None: 7}
    assert table.get(spark.createDataFrame([(None,)], "k string")).collect()[0].n == 7


def test_rate_limit_of_one_key_with_very_many_alerts(spark, tmp_path):
    """A million alerts of one key wait for the watermark, and come in two files."""
    alerts = spark.range(1_000_000).select(
        F.lit("x").alias("topic"), F.timestamp_micros(1_700_000_000_000_000 + F.col("id") * 997_001).alias("ts"), "id")
    for i in range(2):
        alerts.filter(F.col("id") % 2 == i).drop("id").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("topic string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    closing = pipelines.Closing(stream, "ts")
    out = pipelines.run_append(pipelines.rate_limit_stream(closing.stream, "topic", "ts", 3600, "20 days"), "t-many", closing)
    same(out, rate_limit(alerts, "topic", "ts", 3600))


# --- final states -------------------------------------------------------------------------------

def test_final_states_once_per_trace(split_bus):
    bus, stream = split_bus
    closing, late = pipelines.Closing(stream, "time"), pipelines.LateRows()
    ends = pipelines.signup_state_final(closing.stream, 2 * 86400, 3 * 86400, 86400, "2 days")
    out = pipelines.run_append(ends, "t-final", closing, late)
    same(out.select("traceid", "state"), saga.signup_state(bus))
    last = bus.groupBy("traceid").agg(F.max("time").alias("last_at"))
    same(out.select("traceid", "last_at"), last)
    assert {(r.state in saga.END_STATES, r.ended) for r in out.collect()} == {(True, "settled"), (False, "idle")}
    # all that is left of hundreds of traces is the row that closed the stream
    assert late.state_rows <= 2 and late.rows == 0


def test_final_states_do_not_answer_twice_and_are_forgotten(spark, tmp_path):
    from datetime import datetime, timedelta

    start, schema = datetime(2024, 1, 1), "traceid string, time timestamp, type string, notification_type string"
    at = lambda hours: start + timedelta(hours=hours)
    files = [
        [("a", at(0), "SignupRequestedEvent", None), ("a", at(1), "AccountActivatedEvent", None), ("b", at(0), "SignupRequestedEvent", None)],
        [("z", at(10), "SignupRequestedEvent", None)],  # a has settled, b still waits
        [("a", at(10), "PaymentFailedEvent", None), ("b", at(10), "PaymentReceivedEvent", None)],  # a latecomer, and news
        [("z", at(60), "PaymentFailedEvent", None)],  # it came before the time had passed
        [("a", at(61), "SignupRequestedEvent", None)],  # a was forgotten long ago: this is another trace
    ]
    run = None
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        if run is None:
            stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
            closing = pipelines.Closing(stream, "time")
            run = pipelines.AppendRun(pipelines.signup_state_final(closing.stream, 4 * 3600, 20 * 3600, 20 * 3600, "1 hour"), "t-once")
        run.run()
    closing.end()
    run.run()
    found = sorted((r.traceid, r.state, r.last_at, r.ended) for r in run.answer().collect())
    assert found == [
        ("a", "ACTIVE", at(1), "settled"), ("a", "PENDING", at(61), "idle"), ("b", "CHARGED_PENDING", at(10), "idle"),
        ("z", "PAYMENT_FAILED", at(60), "idle")]


def test_final_states_are_kept_in_buckets(spark, tmp_path):
    """Traces that share a bucket are answered, remembered and forgotten each for itself; the calls of the state go by
    buckets, not by traces."""
    from datetime import datetime, timedelta

    dice, schema = random.Random(7), "traceid string, time timestamp, type string, notification_type string"
    types = ["SignupRequestedEvent", "PaymentReceivedEvent", "PaymentFailedEvent", "AccountActivatedEvent", "PaymentRefundedEvent"]
    event = lambda hours: (
        dice.choice([None, *map(str, range(300))]), datetime(2024, 1, 1) + timedelta(hours=dice.uniform(*hours)), dice.choice(types), None)
    late, runs = [pipelines.LateRows() for _ in range(2)], {}
    for i in range(4):
        part = [event((20 * i, 20 * i + 30)) for _ in range(400)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        for n, buckets in enumerate((4, 100_000)):
            if i == 0:
                closing = pipelines.Closing(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "time")
                ends = pipelines.signup_state_final(closing.stream, 4 * 3600, 20 * 3600, 10 * 3600, "3 hours", buckets)
                runs[n] = closing, pipelines.AppendRun(ends, "t-buckets", late[n])
            runs[n][1].run()
        assert 0 < late[0].state_rows <= 3 * 4 and late[1].state_rows > 100
    for closing, run in runs.values():
        closing.end()
        run.run()
    few, many = (run.answer() for _, run in runs.values())
    assert late[0].rows == late[1].rows > 0 and late[0].state_rows == late[1].state_rows == 0
    same(few, many)
    answers = few.groupBy("traceid").count()
    assert few.where("traceid IS NULL").isEmpty() and answers.where("count > 1").count() > 10
    assert {(r.state in saga.END_STATES, r.ended) for r in few.collect()} == {(True, "settled"), (False, "idle")}


def test_state_masks_are_the_rules(spark):
    flags = spark.range(1 << len(saga.FLAGS)).select("id", *[(F.col("id").bitwiseAND(1 << i) > 0).alias(f) for i, f in enumerate(saga.FLAGS)])
    by_column = {r.id: r.state for r in flags.select("id", saga.signup_state_of_flags().alias("state")).collect()}
    rules = saga.state_masks()
    by_bits = {i: next(n for n, need, no, _ in rules if i & need == need and not i & no) for i in by_column}
    assert by_bits == by_column


# --- late rows ----------------------------------------------------------------------------------

def test_late_rows_are_counted(spark, split_bus, tmp_path):
    bus, _ = split_bus
    day = F.dayofmonth("time")
    schema, folder = bus.schema, str(tmp_path / "in")
    bus.filter(day > 20).write.parquet(folder)
    stream = spark.readStream.schema(schema).parquet(folder)
    append, update = pipelines.LateRows(), pipelines.LateRows()
    run = pipelines.AppendRun(pipelines.dedup(stream, "time", "1 day"), "t-late", append)
    run.run()
    assert append.rows == 0
    bus.filter(day < 10).write.mode("append").parquet(folder)
    run.run()
    assert append.rows == bus.filter(day < 10).count() > 0
    assert append.by_operator == {"dedupeWithinWatermark": append.rows}
    same(run.answer().select("id"), bus.filter(day > 20).select("id"))
    # in one run, file after file: a batch is held against the watermark known before the one before it
    for part in (bus.filter(day > 25), bus.filter((day > 20) & (day <= 25)), bus.filter(day < 10)):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "two"))
    two = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "two"))
    counts = two.withWatermark("time", "1 day").groupBy(F.window("time", "1 hour").alias("w"), "id").count()
    out = pipelines.run_update(counts.select(F.col("w.start").alias("at"), "id", "count"), "t-late-update", ["at", "id"], update)
    assert update.by_operator == {"stateStoreSave": bus.filter(day < 10).count()} and out.count() == bus.filter(day > 20).count()

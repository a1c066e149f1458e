from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventflow.operators import envelope, routing
from eventflow.schemas import LOG_RECORD, SIGNUP_REQUEST
from eventflow.sources import checkpoints, logs, outbox

T0 = datetime(2024, 1, 1)


@pytest.fixture
def records(rows):
    df = rows([(f"k{i}", "SignupRequestedEvent" if i % 2 else "MarketAlertEvent", T0 + timedelta(minutes=i))
               for i in range(6)], "key STRING, kind STRING, time TIMESTAMP")
    event = envelope.new_event(F.col("kind"), F.struct(F.col("key").alias("name")), F.col("key"), "src", F.col("time"))
    return logs.to_records(df.select(event.alias("event")), topic="main")


@pytest.mark.parametrize("format", ["json", "parquet"])
def test_write_and_read(spark, records, tmp_path, format):
    logs.write_log(records, str(tmp_path / "log"), format)
    back = logs.read_log(spark, str(tmp_path / "log"), format)
    parsed = envelope.parse_envelope(envelope.event_type(back))
    assert {r.type for r in parsed.collect()} == {"SignupRequestedEvent", "MarketAlertEvent"}
    assert logs.read_to_end(spark, str(tmp_path / "log"), format) == 6
    assert logs.after_cutoff(parsed, F.lit(T0 + timedelta(minutes=3))).count() == 2
    assert logs.read_log(spark, str(tmp_path / "log"), format, start="latest").isEmpty()


def test_header_filter_runs_before_the_parse(spark, records, tmp_path):
    logs.write_log(records, str(tmp_path / "log"), "parquet")
    routed = routing.ingress_filter(envelope.event_type(logs.read_log(spark, str(tmp_path / "log"), "parquet")), "event_type")
    plan = envelope.parse_envelope(routed)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().index("parsejson") < plan.index("Filter")  # printed top down: the filter is below
    assert plan.lower().count("parsejson") == 1


def test_stream_copy_and_drain(spark, records, tmp_path):
    logs.write_log(records, str(tmp_path / "in"), "json")
    stream = logs.read_log(spark, str(tmp_path / "in"), "json", streaming=True).select("key", "value", "headers", "timestamp")
    query = logs.write_log(stream, str(tmp_path / "out"), "json", checkpoint=str(tmp_path / "cp"))
    assert logs.drain(query) == 6
    assert logs.read_to_end(spark, str(tmp_path / "out"), "json") == 6
    with pytest.raises(ValueError, match="checkpoint"):
        logs.write_log(stream, str(tmp_path / "out"), "json")


def test_drain_of_many_batches(spark, tmp_path):
    spark.range(130).selectExpr("CAST(id AS STRING) AS key", "CAST(id AS STRING) AS value").repartition(130).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("key STRING, value STRING").option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = logs.write_log(stream, str(tmp_path / "out"), "json", checkpoint=str(tmp_path / "cp"))
    assert logs.drain(query) == 130 == logs.read_to_end(spark, str(tmp_path / "out"), "json")


def test_equal_requests_are_different(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"userId":"u","email":"a@b","name":"Al","tier":"pro"}\n' * 3)
    read = lambda: logs.to_records(logs.read_requests(
        spark, str(tmp_path / "in"), "SignupRequestedEvent", SIGNUP_REQUEST, "web"))
    ids = [{(r.id, r.traceid) for r in envelope.parse_envelope(envelope.event_type(read())).collect()} for _ in range(2)]
    assert len(ids[0]) == 3 and len({t for _, t in ids[0]}) == 3 and ids[0] == ids[1]


def test_fan_out(spark, records, tmp_path):
    logs.write_log(records, str(tmp_path / "in"), "json")
    stream = envelope.event_type(logs.read_log(spark, str(tmp_path / "in"), "json", streaming=True))
    seen = {}
    handlers = {
        "all": lambda batch, _: seen.__setitem__("all", seen.get("all", 0) + batch.count()),
        "signups": lambda batch, _: seen.__setitem__("signups", seen.get("signups", 0) + routing.signup_only(batch, "event_type").count()),
    }
    for query in logs.fan_out(stream, handlers, str(tmp_path / "cp")).values():
        query.awaitTermination()
    assert seen == {"all": 6, "signups": 3}


def test_split_sink_is_replayable(spark, records, tmp_path):
    split = lambda batch: (batch.filter("key IS NOT NULL AND value LIKE '%Signup%'"), batch.filter("NOT value LIKE '%Signup%'"))
    handle = logs.split_sink(split, str(tmp_path / "good"), str(tmp_path / "dead"))
    for _ in range(2):
        handle(records, 0)
    assert spark.read.json(str(tmp_path / "good")).count() == 3
    assert spark.read.json(str(tmp_path / "dead")).count() == 3


def test_dead_letter_write_never_raises(records, tmp_path):
    (tmp_path / "file").write_text("x")
    assert not logs.write_dead_letter(records, str(tmp_path / "file" / "below"))
    assert logs.write_dead_letter(records, str(tmp_path / "dead"))


def test_requests(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"name":" Al\\u00a0","email":" a@b ","tier":"pro"}\n{"name":"Bo","email":"b@c","tier":"free"}\n'
    )
    for streaming in (False, True):
        df = logs.read_requests(spark, str(tmp_path / "in"), "SignupRequestedEvent", SIGNUP_REQUEST, "web", streaming)
        out = logs.to_records(df)
        if streaming:
            logs.drain(logs.write_log(out, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp")))
            out = logs.read_log(spark, str(tmp_path / "out"))
        parsed = envelope.extract_variables(envelope.parse_envelope(envelope.event_type(out))).orderBy("name").collect()
        assert [(r.name, r.email, r.tier) for r in parsed] == [("Al", "a@b", "pro"), ("Bo", "b@c", "free")]
        assert len({r.id for r in parsed}) == 2 and all(len(r.userId) == 64 for r in parsed)


def test_report(spark, rows, tmp_path):
    df = rows([("a", 1)], "label STRING, n INT")
    for format in ("parquet", "csv"):
        logs.write_report(df, str(tmp_path / format), format)
        assert spark.read.format(format).option("header", "true").load(str(tmp_path / format)).count() == 1


def test_by_type(spark, records, tmp_path):
    logs.write_by_type(envelope.event_type(records).withColumnRenamed("event_type", "type"), str(tmp_path / "types"))
    assert {p.name for p in (tmp_path / "types").iterdir() if p.is_dir()} == {"type=SignupRequestedEvent", "type=MarketAlertEvent"}


@pytest.mark.parametrize(("text", "expected"), [
    ('{"seq":7,"ts":1000,"rf":3,"acks":"all"}', (7, 1000, None, 3, "all")),
    ("msg-7-ts-1000", (7, 1000, None, None, None)), ("value-7-ts-1000", (7, 1000, None, None, None)),
    ("thread-2-msg-7", (7, None, 2, None, None)), ("msg-7", (None,) * 5), ("msg-x-ts-1", (None,) * 5),
    ("{broken", (None,) * 5), (None, (None,) * 5),
])
def test_probes(rows, text, expected):
    row = logs.parse_probe(rows([(text,)], "value STRING")).first()
    assert (row.seq, row.sent_ms, row.thread, row.rf, row.acks) == expected
    assert row.sent_at == (datetime(1970, 1, 1, 0, 0, 1) if expected[1] else None)


def test_checkpoint_dir(spark):
    assert checkpoints.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert checkpoints.run_dir(spark, "x") != checkpoints.run_dir(spark, "x")


def test_requests_in_a_large_file(spark, tmp_path):
    """One file is read by many tasks; equal lines differ, and their ids stay whatever the splits."""
    (tmp_path / "in").mkdir()
    lines = ['{"userId":"u%d","email":"a@b","name":"%s","tier":"pro"}' % (i % 5000, "x" * 40) for i in range(20_000)]
    lines += ['{"userId":"u1","email":"a@b","name":" padded","tier":"pro"}', '{"userId":"u1","email":"a@b","name":"padded","tier":"pro"}']
    (tmp_path / "in" / "a.json").write_text("\r\n".join(lines) + "\n\n  \n")
    before, found, tasks = spark.conf.get("spark.sql.files.maxPartitionBytes"), [], []
    try:
        for size in ("64k", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            tasks.append(logs._request_rows(spark, str(tmp_path / "in"), SIGNUP_REQUEST, False, "json").rdd.getNumPartitions())
            events = logs.read_requests(spark, str(tmp_path / "in"), "SignupRequestedEvent", SIGNUP_REQUEST, "web").select("event.id", "event.traceid")
            found.append({(r.id, r.traceid) for r in events.collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks[0] > 8 > tasks[1] and len(found[0]) == 20_002 and found[0] == found[1]
    small = logs.read_requests(spark, str(tmp_path / "in"), "SignupRequestedEvent", SIGNUP_REQUEST, "web")
    query = logs.land_requests(spark, str(tmp_path / "in"), "SignupRequestedEvent", SIGNUP_REQUEST, "web", str(tmp_path / "out"), str(tmp_path / "cp"))
    assert logs.drain(query) == 20_004  # with two blank lines
    landed = envelope.parse_envelope(envelope.event_type(spark.read.schema(LOG_RECORD).json(str(tmp_path / "out" / "batch=*"))))
    assert landed.select("id").exceptAll(small.select("event.id")).isEmpty() and landed.count() == 20_002


def test_requests_in_columns(spark, tmp_path):
    rows = spark.createDataFrame([("u", "a@b", "Al", "pro")] * 3 + [("v", "c@d", " Bo", "free")], "userId string, email string, name string, tier string")
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    events = logs.read_requests(spark, str(tmp_path / "in"), "SignupRequestedEvent", SIGNUP_REQUEST, "web", format="parquet")
    got = events.select("event.id", "event.data.name").collect()
    assert len({r.id for r in got}) == 4 and sorted(r.name for r in got) == ["Al", "Al", "Al", "Bo"]


def test_outbox_is_published_once(spark, rows, tmp_path):
    log, marked = str(tmp_path / "log"), str(tmp_path / "marks")

    def box(names):
        df = rows([(n, T0) for n in names], "name STRING, time TIMESTAMP")
        event = envelope.new_event(F.lit("AccountActivatedEvent"), F.struct("name"), F.col("name"), "accounts", F.col("time"))
        return df.select(event.alias("event")).select("event.id", "event")

    def published():
        return sorted(r.name for r in envelope.parse_envelope(envelope.event_type(outbox.read_published(spark, log))).select(
            F.try_variant_get("data", "$.name", "string").alias("name")).collect())

    assert outbox.relay(box("ab"), log, marked) == 1 and published() == ["a", "b"]
    assert outbox.relay(box("ab"), log, marked) == 2 and published() == ["a", "b"]  # nothing new
    assert outbox.relay(box("abcc"), log, marked) == 2 and published() == ["a", "b", "c"]
    # a relay that published and died before its marks: the next one replaces what it left
    outbox.to_records(box("de")).write.mode("overwrite").json(f"{log}/relay=3")
    assert published() == ["a", "b", "c", "d", "e"]
    assert outbox.relay(box("cdef"), log, marked) == 3 and published() == ["a", "b", "c", "d", "e", "f"]
    assert outbox.relay(box("abcdef"), log, marked) == 4 and published() == ["a", "b", "c", "d", "e", "f"]
    assert outbox.marks(spark, marked).count() == 6


def test_stream_by_type(spark, records, tmp_path):
    typed = envelope.event_type(records).withColumnRenamed("event_type", "type").drop("topic").withColumn(
        "type", F.when(~F.col("value").contains('"k1"'), F.col("type")))
    typed.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(typed.schema).parquet(str(tmp_path / "in"))
    with pytest.raises(ValueError, match="checkpoint"):
        logs.write_by_type(stream, str(tmp_path / "out"))
    for _ in range(2):  # the second run finds nothing new
        logs.write_by_type(stream, str(tmp_path / "out"), checkpoint=str(tmp_path / "cp"), types=("SignupRequestedEvent",)).awaitTermination()
    schema = typed.schema.add("original_type", "string")
    signups = logs.read_by_type(spark, str(tmp_path / "out"), schema, "SignupRequestedEvent")
    others = logs.read_by_type(spark, str(tmp_path / "out"), schema, logs.OTHER_TYPES)
    name = lambda r: r.value.split('"name":"')[1][:2]
    assert {name(r) for r in signups.collect()} == {"k3", "k5"}
    assert {(name(r), r.original_type) for r in others.collect()} == {("k0", "MarketAlertEvent"), ("k2", "MarketAlertEvent"), ("k4", "MarketAlertEvent"), ("k1", None)}
    assert "PartitionFilters: [isnotnull(type" in signups._jdf.queryExecution().executedPlan().toString()

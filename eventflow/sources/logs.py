"""Reading and writing the event log: files by default, Kafka where its connector is installed.

Records have the columns of `schemas.LOG_RECORD`, whatever the connector.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryProgress

from eventflow.functions.scalar import long_or_zero
from eventflow.operators.envelope import DEFAULT_GROUP, new_event
from eventflow.schemas import LOG_RECORD, PROBE

KAFKA = "kafka"
_LOG = logging.getLogger(__name__)
# Leading and trailing white space as a browser form trims it.
_EDGES = r"^[\s\p{Z}\x{feff}]+|[\s\p{Z}\x{feff}]+\z"

_PROBE_TEXT = r"^(?:(?:msg|value)-[0-9]+-ts-[0-9]+|thread-[0-9]+-msg-[0-9]+)\z"


def read_log(
    spark: SparkSession, location: str, format: str = "json", streaming: bool = False,
    start: str = "earliest", schema: T.StructType = LOG_RECORD, **options: str,
) -> DataFrame:
    """One topic as records.

    `location` is a folder for file formats and a topic for Kafka. A file source always replays
    the whole backlog ('earliest'); `start='latest'` keeps only records stamped after the reader
    attached. Several files may arrive at once: order by event time, never by arrival.
    """
    reader = spark.readStream if streaming else spark.read
    if format == KAFKA:
        options = {"subscribe": location, "includeHeaders": "true", **options}
        if streaming:
            options.setdefault("startingOffsets", start)
        records = reader.format(KAFKA).options(**options).load().withColumns(
            {"key": F.col("key").cast("string"), "value": F.col("value").cast("string")}
        )
        if streaming or start != "latest":
            return records
    else:
        records = reader.format(format).schema(schema).options(**options).load(location)
        if start != "latest":
            return records
    attached = spark.sql("SELECT current_timestamp()").first()[0]
    return after_cutoff(records, F.lit(attached), "timestamp")


def after_cutoff(df: DataFrame, cutoff: Column, time: str = "time") -> DataFrame:
    """Records a subscriber sees that attached at `cutoff` and asked for new ones only."""
    return df.filter(F.col(time) > cutoff)


def to_records(df: DataFrame, event: str = "event", topic: str | None = None) -> DataFrame:
    """Envelope struct column to log records, with the type repeated as a header.

    Fields that are null (such as a missing transaction) are written as JSON null.
    """
    env = F.col(event)
    header = F.struct(F.lit("type").alias("key"), F.encode(env["type"], "UTF-8").alias("value"))
    columns = [
        env["traceid"].alias("key"),
        F.to_json(env, {"ignoreNullFields": "false"}).alias("value"),
        F.array(header).alias("headers"),
        F.to_timestamp(env["time"]).alias("timestamp"),
    ]
    if topic is not None:
        columns.append(F.lit(topic).alias("topic"))
    return df.select(*columns)


def write_log(
    records: DataFrame, location: str, format: str = "json", checkpoint: str | None = None,
    acks: str = "1", once: bool = True, **options: str,
):
    """Append records. A stream needs a `checkpoint` folder and returns its StreamingQuery."""
    if format == KAFKA:
        records = records.drop("timestamp", "topic")
        options = {"topic": location, "kafka.acks": acks, **options}
    if not records.isStreaming:
        writer = records.write.format(format).mode("append").options(**options)
        return writer.save() if format == KAFKA else writer.save(location)
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint folder")
    writer = records.writeStream.format(format).option("checkpointLocation", checkpoint).options(**options)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start() if format == KAFKA else writer.start(location)


OTHER_TYPES = "other"


def write_by_type(
    df: DataFrame, location: str, format: str = "parquet", checkpoint: str | None = None,
    types: tuple[str, ...] | None = None, once: bool = True,
) -> StreamingQuery | None:
    """Land events in one folder per type, in one pass, so that readers of one type open only its files.

    With `types` all others share the folder 'other' and keep their type as `original_type`. A stream needs a
    `checkpoint` folder and returns its query; its sink notes the files of each batch, so a replayed batch
    adds none.
    """
    if types is not None:
        known = F.coalesce(F.col("type").isin(*types), F.lit(False))
        df = df.withColumn("original_type", F.col("type")).withColumn("type", F.when(known, F.col("type")).otherwise(F.lit(OTHER_TYPES)))
    if not df.isStreaming:
        df.write.format(format).mode("append").partitionBy("type").save(location)
        return None
    if checkpoint is None:
        raise ValueError("a streaming write needs a checkpoint folder")
    writer = df.writeStream.format(format).partitionBy("type").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(location)


def read_by_type(spark: SparkSession, location: str, schema: T.StructType, type_: str, format: str = "parquet") -> DataFrame:
    """The landed events of one type; only that type's folder is opened."""
    return spark.read.format(format).schema(schema).load(location).filter(F.col("type") == type_)


@dataclass
class Progress:
    """What a query has read, what its stateful operators dropped behind the watermark, by operator, and the rows of
    state it ended with."""

    rows: int
    late: dict[str, int]
    state_rows: int = 0


def followed(query: StreamingQuery, poll_seconds: float = 0.2) -> Progress:
    """Wait until an availableNow query has read everything there was; what its progress reports say.

    A query remembers its last 100 progress reports only, so they are gathered while it runs: call it
    right after the start. A report that was already gone by then is an error, not a smaller number.
    """
    reports: dict[int, StreamingQueryProgress] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(poll_seconds)
        reports.update({p.batchId: p for p in query.recentProgress})
    if reports and sorted(reports) != list(range(min(reports), max(reports) + 1)):
        raise RuntimeError("progress reports were lost between two polls")
    late: dict[str, int] = {}
    for report in reports.values():
        for operator in report.stateOperators:
            late[operator.operatorName] = late.get(operator.operatorName, 0) + operator.numRowsDroppedByWatermark
    kept = sum(o.numRowsTotal for o in reports[max(reports)].stateOperators) if reports else 0
    return Progress(sum(p.numInputRows for p in reports.values()), late, kept)


def drain(query: StreamingQuery, poll_seconds: float = 0.2) -> int:
    """Wait until an availableNow query has read everything there was; rows it read. See `followed`."""
    return followed(query, poll_seconds).rows


def read_to_end(spark: SparkSession, location: str, format: str = "json", **options: str) -> int:
    """Count the records present right now, for checks of what was delivered."""
    return read_log(spark, location, format, **options).count()


def fan_out(
    log: DataFrame, subscribers: dict[str, Callable[[DataFrame, int], None]], checkpoint_root: str,
    once: bool = True,
) -> dict[str, StreamingQuery]:
    """One independent query per subscriber: each sees every event and keeps its own position."""
    queries = {}
    for name, handle in subscribers.items():
        writer = (
            log.writeStream.queryName(name)
            .option("checkpointLocation", f"{checkpoint_root}/{name}")
            .foreachBatch(handle)
        )
        queries[name] = (writer.trigger(availableNow=True) if once else writer).start()
    return queries


def write_dead_letter(records: DataFrame, location: str, format: str = "json", **options: str) -> bool:
    """Append to the dead-letter log. A failing write is reported by the result, never raised, so
    that it cannot take the accepted records of the same batch down with it."""
    try:
        write_log(records, location, format, **options)
        return True
    except Exception as error:  # noqa: BLE001 - the caller decides what a lost dead letter means
        _LOG.error("dead-letter write to %s failed: %s", location, error)
        return False


def split_sink(
    accept: Callable[[DataFrame], tuple[DataFrame, DataFrame]], log_location: str, dead_location: str,
    format: str = "json",
) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler writing the accepted and the rejected part of each micro-batch.

    Each part goes to a folder named after the batch and replaces it, so a replayed batch rewrites
    its own rows and adds none.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = batch.persist()
        try:
            good, bad = accept(held)
            good.write.format(format).mode("overwrite").save(f"{log_location}/batch={batch_id}")
            try:
                bad.write.format(format).mode("overwrite").save(f"{dead_location}/batch={batch_id}")
            except Exception as error:  # noqa: BLE001
                _LOG.error("dead-letter write of batch %s failed: %s", batch_id, error)
        finally:
            held.unpersist()

    return handle


def read_requests(
    spark: SparkSession, location: str, type_: str, schema: T.StructType, source: str,
    streaming: bool = False, format: str = "json", group: str = DEFAULT_GROUP,
) -> DataFrame:
    """Request payloads dropped in a folder, as envelopes in `event`. Name and e-mail are trimmed.

    The event id hashes the file, the payload and its number among equal ones of that file, so equal requests
    differ and re-reading a file repeats its ids, whatever tasks read it. Large files are split over tasks. As a
    stream, where a file's rows can't be numbered without state, each file of JSON lines is one row: for
    small files only; `land_requests` takes any.
    """
    if streaming and format == "json":
        files = spark.readStream.format("text").option("wholetext", True).load(location)
        split = files.select(F.col("_metadata.file_path").alias("__file"), F.split("value", r"\r?\n").alias("__lines"))
        lines = split.select("__file", "__lines", F.posexplode("__lines").alias("__at", "__row"))
        number = F.size(F.filter(F.slice("__lines", 1, F.col("__at") + 1), lambda x: x == F.col("__row")))
        numbered = lines.filter(F.trim("__row") != "").select("__file", "__row", number.cast("bigint").alias("__number"))
    elif streaming:
        numbered = _request_rows(spark, location, schema, True, format).withColumn("__number", F.lit(1).cast("bigint"))
    else:
        numbered = _numbered(_request_rows(spark, location, schema, False, format))
    return _requests(numbered, type_, schema, source, format, group)


def land_requests(
    spark: SparkSession, location: str, type_: str, schema: T.StructType, source: str, out: str, checkpoint: str,
    format: str = "json", out_format: str = "json", group: str = DEFAULT_GROUP, once: bool = True,
) -> StreamingQuery:
    """Requests as they arrive in a folder, landed as records of the log in `out`, with the ids of `read_requests`.

    A file belongs to one micro-batch as a whole, and its rows are counted there. A batch replaces its own
    folder, so a replayed one adds nothing.
    """
    def land(batch: DataFrame, batch_id: int) -> None:
        events = _requests(_numbered(batch), type_, schema, source, format, group)
        to_records(events).write.format(out_format).mode("overwrite").save(f"{out}/batch={batch_id}")

    writer = _request_rows(spark, location, schema, True, format).writeStream.option("checkpointLocation", checkpoint).foreachBatch(land)
    return (writer.trigger(availableNow=True) if once else writer).start()


def _request_rows(spark: SparkSession, location: str, schema: T.StructType, streaming: bool, format: str) -> DataFrame:
    """(file, row): each request as its line of JSON, or as its payload for formats with columns."""
    reader = spark.readStream if streaming else spark.read
    file = F.col("_metadata.file_path").alias("__file")
    if format == "json":
        lines = reader.format("text").load(location).select(file, F.regexp_replace("value", r"\r\z", "").alias("__row"))
        return lines.filter(F.trim("__row") != "")
    return reader.format(format).schema(schema).load(location).select(file, F.struct(*schema.fieldNames()).alias("__row"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Equal rows of a file, numbered from 1. They are counted map-side, so their order does not matter."""
    counted = rows.groupBy("__file", "__row").agg(F.count(F.lit(1)).alias("__n"))
    return counted.select("__file", "__row", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")).alias("__number"))


def _requests(numbered: DataFrame, type_: str, schema: T.StructType, source: str, format: str, group: str) -> DataFrame:
    parsed, raw = (F.from_json("__row", schema), F.col("__row")) if format == "json" else (F.col("__row"), F.to_json("__row"))
    rows = numbered.select("__file", "__number", raw.alias("__raw"), parsed.alias("__r")).select("__file", "__number", "__raw", "__r.*")
    trimmed = rows.withColumns(
        {c: F.regexp_replace(c, _EDGES, "") for c in ("name", "email") if c in schema.fieldNames()}
    )
    payload = F.struct(*[F.col(c) for c in schema.fieldNames()])
    key = F.concat_ws(":", "__file", "__number", "__raw")
    return trimmed.withColumn("__key", key).select(
        new_event(F.lit(type_), payload, F.col("__key"), source, F.current_timestamp(), group=group).alias("event")
    )


def write_report(df: DataFrame, location: str, format: str = "parquet") -> None:
    """Persist result rows; 'csv' gets a header line."""
    writer = df.write.format(format).mode("overwrite")
    (writer.option("header", "true") if format == "csv" else writer).save(location)


def parse_probe(df: DataFrame, value: str = "value") -> DataFrame:
    """Decode probe messages: JSON `{seq, ts, rf, acks}`, or the texts `msg-<n>-ts-<ms>`,
    `value-<n>-ts-<ms>` and `thread-<t>-msg-<n>`. Fields a form lacks are null."""
    text = F.col(value)
    looks_json = text.startswith("{")
    parsed = df.withColumns({
        "__probe": F.when(looks_json, F.from_json(text, PROBE)),
        "__parts": F.when(~looks_json & text.rlike(_PROBE_TEXT), F.split(text, "-")),
    })
    json, parts = F.col("__probe"), F.col("__parts")
    threaded = F.coalesce(F.get(parts, 0) == "thread", F.lit(False))
    first, second = long_or_zero(F.get(parts, 1)), long_or_zero(F.get(parts, 3))
    out = parsed.withColumns({
        "seq": F.coalesce(json["seq"], F.when(threaded, second).otherwise(F.when(parts.isNotNull(), first))),
        "sent_ms": F.coalesce(json["ts"], F.when(parts.isNotNull() & ~threaded, second)),
        "thread": F.when(threaded, first), "rf": json["rf"], "acks": json["acks"],
    })
    return out.withColumn("sent_at", F.timestamp_millis("sent_ms")).drop("__probe", "__parts")

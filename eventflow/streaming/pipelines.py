"""Streaming forms. Every input needs a TIMESTAMP event time; cast TIMESTAMP_NTZ columns first.

Late rows: what arrives behind the watermark is dropped from windowed and deduplicated state. The
per-trace states carry no watermark of their own and take late rows into account.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime
from time import sleep

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from eventflow.operators.domain import dead_letter_event, payment_event_legacy
from eventflow.operators.routing import signup_only
from eventflow.operators.saga import PAYMENT_OUTCOMES, flag_bits, signup_flags, signup_state_of_flags, state_masks
from eventflow.operators.signals import SENTIMENT_DELTA, window_means
from eventflow.schemas import MAX_ATTEMPTS, REQUEST_TYPES
from eventflow.sources.checkpoints import run_dir
from eventflow.sources.logs import Progress, followed, to_records
from eventflow.streaming.processors import BlockTimes, GreedyChain, PreviousMean, TraceEnd, combined

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER_CONF = "spark.sql.streaming.stateStore.providerClass"
# No event is as late as this; the row that ends a bounded stream is. Nanoseconds since 1970 still hold it.
END_OF_TIME = datetime(2200, 1, 1)
CLOSING_TIME = datetime(2200, 1, 2)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which spills to disk; the keyed processors
    need it. A stream takes its settings along when it starts, so the session's own stays as it was."""
    before = spark.conf.get(_PROVIDER_CONF, None)
    spark.conf.set(_PROVIDER_CONF, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER_CONF)
        else:
            spark.conf.set(_PROVIDER_CONF, before)


def dedup(df: DataFrame, time: str = "time", delay: str = "1 hour") -> DataFrame:
    """First event per id. A stream forgets an id once the watermark has passed it; a batch keeps the
    row `dropDuplicates` meets first, combined map-side, so many copies of one id do not pile up."""
    if df.isStreaming:
        return df.withWatermark(time, delay).dropDuplicatesWithinWatermark(["id"])
    return df.dropDuplicates(["id"])


def signup_state_sessions(df: DataFrame, idle: str, delay: str = "1 hour") -> DataFrame:
    """Final state per trace once it has been idle for `idle`, in append mode.

    Unlike `saga.signup_state` on a stream, which keeps every trace for ever, a trace's state is
    dropped when its session closes. A trace that wakes up later gets a second row.
    """
    marked = df.withWatermark("time", delay)
    flags = signup_flags(marked, "traceid", F.session_window("time", idle).alias("w"))
    return flags.select(
        "traceid", F.col("w.start").alias("first_at"), F.col("w.end").alias("closed_at"),
        signup_state_of_flags().alias("state"),
    )


def signup_state_final(
    df: DataFrame, settle_seconds: int, idle_seconds: int, remember_seconds: int, delay: str = "1 hour", buckets: int = 1024
) -> DataFrame:
    """The final state of each trace, exactly once: (traceid, state, last_at, ended), in append mode.

    A trace in a state that ends its transaction is answered `settle_seconds` of event time after its last event
    ('settled'); one that still waits for something, `idle_seconds` after it ('idle'). What comes for a trace
    within `remember_seconds` of its answer is left out, as is what is behind the watermark; after that time the
    trace is forgotten altogether, so the state is what is open and what ended lately. Equals
    `saga.signup_state` as long as no trace pauses longer than that. Events without a trace or a time are left out.
    The state is kept in `buckets` of traces by the hash of their ids. A micro-batch rewrites the buckets it has events
    of, so more of them suit a larger state, and fewer larger batches; their number stays as it is for a checkpoint.
    Start it inside `rocksdb_state`, as `run_append` does.
    """
    said = df.filter(F.col("time").isNotNull()).select("traceid", F.unix_micros("time").alias("us"), flag_bits().alias("bits"))
    short = said.mapInArrow(combined, "traceid STRING, us LONG, bits LONG").withColumn("time", F.timestamp_micros("us"))
    bucket = F.pmod(F.xxhash64("traceid"), F.lit(buckets)).alias("bucket")
    ends = short.withWatermark("time", delay).select(bucket, "*").groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=TraceEnd(state_masks(), settle_seconds * 1000, idle_seconds * 1000, remember_seconds * 1000),
        outputStructType="traceid STRING, state STRING, us LONG, ended STRING", outputMode="Append", timeMode="EventTime",
    )
    return ends.select("traceid", "state", F.timestamp_micros("us").alias("last_at"), "ended")


def payment_timeouts(df: DataFrame, timeout: str = "5 minutes", delay: str = "1 minute") -> DataFrame:
    """First payment outcome per request within `timeout`, else TIMEOUT; one row per request, once the
    watermark has passed its deadline. Equals `saga.request_outcome` on what was not late.

    A left outer interval join of the stream with itself, then the earliest match of each request; both
    keep their state per trace and drop it with the watermark. Events without a time can have no deadline
    and are left out.
    """
    timed = df.filter(F.col("time").isNotNull()).withWatermark("time", delay)

    def some(types: tuple[str, ...]) -> DataFrame:
        # one condition on the time as well, so that it is not moved below the watermark: every event counts there
        return timed.filter(F.when(F.col("time") < F.lit(END_OF_TIME), F.col("type").isin(*types)).otherwise(F.lit(False)))

    requests = some(REQUEST_TYPES).select("traceid", "id", "type", "time")
    outcomes = some(PAYMENT_OUTCOMES).select(
        F.col("traceid").alias("o_traceid"), F.col("id").alias("o_id"), F.col("type").alias("o_type"), F.col("time").alias("o_time")
    )
    in_time = F.col("o_time").between(F.col("time"), F.col("time") + F.expr(f"INTERVAL {timeout}"))
    met = requests.join(outcomes, (F.col("traceid") == F.col("o_traceid")) & in_time, "left_outer")
    first = F.min(F.when(F.col("o_id").isNotNull(), F.struct("o_time", "o_id", "o_type"))).alias("o")
    return met.groupBy("traceid", "id", "type", "time").agg(first).select(
        "traceid", "id", "type", F.coalesce("o.o_type", F.lit("TIMEOUT")).alias("outcome"), F.col("o.o_id").alias("outcome_id")
    )


def rate_limit_stream(
    alerts: DataFrame, key: str, time: str, interval_seconds: int, delay: str = "1 minute"
) -> DataFrame:
    """Streaming form of `rate_limit`: alerts pass in event-time order once the watermark is past them, and
    up to an eighth of the interval later. A key's alerts wait in blocks of that length, each a state and a
    task's work of its own; the state of the key itself is the last alert let through, as long as it matters.
    Alerts without a time are left out. Start it inside `rocksdb_state`, as `run_append` does."""
    width = interval_seconds * 1_000_000
    block = max(width // 8, 1000)
    blocks = (
        alerts.filter(F.col(time).isNotNull()).select(F.col(key).cast("string").alias("key"), F.col(time).alias("time"))
        .withWatermark("time", delay)
        .withColumn("us", F.unix_micros("time"))
        .withColumn("block", F.floor(F.col("us") / F.lit(block)).cast("bigint"))
        .groupBy("key", "block")
        .transformWithStateInPandas(
            statefulProcessor=BlockTimes(block), outputStructType="key STRING, times ARRAY<LONG>, at TIMESTAMP",
            outputMode="Append", timeMode="EventTime", eventTimeColumnName="at",
        )
    )
    return (
        blocks.groupBy("key")
        .transformWithStateInPandas(
            statefulProcessor=GreedyChain(width, block), outputStructType="key STRING, us LONG",
            outputMode="Append", timeMode="EventTime",
        )
        .select(F.col("key").alias(key), F.timestamp_micros("us").alias(time))
    )


def sentiment_spike_stream(
    scored: DataFrame, width: str = "5 minutes", delta: float = SENTIMENT_DELTA, delay: str = "1 minute"
) -> DataFrame:
    """Streaming form of `signals.sentiment_spike`: a window is compared with the topic's previous
    non-empty one as soon as the watermark has closed it. The state of a topic is one mean. Start it inside
    `rocksdb_state`, as `run_append` does."""
    means = window_means(scored.filter(F.col("ts").isNotNull()).withWatermark("ts", delay), width)
    return (
        means.groupBy("topic").transformWithStateInPandas(
            statefulProcessor=PreviousMean(delta), outputMode="Append", timeMode="None",
            outputStructType="topic STRING, window_start TIMESTAMP, posts LONG, mean_score DOUBLE, previous_mean DOUBLE",
        )
    )


def choreography(
    requests: DataFrame, decisions: DataFrame, source: str = "eventflow", within: str = "1 day", delay: str = "1 hour"
) -> DataFrame:
    """Signup requests answered straight from the log, without an orchestrator: parsed requests in,
    log records of their payment outcome out.

    `decisions` (traceid, payment_success) is what the payment provider answered. As a stream it also has
    `decided_at` and waits for its request, or is waited for, up to `within` in event time. A request
    without a decision publishes nothing.
    """
    asked = signup_only(requests)
    if not decisions.isStreaming:
        return to_records(payment_event_legacy(asked.join(decisions, "traceid"), source))
    asked = asked.filter(F.col("time").isNotNull()).withWatermark("time", delay)
    decided = decisions.filter(F.col("decided_at").isNotNull()).withWatermark("decided_at", delay).select(
        F.col("traceid").alias("__traceid"), "payment_success", "decided_at")
    span = F.expr(f"INTERVAL {within}")
    near = F.col("decided_at").between(F.col("time") - span, F.col("time") + span)
    answered = asked.join(decided, (F.col("traceid") == F.col("__traceid")) & near).drop("__traceid", "decided_at")
    return to_records(payment_event_legacy(answered, source))


def start_sink(
    start: Callable[[DataFrame], DataFrame | None], dead_location: str, format: str = "json",
    max_attempts: int = MAX_ATTEMPTS, pause_seconds: float = 0.5, source: str = "eventflow",
) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler that hands requests to `start` with a bounded number of tries each, and
    dead-letters those that failed in all of them.

    `start` gives back the rows it could not start as (id, reason), or None if there are none; only those
    are tried again. If it raises, all it was given count as failed. Rows need id, type, traceid, time
    and the original text in `value`; ids are unique. The dead letters of a batch replace its folder, so
    a replayed batch adds none twice; they carry the time of the last failure.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        root = run_dir(spark, "starts")
        waiting = batch.withColumn("reason", F.lit("").cast("string"))
        for attempt in range(max_attempts):
            if attempt:
                sleep(pause_seconds)
            try:
                failed = start(waiting.drop("reason"))
                if failed is None:
                    return
                reasons = failed.select("id", F.col("reason").cast("string").alias("reason"))
                waiting = waiting.drop("reason").join(reasons, "id")
            except Exception as error:  # noqa: BLE001 - any failure counts as a failed start
                waiting = waiting.withColumn("reason", F.lit(str(error)))
            path = f"{root}/{attempt}"
            waiting.write.parquet(path)  # what is tried again must not change with another look at the failures
            waiting = spark.read.schema(waiting.schema).parquet(path)
            if waiting.isEmpty():
                return
        dead = dead_letter_event(waiting.withColumn("failed_at", F.current_timestamp()), source, failed_at="failed_at")
        to_records(dead).write.format(format).mode("overwrite").save(f"{dead_location}/batch={batch_id}")

    return handle


# --- running a bounded stream to its end ------------------------------------------------------

class Closing:
    """A second input of a bounded stream that ends it.

    It is empty until all else was read, and then holds one row without content, later than any deadline,
    so that the watermark passes everything that waits. `stream` is the input together with it; give it
    to the operators and this to `run_append`.
    """

    def __init__(self, stream: DataFrame, time: str):
        self.spark, self.time = stream.sparkSession, time
        self.schema = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema])
        self.folder = run_dir(self.spark, "closing")
        self._write([])
        self.stream = stream.unionByName(self.spark.readStream.schema(self.schema).parquet(self.folder))

    def _write(self, rows: list) -> None:
        self.spark.createDataFrame(rows, self.schema).write.mode("append").parquet(self.folder)

    def end(self) -> None:
        self._write([tuple(CLOSING_TIME if f.name == self.time else None for f in self.schema)])


class LateRows:
    """What streams dropped because it was behind the watermark, summed over their batches and operators; and the
    rows of state the last one ended with.

    Hand it to `run_append` or `run_update`. An operator counts the rows that reach it: events, or what a first
    aggregate on the same machine has made of them; a row that is late for two operators counts at both.
    """

    def __init__(self) -> None:
        self.by_operator: dict[str, int] = {}
        self.state_rows = 0

    @property
    def rows(self) -> int:
        return sum(self.by_operator.values())

    def add(self, progress: Progress) -> None:
        for name, rows in progress.late.items():
            self.by_operator[name] = self.by_operator.get(name, 0) + rows
        self.state_rows = progress.state_rows


class AppendRun:
    """An append-mode stream that is run over what is there, as often as there is more; `answer` is its output so far."""

    def __init__(self, df: DataFrame, name: str, late: LateRows | None = None):
        self.df, self.late, self.root = df, late, run_dir(df.sparkSession, name)

    def run(self) -> None:
        with rocksdb_state(self.df.sparkSession):
            query = self.df.writeStream.format("parquet").outputMode("append").trigger(availableNow=True).option(
                "checkpointLocation", f"{self.root}/checkpoint").option("path", f"{self.root}/data").start()
        _end(query, self.late)

    def answer(self) -> DataFrame:
        return self.df.sparkSession.read.schema(self.df.schema).parquet(f"{self.root}/data")


def _end(query: StreamingQuery, late: LateRows | None) -> None:
    if late is None:
        query.awaitTermination()
    else:
        late.add(followed(query))


def run_append(df: DataFrame, name: str, closing: Closing | None = None, late: LateRows | None = None) -> DataFrame:
    """Run an append-mode stream over what is there now; its output as a batch DataFrame. With `closing`
    the stream is run once more to its very end, so that nothing is left waiting. `late` gets what was too late."""
    runs = AppendRun(df, name, late)
    runs.run()
    if closing is not None:
        closing.end()
        runs.run()
    return runs.answer()


def run_update(df: DataFrame, name: str, keys: list[str], late: LateRows | None = None) -> DataFrame:
    """Run an update-mode stream over what is there now; the latest row per key as a batch DataFrame.

    Each micro-batch replaces a folder of its own, so a replayed batch does not add rows twice. `late` gets what
    was too late.
    """
    spark = df.sparkSession
    root = run_dir(spark, name)

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/data/batch={batch_id}")

    query = (
        df.writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", f"{root}/checkpoint").foreachBatch(land).start()
    )
    _end(query, late)
    schema = T.StructType([*df.schema.fields, T.StructField("batch", T.LongType())])
    landed = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(f"{root}/data*")
    rest = [c for c in df.columns if c not in keys]
    latest = landed.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("r"))
    return latest.select(*keys, "r.*")

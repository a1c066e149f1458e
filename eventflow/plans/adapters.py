"""Event-log views over the star-schema test tables, used by the query catalog and the tests.

Deterministic: no current time, no randomness. Times are TIMESTAMP in UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventflow.functions.scalar import iso_time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev_of(table(spark, sf_dir, "events"))


def ev_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id", "CAST(ts AS TIMESTAMP) AS ts", "user_id", "event_type", "value",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k",
    )


def bus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bus_of(ev(spark, sf_dir))


def bus_of(events: DataFrame) -> DataFrame:
    """Business events: one trace per user and day."""
    return events.selectExpr(
        "CAST(event_id AS STRING) AS id",
        "ts AS time",
        "concat('u', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS traceid",
        "user_id", "k", "value",
        """CASE event_type
             WHEN 'signup' THEN CASE k % 4 WHEN 0 THEN 'UpgradeRequestedEvent'
               WHEN 1 THEN 'AccountDeactivationRequestedEvent' ELSE 'SignupRequestedEvent' END
             WHEN 'purchase' THEN 'PaymentReceivedEvent'
             WHEN 'error' THEN CASE k % 4 WHEN 0 THEN 'PaymentRefundedEvent'
               WHEN 1 THEN 'PaymentRefundFailedEvent' ELSE 'PaymentFailedEvent' END
             WHEN 'view' THEN CASE WHEN k % 10 = 0 THEN 'ProcessStartFailedEvent'
               ELSE 'AccountActivatedEvent' END
             ELSE 'NotificationSentEvent' END AS type""",
        """CASE WHEN event_type = 'click' THEN CASE k % 7 WHEN 0 THEN 'AccountActivationFailedEvent'
             WHEN 1 THEN 'SignupValidationFailedEvent' WHEN 2 THEN 'TechnicalError'
             WHEN 3 THEN 'PaymentReceivedEvent' WHEN 4 THEN 'UpgradeCompletedEvent'
             WHEN 5 THEN 'AccountDeactivatedEvent' ELSE 'SomethingUnknown' END END AS notification_type""",
        "CASE k % 4 WHEN 0 THEN 'free' WHEN 1 THEN 'PRO' WHEN 2 THEN 'Enterprise' ELSE 'GOLD' END AS tier",
        """CASE WHEN event_type IN ('purchase', 'error') THEN CASE k % 4 WHEN 1 THEN 1900L
             WHEN 2 THEN 9900L ELSE 0L END END AS payment_amount""",
        """CASE WHEN event_type = 'purchase' AND k % 9 <> 0
             THEN concat('tx-', CAST(event_id AS STRING)) END AS transaction_id""",
        "(k % 2 = 1) AS retry_payment",
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS user_id",
        "CASE WHEN c_custkey % 25 = 0 THEN '  ' ELSE c_name END AS name",
        """CASE c_custkey % 10 WHEN 0 THEN 'invalid-email' WHEN 1 THEN '@example.com' WHEN 2 THEN 'user@'
             ELSE concat('u', CAST(c_custkey AS STRING), '@example.com') END AS email""",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'gold' WHEN 'MACHINERY' THEN 'Pro'
             WHEN 'AUTOMOBILE' THEN 'ENTERPRISE' ELSE 'free' END AS tier""",
    )


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(l_linenumber % 3 + 1 AS INT) AS rf",
        "CASE l_returnflag WHEN 'A' THEN 'all' WHEN 'R' THEN '1' ELSE '0' END AS acks",
        "CASE l_linestatus WHEN 'F' THEN 'FAULT' ELSE 'BASELINE' END AS phase",
        "CAST(l_orderkey % 4 AS INT) AS part",
        "concat('c', CAST(l_suppkey % 2 AS STRING)) AS consumer",
        "(l_discount > 0) AS acked", "(l_tax > 0) AS consumed",
    )


def probes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat(l_returnflag, l_linestatus) AS label", "CAST(l_quantity AS BIGINT) AS latency_ms",
        "(l_discount > 0) AS ok", "CAST(l_shipdate AS TIMESTAMP) AS cb_ts", "l_linenumber AS threads",
        "(l_tax > 0) AS consumed",
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev(spark, sf_dir).selectExpr(
        "user_id % 5 AS run", "ts",
        "CASE WHEN k % 7 = 0 THEN CAST(-1 AS DOUBLE) ELSE CAST(k AS DOUBLE) / 100 END AS cpu_load",
        "k * 1048576 + user_id AS heap_used", "CAST(536870912 AS BIGINT) AS heap_max",
    )


def cluster_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev(spark, sf_dir).selectExpr(
        "'t' AS topic", "CAST(user_id % 3 AS INT) AS partition", "event_id AS obs_id", "ts AS observed_at",
        "CASE WHEN k % 10 = 0 THEN NULL ELSE CAST(k % 3 AS INT) END AS leader",
        "CASE k % 4 WHEN 0 THEN '' WHEN 1 THEN '1' WHEN 2 THEN '1,2' ELSE '2,1' END AS isr_text",
    ).withColumn(
        "isr",
        F.when(F.col("isr_text") == "", F.array().cast("array<int>")).otherwise(
            F.split("isr_text", ",").cast("array<int>")
        ),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS symbol", "CAST(ts AS TIMESTAMP) AS ts", "value AS price"
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_of(ev(spark, sf_dir))


def posts_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS post_id", "ts", "event_type AS topic",
        "CASE WHEN k < 33 THEN -1 WHEN k < 66 THEN 0 ELSE 1 END AS score",
        "CASE WHEN k % 5 = 0 THEN 'app.bsky.feed.like' ELSE 'app.bsky.feed.post' END AS record_type",
    )


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev(spark, sf_dir).selectExpr(
        "concat('s', CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS start_id",
        "event_id", "ts", "(k % 3 = 0) AS ok",
        "CASE WHEN k % 4 = 0 THEN ' ' ELSE concat('err', CAST(k % 3 AS STRING)) END AS reason",
    )


def raw_log(events: DataFrame) -> DataFrame:
    """`bus` rows as log records: JSON envelope, type header, and a payload per request type with
    absent fields, text and numeric flags, blank trace ids and a body type that sometimes differs."""
    payload = F.expr(
        """named_struct(
          'userId', CASE WHEN k % 5 <> 0 THEN concat('u', CAST(user_id AS STRING)) END,
          'name', concat('User ', CAST(user_id AS STRING)),
          'email', concat('u', CAST(user_id AS STRING), '@example.com'),
          'tier', CASE WHEN type <> 'UpgradeRequestedEvent' THEN tier END,
          'currentTier', CASE WHEN type = 'UpgradeRequestedEvent' THEN 'free' END,
          'targetTier', CASE WHEN type = 'UpgradeRequestedEvent' THEN tier END,
          'reason', CASE WHEN k % 3 <> 0 THEN concat('r', CAST(k AS STRING)) END,
          'forceActivationFailure', (k % 3 = 1),
          'forcePaymentFailure', CASE k % 4 WHEN 2 THEN 'true' WHEN 3 THEN 'TRUE' END,
          'forcePaymentError', k % 7)"""
    )
    envelope = F.struct(
        F.expr("CASE WHEN k % 50 = 0 THEN 'OtherEvent' ELSE type END").alias("type"), "id",
        F.lit("tests").alias("source"), iso_time(F.col("time")).alias("time"), payload.alias("data"),
        F.lit("application/json").alias("datacontenttype"), F.lit("1.0").alias("specversion"),
        F.expr("CASE WHEN k % 6 = 0 THEN ' ' ELSE traceid END").alias("traceid"),
        F.lit(None).cast("string").alias("correlationid"), F.lit("events").alias("group"),
    )
    header = F.struct(F.lit("type").alias("key"), F.encode("type", "UTF-8").alias("value"))
    return events.select(
        F.col("traceid").alias("key"), F.to_json(envelope).alias("value"), F.array(header).alias("headers"),
        F.col("time").alias("timestamp"),
    )

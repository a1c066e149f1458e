"""The registered queries: each operator over the test tables. Times come out as epoch microseconds."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventflow.functions.scalar import (
    blank_or_null, bool_lenient, bool_parse, bool_strict, coalesce_null, document, field, long_or_zero,
    number_to_long, price_for_tier, str_or_empty, text_or,
)
from eventflow.operators import audit, cluster, delivery, domain, envelope, metrics, routing, saga, signals
from eventflow.operators.rate_limit import rate_limit, rate_limit_tumbling
from eventflow.plans import adapters as views
from eventflow.schemas import (
    ACTIVATION_FAILED, LOG_RECORD, NOTIFICATION_SENT, PAYMENT_FAILED, PAYMENT_RECEIVED,
    PROCESS_START_FAILED_EVENT, REQUEST_TYPES, SIGNUP_REQUEST, SIGNUP_REQUESTED, TECHNICAL_ERROR,
)
from eventflow.sources import logs, outbox
from eventflow.sources.checkpoints import run_dir
from eventflow.streaming import pipelines, upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters that suit the sparse test events (the library defaults are far shorter).
HORIZON = "6 hours"
MONTH = "30 days"
KEYWORDS = ("thre", "ble", "from")
LEXICON = {"the": 1, "this": 1, "from": 1, "was": -1, "that": -1}
WATCHLIST = ("purchase", "view")
CUTOFF = "2024-01-16 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _us(column: str, name: str | None = None) -> Column:
    return F.unix_micros(column).alias(name or f"{column}_us")


# --- state per transaction ------------------------------------------------------------------

@query
def outcome_summary(spark, sf):
    return saga.outcome_summary(saga.signup_state(views.bus(spark, sf)))


@query
def trace_state(spark, sf):
    return saga.signup_state(views.bus(spark, sf))


@query
def trace_timeline(spark, sf):
    return saga.trace_timeline(views.bus(spark, sf)).select("traceid", "seq", "id", "type", _us("time"))


@query
def payment_state(spark, sf):
    return saga.payment_state(views.bus(spark, sf))


@query
def upgrade_state(spark, sf):
    return saga.upgrade_state(views.bus(spark, sf))


@query
def deactivation_state(spark, sf):
    return saga.deactivation_state(views.bus(spark, sf))


@query
def parallel_ready(spark, sf):
    return saga.parallel_ready(views.bus(spark, sf)).select(
        "traceid", "notification_done", "eligibility_done", "ready", _us("ready_at")
    )


# --- routing and envelopes ------------------------------------------------------------------

@query
def ingress_routes(spark, sf):
    routed = routing.ingress_filter(envelope.event_type(views.raw_log(views.bus(spark, sf))), "event_type")
    parsed = envelope.extract_variables(routing.route_process(envelope.parse_envelope(routed)))
    return parsed.select(
        "id", "traceid", "process_id", F.col("userId").alias("user_id"), "name", "email", "tier",
        F.col("currentTier").alias("current_tier"), F.col("targetTier").alias("target_tier"), "reason",
        F.col("forceActivationFailure").alias("force_activation_failure"),
        F.col("forcePaymentFailure").alias("force_payment_failure"),
        F.col("forcePaymentError").alias("force_payment_error"),
    )


@query
def notification_routes(spark, sf):
    bus = views.bus(spark, sf)
    direct = routing.route_notifications_legacy(bus).select(
        "id", F.lit("log").alias("channel"), "template", F.lit(None).cast("boolean").alias("sent"),
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("outcome_type"),
    )
    payload = F.to_variant_object(F.expr(
        """named_struct('name', CASE WHEN k % 6 <> 0 THEN concat('User ', CAST(user_id AS STRING)) END,
           'email', concat('u', CAST(user_id AS STRING), '@example.com'), 'tier', tier)"""
    ))
    commands = bus.filter("notification_type IS NOT NULL").withColumns({"data": payload, "dispatch_ok": F.col("k") % 10 != 0})
    sent = domain.send_notification(commands).select(
        "id", F.lit("command").alias("channel"), "template", F.col("notification_sent").alias("sent"),
        F.col("notification_error").alias("error"), "outcome_type",
    )
    return direct.unionByName(sent)


@query
def message_classes(spark, sf):
    messages = views.bus(spark, sf).select(F.coalesce("notification_type", "type").alias("message"))
    counts = messages.groupBy("message").agg(F.count(F.lit(1)).alias("messages"))
    return routing.classify_message(counts)


@query
def envelope_roundtrip(spark, sf):
    records = views.raw_log(views.bus(spark, sf))
    parsed = envelope.parse_envelope(envelope.event_type(records))
    return parsed.select(
        "id", "type", "type_mismatch", "traceid", _us("time"), "source", "datacontenttype", "specversion",
        "correlationid", F.col("group").alias("event_group"), field(F.col("data"), "name").alias("name"),
        field(F.col("data"), "userId").alias("user_id"),
    )


@query
def events_by_type(spark, sf):
    """One pass that lands every type in its folder; the counts come from the folders' footers."""
    folder = run_dir(spark, "by-type")
    logs.write_by_type(views.bus(spark, sf), folder)
    return spark.read.parquet(folder).groupBy("type").agg(F.count(F.lit(1)).alias("events"))


@query
def scalar_functions(spark, sf):
    json = F.expr(
        """CASE k % 8 WHEN 0 THEN '{"v":true}' WHEN 1 THEN '{"v":"true"}' WHEN 2 THEN '{"v":1}'
           WHEN 3 THEN '{"v":" true "}' WHEN 4 THEN '{"v":null}' WHEN 5 THEN '{}'
           WHEN 6 THEN '{"v":"TRUE"}' ELSE '{"v":12.7}' END"""
    )
    rows = views.bus(spark, sf).withColumns({
        "j": document(json),
        "traceid": F.expr("CASE WHEN k % 6 = 0 THEN ' \t' ELSE traceid END"),
        "userId": F.expr("CASE WHEN k % 5 <> 0 THEN concat('u', CAST(user_id AS STRING)) END"),
        "data": document(F.expr("CASE WHEN k % 9 <> 0 THEN '{}' END")),
    })
    ensured = envelope.ensure_user_id(envelope.ensure_traceid(rows))
    good, bad = envelope.quarantine(ensured)
    both = good.withColumn("missing", F.lit("")).unionByName(
        bad.withColumn("missing", F.array_join("missing_fields", ",")).drop("missing_fields")
    )
    j = F.col("j")
    return both.select(
        "id", "traceid", F.col("userId").alias("user_id"), "missing",
        str_or_empty(j, "v").alias("text"), text_or(j, "v", "none").alias("text_or"),
        bool_lenient(j, "v").alias("lenient"), bool_parse(j, "v").alias("parsed"),
        bool_strict(j, "v").alias("strict"), long_or_zero(field(j, "v")).alias("whole"),
        coalesce_null(F.col("payment_amount"), 0).alias("amount"),
    )


# --- domain ---------------------------------------------------------------------------------

@query
def validate_accounts(spark, sf):
    return domain.handler("validate-signup")(views.accounts(spark, sf)).select("user_id", "validation_error", "tier")


@query
def price_accounts(spark, sf):
    rated = domain.handler("assess-payment-eligibility")(views.accounts(spark, sf)).withColumn(
        "price_cents", price_for_tier(F.col("tier"))
    )
    paid, free = routing.payment_required_gate(rated)
    return paid.withColumn("branch", F.lit("paid")).unionByName(free.withColumn("branch", F.lit("free"))).select(
        "user_id", "payment_required", "price_cents", "branch"
    )


@query
def upgrade_plan(spark, sf):
    targets = views.accounts(spark, sf).withColumnRenamed("tier", "target_tier")
    return domain.handler("apply-tier-upgrade")(targets).select("user_id", "upgrade_applied", "upgrade_error", "tier")


_RENDERED = routing.LOG_TEMPLATES | routing.COMMAND_TEMPLATES


@query
def render_notifications(spark, sf):
    bus = views.bus(spark, sf).drop("tier").withColumn("message", F.coalesce("notification_type", "type"))
    wanted = bus.filter(F.col("message").isin(*_RENDERED)).withColumn(
        "template", routing.lookup(F.col("message"), _RENDERED)
    )
    payload = F.to_variant_object(F.expr(
        """named_struct('name', CASE WHEN k % 11 <> 0 THEN name END, 'email', email, 'tier', tier,
           'currentTier', 'FREE', 'targetTier', CASE WHEN k % 13 <> 0 THEN 'PRO' END,
           'reason', CASE WHEN k % 3 <> 0 THEN concat('r', CAST(k AS STRING)) END,
           'validationError', CASE WHEN k % 2 = 0 THEN 'email-invalid' END,
           'refundSkipped', (k % 5 = 0), 'refundSuccess', (k % 5 IN (1, 2)),
           'refundTransactionId', concat('rtx-', id),
           'deactivatedAt', CASE WHEN k % 4 <> 0 THEN '2024-02-01T00:00:00Z' END)"""
    ))
    joined = wanted.join(views.accounts(spark, sf), "user_id").withColumn("data", payload)
    return domain.render_notification(joined, brand="Example").select("id", "template", "text")


@query
def chat_messages(spark, sf):
    kind = (
        F.when(F.col("type") == PAYMENT_RECEIVED, "success")
        .when(F.col("type") == PAYMENT_FAILED, "failed")
        .when(F.col("notification_type") == TECHNICAL_ERROR, "error")
    )
    rows = views.bus(spark, sf).withColumn("chat_kind", kind).filter("chat_kind IS NOT NULL").withColumns({
        "user_id": F.concat(F.lit("u"), F.col("user_id").cast("string")),
        "email": F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("@example.com")),
        "name": F.concat(F.lit("User "), F.col("user_id").cast("string")),
    })
    return domain.render_chat_message(rows).select("id", "chat_kind", "chat_text")


@query
def refund_plan(spark, sf):
    text = F.expr(
        "CASE k % 5 WHEN 0 THEN '12.7' WHEN 1 THEN ' 12 ' ELSE CAST(payment_amount AS STRING) END"
    )
    rows = views.bus(spark, sf).filter(F.col("type") == PAYMENT_RECEIVED).withColumns({
        "payment_amount": long_or_zero(text), "refund_ok": F.col("k") % 10 != 3,
        "email": F.lit("e"), "name": F.lit("n"),
    })
    planned = domain.refund_payment(rows)
    published = domain.refund_event(planned).withColumn("event_type", F.col("event.type")).drop("event")
    silent = planned.filter("refund_skipped").withColumn("event_type", F.lit(None).cast("string"))
    return published.unionByName(silent).select(
        "id", "payment_amount", "refund_action", "refund_skipped", "refund_success",
        "refund_transaction_id", "event_type",
    )


@query
def domain_events(spark, sf):
    people = views.accounts(spark, sf).select("user_id", "name", "email")
    signups = routing.signup_only(views.bus(spark, sf)).join(people, "user_id").withColumns({
        "payment_success": F.col("k") % 3 != 0, "transaction_id": F.concat(F.lit("tx-"), F.col("id")),
        "force_payment_failure": F.col("k") % 11 == 0, "force_payment_error": F.col("k") % 7 == 0,
        "force_activation_failure": F.col("k") % 10 == 3,
    })
    paid = domain.payment_event(domain.process_payment(signups), "shop").select("event")
    active = domain.account_activated_event(domain.activate_account(signups), "shop").select("event")
    records = logs.to_records(paid).unionByName(logs.to_records(active))
    parsed = envelope.parse_envelope(envelope.event_type(records))
    data = F.col("data")
    return parsed.select(
        F.col("id").alias("event_id"), "type", "traceid", "source", _us("time"),
        field(data, "email").alias("email"), field(data, "tier").alias("tier"),
        field(data, "paymentAmount").try_cast("bigint").alias("payment_amount"),
        field(data, "transactionId").alias("transaction_id"),
        envelope.copy_present(data).alias("present"),
    )


@query
def account_closures(spark, sf):
    rows = views.bus(spark, sf).filter(F.col("type") == "AccountDeactivationRequestedEvent").withColumn(
        "reason", F.expr("CASE WHEN k % 3 <> 0 THEN concat('r', CAST(k AS STRING)) END")
    )
    return domain.deactivate_account(rows).select(
        "id", "account_active", _us("deactivated_at"), "deactivation_reason"
    )


@query
def payment_gates(spark, sf):
    bus = views.bus(spark, sf).withColumns({
        "payment_success": F.when(F.col("type") == PAYMENT_RECEIVED, True).when(F.col("type") == PAYMENT_FAILED, False),
        "retry_count": F.col("k") % 5,
    })
    decision = routing.retry_decision(F.col("retry_payment"), F.col("retry_count"))
    return bus.groupBy(
        F.coalesce(routing.payment_result(F.col("payment_success")), F.lit("neither")).alias("payment_branch"),
        F.coalesce(routing.tier_gate_v1(F.col("tier")), F.lit("neither")).alias("tier_branch_v1"),
        routing.tier_gate(F.col("tier")).alias("tier_branch"), decision.alias("retry_branch"),
    ).agg(F.count(F.lit(1)).alias("rows_in_branch"))


# --- correlation ----------------------------------------------------------------------------

@query
def request_outcome(spark, sf):
    return saga.request_outcome(views.bus(spark, sf), HORIZON).select(
        "traceid", "id", "type", "outcome", "outcome_id", _us("outcome_time")
    )


@query
def compensations(spark, sf):
    return saga.compensations(views.bus(spark, sf))


@query
def charged_not_activated(spark, sf):
    return saga.charged_not_activated(views.bus(spark, sf)).select(
        "traceid", "payments", "captured_cents", _us("first_paid_at")
    )


@query
def activated_unpaid(spark, sf):
    return saga.activated_unpaid(views.bus(spark, sf))


@query
def refund_follow_up(spark, sf):
    return saga.refund_follow_up(views.bus(spark, sf)).select("traceid", "refund_event_id", _us("failed_at"))


@query
def payment_attempts(spark, sf):
    attempts = saga.payment_attempts(views.bus(spark, sf))
    decision = routing.retry_decision(F.col("retry_payment"), F.col("attempt"))
    return attempts.select(
        "traceid", "id", "type", "attempt",
        F.when(F.col("type") == PAYMENT_FAILED, decision).alias("decision"),
    )


@query
def retries_exhausted(spark, sf):
    return saga.retries_exhausted(views.bus(spark, sf))


@query
def start_or_dead_letter(spark, sf):
    return saga.start_or_dead_letter(views.attempts(spark, sf)).select(
        "start_id", "attempts", "outcome", "reason", _us("last_at")
    )


@query
def dead_letter_events(spark, sf):
    failed = saga.start_or_dead_letter(views.attempts(spark, sf)).filter("outcome = 'dead_letter'").select(
        F.col("start_id").alias("id"), F.col("start_id").alias("traceid"), "reason", F.col("last_at").alias("time"),
        F.lit(SIGNUP_REQUESTED).alias("type"),
        F.concat(F.lit('{"id":"'), "start_id", F.lit('"}')).alias("value"),
    )
    parsed = envelope.parse_envelope(envelope.event_type(logs.to_records(domain.dead_letter_event(failed, "ingress"))))
    data = F.col("data")
    return parsed.select(
        F.col("id").alias("event_id"), "type", "traceid", field(data, "originalType").alias("original_type"),
        field(data, "reason").alias("reason"), field(data, "originalMessage").alias("original_message"),
        F.unix_micros(field(data, "failedAt").cast("timestamp")).alias("failed_at_us"),
    )


@query
def account_state(spark, sf):
    bus = views.bus(spark, sf).withColumn("account", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    return saga.account_state(bus).select("account", "tier", "active", _us("updated_at"))


@query
def revenue_by_tier(spark, sf):
    return saga.revenue_by_tier(views.bus(spark, sf))


# --- audit ----------------------------------------------------------------------------------

@query
def notification_audit(spark, sf):
    bus = views.bus(spark, sf)
    commands = bus.filter(F.col("type").isin(*routing.COMMAND_TEMPLATES)).select(
        "traceid", F.col("type").alias("notification_type")
    )
    outcomes = bus.filter(F.col("type") == NOTIFICATION_SENT).select("traceid", "notification_type")
    return audit.notification_audit(commands, outcomes)


@query
def dead_letter_recovery(spark, sf):
    bus = views.bus(spark, sf)
    original = F.to_json(F.struct(F.lit(SIGNUP_REQUESTED).alias("type"), "id", "traceid"))
    dead = bus.filter(F.col("type") == PROCESS_START_FAILED_EVENT).withColumns({
        "value": original, "reason": F.concat(F.lit("err"), (F.col("k") % 3).cast("string")),
    })
    progressed = F.col("type").isin(PAYMENT_RECEIVED, PAYMENT_FAILED, "AccountActivatedEvent")
    return audit.dead_letter_recovery(dead, bus, progressed)


@query
def best_effort_loss(spark, sf):
    bus = views.bus(spark, sf)
    state = bus.filter(F.col("type") == NOTIFICATION_SENT).select(
        "traceid", F.col("notification_type").alias("outcome")
    )
    return audit.best_effort_loss(state, bus, {PAYMENT_RECEIVED: PAYMENT_RECEIVED, ACTIVATION_FAILED: PAYMENT_RECEIVED})


@query
def lost_orders(spark, sf):
    return audit.lost_messages(
        views.table(spark, sf, "orders"), views.table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey"
    )


@query
def outbox_pending(spark, sf):
    bus = views.bus(spark, sf)
    outbox = bus.filter(F.col("type").isin(PROCESS_START_FAILED_EVENT, "AccountActivatedEvent"))
    return audit.outbox_relay(outbox, outbox.filter("k % 2 = 1")).select("id", "type", "traceid")


# --- delivery -------------------------------------------------------------------------------

@query
def delivery_report(spark, sf):
    configs = [(rf, acks, "BASELINE") for rf, acks in delivery.ALL_CONFIGS]
    configs += [(rf, acks, "FAULT") for rf, acks in delivery.FAULT_CONFIGS]
    matrix = spark.createDataFrame(configs, "rf INT, acks STRING, phase STRING")
    return delivery.config_matrix(delivery.delivery_result(views.deliveries(spark, sf)), matrix)


@query
def phase_comparison(spark, sf):
    results = delivery.delivery_result(views.deliveries(spark, sf))
    baseline = results.filter("phase = 'BASELINE'").drop("phase")
    fault = results.filter("phase = 'FAULT'").drop("phase")
    return delivery.compare_phases(delivery.union_phases(baseline, fault))


@query
def delivery_latency(spark, sf):
    rows = views.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_linenumber % 3 + 1 AS INT) AS rf",
        "CASE l_returnflag WHEN 'A' THEN 'all' WHEN 'R' THEN '1' ELSE '0' END AS acks",
        "CASE l_linestatus WHEN 'F' THEN 'FAULT' ELSE 'BASELINE' END AS phase",
        "(l_discount > 0) AS acked", "(l_tax > 0) AS consumed",
        "CAST(l_quantity AS BIGINT) AS latency_ms", "CAST(l_shipdate AS TIMESTAMP) AS cb_ts",
    )
    return delivery.delivery_result_with_latency(rows).select(
        "rf", "acks", "phase", "attempted", "sent", "failed", "consumed", "lost", "throughput", "max_ms",
        "p50", "p95", "p99", "verdict",
    )


@query
def offset_reset(spark, sf):
    bus = views.bus(spark, sf)
    return delivery.offset_reset_report(bus, F.lit(CUTOFF).cast("timestamp"))


@query
def partition_distribution(spark, sf):
    return delivery.partition_distribution(views.deliveries(spark, sf))


@query
def group_totals(spark, sf):
    return delivery.group_totals(views.deliveries(spark, sf), "phase")


# --- metrics --------------------------------------------------------------------------------

@query
def run_summary(spark, sf):
    return metrics.run_summary(views.probes(spark, sf), ["label"])


@query
def setting_comparison(spark, sf):
    return metrics.compare_by_setting(views.probes(spark, sf), "label")


@query
def floor_percentiles(spark, sf):
    return metrics.floor_percentiles(views.probes(spark, sf), ["label"])


@query
def throughput_buckets(spark, sf):
    return metrics.per_second_counts(views.probes(spark, sf), ["label"], width_ms=30 * 86_400_000)


@query
def throughput_stats(spark, sf):
    buckets = metrics.per_second_counts(views.probes(spark, sf), ["label"], width_ms=86_400_000)
    sparse = metrics.throughput_stats(buckets, ["label"]).withColumn("dense", F.lit(False))
    return sparse.unionByName(
        metrics.throughput_stats(buckets, ["label"], dense=True).withColumn("dense", F.lit(True))
    )


@query
def send_counts(spark, sf):
    return metrics.send_counts(views.probes(spark, sf), ["label", "threads"])


@query
def success_rate(spark, sf):
    return metrics.success_rate(views.probes(spark, sf), ["label"])


@query
def load_scaling(spark, sf):
    return metrics.load_scaling(views.probes(spark, sf))


@query
def latency_since_start(spark, sf):
    return metrics.latency_since_start(views.probes(spark, sf), ["label"])


@query
def resource_summary(spark, sf):
    return metrics.resource_summary(views.samples(spark, sf), ["run"]).withColumns({
        "avg_cpu": F.round("avg_cpu", 6)
    })


@query
def progress(spark, sf):
    return metrics.progress_samples(views.probes(spark, sf), ["label"], "cb_ts", MONTH).select(
        "label", _us("sampled_at"), "processed", "total"
    )


@query
def progress_marks(spark, sf):
    return metrics.progress_marks(views.probes(spark, sf), ["label"], "cb_ts").select("label", _us("at"), "record")


@query
def consumer_lag(spark, sf):
    probes = views.probes(spark, sf)
    processed = probes.filter("consumed").withColumn(
        "cb_ts", F.expr("cb_ts + make_dt_interval(0, CAST(latency_ms AS INT))")
    )
    return metrics.consumer_lag(probes, processed, ["label"], "cb_ts", MONTH).select(
        "label", _us("at"), "produced", "processed", "lag"
    )


@query
def event_type_counts(spark, sf):
    return metrics.event_type_counts(views.bus(spark, sf)).withColumn("day", F.col("day").cast("string"))


# --- cluster metadata -----------------------------------------------------------------------

_OBSERVED = ("observed_at", "obs_id")


@query
def leader_changes(spark, sf):
    return cluster.leader_changes(views.cluster_obs(spark, sf), order=_OBSERVED).select(
        "topic", "partition", "obs_id", _us("observed_at"), "old_leader", "new_leader"
    )


@query
def isr_changes(spark, sf):
    return cluster.isr_changes(views.cluster_obs(spark, sf), order=_OBSERVED).select(
        "topic", "partition", "obs_id", "old_isr", "new_isr"
    )


@query
def isr_set_changes(spark, sf):
    return cluster.isr_changes(views.cluster_obs(spark, sf), as_set=True, order=_OBSERVED).select(
        "topic", "partition", "obs_id", "old_isr", "new_isr"
    )


@query
def failover_time(spark, sf):
    return cluster.failover_time(
        cluster.leader_changes(views.cluster_obs(spark, sf), order=_OBSERVED), order=_OBSERVED
    ).select(
        "topic", "partition", "obs_id", "gap_ms"
    )


@query
def cluster_state(spark, sf):
    return cluster.cluster_state(views.cluster_obs(spark, sf), order=_OBSERVED).select(
        "topic", "partition", _us("observed_at"), "leader", "isr"
    )


# --- signals --------------------------------------------------------------------------------

@query
def price_change(spark, sf):
    return signals.price_change(views.prices(spark, sf), HORIZON).select(
        "symbol", _us("ts"), "price", "copies", "base_price", "change_percent"
    )


@query
def price_alerts(spark, sf):
    watched = routing.watchlist_filter(views.prices(spark, sf), WATCHLIST)
    return signals.price_alerts(signals.price_change(watched, HORIZON)).select(
        "symbol", _us("ts"), "alert_type", "change_percent"
    )


@query
def volatility(spark, sf):
    return signals.volatility(views.prices(spark, sf), 50.0, HORIZON).select(
        "symbol", _us("ts"), "prices", F.round("volatility", 6).alias("volatility")
    )


@query
def alert_events(spark, sf):
    alerts = signals.price_alerts(signals.price_change(views.prices(spark, sf), HORIZON))
    events = domain.alerts_to_events(signals.describe_price_alert(alerts, HORIZON), "market", "scanner")
    parsed = envelope.parse_envelope(envelope.event_type(logs.to_records(events)))
    routed = routing.route_scanner_alerts(parsed)
    data = F.col("data")
    return routed.select(
        "type", "template", "source", _us("time"), field(data, "symbol").alias("symbol"),
        field(data, "alertType").alias("alert_type"), field(data, "currentPrice").cast("double").alias("price"),
        field(data, "changePercent").cast("double").alias("change_percent"),
        (~blank_or_null(field(data, "description"))).alias("described"),
    )


@query
def rate_limited_alerts(spark, sf):
    posts = routing.post_filter(views.posts(spark, sf))
    return rate_limit(posts, "topic", "ts", signals.seconds(HORIZON)).select("topic", _us("ts"))


@query
def topic_counts(spark, sf):
    posts = routing.post_filter(views.posts(spark, sf))
    return signals.topic_counts(posts, HORIZON, "2 hours").select("topic", _us("window_start"), "posts")


@query
def trending(spark, sf):
    posts = routing.post_filter(views.posts(spark, sf))
    return signals.trending(signals.topic_counts(posts, HORIZON, "2 hours"), 3).select(
        "topic", _us("window_start"), "posts"
    )


@query
def trend_events(spark, sf):
    scored = routing.post_filter(views.posts(spark, sf))
    spikes = signals.sentiment_spike(scored, HORIZON).withColumn(
        "sentiment", signals.sentiment_label(F.col("mean_score"))
    )
    events = domain.alerts_to_events(signals.describe_trend(spikes, "SENTIMENT_SPIKE"), "social", "scanner")
    rendered = domain.render_notification(
        routing.route_scanner_alerts(envelope.parse_envelope(envelope.event_type(logs.to_records(events))))
    )
    return rendered.select("type", "template", _us("time"), "text")


@query
def sentiment_spike(spark, sf):
    scored = routing.post_filter(views.posts(spark, sf))
    return signals.sentiment_spike(scored, HORIZON).select(
        "topic", _us("window_start"), "posts", F.round("mean_score", 6).alias("mean_score"),
        F.round("previous_mean", 6).alias("previous_mean"),
    )


@query
def keyword_match(spark, sf):
    return signals.keyword_match(views.table(spark, sf, "documents"), KEYWORDS).select("doc_id", "keyword")


@query
def sentiment(spark, sf):
    return signals.sentiment(views.table(spark, sf, "documents"), LEXICON).select("doc_id", "score", "sentiment")


@query
def topic_sentiment(spark, sf):
    scored = signals.sentiment(views.table(spark, sf, "documents"), LEXICON)
    return signals.topic_sentiment(scored, "source").withColumn("mean_score", F.round("mean_score", 6))


# --- probes ---------------------------------------------------------------------------------

@query
def probe_payload(spark, sf):
    text = F.expr(
        """CASE l_linenumber % 4
             WHEN 0 THEN concat('{"seq":', l_orderkey, ',"ts":', l_partkey, ',"rf":', l_linenumber, ',"acks":"all"}')
             WHEN 1 THEN concat('msg-', l_orderkey, '-ts-', l_partkey)
             WHEN 2 THEN concat('value-', l_orderkey, '-ts-', l_partkey)
             ELSE concat('thread-', l_linenumber, '-msg-', l_orderkey) END"""
    )
    parsed = logs.parse_probe(views.table(spark, sf, "lineitem").select(text.alias("value")))
    return parsed.select("seq", "sent_ms", "thread", "rf", "acks")


# --- streams --------------------------------------------------------------------------------

def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of them, some files at a time."""
    static = views.table(spark, sf, "events")
    # a file stream takes a folder or a pattern, so a single file is named by a pattern
    return spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 16).parquet(f"{sf}/events.parque[t]")


def _delay(spark: SparkSession, sf: str, least: int) -> str:
    """`least` seconds, or how far the table's files go back behind those read before them, so that no row is late.

    Files are read in the order of their modification times, those of the same time in any order.
    """
    ts = F.col("ts").cast("timestamp")
    read = views.table(spark, sf, "events").groupBy(F.col("_metadata.file_modification_time").alias("at")).agg(
        F.countDistinct("_metadata.file_path").alias("files"), F.unix_micros(F.min(ts)).alias("first"), F.unix_micros(F.max(ts)).alias("last"))
    back, latest = 0, None
    for r in sorted(read.where("first IS NOT NULL").collect(), key=lambda r: r["at"]):
        before = [t for t in (latest, r["last"] if r["files"] > 1 else None) if t is not None]
        back = max([back, *(t - r["first"] for t in before)])
        latest = max(r["last"], latest if latest is not None else r["last"])
    return f"{max(least, back // 1_000_000 + 1)} seconds"


@query
def dedup_events(spark, sf):
    bus = views.bus(spark, sf)
    return pipelines.dedup(bus.unionByName(bus)).select("id", "type", "traceid", _us("time"))


@query
def tumbling_alerts(spark, sf):
    posts = routing.post_filter(views.posts(spark, sf))
    return rate_limit_tumbling(posts, "topic", "ts", HORIZON).select("topic", _us("ts"))


@query
def retry_branches(spark, sf):
    again, stop = routing.retry_gate(views.bus(spark, sf).withColumn("retry_count", F.col("k") % 5))
    both = again.withColumn("branch", F.lit("retry")).unionByName(stop.withColumn("branch", F.lit("cancel")))
    return both.groupBy("type", "branch").agg(F.count(F.lit(1)).alias("payments"))


@query
def notification_events(spark, sf):
    """Events of the notification commands, by what became of them."""
    commands = views.bus(spark, sf).filter("notification_type IS NOT NULL").withColumns({
        "data": F.to_variant_object(F.struct("tier")), "dispatch_ok": F.col("k") % 10 != 0,
        "email": F.lit(None).cast("string"), "name": F.lit(None).cast("string")})
    events = domain.notification_event(domain.send_notification(commands)).select("event.*")
    return events.groupBy("type", F.col("data.notificationType").alias("notification_type"), F.col("data.email").alias("email"),
                          F.col("data.success").alias("success")).agg(F.count(F.lit(1)).alias("events"))


@query
def split_payments(spark, sf):
    """The payments of each branch of the gate, added up."""
    bus = views.bus(spark, sf).withColumn(
        "payment_success", F.when(F.col("type") == PAYMENT_RECEIVED, True).when(F.col("type") == PAYMENT_FAILED, False))
    sides = [side.groupBy(F.lit(name).alias("branch")).agg(F.count(F.lit(1)).alias("payments"), F.sum("payment_amount").alias("cents"))
             for name, side in zip(("succeeded", "failed"), routing.payment_result_gate(bus))]
    return sides[0].unionByName(sides[1])


@query
def accepted_signups(spark, sf):
    """Valid signups with their new user ids, and the others with what is wrong with them."""
    valid, rejected = domain.accept_signup(views.accounts(spark, sf).withColumn("key", F.col("user_id").cast("string")), "key", "shop")
    return valid.select("user_id", "tier", F.col("userId").alias("new_id"), F.lit(None).cast("string").alias("validation_error")).unionByName(
        rejected.select("user_id", "tier", F.lit(None).cast("string").alias("new_id"), "validation_error"))


@query
def whole_numbers(spark, sf):
    """Measured values as whole numbers: cut towards zero, kept within the range, nothing as 0."""
    value = F.when(F.col("k") % 10 == 0, None).when(F.col("k") % 10 == 1, F.col("value") * 1e18).when(F.col("k") % 10 == 2, F.col("value") * -1e18)
    rows = views.bus(spark, sf).select("id", number_to_long(value.otherwise(F.col("value") - 50)).alias("whole"))
    return rows.groupBy((F.col("id").cast("bigint") % 100).alias("part")).agg(
        F.sum(F.col("whole").cast("decimal(38,0)")).cast("double").alias("total"), F.count_if(F.col("whole") == 0).alias("zeros"))


@query
def demuxed_requests(spark, sf):
    """Each request type as a DataFrame of its own."""
    parts = routing.demux_by_type(views.bus(spark, sf), REQUEST_TYPES)
    return reduce(DataFrame.unionByName, [
        part.groupBy(F.lit(name).alias("type"), "tier").agg(F.count(F.lit(1)).alias("requests")) for name, part in parts.items()])


@query
def latest_log(spark, sf):
    """A subscriber that wants only what is stamped after it attached: every third record is, in a hundred years."""
    folder = run_dir(spark, "latest")
    log = views.raw_log(views.bus(spark, sf).filter("k % 3 <> 0")).unionByName(
        views.raw_log(views.bus(spark, sf).filter("k % 3 = 0")).withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 100 YEARS")))
    logs.write_log(log, folder, "parquet")
    seen = envelope.event_type(logs.read_log(spark, folder, "parquet", start="latest"))
    return seen.groupBy(F.col("event_type").alias("type")).agg(F.count(F.lit(1)).alias("events"))


@query
def landed_log(spark, sf):
    """The log written, streamed on to its end, and read back: all of it, and what a late subscriber gets."""
    root = run_dir(spark, "landed")
    logs.write_log(views.raw_log(views.bus(spark, sf)), f"{root}/in", "parquet")
    stream = logs.read_log(spark, f"{root}/in", "parquet", streaming=True)
    moved = logs.drain(logs.write_log(stream, f"{root}/out", "parquet", checkpoint=f"{root}/checkpoint"))
    back = logs.read_log(spark, f"{root}/out", "parquet")
    late = logs.after_cutoff(back, F.lit(CUTOFF).cast("timestamp"), "timestamp")
    parts = [part.withColumn("policy", F.lit(policy)) for policy, part in (("earliest", back), ("latest", late))]
    both = envelope.event_type(parts[0].unionByName(parts[1]))
    return both.groupBy("policy", F.col("event_type").alias("type")).agg(F.count(F.lit(1)).alias("events")).withColumn(
        "moved", F.lit(moved).cast("bigint")
    )


@query
def accepted_and_dead(spark, sf):
    """Two subscribers of one log, each with all of it: one splits good records from dead letters, one counts."""
    root = run_dir(spark, "split")
    bus = views.bus(spark, sf)
    broken = views.raw_log(bus.filter("k % 9 = 0")).withColumn("value", F.lit("{broken"))
    logs.write_log(views.raw_log(bus.filter("k % 9 <> 0")).unionByName(broken), f"{root}/in", "parquet")
    stream = logs.read_log(spark, f"{root}/in", "parquet", streaming=True)

    def accept(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        good, bad = envelope.quarantine(envelope.parse_envelope(envelope.event_type(batch)), ("type", "data", "time"))
        return good.select("key", "value"), bad.select("key", "value")

    def count(batch: DataFrame, batch_id: int) -> None:
        logs.write_report(batch.agg(F.count(F.lit(1)).alias("records")), f"{root}/seen/batch={batch_id}")

    subscribers = {"split": logs.split_sink(accept, f"{root}/good", f"{root}/dead", "parquet"), "count": count}
    for running in logs.fan_out(stream, subscribers, f"{root}/checkpoints").values():
        running.awaitTermination()
    logs.write_dead_letter(broken.select("key", "value"), f"{root}/again", "parquet")
    sides = [spark.read.schema("key STRING, value STRING").parquet(f"{root}/{side}").agg(
        F.lit(side).alias("side"), F.count(F.lit(1)).alias("records")) for side in ("good", "dead", "again")]
    seen = spark.read.parquet(f"{root}/seen").agg(F.lit("seen").alias("side"), F.sum("records").alias("records"))
    return reduce(DataFrame.unionByName, [*sides, seen])


def _request_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return views.accounts(spark, sf).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("userId"), "email", F.concat(F.lit("  "), "name").alias("name"), "tier",
        F.explode(F.when(F.col("user_id") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


@query
def landed_requests(spark, sf):
    """Request payloads dropped in a folder, every third one twice, each an event of its own."""
    folder = run_dir(spark, "requests")
    _request_payloads(spark, sf).write.json(folder)
    events = logs.read_requests(spark, folder, SIGNUP_REQUESTED, SIGNUP_REQUEST, "web")
    parsed = envelope.extract_variables(envelope.parse_envelope(envelope.event_type(logs.to_records(events))))
    return parsed.groupBy("type", F.col("userId").alias("user_id"), "name").agg(
        F.countDistinct("id").alias("events"), F.countDistinct("traceid").alias("traces"))


@query
def landed_requests_stream(spark, sf):
    """The same as a stream of files of any size; every event has the id it gets when its folder is read at once."""
    folder, root = run_dir(spark, "requests"), run_dir(spark, "landed-requests")
    payload = _request_payloads(spark, sf)
    payload.write.json(folder)
    running = logs.land_requests(spark, folder, SIGNUP_REQUESTED, SIGNUP_REQUEST, "web", f"{root}/out", f"{root}/checkpoint")
    moved = logs.drain(running)
    landed = envelope.parse_envelope(envelope.event_type(spark.read.schema(LOG_RECORD).json(f"{root}/out/batch=*")))
    at_once = envelope.parse_envelope(envelope.event_type(logs.to_records(
        logs.read_requests(spark, folder, SIGNUP_REQUESTED, SIGNUP_REQUEST, "web"))))
    both = landed.select("id", F.lit(1).alias("s"), F.lit(0).alias("b")).unionByName(
        at_once.select("id", F.lit(0).alias("s"), F.lit(1).alias("b"))).groupBy("id").agg(F.sum("s").alias("s"), F.sum("b").alias("b"))
    return both.agg(F.lit(moved).cast("bigint").alias("moved"), F.count(F.lit(1)).alias("ids"), F.count_if(F.expr("s = 1 AND b = 1")).alias("in_both"))


@query
def outbox_relayed(spark, sf):
    """An outbox relayed twice, the second time with more in it: every event is on the log once."""
    root = run_dir(spark, "outbox")
    bus = views.bus(spark, sf).filter(F.col("type").isin(PROCESS_START_FAILED_EVENT, "AccountActivatedEvent"))
    event = envelope.new_event(F.col("type"), F.struct("tier"), F.col("id"), "accounts", F.col("time"), F.col("traceid"))
    rows = bus.select(event.alias("event"), "k").select("event.id", "event", "k")
    numbers = [outbox.relay(part, f"{root}/log", f"{root}/marks", "parquet") for part in (rows.filter("k % 2 = 1"), rows, rows)]
    log = envelope.parse_envelope(envelope.event_type(outbox.read_published(spark, f"{root}/log", "parquet").select(*LOG_RECORD.fieldNames())))
    return log.groupBy("type").agg(F.count(F.lit(1)).alias("records"), F.countDistinct("id").alias("events")).withColumn(
        "relays", F.lit(len(set(numbers))))


@query
def repeated_json_keys(spark, sf):
    """Messages whose JSON says a thing twice: the last value holds, in the envelope and in its data."""
    value = F.expr("""concat('{"type":"Superseded","type":"', type, '","id":"x","id":"', id, '","traceid":"', traceid, '","time":"',
        date_format(time, "yyyy-MM-dd'T'HH:mm:ss'Z'"), '","data":{"tier":"none","tier":"', tier, '","userId":{"old":1},"userId":"u', user_id, '"}}')""")
    parsed = envelope.parse_envelope(views.bus(spark, sf).select(value.alias("value")))
    good, _ = envelope.quarantine(parsed)
    routed = routing.route_process(envelope.extract_variables(routing.ingress_filter(good)))
    return routed.groupBy("type", "process_id", "tier").agg(
        F.count(F.lit(1)).alias("messages"), F.countDistinct("id").alias("ids"), F.countDistinct("userId").alias("users"))


@query
def late_rows_stream(spark, sf):
    """Events that arrive when the watermark has passed them are dropped, and counted. The second half of the
    month comes first; with a delay of 20 days, what is older than that is late."""
    root = run_dir(spark, "late")
    bus = views.bus(spark, sf)
    late = pipelines.LateRows()
    bus.filter(F.col("time") >= CUTOFF).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(bus.schema).parquet(f"{root}/in")
    run = pipelines.AppendRun(pipelines.dedup(stream, "time", "20 days"), "late-rows", late)
    run.run()
    bus.filter(F.col("time") < CUTOFF).write.mode("append").parquet(f"{root}/in")
    run.run()
    return run.answer().agg(F.count(F.lit(1)).alias("kept")).withColumn("late", F.lit(late.rows).cast("bigint"))


@query
def events_by_type_stream(spark, sf):
    """One pass over a stream that lands every type in its folder, all but the named ones together."""
    root = run_dir(spark, "by-type")
    bus = views.bus_of(views.ev_of(_event_stream(spark, sf)))
    logs.write_by_type(bus, f"{root}/out", checkpoint=f"{root}/checkpoint", types=REQUEST_TYPES).awaitTermination()
    schema = bus.schema.add("original_type", "string")
    parts = [logs.read_by_type(spark, f"{root}/out", schema, t) for t in (*REQUEST_TYPES, logs.OTHER_TYPES)]
    return reduce(DataFrame.unionByName, parts).groupBy("type", "original_type").agg(F.count(F.lit(1)).alias("events"))


@query
def signup_final_stream(spark, sf):
    """Each trace answered once, when it has ended, and forgotten."""
    closing = pipelines.Closing(views.bus_of(views.ev_of(_event_stream(spark, sf))), "time")
    ends = pipelines.signup_state_final(closing.stream, 86_400, 2 * 86_400, 7 * 86_400, _delay(spark, sf, 3600))
    return pipelines.run_append(ends, "final-states", closing).select("traceid", "state", _us("last_at"), "ended")


@query
def written_report(spark, sf):
    """The delivery results as they are persisted, read back."""
    folder = run_dir(spark, "report")
    logs.write_report(delivery.report_rows(delivery.delivery_result(views.deliveries(spark, sf))), folder, "csv")
    schema = "rf INT, acks STRING, phase STRING, attempted BIGINT, sent BIGINT, sendFailed BIGINT, consumed BIGINT, dropped BIGINT"
    found = spark.read.option("header", "true").csv(folder)
    return found.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in schema.split(", ") if c.split()[0] in found.columns])


@query
def started_requests(spark, sf):
    """Requests of a stream started one by one: those that fail every time are dead-lettered alone."""
    root = run_dir(spark, "starting")
    requests = routing.ingress_filter(views.bus_of(views.ev_of(_event_stream(spark, sf)))).withColumn("value", F.col("id"))
    bad = F.col("k") % 10 == 3

    def start(batch: DataFrame) -> DataFrame:
        batch.filter(~bad).select("id", "type").write.mode("append").parquet(f"{root}/started")
        return batch.filter(bad).select("id", F.lit("engine down").alias("reason"))

    sink = pipelines.start_sink(start, f"{root}/dead", "parquet", pause_seconds=0)
    requests.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(sink).start().awaitTermination()
    started = spark.read.schema("id STRING, type STRING").parquet(f"{root}/started").withColumn("outcome", F.lit("started"))
    dead = envelope.parse_envelope(envelope.event_type(logs.read_log(spark, f"{root}/dead", "parquet")))
    lost = dead.select(field(F.col("data"), "originalMessage").alias("id"), field(F.col("data"), "originalType").alias("type"),
                       F.lit("dead letter").alias("outcome"))
    return started.unionByName(lost)


@query
def saga_state_stream(spark, sf):
    bus = views.bus_of(views.ev_of(_event_stream(spark, sf)))
    return pipelines.run_update(saga.signup_state(bus), "saga-state", ["traceid"])


@query
def account_state_stream(spark, sf):
    """Accounts upserted from a stream into a table of buckets, batch by batch, and read back."""
    root = run_dir(spark, "accounts")
    named = lambda bus: bus.withColumn("account", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    stream = named(views.bus_of(views.ev_of(_event_stream(spark, sf))))
    table = upsert.account_table(spark, f"{root}/table", stream, buckets=8)
    stream.writeStream.trigger(availableNow=True).option("checkpointLocation", f"{root}/checkpoint").foreachBatch(
        table.sink(upsert.account_states)).start().awaitTermination()
    return upsert.account_view(table.read()).select("account", "tier", "active", _us("updated_at"))


@query
def topic_counts_stream(spark, sf):
    posts = routing.post_filter(views.posts_of(views.ev_of(_event_stream(spark, sf))))
    counts = signals.topic_counts(posts.withWatermark("ts", _delay(spark, sf, 86400)), HORIZON, "2 hours")
    latest = pipelines.run_update(counts, "topic-counts", ["topic", "window_start"])
    return latest.select("topic", _us("window_start"), "posts")


@query
def dedup_stream(spark, sf):
    bus = views.bus_of(views.ev_of(_event_stream(spark, sf)))
    twice = bus.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return pipelines.run_append(pipelines.dedup(twice, "time", _delay(spark, sf, 86400)), "dedup").select("id", "type", "traceid", _us("time"))




@query
def payment_timeouts_stream(spark, sf):
    closing = pipelines.Closing(views.bus_of(views.ev_of(_event_stream(spark, sf))), "time")
    return pipelines.run_append(pipelines.payment_timeouts(closing.stream, HORIZON, _delay(spark, sf, 3600)), "timeouts", closing)


@query
def rate_limited_alerts_stream(spark, sf):
    posts = routing.post_filter(views.posts_of(views.ev_of(_event_stream(spark, sf))))
    closing = pipelines.Closing(posts, "ts")
    passed = pipelines.rate_limit_stream(closing.stream, "topic", "ts", signals.seconds(HORIZON), _delay(spark, sf, 3600))
    return pipelines.run_append(passed, "rate-limit", closing).select("topic", _us("ts"))


@query
def sentiment_spike_stream(spark, sf):
    closing = pipelines.Closing(routing.post_filter(views.posts_of(views.ev_of(_event_stream(spark, sf)))), "ts")
    spikes = pipelines.sentiment_spike_stream(closing.stream, HORIZON, delay=_delay(spark, sf, 3600))
    return pipelines.run_append(spikes, "spikes", closing).select(
        "topic", _us("window_start"), "posts", F.round("mean_score", 6).alias("mean_score"),
        F.round("previous_mean", 6).alias("previous_mean"),
    )


@query
def signup_sessions_stream(spark, sf):
    closing = pipelines.Closing(views.bus_of(views.ev_of(_event_stream(spark, sf))), "time")
    sessions = pipelines.signup_state_sessions(closing.stream, "1 day", _delay(spark, sf, 3600))
    return pipelines.run_append(sessions, "sessions", closing).select(
        "traceid", _us("first_at"), _us("closed_at"), "state"
    )


@query
def choreography_stream(spark, sf):
    stream = envelope.parse_envelope(envelope.event_type(views.raw_log(views.bus_of(views.ev_of(_event_stream(spark, sf))))))
    decided = views.bus(spark, sf).groupBy("traceid").agg(
        (F.count(F.lit(1)) % 2 == 0).alias("payment_success"), F.max("time").alias("decided_at"))
    folder = run_dir(spark, "decisions")
    decided.write.parquet(folder)
    decisions = spark.readStream.schema(decided.schema).parquet(folder)
    landed = pipelines.run_append(pipelines.choreography(stream, decisions, "shop", delay=_delay(spark, sf, 86400)), "choreography")
    parsed = envelope.parse_envelope(envelope.event_type(landed))
    return parsed.select(
        F.col("id").alias("event_id"), "type", "traceid", field(F.col("data"), "email").alias("email"),
        field(F.col("data"), "tier").alias("tier"), _us("time"),
    )

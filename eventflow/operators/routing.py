"""Filters and routes over event and notification types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.functions.scalar import case, normalize_tier
from eventflow.schemas import (
    ACCOUNT_DEACTIVATED, ACTIVATION_FAILED, DEACTIVATION_REQUESTED, MARKET_ALERT_EVENT,
    MAX_ATTEMPTS, MESSAGE_CLASSES, PAYMENT_FAILED, PAYMENT_RECEIVED, PAYMENT_REFUNDED,
    PAYMENT_REFUND_FAILED, PROCESS_IDS, REQUEST_TYPES, SIGNUP_REQUESTED,
    SIGNUP_VALIDATION_FAILED, SOCIAL_TREND_EVENT, TECHNICAL_ERROR, UPGRADE_COMPLETED,
    UPGRADE_PAYMENT_FAILED, UPGRADE_REQUESTED,
)

# Event type -> message template, for subscribers that notify straight from the log.
LOG_TEMPLATES = {
    SIGNUP_REQUESTED: "signup",
    PAYMENT_RECEIVED: "payment_received",
    PAYMENT_FAILED: "payment_failed",
    PAYMENT_REFUNDED: "refunded",
    PAYMENT_REFUND_FAILED: "refund_failed",
}
# Notification type -> message template, for notification commands.
COMMAND_TEMPLATES = {
    SIGNUP_REQUESTED: "signup",
    PAYMENT_RECEIVED: "payment_received",
    PAYMENT_FAILED: "payment_failed",
    TECHNICAL_ERROR: "technical_error",
    SIGNUP_VALIDATION_FAILED: "validation_failed",
    ACTIVATION_FAILED: "activation_failed",
    UPGRADE_REQUESTED: "upgrade_requested",
    UPGRADE_COMPLETED: "upgrade_completed",
    UPGRADE_PAYMENT_FAILED: "upgrade_payment_failed",
    DEACTIVATION_REQUESTED: "deactivation_requested",
    ACCOUNT_DEACTIVATED: "deactivated",
}
ALERT_TEMPLATES = {MARKET_ALERT_EVENT: "market_alert", SOCIAL_TREND_EVENT: "social_trend"}


def lookup(key: Column, mapping: dict[str, str]) -> Column:
    """Value of a small fixed mapping, null when the key is unknown."""
    return case((key == k, F.lit(v)) for k, v in mapping.items())


def ingress_filter(df: DataFrame, column: str = "type") -> DataFrame:
    """Keep the request events. Point `column` at the header type to filter before parsing."""
    return df.filter(F.col(column).isin(*REQUEST_TYPES))


def route_process(df: DataFrame) -> DataFrame:
    return df.withColumn("process_id", lookup(F.col("type"), PROCESS_IDS))


def signup_only(df: DataFrame, column: str = "type") -> DataFrame:
    return df.filter(F.col(column) == SIGNUP_REQUESTED)


def route_notifications_legacy(df: DataFrame) -> DataFrame:
    """Template per log event; types without one are dropped."""
    return df.filter(F.col("type").isin(*LOG_TEMPLATES)).withColumn(
        "template", lookup(F.col("type"), LOG_TEMPLATES)
    )


def route_scanner_alerts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("type").isin(*ALERT_TEMPLATES)).withColumn(
        "template", lookup(F.col("type"), ALERT_TEMPLATES)
    )


def route_notification_type(df: DataFrame) -> DataFrame:
    """Template per notification command; an unknown type keeps its row with a null template."""
    return df.withColumn("template", lookup(F.col("notification_type"), COMMAND_TEMPLATES))


def classify_message(df: DataFrame, column: str = "message") -> DataFrame:
    """Kind (event or command) and mechanism of each message; unmatched rows are flagged."""
    kinds = {m: kind for m, kind, _ in MESSAGE_CLASSES}
    mechanisms = {m: mechanism for m, _, mechanism in MESSAGE_CLASSES}
    name = F.col(column)
    return df.withColumns({
        "kind": lookup(name, kinds),
        "mechanism": lookup(name, mechanisms),
        "classified": F.coalesce(name.isin(*kinds), F.lit(False)),
    })


def demux_by_type(df: DataFrame, types: tuple[str, ...]) -> dict[str, DataFrame]:
    """One DataFrame per event type. To land them, write once with partitionBy('type')."""
    return {t: df.filter(F.col("type") == t) for t in types}


def payment_required_gate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(paid, free) branches; a null flag satisfies neither."""
    flag = F.col("payment_required")
    return df.filter(flag), df.filter(~flag)


def payment_result(success: Column) -> Column:
    """The branch a payment takes: 'succeeded', 'failed', or null where the flag is null."""
    return F.when(success, F.lit("succeeded")).when(~success, F.lit("failed"))


def payment_result_gate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(succeeded, failed) branches; a null flag satisfies neither."""
    branch = payment_result(F.col("payment_success"))
    return df.filter(branch == "succeeded"), df.filter(branch == "failed")


def retry_decision(retry: Column, retry_count: Column, max_retry: Column | None = None) -> Column:
    """'retry' iff retrying was chosen and the counter is still below the maximum, else 'cancel'."""
    limit = F.coalesce(max_retry, F.lit(MAX_ATTEMPTS)) if max_retry is not None else F.lit(MAX_ATTEMPTS)
    again = F.coalesce(retry, F.lit(False)) & F.coalesce(retry_count < limit, F.lit(False))
    return F.when(again, F.lit("retry")).otherwise(F.lit("cancel"))


def retry_gate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(retry, cancel) branches over `retry_payment` and `retry_count`."""
    decision = retry_decision(F.col("retry_payment"), F.col("retry_count"))
    return df.filter(decision == "retry"), df.filter(decision == "cancel")


def tier_gate_v1(tier: Column) -> Column:
    """Earlier gate: the tier is compared as written, so other spellings match no branch."""
    return F.when(tier == "FREE", F.lit("free")).when(tier.isin("PRO", "ENTERPRISE"), F.lit("paid"))


def tier_gate(tier: Column) -> Column:
    return F.when(normalize_tier(tier).isin("PRO", "ENTERPRISE"), F.lit("paid")).otherwise(F.lit("free"))


def watchlist_filter(df: DataFrame, symbols: tuple[str, ...], column: str = "symbol") -> DataFrame:
    """Keep the configured symbols; the predicate reaches the scan."""
    return df.filter(F.col(column).isin(*symbols))


def post_filter(df: DataFrame, record_type: str = "app.bsky.feed.post") -> DataFrame:
    return df.filter(F.col("record_type") == record_type)

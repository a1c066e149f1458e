"""Business projections: validation, pricing, account actions, notifications and their events.

The functions named in `HANDLERS` are the per-record handlers; each is a DataFrame -> DataFrame
transform built from Column expressions, so a chain of them stays one projection.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.functions.scalar import (
    blank_or_null, case, coalesce_null, derived_id, iso_time, is_paid_tier, is_supported_tier, is_valid_email,
    normalize_tier, price_for_tier,
)
from eventflow.functions.templates import CHAT_TEXTS, TEMPLATES, fill, render
from eventflow.operators.envelope import new_event, reply_event
from eventflow.operators.routing import route_notification_type
from eventflow.operators.saga import refund_action
from eventflow.schemas import (
    ACCOUNT_ACTIVATED_EVENT, MARKET_ALERT_EVENT, NOTIFICATION_FAILED, NOTIFICATION_SENT,
    PAYMENT_FAILED, PAYMENT_RECEIVED, PAYMENT_REFUNDED, PAYMENT_REFUND_FAILED,
    PROCESS_START_FAILED_EVENT, SOCIAL_TREND_EVENT,
)

DEFAULT_SOURCE = "eventflow"
DEFAULT_BRAND = "our service"

UNKNOWN_NOTIFICATION = "unknown-notification-type"
DISPATCH_FAILED = "notification-dispatch-failed"
UPGRADE_ERROR = "UPGRADE_ERROR"
ACTIVATION_ERROR = "ACTIVATION_ERROR"
PAYMENT_ERROR = "PAYMENT_ERROR"


# --- signup ---------------------------------------------------------------------------------

def validate_signup(df: DataFrame) -> DataFrame:
    """First failing rule as `validation_error` (null for valid rows) and the upper-cased tier."""
    tier = normalize_tier(F.col("tier"))
    email = F.coalesce(F.col("email"), F.lit(""))
    error = (
        F.when(blank_or_null(F.col("name")), "name-missing")
        .when(~is_valid_email(email), "email-invalid")
        .when(~is_supported_tier(tier), "tier-unsupported")
    )
    return df.withColumns({"validation_error": error, "tier": tier})


def accept_signup(df: DataFrame, key: str, source: str = DEFAULT_SOURCE) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) split of `validate_signup`. Valid rows get a new user id and the source."""
    checked = validate_signup(df)
    ok = F.col("validation_error").isNull()
    valid = checked.filter(ok).withColumns(
        {"userId": derived_id(source, "user", F.col(key)), "source": F.lit(source)}
    )
    return valid.drop("validation_error"), checked.filter(~ok)


def assess_payment_eligibility(df: DataFrame) -> DataFrame:
    return df.withColumn("payment_required", is_paid_tier(normalize_tier(F.col("tier"))))


def activate_account(df: DataFrame) -> DataFrame:
    """Rows flagged to fail get ACTIVATION_ERROR; the others become active."""
    fails = coalesce_null(F.col("force_activation_failure"), False)
    return df.withColumns({
        "activation_error": F.when(fails, F.lit(ACTIVATION_ERROR)),
        "account_active": ~fails,
        "activated_at": F.when(~fails, F.col("time")),
    })


def apply_tier_upgrade(df: DataFrame) -> DataFrame:
    """The target must be a paid tier; the current tier is not checked, a downgrade passes."""
    target = normalize_tier(F.col("target_tier"))
    ok = is_paid_tier(target)
    out = {
        "upgrade_applied": ok,
        "upgrade_error": F.when(~ok, F.lit(UPGRADE_ERROR)),
        "tier": F.when(ok, target),
    }
    if "time" in df.columns:
        out["upgraded_at"] = F.when(ok, F.col("time"))
    return df.withColumns(out)


def deactivate_account(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "account_active": F.lit(False),
        "deactivated_at": F.col("time"),
        "deactivation_reason": F.coalesce(F.col("reason"), F.lit("")),
    })


# --- payment --------------------------------------------------------------------------------

def process_payment(df: DataFrame) -> DataFrame:
    """Amount and forced outcomes. A forced error wins over a forced failure; otherwise the
    outcome is the input column `payment_success` (the payment provider is outside), and a tier
    without a price always succeeds without a transaction."""
    error = coalesce_null(F.col("force_payment_error"), False)
    forced = coalesce_null(F.col("force_payment_failure"), False)
    amount = price_for_tier(F.col("tier"))
    success = F.when(error, F.lit(None).cast("boolean")).when(forced, F.lit(False)).when(
        amount == 0, F.lit(True)
    ).otherwise(F.col("payment_success"))
    return df.withColumns({
        "payment_error": F.when(error, F.lit(PAYMENT_ERROR)),
        "payment_success": success,
        "payment_amount": F.when(~error, amount),
        "transaction_id": F.when(success & (amount > 0), F.col("transaction_id")),
    })


def plan_refund(df: DataFrame) -> DataFrame:
    return df.withColumn("refund_action", refund_action(F.col("payment_amount"), F.col("transaction_id")))


def refund_payment(df: DataFrame) -> DataFrame:
    """Refund result: skipped counts as a success; else the input column `refund_ok` decides."""
    planned = plan_refund(df)
    skipped = F.col("refund_action") == "skip"
    success = skipped | coalesce_null(F.col("refund_ok"), False)
    return planned.withColumns({
        "refund_skipped": skipped,
        "refund_success": success,
        "refund_transaction_id": F.when(
            success & ~skipped, derived_id("refund", F.col("transaction_id"))
        ).otherwise(F.lit("")),
    })


# --- events ---------------------------------------------------------------------------------

def _person(*extra: Column) -> Column:
    """Who it is about; what is not known is written as empty text."""
    known = {"userId": "user_id", "email": "email", "name": "name", "tier": "tier"}
    return F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(name) for name, c in known.items()], *extra)


def payment_event(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Outcome event per payment; a failure still carries the amount and a null transaction."""
    payload = _person(
        F.col("payment_amount").alias("paymentAmount"),
        F.when(F.col("payment_success"), F.col("transaction_id")).alias("transactionId"),
    )
    type_ = F.when(F.col("payment_success"), F.lit(PAYMENT_RECEIVED)).otherwise(F.lit(PAYMENT_FAILED))
    decided = df.filter(F.col("payment_success").isNotNull())
    return decided.withColumn(
        "event", reply_event(type_, payload, F.col("id"), source, F.col("time"), F.col("traceid"))
    )


def payment_event_legacy(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Choreography variant: the outcome event repeats the request payload unchanged."""
    type_ = F.when(F.col("payment_success"), F.lit(PAYMENT_RECEIVED)).otherwise(F.lit(PAYMENT_FAILED))
    return df.withColumn(
        "event", reply_event(type_, F.col("data"), F.col("id"), source, F.col("time"), F.col("traceid"))
    )


def refund_event(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Refund outcome events; a skipped refund publishes none."""
    payload = _person(
        F.col("payment_amount").alias("paymentAmount"),
        F.col("transaction_id").alias("transactionId"),
        F.col("refund_transaction_id").alias("refundTransactionId"),
        F.col("refund_success").alias("refundSuccess"),
    )
    type_ = F.when(F.col("refund_success"), F.lit(PAYMENT_REFUNDED)).otherwise(F.lit(PAYMENT_REFUND_FAILED))
    return df.filter(~F.col("refund_skipped")).withColumn(
        "event", reply_event(type_, payload, F.col("id"), source, F.col("time"), F.col("traceid"))
    )


def account_activated_event(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Activation events of the rows `activate_account` accepted. The api token stays out."""
    payload = _person(iso_time(F.col("activated_at")).alias("activatedAt"))
    return df.filter("account_active").withColumn(
        "event",
        reply_event(
            F.lit(ACCOUNT_ACTIVATED_EVENT), payload, F.col("id"), source, F.col("time"), F.col("traceid")
        ),
    )


def dead_letter_event(
    df: DataFrame, source: str = DEFAULT_SOURCE, value_col: str = "value", failed_at: str = "time"
) -> DataFrame:
    """Wrap the original text, its type and the reason (blank reads 'unknown'), same trace id.
    `failed_at` is the column with the time of the failure."""
    payload = F.struct(
        F.col("type").alias("originalType"),
        F.when(blank_or_null(F.col("reason")), F.lit("unknown")).otherwise(F.col("reason")).alias("reason"),
        iso_time(F.col(failed_at)).alias("failedAt"),
        F.col(value_col).alias("originalMessage"),
    )
    return df.withColumn(
        "event",
        reply_event(
            F.lit(PROCESS_START_FAILED_EVENT), payload, F.col("id"), source, F.col(failed_at), F.col("traceid")
        ),
    )


def alerts_to_events(df: DataFrame, kind: str, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Alert rows to envelopes. `kind` is 'market' or 'social'; `alert_key` identifies the alert."""
    if kind == "market":
        type_ = MARKET_ALERT_EVENT
        fields = {
            "symbol": "symbol", "alert_type": "alertType", "current_price": "currentPrice",
            "change_percent": "changePercent", "description": "description",
        }
    elif kind == "social":
        type_ = SOCIAL_TREND_EVENT
        fields = {
            "topic": "topic", "alert_type": "alertType", "post_count": "postCount",
            "sentiment": "sentiment", "description": "description",
        }
    else:
        raise ValueError(f"unknown alert kind: {kind}")
    payload = F.struct(*[F.col(column).alias(name) for column, name in fields.items()])
    return df.withColumn(
        "event", new_event(F.lit(type_), payload, F.col("alert_key"), source, F.col("time"))
    )


# --- notifications --------------------------------------------------------------------------

def render_notification(
    df: DataFrame, brand: str = DEFAULT_BRAND, out: str = "text", command: bool = False
) -> DataFrame:
    """Text for each row's `template` over its payload document `data`; null for an unknown template or a
    missing mandatory field. The validation reason is taken from the payload, as intended by the
    modelled process, although the original worker dropped it on the way. With `command` a missing
    name, e-mail or tier reads as empty text, as it does in commands."""
    text = case(
        (F.col("template") == name, render(name, F.col("data"), F.col("traceid"), brand, command)) for name in TEMPLATES
    )
    # a generated row: the text is made once, however many later columns and filters look at it
    return df.drop(out).select("*", F.explode(F.array(text)).alias(out))


def render_chat_message(df: DataFrame) -> DataFrame:
    """Chat text for `chat_kind` success / failed / error. A null part makes the text null; only
    the error text reads a null amount as 0."""
    values = {
        name: F.col(name) for name in ("traceid", "email", "name", "tier", "user_id")
    } | {"transaction": F.col("transaction_id")}
    amount = F.col("payment_amount").cast("string")
    zero = {"error": F.coalesce(amount, F.lit("0"))}
    text = case(
        (F.col("chat_kind") == kind, fill(template, values | {"amount": zero.get(kind, amount)}))
        for kind, template in CHAT_TEXTS.items()
    )
    return df.withColumn("chat_text", text)


def notification_outcome(df: DataFrame) -> DataFrame:
    """Result of each command from its `template`, rendered `text` and, where there is such a column,
    `dispatch_ok`: whether the channel took it.

    Unknown type: fallback and no event. Known type without text or not taken: fallback and a Failed event.
    """
    known, sent = F.col("template").isNotNull(), F.col("text").isNotNull()
    if "dispatch_ok" in df.columns:
        sent = sent & coalesce_null(F.col("dispatch_ok"), False)
    return df.withColumns({
        "notification_sent": known & sent,
        "fallback_used": ~(known & sent),
        "notification_error": F.when(~known, F.lit(UNKNOWN_NOTIFICATION))
        .when(~sent, F.lit(DISPATCH_FAILED))
        .otherwise(F.lit("")),
        "outcome_type": F.when(known & sent, F.lit(NOTIFICATION_SENT)).when(known, F.lit(NOTIFICATION_FAILED)),
        "notification_id": F.when(known & sent, derived_id("notification", F.col("id"))).otherwise(F.lit("")),
    })


def send_notification(df: DataFrame, brand: str = DEFAULT_BRAND) -> DataFrame:
    """Commands to their outcome. Name, e-mail and tier are never missing here, only empty."""
    return notification_outcome(render_notification(route_notification_type(df), brand, command=True))


def notification_event(df: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Sent/Failed events of the commands that publish one."""
    payload = F.struct(
        F.col("notification_type").alias("notificationType"),
        F.col("notification_id").alias("notificationId"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("email", "name", "tier")],
        F.col("notification_sent").alias("success"),
    )
    return df.filter(F.col("outcome_type").isNotNull()).withColumn(
        "event",
        reply_event(
            F.col("outcome_type"), payload, F.col("id"), source, F.col("time"), F.col("traceid")
        ),
    )


# --- handler registry -----------------------------------------------------------------------

HANDLERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "validate-signup": validate_signup,
    "assess-payment-eligibility": assess_payment_eligibility,
    "activate-account": activate_account,
    "apply-tier-upgrade": apply_tier_upgrade,
    "deactivate-account": deactivate_account,
    "process-payment": process_payment,
    "refund-payment": refund_payment,
    "send-notification": send_notification,
}


def handler(name: str) -> Callable[[DataFrame], DataFrame]:
    """Handler by name; a name without one raises instead of waiting for work that never runs."""
    try:
        return HANDLERS[name]
    except KeyError:
        raise KeyError(f"no handler named {name!r}; known: {', '.join(sorted(HANDLERS))}") from None

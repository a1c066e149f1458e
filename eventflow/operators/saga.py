"""Business-transaction state and correlation by trace id.

Every per-trace answer is one grouped fold: flags and first/last values are combined map-side
before the single shuffle on the trace id, so a trace holding a large share of the log costs one
partial row per task. Only the row-per-event forms use ordered windows (see `ordered`).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventflow.functions.scalar import blank_or_null, case, is_paid_tier, normalize_tier
from eventflow.operators.ordered import DAY, next_known, numbered
from eventflow.schemas import (
    ACCOUNT_ACTIVATED_EVENT, ACCOUNT_DEACTIVATED, ACTIVATION_FAILED, DEACTIVATION_REQUESTED,
    MAX_ATTEMPTS, NOTIFICATION_FAILED, NOTIFICATION_SENT, PAYMENT_FAILED, PAYMENT_RECEIVED,
    PAYMENT_REFUNDED, PAYMENT_REFUND_FAILED, PAYMENT_TIMEOUT, PROCESS_START_FAILED_EVENT,
    REQUEST_TYPES, SIGNUP_REQUESTED, SIGNUP_VALIDATION_FAILED, TECHNICAL_ERROR, UPGRADE_COMPLETED,
    UPGRADE_PAYMENT_FAILED, UPGRADE_REQUESTED,
)

PAYMENT_OUTCOMES = (PAYMENT_RECEIVED, PAYMENT_FAILED)


def _is(*types: str) -> Column:
    return F.col("type").isin(*types)


def _notified(*types: str) -> Column:
    """A notification event proves the outcome it reports, whether or not it could be sent."""
    return _is(NOTIFICATION_SENT, NOTIFICATION_FAILED) & F.coalesce(
        F.col("notification_type").isin(*types), F.lit(False)
    )


def _any(condition: Column) -> Column:
    return F.bool_or(condition)


def _position() -> Column:
    return F.struct("time", "id")


# --- timeline -------------------------------------------------------------------------------

def trace_timeline(df: DataFrame, slot: float = DAY) -> DataFrame:
    """All events of each trace with their position in time order, one row per event."""
    events = df.select("traceid", "time", "id", "type")
    return numbered(events, ["traceid"], ["time", "id"], "seq", slot)


# --- outcome of each kind of transaction ----------------------------------------------------

def _signup_flags() -> dict[str, Column]:
    return {
        "start_failed": _is(PROCESS_START_FAILED_EVENT),
        "invalid": _notified(SIGNUP_VALIDATION_FAILED),
        "activation_failed": _notified(ACTIVATION_FAILED),
        "technical_error": _notified(TECHNICAL_ERROR),
        "refunded": _is(PAYMENT_REFUNDED),
        "refund_failed": _is(PAYMENT_REFUND_FAILED),
        "paid": _is(PAYMENT_RECEIVED),
        "pay_failed": _is(PAYMENT_FAILED),
        "activated": _is(ACCOUNT_ACTIVATED_EVENT),
        "requested": _is(SIGNUP_REQUESTED),
    }


#: The state of a trace: the first rule whose flags are all set, and none of those that rule it out.
STATE_RULES: tuple[tuple[str, tuple[str, ...], tuple[str, ...]], ...] = (
    ("START_FAILED", ("start_failed",), ()),
    ("VALIDATION_FAILED", ("invalid",), ()),
    ("COMPENSATED", ("activation_failed", "refunded"), ()),
    ("REFUND_FOLLOW_UP", ("activation_failed", "refund_failed"), ()),
    ("COMPENSATION_MISSING", ("activation_failed", "paid"), ()),
    ("ACTIVATION_FAILED_NO_CHARGE", ("activation_failed",), ()),
    ("ACTIVATED_UNPAID", ("activated", "pay_failed"), ("paid",)),
    ("ACTIVE", ("activated",), ()),
    ("TECHNICAL_ERROR", ("technical_error",), ()),
    ("PAYMENT_FAILED", ("pay_failed",), ("paid",)),
    ("CHARGED_PENDING", ("paid",), ()),
    ("PENDING", ("requested",), ()),
)
NO_STATE = "NO_REQUEST"
#: States in which a transaction has ended; in the others something is still to come: a retry, a refund, an activation.
END_STATES = (
    "START_FAILED", "VALIDATION_FAILED", "COMPENSATED", "REFUND_FOLLOW_UP", "ACTIVATION_FAILED_NO_CHARGE", "ACTIVATED_UNPAID",
    "ACTIVE", "TECHNICAL_ERROR",
)
FLAGS = (
    "start_failed", "invalid", "activation_failed", "technical_error", "refunded", "refund_failed", "paid", "pay_failed",
    "activated", "requested",
)


def signup_state_of_flags() -> Column:
    """First matching rule over the per-trace flags."""
    def holds(needed: tuple[str, ...], against: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a & b, [*map(F.col, needed), *[~F.col(c) for c in against]])

    return case((holds(needed, against), F.lit(name)) for name, needed, against in STATE_RULES).otherwise(NO_STATE)


def flag_bits() -> Column:
    """What one event says of its trace: a bit for each of FLAGS."""
    conditions = _signup_flags()
    return reduce(lambda a, b: a.bitwiseOR(b), [
        F.when(conditions[name], F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(FLAGS)]).cast("bigint")


def state_masks() -> list[tuple[str, int, int, bool]]:
    """The rules over bits: state, bits needed, bits that rule it out, whether the transaction has ended."""
    bits = lambda names: sum(1 << FLAGS.index(n) for n in names)
    return [(name, bits(needed), bits(against), name in END_STATES) for name, needed, against in STATE_RULES] + [(NO_STATE, 0, 0, False)]


def signup_flags(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*(keys or ("traceid",))).agg(
        *[_any(condition).alias(name) for name, condition in _signup_flags().items()]
    )


def signup_state(df: DataFrame) -> DataFrame:
    """One terminal state per trace. Also runs on a stream, in update or complete mode."""
    return signup_flags(df).select("traceid", signup_state_of_flags().alias("state"))


def outcome_summary(states: DataFrame) -> DataFrame:
    """Traces per state and their share of all traces."""
    counts = states.groupBy("state").agg(F.count(F.lit(1)).alias("traces"))
    # one row per state by now, so the unpartitioned window is over a dozen rows
    total = F.sum("traces").over(Window.partitionBy())
    return counts.withColumn("share", F.round(F.col("traces") / total, 6))


def payment_state(df: DataFrame) -> DataFrame:
    """RECEIVED / ERROR / CANCELLED / RETRYING per trace with the number of attempts.

    `retry_payment` is the human decision, which never reaches the log: it is an input column.
    """
    outcome = _is(*PAYMENT_OUTCOMES)
    last = F.max(F.when(outcome, F.struct("time", "id", "type", "retry_payment")))
    folded = (
        df.filter(outcome | _notified(TECHNICAL_ERROR))
        .groupBy("traceid")
        .agg(
            F.count_if(outcome).alias("attempts"),
            _any(_is(PAYMENT_RECEIVED)).alias("paid"),
            _any(_notified(TECHNICAL_ERROR)).alias("technical_error"),
            last.alias("last"),
        )
    )
    failed = F.col("last.type") == PAYMENT_FAILED
    stop = (F.col("attempts") >= MAX_ATTEMPTS) | ~F.coalesce(F.col("last.retry_payment"), F.lit(False))
    state = (
        F.when(F.col("paid"), "RECEIVED")
        .when(F.col("technical_error"), "ERROR")
        .when(failed & stop, "CANCELLED")
        .when(failed, "RETRYING")
    )
    return folded.select("traceid", state.alias("state"), "attempts").filter("state IS NOT NULL")


def upgrade_state(df: DataFrame) -> DataFrame:
    """State of each trace with an upgrade request. A paid upgrade to an unsupported tier is STUCK:
    the worker rejects it but no one catches the rejection."""
    folded = (
        df.groupBy("traceid")
        .agg(
            _any(_is(UPGRADE_REQUESTED)).alias("requested"),
            _any(_notified(UPGRADE_COMPLETED)).alias("completed"),
            _any(_notified(UPGRADE_PAYMENT_FAILED)).alias("pay_failed_notice"),
            _any(_is(PAYMENT_FAILED)).alias("pay_failed"),
            _any(_is(PAYMENT_RECEIVED)).alias("paid"),
            F.max(F.when(_is(UPGRADE_REQUESTED), F.struct("time", "id", "tier"))).alias("request"),
        )
        .filter("requested")
    )
    target_paid = is_paid_tier(normalize_tier(F.col("request.tier")))
    state = (
        F.when(F.col("completed"), "APPLIED")
        .when(F.col("pay_failed_notice") | (F.col("pay_failed") & ~F.col("paid")), "PAYMENT_FAILED")
        .when(F.col("paid") & ~target_paid, "STUCK")
        .when(F.col("paid"), "PAID")
        .otherwise("REQUESTED")
    )
    return folded.select("traceid", state.alias("state"))


def deactivation_state(df: DataFrame) -> DataFrame:
    folded = df.groupBy("traceid").agg(
        _any(_is(DEACTIVATION_REQUESTED)).alias("requested"),
        _any(_notified(ACCOUNT_DEACTIVATED)).alias("done"),
    )
    return folded.filter("requested").select(
        "traceid", F.when(F.col("done"), "DEACTIVATED").otherwise("REQUESTED").alias("state")
    )


def all_of(df: DataFrame, branches: dict[str, Column], only: Column) -> DataFrame:
    """Parallel join: a trace is ready once every branch has an event, at the latest first time.

    `only` selects the traces (any event satisfying it).
    """
    firsts = {name: F.min(F.when(cond, F.col("time"))) for name, cond in branches.items()}
    folded = df.groupBy("traceid").agg(
        _any(only).alias("__only"), *[agg.alias(f"{name}_at") for name, agg in firsts.items()]
    )
    done = {f"{name}_done": F.col(f"{name}_at").isNotNull() for name in branches}
    ready = F.forall(F.array(*done.values()), lambda d: d)
    times = [F.col(f"{name}_at") for name in branches]
    latest = F.greatest(*times) if len(times) > 1 else times[0]
    return folded.filter("__only").select(
        "traceid", *[c.alias(n) for n, c in done.items()], ready.alias("ready"),
        F.when(ready, latest).alias("ready_at"),
    )


def parallel_ready(df: DataFrame) -> DataFrame:
    """Signup traces: the notification branch and the eligibility branch (seen through the payment
    or activation event that follows it) must both have finished."""
    return all_of(
        df,
        {
            "notification": _is(NOTIFICATION_SENT),
            "eligibility": _is(
                PAYMENT_RECEIVED, PAYMENT_FAILED, PAYMENT_REFUNDED, PAYMENT_REFUND_FAILED,
                ACCOUNT_ACTIVATED_EVENT,
            ),
        },
        _is(SIGNUP_REQUESTED),
    )


# --- correlation ----------------------------------------------------------------------------

def request_outcome(df: DataFrame, timeout: str = PAYMENT_TIMEOUT, slot: float = DAY) -> DataFrame:
    """First payment outcome of the same trace within `timeout` of each request, else TIMEOUT.

    An as-of lookup in one ordered pass over requests and outcomes together, not a join of all
    pairs, so a trace with many of both stays linear.
    """
    both = df.filter(_is(*REQUEST_TYPES, *PAYMENT_OUTCOMES)).select(
        "traceid", "time", "id", "type", _is(*PAYMENT_OUTCOMES).alias("is_outcome")
    )
    outcome = F.when(F.col("is_outcome"), F.struct("time", "id", "type"))
    keys, order = ["traceid"], ["time", "is_outcome", "id"]
    found = next_known(both, keys, order, outcome, "outcome", slot)
    in_time = F.col("outcome.time") <= F.col("time") + F.expr(f"INTERVAL {timeout}")
    hit = F.when(in_time, F.col("outcome"))
    return found.filter("NOT is_outcome").select(
        "traceid", "id", "type", "time",
        F.coalesce(hit["type"], F.lit("TIMEOUT")).alias("outcome"),
        hit["id"].alias("outcome_id"), hit["time"].alias("outcome_time"),
    )


def _last_payment() -> Column:
    return F.max(
        F.when(_is(PAYMENT_RECEIVED), F.struct("time", "id", "payment_amount", "transaction_id", "tier"))
    )


def compensations(df: DataFrame) -> DataFrame:
    """One refund command per trace with a captured payment and a failed activation, unless a
    refund was already issued. `refund_action` says whether there is money to return."""
    folded = (
        df.groupBy("traceid")
        .agg(
            _last_payment().alias("payment"),
            _any(_notified(ACTIVATION_FAILED)).alias("activation_failed"),
            _any(_is(PAYMENT_REFUNDED, PAYMENT_REFUND_FAILED)).alias("refund_issued"),
        )
        .filter("payment IS NOT NULL AND activation_failed AND NOT refund_issued")
    )
    return folded.select(
        "traceid", F.col("payment.id").alias("payment_id"),
        F.col("payment.payment_amount").alias("payment_amount"),
        F.col("payment.transaction_id").alias("transaction_id"),
        refund_action(F.col("payment.payment_amount"), F.col("payment.transaction_id")).alias("refund_action"),
    )


def refund_action(amount: Column, transaction_id: Column) -> Column:
    """'skip' when nothing was captured (no amount or no transaction), else 'refund'."""
    nothing = F.coalesce(amount <= 0, F.lit(True)) | blank_or_null(transaction_id)
    return F.when(nothing, F.lit("skip")).otherwise(F.lit("refund"))


def charged_not_activated(df: DataFrame) -> DataFrame:
    """Traces with a received payment but neither an activation nor any refund outcome."""
    paid = _is(PAYMENT_RECEIVED)
    return (
        df.filter(_is(PAYMENT_RECEIVED, ACCOUNT_ACTIVATED_EVENT, PAYMENT_REFUNDED, PAYMENT_REFUND_FAILED))
        .groupBy("traceid")
        .agg(
            F.count_if(paid).alias("payments"),
            F.sum(F.when(paid, F.col("payment_amount"))).alias("captured_cents"),
            F.min(F.when(paid, F.col("time"))).alias("first_paid_at"),
            _any(~paid).alias("settled"),
        )
        .filter("payments > 0 AND NOT settled")
        .drop("settled")
    )


def activated_unpaid(df: DataFrame) -> DataFrame:
    """Traces activated on a paid tier although every payment failed.

    The failed payment branch of the modelled process ends normally, so activation still runs.
    """
    on_paid_tier = _is(ACCOUNT_ACTIVATED_EVENT) & is_paid_tier(normalize_tier(F.col("tier")))
    return (
        df.filter(_is(ACCOUNT_ACTIVATED_EVENT, *PAYMENT_OUTCOMES))
        .groupBy("traceid")
        .agg(
            _any(on_paid_tier).alias("activated"),
            F.count_if(_is(PAYMENT_FAILED)).alias("failed_payments"),
            _any(_is(PAYMENT_RECEIVED)).alias("paid"),
        )
        .filter("activated AND failed_payments > 0 AND NOT paid")
        .select("traceid", "failed_payments")
    )


def refund_follow_up(df: DataFrame) -> DataFrame:
    """Traces whose last failed refund was not followed by a successful one."""
    return (
        df.filter(_is(PAYMENT_REFUNDED, PAYMENT_REFUND_FAILED))
        .groupBy("traceid")
        .agg(
            F.max(F.when(_is(PAYMENT_REFUND_FAILED), _position())).alias("failed"),
            F.max(F.when(_is(PAYMENT_REFUNDED), _position())).alias("refunded"),
        )
        .filter("failed IS NOT NULL AND (refunded IS NULL OR refunded < failed)")
        .select("traceid", F.col("failed.id").alias("refund_event_id"), F.col("failed.time").alias("failed_at"))
    )


# --- retries --------------------------------------------------------------------------------

def payment_attempts(df: DataFrame, slot: float = DAY) -> DataFrame:
    """Payment events with their attempt number within the trace."""
    payments = df.filter(_is(*PAYMENT_OUTCOMES)).select("traceid", "time", "id", "type", "retry_payment")
    return numbered(payments, ["traceid"], ["time", "id"], "attempt", slot)


def retries_exhausted(df: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Traces whose last payment failed at or beyond the last allowed attempt."""
    return (
        df.filter(_is(*PAYMENT_OUTCOMES))
        .groupBy("traceid")
        .agg(F.count(F.lit(1)).alias("attempts"), F.max(F.struct("time", "id", "type")).alias("last"))
        .filter((F.col("attempts") >= max_attempts) & (F.col("last.type") == PAYMENT_FAILED))
        .select("traceid", "attempts", F.col("last.id").alias("last_id"))
    )


def start_or_dead_letter(attempts: DataFrame, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Outcome of each process start: 'started', 'dead_letter' after the allowed tries, or 'retry'.

    The reason is that of the last attempt; a blank one reads 'unknown'.
    """
    folded = attempts.groupBy("start_id").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.bool_or("ok").alias("started"),
        F.max(F.struct("ts", "event_id", "reason")).alias("last"),
    )
    outcome = (
        F.when(F.col("started"), "started")
        .when(F.col("attempts") >= max_attempts, "dead_letter")
        .otherwise("retry")
    )
    reason = F.when(blank_or_null(F.col("last.reason")), "unknown").otherwise(F.col("last.reason"))
    return folded.select(
        "start_id", "attempts", outcome.alias("outcome"),
        F.when(outcome == "dead_letter", reason).alias("reason"),
        F.col("last.ts").alias("last_at"), F.col("last.event_id").alias("last_event_id"),
    )


# --- accounts and money ---------------------------------------------------------------------

def account_event_kinds() -> tuple[Column, Column, Column]:
    """Whether an event opens, upgrades or closes an account."""
    return _is(ACCOUNT_ACTIVATED_EVENT), _notified(UPGRADE_COMPLETED), _notified(ACCOUNT_DEACTIVATED)


def account_state(df: DataFrame, key: str = "account") -> DataFrame:
    """Latest tier and active flag per account, from activation, upgrade and deactivation events.

    The user id is minted anew along the way, so the account key must be a stable one (e-mail).
    An upgrade keeps the active flag it does not mention, a deactivation keeps the tier.
    """
    opened, upgraded, closed = account_event_kinds()
    at = F.struct(F.col("time"), F.col("id"))
    return (
        df.filter(opened | upgraded | closed)
        .groupBy(key)
        .agg(
            F.max_by("tier", F.when(opened | upgraded, at)).alias("tier"),
            F.max_by(opened, F.when(opened | closed, at)).alias("active"),
            F.max("time").alias("updated_at"),
        )
        .withColumns({"tier": normalize_tier(F.col("tier"))})
    )


def revenue_by_tier(df: DataFrame) -> DataFrame:
    """Captured, refunded and net cents per tier."""
    amount = F.coalesce(F.col("payment_amount"), F.lit(0))
    captured = F.sum(F.when(_is(PAYMENT_RECEIVED), amount).otherwise(0))
    refunded = F.sum(F.when(_is(PAYMENT_REFUNDED), amount).otherwise(0))
    return (
        df.filter(_is(PAYMENT_RECEIVED, PAYMENT_REFUNDED))
        .groupBy(normalize_tier(F.col("tier")).alias("tier"))
        .agg(captured.alias("captured_cents"), refunded.alias("refunded_cents"),
             (captured - refunded).alias("net_cents"))
    )

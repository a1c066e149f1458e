from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventflow.operators import audit, saga

T0 = datetime(2024, 1, 1)
SCHEMA = (
    "traceid STRING, id STRING, time TIMESTAMP, type STRING, notification_type STRING, tier STRING, "
    "payment_amount BIGINT, transaction_id STRING, retry_payment BOOLEAN"
)


def log(rows, *traces):
    """traces: (traceid, [event or (event, {column: value})]); events one minute apart."""
    out, n = [], 0
    for traceid, events in traces:
        for i, event in enumerate(events):
            name, extra = event if isinstance(event, tuple) else (event, {})
            type_, _, nt = name.partition("/")
            row = {"notification_type": nt or None, "tier": "PRO", "payment_amount": None,
                   "transaction_id": None, "retry_payment": None, "minute": i} | extra
            minute = row.pop("minute")
            out.append((traceid, f"e{n:04d}", T0 + timedelta(minutes=minute), type_, *row.values()))
            n += 1
    return rows(out, SCHEMA)


PAID = ("PaymentReceivedEvent", {"payment_amount": 1900, "transaction_id": "tx"})
SENT = "NotificationSentEvent/"

# The demo scenarios: events on the log -> state of the trace.
SCENARIOS = [
    ("free", ["SignupRequestedEvent", SENT + "SignupRequestedEvent", "AccountActivatedEvent"], "ACTIVE"),
    ("pro", ["SignupRequestedEvent", PAID, "AccountActivatedEvent"], "ACTIVE"),
    ("refunded", ["SignupRequestedEvent", PAID, "PaymentRefundedEvent", SENT + "AccountActivationFailedEvent"],
     "COMPENSATED"),
    ("refund failed", ["SignupRequestedEvent", PAID, "PaymentRefundFailedEvent", SENT + "AccountActivationFailedEvent"],
     "REFUND_FOLLOW_UP"),
    ("no refund", ["SignupRequestedEvent", PAID, SENT + "AccountActivationFailedEvent"], "COMPENSATION_MISSING"),
    ("free, activation failed", ["SignupRequestedEvent", SENT + "AccountActivationFailedEvent"],
     "ACTIVATION_FAILED_NO_CHARGE"),
    ("declined but activated", ["SignupRequestedEvent", "PaymentFailedEvent", "AccountActivatedEvent"],
     "ACTIVATED_UNPAID"),
    ("declined", ["SignupRequestedEvent", "PaymentFailedEvent"], "PAYMENT_FAILED"),
    ("payment error", ["SignupRequestedEvent", SENT + "TechnicalError"], "TECHNICAL_ERROR"),
    ("invalid", ["SignupRequestedEvent", SENT + "SignupValidationFailedEvent"], "VALIDATION_FAILED"),
    ("invalid, mail failed", ["SignupRequestedEvent", "NotificationFailedEvent/SignupValidationFailedEvent"],
     "VALIDATION_FAILED"),
    ("not started", ["SignupRequestedEvent", "ProcessStartFailedEvent"], "START_FAILED"),
    ("charged", ["SignupRequestedEvent", PAID], "CHARGED_PENDING"),
    ("pending", ["SignupRequestedEvent"], "PENDING"),
    ("stray", [SENT + "Other"], "NO_REQUEST"),
]


def test_signup_scenarios(rows):
    df = log(rows, *[(name, events) for name, events, _ in SCENARIOS])
    states = saga.signup_state(df)
    assert {r.traceid: r.state for r in states.collect()} == {name: state for name, _, state in SCENARIOS}
    summary = saga.outcome_summary(states).collect()
    assert sum(r.traces for r in summary) == len(SCENARIOS)
    assert sum(r.share for r in summary) == pytest.approx(1, abs=1e-4)


def test_upgrade_and_deactivation(rows):
    free = ("UpgradeRequestedEvent", {"tier": "free"})
    df = log(
        rows,
        ("applied", ["UpgradeRequestedEvent", PAID, SENT + "UpgradeCompletedEvent"]),
        ("paid", ["UpgradeRequestedEvent", PAID]),
        ("stuck", [free, PAID]),
        ("failed", ["UpgradeRequestedEvent", "PaymentFailedEvent"]),
        ("open", ["UpgradeRequestedEvent"]),
        ("other", ["SignupRequestedEvent", PAID]),
        ("gone", ["AccountDeactivationRequestedEvent", SENT + "AccountDeactivatedEvent"]),
        ("leaving", ["AccountDeactivationRequestedEvent"]),
    )
    assert {r.traceid: r.state for r in saga.upgrade_state(df).collect()} == {
        "applied": "APPLIED", "paid": "PAID", "stuck": "STUCK", "failed": "PAYMENT_FAILED", "open": "REQUESTED",
    }
    assert {r.traceid: r.state for r in saga.deactivation_state(df).collect()} == {
        "gone": "DEACTIVATED", "leaving": "REQUESTED",
    }


def test_payment_state_and_retries(rows):
    again = ("PaymentFailedEvent", {"retry_payment": True})
    df = log(
        rows, ("received", [again, PAID]), ("error", [again, SENT + "TechnicalError"]), ("retrying", [again, again]),
        ("third", [again, again, again]), ("declined", [("PaymentFailedEvent", {"retry_payment": False})]),
        ("none", ["SignupRequestedEvent"]),
    )
    assert {r.traceid: (r.state, r.attempts) for r in saga.payment_state(df).collect()} == {
        "received": ("RECEIVED", 2), "error": ("ERROR", 1), "retrying": ("RETRYING", 2),
        "third": ("CANCELLED", 3), "declined": ("CANCELLED", 1),
    }
    assert [r.traceid for r in saga.retries_exhausted(df).collect()] == ["third"]
    attempts = saga.payment_attempts(df).filter("traceid = 'third'").orderBy("time").collect()
    assert [r.attempt for r in attempts] == [1, 2, 3]


def test_parallel_ready(rows):
    df = log(
        rows, ("both", ["SignupRequestedEvent", SENT + "SignupRequestedEvent", PAID]),
        ("one", ["SignupRequestedEvent", PAID]), ("no request", [SENT + "x", PAID]),
    )
    out = {r.traceid: r for r in saga.parallel_ready(df).collect()}
    assert set(out) == {"both", "one"}
    assert out["both"].ready and out["both"].ready_at == T0 + timedelta(minutes=2)
    assert not out["one"].ready and out["one"].ready_at is None and not out["one"].notification_done


def test_request_outcome(rows):
    late = ("PaymentReceivedEvent", {"minute": 6})
    edge = ("PaymentFailedEvent", {"minute": 5})
    same_time = ("PaymentReceivedEvent", {"minute": 0})
    early = ("PaymentReceivedEvent", {"minute": -1})
    df = log(
        rows, ("late", ["SignupRequestedEvent", late]), ("edge", ["SignupRequestedEvent", edge, late]),
        ("at once", ["SignupRequestedEvent", same_time]), ("before", [early, ("SignupRequestedEvent", {"minute": 0})]),
    )
    for slot in (86_400, 1):
        out = {r.traceid: r.outcome for r in saga.request_outcome(df, slot=slot).collect()}
        assert out == {"late": "TIMEOUT", "edge": "PaymentFailedEvent", "at once": "PaymentReceivedEvent",
                       "before": "TIMEOUT"}


def test_compensation_checks(rows):
    failed = SENT + "AccountActivationFailedEvent"
    empty = ("PaymentReceivedEvent", {"payment_amount": 0, "transaction_id": None})
    df = log(
        rows, ("due", ["SignupRequestedEvent", PAID, failed]), ("nothing charged", [empty, failed]),
        ("issued", [PAID, failed, "PaymentRefundFailedEvent"]), ("retried", [PAID, "PaymentRefundFailedEvent", "PaymentRefundedEvent"]),
        ("fine", [PAID, "AccountActivatedEvent"]), ("unpaid", ["PaymentFailedEvent", "AccountActivatedEvent"]),
        ("unpaid free", ["PaymentFailedEvent", ("AccountActivatedEvent", {"tier": "free"})]),
    )
    assert {r.traceid: r.refund_action for r in saga.compensations(df).collect()} == {
        "due": "refund", "nothing charged": "skip",
    }
    assert {r.traceid for r in saga.charged_not_activated(df).collect()} == {"due", "nothing charged"}
    assert [r.traceid for r in saga.activated_unpaid(df).collect()] == ["unpaid"]
    assert [r.traceid for r in saga.refund_follow_up(df).collect()] == ["issued"]


def test_account_state(rows):
    df = log(
        rows, ("a", [("AccountActivatedEvent", {"tier": "free"}), (SENT + "UpgradeCompletedEvent", {"tier": "pro"}),
                     SENT + "AccountDeactivatedEvent"]),
        ("b", [("AccountActivatedEvent", {"tier": "PRO"})]),
    ).withColumn("account", F.col("traceid"))
    out = {r.account: (r.tier, r.active) for r in saga.account_state(df).collect()}
    assert out == {"a": ("PRO", False), "b": ("PRO", True)}


def test_start_or_dead_letter(rows):
    data = [("ok", 1, T0, False, "x"), ("ok", 2, T0, True, "y"), ("dead", 1, T0, False, "a"), ("dead", 2, T0, False, "b"),
            ("dead", 3, T0, False, " "), ("once", 1, T0, False, "c")]
    df = rows(data, "start_id STRING, event_id INT, ts TIMESTAMP, ok BOOLEAN, reason STRING")
    out = {r.start_id: (r.outcome, r.reason) for r in saga.start_or_dead_letter(df).collect()}
    assert out == {"ok": ("started", None), "dead": ("dead_letter", "unknown"), "once": ("retry", None)}


def test_audits(rows):
    sent = rows([("a",), ("a",), ("b",)], "key STRING")
    consumed = rows([("b",), ("b",), ("c",)], "key STRING")
    assert [tuple(r) for r in audit.lost_messages(sent, consumed, "key", "key").collect()] == [("a", 2)]
    outbox = rows([("1", "x"), ("2", "y")], "id STRING, v STRING")
    assert [tuple(r) for r in audit.outbox_relay(outbox, rows([("1",), ("1",)], "id STRING")).collect()] == [("2", "y")]

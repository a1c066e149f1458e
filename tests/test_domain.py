from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from eventflow.functions.scalar import document, field
from eventflow.functions.templates import TEMPLATES
from eventflow.operators import domain, envelope, routing
from eventflow.sources import logs

T0 = datetime(2024, 1, 1, 12)


def test_validation_order(rows):
    df = rows([(1, " \t", "bad", "gold"), (2, "n", "bad", "gold"), (3, "n", "a@b", "gold"), (4, "n", "a@b", "pro"),
               (5, None, "a@b", "pro"), (6, "n", None, "pro"), (7, "n", "a@b", None)],
              "id INT, name STRING, email STRING, tier STRING")
    out = {r.id: (r.validation_error, r.tier) for r in domain.validate_signup(df).collect()}
    assert [out[i][0] for i in range(1, 8)] == [
        "name-missing", "email-invalid", "tier-unsupported", None, "name-missing", "email-invalid", "tier-unsupported"]
    assert out[4][1] == "PRO"
    valid, rejected = domain.accept_signup(df, "id")
    assert valid.count() + rejected.count() == df.count()
    assert valid.first().userId is not None


def test_upgrade_and_activation(rows):
    df = rows([("pro", None, T0), ("free", True, T0), (None, False, T0)],
              "target_tier STRING, force_activation_failure BOOLEAN, time TIMESTAMP")
    up = domain.apply_tier_upgrade(df).collect()
    assert [(r.upgrade_applied, r.upgrade_error, r.tier) for r in up] == [
        (True, None, "PRO"), (False, "UPGRADE_ERROR", None), (False, "UPGRADE_ERROR", None)]
    act = domain.activate_account(df).collect()
    assert [(r.account_active, r.activation_error) for r in act] == [
        (True, None), (False, "ACTIVATION_ERROR"), (True, None)]


def test_payment(rows):
    schema = ("id STRING, traceid STRING, time TIMESTAMP, user_id STRING, email STRING, name STRING, tier STRING, "
              "force_payment_error BOOLEAN, force_payment_failure BOOLEAN, payment_success BOOLEAN, transaction_id STRING")
    base = ("t", T0, "u", "e", "n")
    df = rows([("1", *base, "pro", False, False, True, "tx"), ("2", *base, "PRO", False, True, True, "tx"),
               ("3", *base, "pro", True, True, True, "tx"), ("4", *base, "free", None, None, None, "tx"),
               ("5", *base, "enterprise", None, None, False, "tx")], schema)
    paid = domain.process_payment(df)
    out = {r.id: (r.payment_success, r.payment_amount, r.transaction_id, r.payment_error) for r in paid.collect()}
    assert out == {
        "1": (True, 1900, "tx", None), "2": (False, 1900, None, None), "3": (None, None, None, "PAYMENT_ERROR"),
        "4": (True, 0, None, None), "5": (False, 9900, None, None),
    }
    events = {r.id: r.event for r in domain.payment_event(paid).select("id", "event").collect()}
    assert set(events) == {"1", "2", "4", "5"}
    assert events["2"].type == "PaymentFailedEvent" and events["2"].data.paymentAmount == 1900
    assert events["2"].data.transactionId is None and events["2"].traceid == "t"


def test_refund(rows):
    schema = ("id STRING, traceid STRING, time TIMESTAMP, user_id STRING, email STRING, name STRING, tier STRING, "
              "payment_amount BIGINT, transaction_id STRING, refund_ok BOOLEAN")
    base = ("t", T0, "u", "e", "n", "pro")
    df = domain.refund_payment(rows([("1", *base, 0, "tx", True), ("2", *base, 1900, "tx", True),
                                     ("3", *base, 1900, "tx", False)], schema))
    out = {r.id: (r.refund_skipped, r.refund_success, r.refund_transaction_id != "") for r in df.collect()}
    assert out == {"1": (True, True, False), "2": (False, True, True), "3": (False, False, False)}
    events = {r.id: r.event.type for r in domain.refund_event(df).collect()}
    assert events == {"2": "PaymentRefundedEvent", "3": "PaymentRefundFailedEvent"}


def render(rows, template, json):
    df = rows([(template, "t1", json)], "template STRING, traceid STRING, j STRING").withColumn("data", document(F.col("j")))
    return domain.render_notification(df, brand="Example").first().text


PERSON = '"name":"Al","email":"al@x.org","tier":"PRO"'


@pytest.mark.parametrize(("template", "json", "text"), [
    ("signup", f"{{{PERSON}}}",
     "[EMAIL] Welcome to Example! | To: al@x.org | Dear Al, your PRO signup is being processed. | Trace: t1"),
    ("validation_failed", f'{{{PERSON},"validationError":"email-invalid"}}',
     "[EMAIL] Signup Validation Failed | To: al@x.org | Dear Al, we could not validate your PRO signup. "
     "Reason: email-invalid | Trace: t1"),
    ("activation_failed", f'{{{PERSON},"refundSkipped":true,"refundSuccess":true}}',
     "[EMAIL] Account Activation Failed | To: al@x.org | Dear Al, we could not activate your PRO account. "
     "No charge was captured, so no refund was needed. | Trace: t1"),
    ("refunded", "{}", "[EMAIL] Refund Completed | To: unknown | Your unknown payment was refunded. "
     "Refund Transaction:  | Trace: t1"),
    ("upgrade_payment_failed", '{"name":"","email":"e"}',
     "[EMAIL] Upgrade Payment Failed | To: e | Dear , we could not process payment for UNKNOWN upgrade. | Trace: t1"),
    ("market_alert", '{"symbol":"S","alertType":"PRICE_DROP","changePercent":-5,"description":"d"}',
     "[ALERT] Market Alert: PRICE_DROP | Symbol: S | Change: -5.0% | d | Trace: t1"),
    ("social_trend", '{"topic":"T","alertType":"TRENDING","postCount":7,"sentiment":"NEUTRAL","description":"d"}',
     "[ALERT] Social Trend: TRENDING | Topic: T | Posts: 7 | Sentiment: NEUTRAL | d | Trace: t1"),
    ("payment_failed", '{"name":"Al","tier":"PRO"}', None),
    ("social_trend", '{"topic":"T"}', None),
    ("nothing", f"{{{PERSON}}}", None),
])
def test_render(rows, template, json, text):
    assert render(rows, template, json) == text


def test_every_template_renders(rows):
    everything = ('{"name":"n","email":"e","tier":"t","symbol":"s","alertType":"a","changePercent":1.5,"description":"d",'
                  '"topic":"t","postCount":1,"sentiment":"s"}')
    df = rows([(t, "t1", everything) for t in TEMPLATES], "template STRING, traceid STRING, j STRING")
    for r in domain.render_notification(df.withColumn("data", document(F.col("j")))).collect():
        assert r.text and "{" not in r.text and r.text.endswith("| Trace: t1")


def test_chat(rows):
    schema = ("chat_kind STRING, traceid STRING, user_id STRING, email STRING, name STRING, tier STRING, "
              "payment_amount BIGINT, transaction_id STRING")
    df = rows([("success", "t", "u", "e", "n", "PRO", 1900, "tx"), ("success", "t", "u", "e", "n", "PRO", 1900, None),
               ("error", "t", "u", "e", "n", "PRO", None, None), ("failed", "t", "u", "e", "n", "PRO", None, None)], schema)
    out = [r.chat_text for r in domain.render_chat_message(df).collect()]
    assert out[0].endswith("Amount: 1900\nTransaction: tx") and out[1] is None and out[3] is None
    assert "Payment amount: 0\n" in out[2]


def test_notification_outcome(rows):
    df = rows([("1", "PaymentReceivedEvent", f"{{{PERSON}}}"), ("2", "PaymentReceivedEvent", "{}"), ("3", "Other", f"{{{PERSON}}}"),
               ("4", None, "{}")], "id STRING, notification_type STRING, j STRING").withColumns({
        "data": document(F.col("j")), "traceid": F.lit("t"), "time": F.lit(T0), "email": F.lit("e"),
        "name": F.lit("n"), "tier": F.lit("PRO")})
    assert domain.send_notification(df).filter("id = '2'").first().notification_sent  # nobody named is no failure
    sent = domain.send_notification(df.withColumn("dispatch_ok", F.col("id") != "2"))
    assert "null" not in sent.filter("id = '2'").first().text
    out = {r.id: (r.notification_sent, r.fallback_used, r.notification_error, r.outcome_type) for r in sent.collect()}
    assert out == {
        "1": (True, False, "", "NotificationSentEvent"),
        "2": (False, True, "notification-dispatch-failed", "NotificationFailedEvent"),
        "3": (False, True, "unknown-notification-type", None), "4": (False, True, "unknown-notification-type", None),
    }
    events = {r.id: r.event for r in domain.notification_event(sent).collect()}
    assert set(events) == {"1", "2"} and events["1"].data.success and events["2"].data.notificationId == ""


def test_registry(rows):
    assert len(domain.HANDLERS) == 8
    df = rows([("pro",)], "tier STRING")
    assert df.transform(domain.handler("assess-payment-eligibility")).first().payment_required
    with pytest.raises(KeyError, match="no handler"):
        domain.handler("validate_signup")


def test_gates_lose_no_row(rows):
    df = rows([(True, 1), (False, 1), (None, 5), (True, 9)], "retry_payment BOOLEAN, retry_count INT")
    again, stop = routing.retry_gate(df)
    assert (again.count(), stop.count()) == (1, 3)
    flags = rows([(True,), (False,), (None,)], "payment_success BOOLEAN")
    assert [p.count() for p in routing.payment_result_gate(flags)] == [1, 1]
    tiers = rows([("PRO",), ("pro",), ("FREE",)], "tier STRING")
    assert [r[0] for r in tiers.select(routing.tier_gate_v1(F.col("tier"))).collect()] == ["paid", None, "free"]


def test_envelope_roundtrip(rows):
    df = rows([("k1", T0, None), ("k2", T0, "x")], "key STRING, time TIMESTAMP, tx STRING")
    event = envelope.new_event(F.lit("T"), F.struct(F.col("tx"), F.lit(1).alias("n")), F.col("key"), "src", F.col("time"))
    records = logs.to_records(df.select(event.alias("event")))
    assert '"correlationid":null' in records.first().value and '"tx":null' in records.first().value
    parsed = envelope.parse_envelope(envelope.event_type(records))
    row = parsed.withColumn("tx", field(F.col("data"), "tx")).orderBy("tx").collect()
    assert row[0].tx is None and row[1].tx == "x"
    assert row[0].time == T0 and row[0].type == "T" and row[0].specversion == "1.0" and not row[0].type_mismatch
    assert row[0].id != row[1].id and row[0].traceid != row[1].traceid
    again = envelope.parse_envelope(envelope.event_type(records)).select("id").collect()
    assert {r.id for r in again} == {r.id for r in row}


def test_missing_header_and_quarantine(rows):
    df = rows([('{"type":"A","traceid":"t","data":{},"time":"2024-01-01T00:00:00Z"}', None), ("broken", []), ('{"type":"B","data":null}', None)],
              "value STRING, headers ARRAY<STRUCT<key: STRING, value: BINARY>>")
    parsed = envelope.parse_envelope(envelope.event_type(df))
    good, bad = envelope.quarantine(parsed)
    assert [r.type for r in good.collect()] == ["A"]
    assert {tuple(r.missing_fields) for r in bad.collect()} == {("type", "traceid", "data", "time"), ("traceid", "data", "time")}


def test_copy_present(rows):
    df = rows([('{"reason":"r","other":1,"paymentAmount":5,"tier":null,"transactionId":null,"refundSuccess":false}',)], "j STRING")
    out = df.select(envelope.copy_present(document(F.col("j")))).first()[0]
    assert out == '{"paymentAmount":5,"reason":"r","refundSuccess":false}'


def test_classify(rows):
    df = rows([("process-payment",), ("MarketAlertEvent",), ("x",), (None,)], "message STRING")
    out = [(r.kind, r.mechanism, r.classified) for r in routing.classify_message(df).collect()]
    assert out == [("Command", "engine", True), ("Event", "log", True), (None, None, False), (None, None, False)]

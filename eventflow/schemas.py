"""Schemas, event types and other fixed values of the event log."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _L, _I, _D, _B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()

# `data` is any JSON value; parsed events carry it as VARIANT until the type is known.
ENVELOPE = _struct(
    type=_S, id=_S, source=_S, time=_S, data=T.VariantType(), datacontenttype=_S, specversion=_S,
    traceid=_S, correlationid=_S, group=_S,
)
SIGNUP_REQUEST = _struct(
    userId=_S, email=_S, name=_S, tier=_S,
    forceActivationFailure=_B, forcePaymentFailure=_B, forcePaymentError=_B,
)
UPGRADE_REQUEST = _struct(userId=_S, email=_S, name=_S, currentTier=_S, targetTier=_S)
DEACTIVATION_REQUEST = _struct(userId=_S, email=_S, name=_S, tier=_S, reason=_S)
PAYMENT_RESULT = _struct(userId=_S, email=_S, name=_S, tier=_S, paymentAmount=_L, transactionId=_S)
REFUND_RESULT = _struct(
    userId=_S, email=_S, name=_S, tier=_S, paymentAmount=_L, transactionId=_S,
    refundTransactionId=_S, refundSuccess=_B,
)
ACCOUNT_ACTIVATED = _struct(userId=_S, email=_S, name=_S, tier=_S, activatedAt=_S)
NOTIFICATION_OUTCOME = _struct(notificationType=_S, notificationId=_S, email=_S, name=_S, tier=_S, success=_B)
PROCESS_START_FAILED = _struct(originalType=_S, reason=_S, failedAt=_S, originalMessage=_S)
MARKET_ALERT = _struct(symbol=_S, alertType=_S, currentPrice=_D, changePercent=_D, description=_S)
SOCIAL_TREND = _struct(topic=_S, alertType=_S, postCount=_I, sentiment=_S, description=_S)
PROBE = _struct(seq=_L, ts=_L, rf=_I, acks=_S)
RESOURCE_SAMPLE = _struct(timestamp=_L, cpuLoad=_D, heapUsedBytes=_L, heapMaxBytes=_L)
DELIVERY_RESULT = _struct(
    rf=_I, acks=_S, phase=_S, attempted=_L, sent=_L, sendFailed=_L, consumed=_L, dropped=_L,
    dropRate=_D, throughput=_D, p50=_L, p95=_L, p99=_L, verdict=_S,
)
CLUSTER_OBS = _struct(
    topic=_S, partition=_I, observed_at=T.TimestampType(), leader=_I,
    isr=T.ArrayType(_I), replicas=T.ArrayType(_I),
)

# One record as it sits on the log, whatever the connector.
LOG_RECORD = T.StructType([
    T.StructField("key", _S),
    T.StructField("value", _S),
    T.StructField("topic", _S),
    T.StructField("partition", _I),
    T.StructField("offset", _L),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("headers", T.ArrayType(_struct(key=_S, value=T.BinaryType()))),
])

# --- fixed values: event types, notification types, tiers, prices ---------------------------
SIGNUP_REQUESTED = "SignupRequestedEvent"
UPGRADE_REQUESTED = "UpgradeRequestedEvent"
DEACTIVATION_REQUESTED = "AccountDeactivationRequestedEvent"
PAYMENT_RECEIVED = "PaymentReceivedEvent"
PAYMENT_FAILED = "PaymentFailedEvent"
PAYMENT_REFUNDED = "PaymentRefundedEvent"
PAYMENT_REFUND_FAILED = "PaymentRefundFailedEvent"
ACCOUNT_ACTIVATED_EVENT = "AccountActivatedEvent"
NOTIFICATION_SENT = "NotificationSentEvent"
NOTIFICATION_FAILED = "NotificationFailedEvent"
MARKET_ALERT_EVENT = "MarketAlertEvent"
SOCIAL_TREND_EVENT = "SocialTrendEvent"
PROCESS_START_FAILED_EVENT = "ProcessStartFailedEvent"

# Outcomes that exist only as the notification type of a notification event.
TECHNICAL_ERROR = "TechnicalError"
SIGNUP_VALIDATION_FAILED = "SignupValidationFailedEvent"
ACTIVATION_FAILED = "AccountActivationFailedEvent"
UPGRADE_COMPLETED = "UpgradeCompletedEvent"
UPGRADE_PAYMENT_FAILED = "UpgradePaymentFailedEvent"
ACCOUNT_DEACTIVATED = "AccountDeactivatedEvent"

REQUEST_TYPES = (SIGNUP_REQUESTED, UPGRADE_REQUESTED, DEACTIVATION_REQUESTED)
PROCESS_IDS = {
    SIGNUP_REQUESTED: "signup-process",
    UPGRADE_REQUESTED: "upgrade-process",
    DEACTIVATION_REQUESTED: "deactivation-process",
}

TIERS = ("FREE", "PRO", "ENTERPRISE")
PAID_TIERS = ("PRO", "ENTERPRISE")
TIER_PRICE_CENTS = {"PRO": 1900, "ENTERPRISE": 9900}

MAX_ATTEMPTS = 3
PAYMENT_TIMEOUT = "5 minutes"

# (message, kind, mechanism): which messages are broadcast facts and which are directed commands.
MESSAGE_CLASSES = (
    (SIGNUP_REQUESTED, "Event", "log"),
    (UPGRADE_REQUESTED, "Event", "log"),
    (DEACTIVATION_REQUESTED, "Event", "log"),
    ("validate-signup", "Command", "engine"),
    ("process-payment", "Command", "engine"),
    ("refund-payment", "Command", "engine"),
    ("send-notification", "Command", "engine"),
    ("activate-account", "Command", "engine"),
    ("apply-tier-upgrade", "Command", "engine"),
    ("deactivate-account", "Command", "engine"),
    (PAYMENT_RECEIVED, "Event", "log"),
    (PAYMENT_FAILED, "Event", "log"),
    (PAYMENT_REFUNDED, "Event", "log"),
    (PAYMENT_REFUND_FAILED, "Event", "log"),
    (NOTIFICATION_SENT, "Event", "log"),
    (NOTIFICATION_FAILED, "Event", "log"),
    (ACCOUNT_ACTIVATED_EVENT, "Event", "log"),
    (MARKET_ALERT_EVENT, "Event", "log"),
    (SOCIAL_TREND_EVENT, "Event", "log"),
    (PROCESS_START_FAILED_EVENT, "Event", "log"),
)

# The optional payload fields a notification command may carry.
NOTIFICATION_OPTIONAL_FIELDS = (
    "paymentAmount", "transactionId", "refundSuccess", "refundSkipped", "refundTransactionId",
    "currentTier", "targetTier", "reason", "deactivatedAt", "upgradedAt", "upgradeApplied",
)
# --------------------------------------------------------------------------------------------

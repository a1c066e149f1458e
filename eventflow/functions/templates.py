"""Message texts. `{field}` names a payload field (or `traceid`)."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from eventflow.functions.scalar import bool_lenient, field, refund_detail, str_or_empty, text_or

# --- fixed values: the wording of each message ----------------------------------------------
TEMPLATES = {
    "signup": "[EMAIL] Welcome to {brand}! | To: {email} | Dear {name}, your {tier} signup is being processed. | Trace: {traceid}",
    "payment_received": "[EMAIL] Payment Confirmed! | To: {email} | Dear {name}, your {tier} subscription is now active. | Trace: {traceid}",
    "payment_failed": "[EMAIL] Payment Failed | To: {email} | Dear {name}, we could not process payment for {tier} tier. Please try again or contact support. | Trace: {traceid}",
    "technical_error": "[EMAIL] Temporary Technical Issue | To: {email} | Dear {name}, we hit a technical issue processing your {tier} signup. Our team has been notified. | Trace: {traceid}",
    "validation_failed": "[EMAIL] Signup Validation Failed | To: {email} | Dear {name}, we could not validate your {tier} signup. Reason: {validationError} | Trace: {traceid}",
    "activation_failed": "[EMAIL] Account Activation Failed | To: {email} | Dear {name}, we could not activate your {tier} account. {refundDetail} | Trace: {traceid}",
    "refunded": "[EMAIL] Refund Completed | To: {email} | Your {tier} payment was refunded. Refund Transaction: {refundTransactionId} | Trace: {traceid}",
    "refund_failed": "[EMAIL] Refund Pending Manual Follow-up | To: {email} | Automatic refund for your {tier} payment failed. Support will follow up manually. | Trace: {traceid}",
    "upgrade_requested": "[EMAIL] Upgrade Requested | To: {email} | Dear {name}, upgrade request {currentTier} -> {targetTier} is being processed. | Trace: {traceid}",
    "upgrade_completed": "[EMAIL] Upgrade Completed | To: {email} | Dear {name}, your plan was upgraded from {currentTier} to {targetTier}. | Trace: {traceid}",
    "upgrade_payment_failed": "[EMAIL] Upgrade Payment Failed | To: {email} | Dear {name}, we could not process payment for {targetTier} upgrade. | Trace: {traceid}",
    "deactivation_requested": "[EMAIL] Deactivation Requested | To: {email} | Dear {name}, your deactivation request was received. Reason: {reason} | Trace: {traceid}",
    "deactivated": "[EMAIL] Account Deactivated | To: {email} | Dear {name}, your account has been deactivated at {deactivatedAt}. | Trace: {traceid}",
    "market_alert": "[ALERT] Market Alert: {alertType} | Symbol: {symbol} | Change: {changePercent}% | {description} | Trace: {traceid}",
    "social_trend": "[ALERT] Social Trend: {alertType} | Topic: {topic} | Posts: {postCount} | Sentiment: {sentiment} | {description} | Trace: {traceid}",
}
# Templates whose name, email and tier must be present; the alert templates need all their fields.
STRICT = ("signup", "payment_received", "payment_failed", "technical_error", "validation_failed", "activation_failed")
ALERTS = ("market_alert", "social_trend")
DEFAULTS = {
    "name": "user", "email": "unknown", "tier": "unknown", "currentTier": "UNKNOWN", "targetTier": "UNKNOWN",
    "reason": "not-provided", "deactivatedAt": "unknown-time", "refundTransactionId": "", "validationError": "unknown",
}
# Fields shown as numbers; other content counts as 0.
NUMBERS = {"changePercent": "double", "postCount": "int"}
CHAT_TEXTS = {
    "success": "✅ *Payment succeeded*\nTrace ID: {traceid}\nEmail: {email}\nName: {name}\nTier: {tier}\nAmount: {amount}\nTransaction: {transaction}",
    "failed": "⚠️ *Payment failed (signup cancelled)*\nTrace ID: {traceid}\nEmail: {email}\nName: {name}\nTier: {tier}\nAmount: {amount}\nNotification: PaymentFailedEvent",
    "error": "🚨 *Payment process error*\nTrace ID: {traceid}\nUser ID: {user_id}\nEmail: {email}\nName: {name}\nTier: {tier}\nPayment amount: {amount}\nContext: payment-processing error (boundary)",
}
# --------------------------------------------------------------------------------------------

_SLOT = re.compile(r"\{(\w+)\}")


def fill(template: str, values: dict[str, Column]) -> Column:
    """Concatenate a template with its values; any null value makes the whole text null."""
    parts = _SLOT.split(template)
    pieces = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(parts) if i % 2 or p]
    return F.concat(*pieces)


def render(template: str, doc: Column, traceid: Column, brand: str, command: bool = False) -> Column:
    """Text of one template over a payload document; null when a mandatory field is absent.

    A command carries name, e-mail and tier in any case, empty where it was not told them, so none of
    them is ever absent or replaced there.
    """
    values = {
        "brand": F.lit(brand), "traceid": F.coalesce(traceid, F.lit("")),
        "refundDetail": refund_detail(
            bool_lenient(doc, "refundSkipped"), bool_lenient(doc, "refundSuccess"),
            field(doc, "refundTransactionId"),
        ),
    }
    for slot in _SLOT.findall(TEMPLATES[template]):
        if slot in values:
            continue
        person = slot in ("name", "email", "tier")
        mandatory = template in ALERTS or (template in STRICT and person)
        if command and person:
            values[slot] = str_or_empty(doc, slot)
        else:
            values[slot] = field(doc, slot) if mandatory else text_or(doc, slot, DEFAULTS[slot])
        if slot in NUMBERS:
            # a number in any notation; whole ones lose their fraction
            content = field(doc, slot).try_cast("double").try_cast(NUMBERS[slot])
            number = F.coalesce(content, F.lit(0).cast(NUMBERS[slot]))
            values[slot] = F.when(field(doc, slot).isNotNull(), number.cast("string"))
    return fill(TEMPLATES[template], values)

"""Column -> Column helpers. Everything here is a built-in expression, no UDF."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, SparkSession, functions as F

from eventflow.schemas import PAID_TIERS, TIER_PRICE_CENTS, TIERS

# Whitespace by the JVM's definition: tabs and Unicode spaces, but not the no-break spaces.
_BLANK = r"^[\t-\r\x1c-\x20\u1680\u2000-\u2006\u2008-\u200a\u2028\u2029\u205f\u3000]*\z"
_INTEGER = r"^[+-]?[0-9]+\z"
_TRUE_PADDED = r"^[\x00-\x20]*true[\x00-\x20]*\z"
_LONG_MAX, _LONG_MIN = 2**63 - 1, -(2**63)
_REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def case(branches: Iterable[tuple[Column, Column]]) -> Column:
    """First branch whose condition holds, else null: one flat CASE."""
    (condition, value), *rest = branches
    out = F.when(condition, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out


def is_blank(text: Column) -> Column:
    """Empty or whitespace only. Null stays null; wrap in `blank_or_null` where null counts as blank."""
    return text.rlike(_BLANK)


def blank_or_null(text: Column) -> Column:
    return text.isNull() | is_blank(text)


# --- fields of a JSON document -----------------------------------------------------------------
# A document is a VARIANT column: parsed once per row, then looked up by field name. A malformed
# document is null. `field` reads objects and arrays as their JSON text.

def document(json: Column) -> Column:
    """The parsed document. Of a repeated key the last value holds, at any depth.

    Spark rejects repeated keys unless the session allows them, and looks that up when a plan is made, so the
    session's `spark.sql.variant.allowDuplicateKeys` is switched on here and stays on.
    """
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get(_REPEATED_KEYS, "false") != "true":
        session.conf.set(_REPEATED_KEYS, "true")
    return F.try_parse_json(json)


def field(doc: Column, name: str) -> Column:
    """Text of one field; null when the field is missing or JSON null."""
    return F.try_variant_get(doc, f"$.{name}", "string")


def _kind(doc: Column, name: str) -> Column:
    """Type of one field: BOOLEAN, BIGINT, STRING, ..."""
    return F.schema_of_variant(F.try_variant_get(doc, f"$.{name}", "variant"))


def _plain(doc: Column, name: str) -> Column:
    """Text of one field, which an object or an array does not have: they read as empty text."""
    text = field(doc, name)
    container = text.rlike(r"^[\[{]") & _kind(doc, name).rlike("^(OBJECT|ARRAY)")
    return F.when(container, F.lit("")).otherwise(text)


def str_or_empty(doc: Column, name: str) -> Column:
    return F.coalesce(_plain(doc, name), F.lit(""))


def text_or(doc: Column, name: str, default: str) -> Column:
    """Field text, or `default` when the field is absent. An empty string stays empty."""
    return F.coalesce(_plain(doc, name), F.lit(default))


def bool_strict(doc: Column, name: str) -> Column:
    """Only a real JSON `true` counts."""
    return F.coalesce((_kind(doc, name) == "BOOLEAN") & (field(doc, name) == "true"), F.lit(False))


def bool_parse(doc: Column, name: str) -> Column:
    """JSON `true`, or the text "true" in any case without padding."""
    return F.coalesce(F.lower(field(doc, name)) == "true", F.lit(False))


def bool_lenient(doc: Column, name: str) -> Column:
    """JSON `true`, a non-zero whole number, or the exact text "true" with padding allowed."""
    text = field(doc, name)
    return F.coalesce(
        text.rlike(_TRUE_PADDED) | ((_kind(doc, name) == "BIGINT") & (text != "0")), F.lit(False)
    )


def long_or_zero(text: Column) -> Column:
    """Text to BIGINT; anything that is not a plain whole number in range gives 0."""
    return F.when(text.rlike(_INTEGER), F.coalesce(text.try_cast("bigint"), F.lit(0).cast("bigint"))).otherwise(
        F.lit(0).cast("bigint")
    )


def number_to_long(number: Column) -> Column:
    """Numeric column to BIGINT: truncated toward zero, clamped to the BIGINT range, null and NaN to 0."""
    value = number.cast("double")
    return (
        F.when(value.isNull() | F.isnan(value), F.lit(0).cast("bigint"))
        .when(value >= float(2**63), F.lit(_LONG_MAX))
        .when(value <= float(-(2**63)), F.lit(_LONG_MIN).cast("bigint"))
        .otherwise(number.try_cast("bigint"))
    )


def coalesce_null(value: Column, default) -> Column:
    """`if x = null then d else x`."""
    return F.coalesce(value, F.lit(default))


def is_valid_email(email: Column) -> Column:
    """Contains an @ that is neither the first nor the last character. No trim, several @ pass."""
    return email.contains("@") & ~email.startswith("@") & ~email.endswith("@")


def normalize_tier(tier: Column) -> Column:
    return F.upper(F.coalesce(tier, F.lit("")))


def is_supported_tier(tier: Column) -> Column:
    return tier.isin(*TIERS)


def is_paid_tier(tier: Column) -> Column:
    return tier.isin(*PAID_TIERS)


def price_for_tier(tier: Column) -> Column:
    """Price in cents, case-insensitive; unknown tiers cost nothing."""
    upper = normalize_tier(tier)
    prices = ((upper == name, F.lit(cents).cast("bigint")) for name, cents in TIER_PRICE_CENTS.items())
    return case(prices).otherwise(F.lit(0).cast("bigint"))


def refund_detail(skipped: Column, success: Column, refund_tx: Column) -> Column:
    """Sentence about the refund; a skipped refund is tested before a successful one."""
    return (
        F.when(F.coalesce(skipped, F.lit(False)), F.lit("No charge was captured, so no refund was needed."))
        .when(
            F.coalesce(success, F.lit(False)),
            F.concat(
                F.lit("Your payment was refunded successfully. Refund Transaction: "),
                F.coalesce(refund_tx, F.lit("")),
            ),
        )
        .otherwise(F.lit("Refund is pending manual support follow-up."))
    )


def derived_id(*parts: Column | str) -> Column:
    """Id that a retried batch computes again identically, in place of a random one."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.sha2(F.concat_ws(":", *cols), 256)


def iso_time(time: Column) -> Column:
    """ISO-8601 text with microseconds and offset, as event times appear on the log."""
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")

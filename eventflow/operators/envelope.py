"""Envelope construction, parsing, routing header, quarantine and process variables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventflow.functions.scalar import (
    blank_or_null, bool_lenient, derived_id, document, field, iso_time, str_or_empty,
)
from eventflow.schemas import (
    DEACTIVATION_REQUESTED, ENVELOPE, NOTIFICATION_OPTIONAL_FIELDS, SIGNUP_REQUESTED,
    UPGRADE_REQUESTED,
)

CONTENT_TYPE = "application/json"
SPEC_VERSION = "1.0"
DEFAULT_GROUP = "events"


def header_type(headers: Column) -> Column:
    """Text of the `type` header; null when the header is missing (a bare [0] would raise)."""
    return F.get(F.filter(headers, lambda h: h["key"] == "type"), 0)["value"].cast("string")


def event_type(df: DataFrame) -> DataFrame:
    """Routing type. Reads only the header, so filters on it run before any JSON is parsed."""
    return df.withColumn("event_type", header_type(F.col("headers")))


def parse_envelope(df: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text to envelope columns. `data` is the payload as a document (VARIANT), so one parse of
    the message serves the envelope and every payload field.

    When the row carries an `event_type` (the header), it wins over the type in the body and
    `type_mismatch` tells where the two differ.
    """
    parsed = df.withColumn("__doc", document(F.col(value_col)))
    doc = F.col("__doc")
    body_type = field(doc, "type")
    columns = {
        name: field(doc, name) for name in ENVELOPE.fieldNames() if name not in ("type", "time", "data")
    }
    columns["time"] = field(doc, "time").try_cast("timestamp")
    payload = F.try_variant_get(doc, "$.data", "variant")
    columns["data"] = F.when(~F.is_variant_null(payload), payload)
    if "event_type" in df.columns:
        columns["type"] = F.coalesce(F.col("event_type"), body_type)
        columns["type_mismatch"] = F.coalesce(F.col("event_type") != body_type, F.lit(False))
    else:
        columns["type"] = body_type
    return parsed.withColumns(columns).drop("__doc", "event_type")


def quarantine(df: DataFrame, required: tuple[str, ...] = ("type", "traceid", "data", "time")) -> tuple[DataFrame, DataFrame]:
    """Split parsed rows into (good, bad). Every input row lands in exactly one side.

    A row without a readable time is bad: event-time state could not place it. Columns of `required`
    that the rows do not have are not asked for.
    """
    required = tuple(c for c in required if c in df.columns)
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    tagged = df.withColumn("missing_fields", missing)
    good = tagged.filter(F.size("missing_fields") == 0).drop("missing_fields")
    return good, tagged.filter(F.size("missing_fields") > 0)


def new_event(
    type_: Column, payload: Column, key: Column, source: str, time: Column,
    traceid: Column | None = None, group: str = DEFAULT_GROUP,
) -> Column:
    """Envelope struct around a payload.

    `key` identifies the event within its source: id and trace id are hashes of it, so a retried
    batch writes the same row again instead of a second event.
    """
    return F.struct(
        type_.alias("type"),
        derived_id(source, "event", type_, key).alias("id"),
        F.lit(source).alias("source"),
        iso_time(time).alias("time"),
        payload.alias("data"),
        F.lit(CONTENT_TYPE).alias("datacontenttype"),
        F.lit(SPEC_VERSION).alias("specversion"),
        (derived_id(source, "trace", key) if traceid is None else traceid).alias("traceid"),
        F.lit(None).cast("string").alias("correlationid"),
        F.lit(group).alias("group"),
    )


def reply_event(
    type_: Column, payload: Column, key: Column, source: str, time: Column,
    traceid: Column, group: str = DEFAULT_GROUP,
) -> Column:
    """As `new_event`, keeping the trace id of the event it answers."""
    return new_event(type_, payload, key, source, time, traceid=traceid, group=group)


def ensure_traceid(df: DataFrame, key: str = "id") -> DataFrame:
    return df.withColumn(
        "traceid",
        F.when(blank_or_null(F.col("traceid")), derived_id("trace", F.col(key))).otherwise(F.col("traceid")),
    )


def ensure_user_id(df: DataFrame, key: str = "id", column: str = "userId") -> DataFrame:
    return df.withColumn(
        column,
        F.when(blank_or_null(F.col(column)), derived_id("user", F.col(key))).otherwise(F.col(column)),
    )


def extract_variables(df: DataFrame) -> DataFrame:
    """Process variables of the three request types as one sparse set of columns.

    Upgrade requests take their target tier as `tier`; fields another type owns are null.
    """
    data, type_ = F.col("data"), F.col("type")
    signup, upgrade, leave = type_ == SIGNUP_REQUESTED, type_ == UPGRADE_REQUESTED, type_ == DEACTIVATION_REQUESTED
    flags = {
        name: F.when(signup, bool_lenient(data, name))
        for name in ("forceActivationFailure", "forcePaymentFailure", "forcePaymentError")
    }
    out = df.withColumns({
        "userId": str_or_empty(data, "userId"),
        "name": str_or_empty(data, "name"),
        "email": str_or_empty(data, "email"),
        "tier": F.when(upgrade, str_or_empty(data, "targetTier")).otherwise(str_or_empty(data, "tier")),
        "currentTier": F.when(upgrade, str_or_empty(data, "currentTier")),
        "targetTier": F.when(upgrade, str_or_empty(data, "targetTier")),
        "reason": F.when(leave, str_or_empty(data, "reason")),
        **flags,
    })
    return ensure_user_id(ensure_traceid(out))


def copy_present(doc: Column, fields: tuple[str, ...] = NOTIFICATION_OPTIONAL_FIELDS) -> Column:
    """JSON object holding only the non-null fields out of `fields`, with their values unchanged."""
    kept = F.map_filter(
        doc.cast("map<string, variant>"), lambda k, v: k.isin(*fields) & ~F.is_variant_null(v)
    )
    return F.to_json(kept)

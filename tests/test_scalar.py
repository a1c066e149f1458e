from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from eventflow.functions import scalar
from eventflow.operators import routing, saga


def values(rows, data, fn, schema="x STRING"):
    df = rows([(i, v) for i, v in enumerate(data)], f"i INT, {schema}")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def test_blank(rows):
    blank = ["", "  ", "\t", "\n", "\x1c", " ", " ", "　"]
    solid = [" ", " ", " ", "\u0085", "a", " a ", "a\n"]
    assert values(rows, blank, scalar.is_blank) == [True] * len(blank)
    assert values(rows, solid, scalar.is_blank) == [False] * len(solid)
    assert values(rows, [None], scalar.blank_or_null) == [True]


def test_email(rows):
    good = ["a@b", "a@b@c", " a@b"]
    bad = ["@b", "a@", "@", "a", ""]
    assert values(rows, good + bad, scalar.is_valid_email) == [True] * 3 + [False] * 5


def test_tiers_and_prices(rows):
    tiers = ["pro", "Pro ", None, "ENTERPRISE", "FREE", "GOLD", ""]
    supported = values(rows, tiers, lambda c: scalar.is_supported_tier(scalar.normalize_tier(c)))
    assert supported == [True, False, False, True, True, False, False]
    assert values(rows, tiers, scalar.price_for_tier) == [1900, 0, 0, 9900, 0, 0, 0]


def test_long_or_zero(rows):
    data = ["12", "+5", "-3", "12.7", " 12 ", "12\n", "abc", None, "9223372036854775808"]
    assert values(rows, data, scalar.long_or_zero) == [12, 5, -3, 0, 0, 0, 0, 0, 0]
    numbers = [12.9, -12.9, None, float("nan"), 1e300, -1e300]
    assert values(rows, numbers, scalar.number_to_long, "x DOUBLE") == [12, -12, 0, 0, 2**63 - 1, -(2**63)]


@pytest.mark.parametrize(
    ("json", "lenient", "parsed", "strict", "text"),
    [
        ('{"f":true}', True, True, True, "true"),
        ('{"f":false}', False, False, False, "false"),
        ('{"f":"true"}', True, True, False, "true"),
        ('{"f":"TRUE"}', False, True, False, "TRUE"),
        ('{"f":" true "}', True, False, False, " true "),
        ('{"f":1}', True, False, False, "1"),
        ('{"f":0}', False, False, False, "0"),
        ('{"f":"1"}', False, False, False, "1"),
        ('{"f":1.5}', False, False, False, "1.5"),
        ('{"f":null}', False, False, False, ""),
        ('{"f":{"a":1}}', False, False, False, ""),
        ('{"f":[true]}', False, False, False, ""),
        ('{"f":"{not an object}"}', False, False, False, "{not an object}"),
        ('{"f":"first","f":"last"}', False, False, False, "last"),
        ('{"f":null,"f":true}', True, True, True, "true"),
        ("{}", False, False, False, ""),
        ("not json", False, False, False, ""),
        (None, False, False, False, ""),
    ],
)
def test_json_fields(rows, json, lenient, parsed, strict, text):
    doc = scalar.document(F.col("j"))
    row = rows([(json,)], "j STRING").select(
        scalar.bool_lenient(doc, "f"), scalar.bool_parse(doc, "f"), scalar.bool_strict(doc, "f"),
        scalar.str_or_empty(doc, "f"), scalar.text_or(doc, "f", "d"),
    ).first()
    assert tuple(row)[:4] == (lenient, parsed, strict, text)
    assert row[4] == (text if json and '"f"' in json and json != '{"f":null}' else "d")


def test_refund_action(rows):
    df = rows([(0, "tx"), (1900, None), (1900, " "), (1900, "tx"), (None, "tx")], "a BIGINT, t STRING")
    out = [r[0] for r in df.select(saga.refund_action(F.col("a"), F.col("t"))).collect()]
    assert out == ["skip", "skip", "skip", "refund", "skip"]


def test_retry_decision(rows):
    df = rows([(True, 2), (True, 3), (False, 1), (None, 1), (True, None)], "r BOOLEAN, n INT")
    out = [r[0] for r in df.select(routing.retry_decision(F.col("r"), F.col("n"))).collect()]
    assert out == ["retry", "cancel", "cancel", "cancel", "cancel"]
    limits = rows([(True, 4, 5), (True, 2, None)], "r BOOLEAN, n INT, m INT")
    out = [r[0] for r in limits.select(routing.retry_decision(F.col("r"), F.col("n"), F.col("m"))).collect()]
    assert out == ["retry", "retry"]


def test_refund_detail(rows):
    df = rows([(True, True, "x"), (False, True, "tx"), (False, False, "x"), (None, None, None)],
              "s BOOLEAN, ok BOOLEAN, tx STRING")
    out = [r[0] for r in df.select(scalar.refund_detail(F.col("s"), F.col("ok"), F.col("tx"))).collect()]
    assert out[0].startswith("No charge") and out[1].endswith("Transaction: tx") and "pending manual" in out[2]
    assert out[3] == out[2]

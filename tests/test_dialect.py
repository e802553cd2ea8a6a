from __future__ import annotations

from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from perilframe.functions import dialect as dl
from perilframe.functions import rules
from perilframe.params import Alive, InForce

DAY = date(2020, 6, 30)
BEFORE, AFTER = DAY - timedelta(days=1), DAY + timedelta(days=1)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "parts, expected",
    [(("a", None, "b"), "ab"), ((None, None), None), (("", None), None), (("a", ""), "a")],
)
def test_join_text(spark, parts, expected):
    assert one(spark, dl.join_text(*(F.lit(p) for p in parts))) == expected


@pytest.mark.parametrize("layer, expected", [(7, "07"), (12, "12"), (123, "12"), (None, None)])
def test_layer_text(spark, layer, expected):
    assert one(spark, dl.layer_text(F.lit(layer).cast("int"))) == expected


@pytest.mark.parametrize(
    "amount, expected",
    [("100.00", "100"), ("120.50", "120.5"), ("0.00", "0"), ("100000000.00", "100000000"),
     ("0.07", "0.07")],
)
def test_plain_number(spark, amount, expected):
    assert one(spark, dl.plain_number(F.lit(Decimal(amount)).cast("decimal(18,2)"))) == expected


def test_percent_text(spark):
    assert one(spark, dl.percent_text(F.lit(Decimal("2")).cast("decimal(9,4)"))) == "0.02"
    assert one(spark, dl.percent_text(F.lit(Decimal("12.3456")).cast("decimal(9,4)"))) == "0.123456"


@pytest.mark.parametrize(
    "text, expected",
    [("", Decimal(0)), ("  ", Decimal(0)), ("12.5", Decimal("12.5")), ("x", None), (None, None)],
)
def test_number_or_zero(spark, text, expected):
    assert one(spark, dl.number_or_zero(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text, expected", [("2.5", 3), ("2", 2), ("", None), (None, None)])
def test_round_up(spark, text, expected):
    assert one(spark, dl.round_up(F.lit(text).cast("string"))) == expected


def test_blank_length_ignores_trailing_blanks(spark):
    assert one(spark, dl.blank_length(F.lit(" ab  "))) == 3


@pytest.mark.parametrize(
    "amount, money, whole",
    [("2.5", "$3", "3"), ("-1234.5", "-$1,235", "-1,235"), ("0", "$0", "0"), (None, None, None)],
)
def test_report_numbers(spark, amount, money, whole):
    value = F.lit(amount).cast("decimal(18,4)")
    assert one(spark, dl.money_text(value)) == money
    assert one(spark, dl.whole_text(value)) == whole


@pytest.mark.parametrize(
    "share, expected",
    [(0.12345, "12.35 %"), (-0.5, "-50.00 %"), (12.0, "1,200.00 %"), (None, None)],
)
def test_share_text(spark, share, expected):
    assert one(spark, dl.share_text(F.lit(share).cast("double"))) == expected


@pytest.mark.parametrize(
    "spec, kept",
    [
        (Alive(), {DAY, AFTER, None}),
        (Alive(on_date_counts=False), {AFTER, None}),
        (Alive(open_counts=False), {DAY, AFTER}),
    ],
)
def test_alive(frame, spec, kept):
    rows = frame([(d,) for d in (BEFORE, DAY, AFTER, None)], "deleted_dt date")
    assert {r[0] for r in rows.filter(dl.alive(DAY, spec)).collect()} == kept


@pytest.mark.parametrize(
    "spec, expires, cancels",
    [
        (InForce(), {AFTER}, {AFTER, None}),
        (InForce(cancellation="ignore"), {AFTER}, {BEFORE, DAY, AFTER, None}),
        (InForce(True, "on_or_after"), {DAY, AFTER}, {DAY, AFTER, None}),
    ],
)
def test_term_in_force(frame, spec, expires, cancels):
    days = (BEFORE, DAY, AFTER)
    rows = frame(
        [(s, e, c) for s in days for e in days for c in (*days, None)],
        "policy_term_effective_dt date, policy_term_expiration_dt date, "
        "cancellation_effective_dt date",
    )
    kept = {tuple(r) for r in rows.filter(dl.term_in_force(DAY, spec)).collect()}
    assert kept == {(s, e, c) for s in (BEFORE, DAY) for e in expires for c in cancels}


def test_unknown_cancellation_rule():
    with pytest.raises(ValueError):
        dl.term_in_force(DAY, InForce(cancellation="never"))


@pytest.mark.parametrize(
    "unit, product, expected",
    [
        ("PIM", "PIMPROPEX", "PIMx"),
        ("PIM", "PIMPROPEX___DPG", "PIMt"),
        ("AED", "DPG", "ALT"),
        ("GARS", "DPG", "GARS_Condo"),
        ("GARS", None, "GARS"),
        ("SHS", "DPG", "SHS"),
    ],
)
def test_line_of_business(spark, unit, product, expected):
    column = rules.line_of_business(F.lit(unit), F.lit(product).cast("string"))
    assert one(spark, column) == expected


def test_currencies_use_different_country_codes(spark):
    assert one(spark, rules.contract_currency(F.lit("CAN"))) == "CAD"
    assert one(spark, rules.contract_currency(F.lit("CA"))) == "USD"
    assert one(spark, rules.location_currency(F.lit("CA"))) == "CAD"
    assert one(spark, rules.location_currency(F.lit("CAN"))) == "USD"


def test_layer_id(spark):
    key = F.lit("CPP000000101")
    assert one(spark, rules.layer_id(key, F.lit(0), F.lit(None))) == "CPP000000101-01"
    assert one(spark, rules.layer_id(key, F.lit(1), F.lit(7))) == "CPP000000101-07"

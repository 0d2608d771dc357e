"""Row validation: each rule, precedence, coercions, and the accepted/rejected split."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordermill.operators import validate
from ordermill.operators.clean import clean_orders
from ordermill.schema import ORDER_COLUMNS, RAW_SCHEMA

GOOD = dict(zip(ORDER_COLUMNS, ["1", "55", "1", "2", "9", "", "70", "Kettle", "kitchen", "home", "2", "9.35", "0", "2024-06-03"], strict=True))

# (order_id cell, changes, expected reason or None)
CASES = [
    ("1", {}, None),
    ("2", {"user_id": "", "department": None}, "missing_required:department,user_id"),
    ("3", {"quantity": "2.5"}, "invalid_numeric"),
    ("4", {"unit_price": "NaN"}, "invalid_numeric"),
    ("5", {"quantity": "0"}, "out_of_range"),
    ("6", {"unit_price": "-1"}, "out_of_range"),
    ("x", {}, "invalid_integer:order_id"),
    ("7", {"unit_price": "Infinity", "quantity": " 3 "}, "invalid_numeric"),
    ("8", {"order_date": "notadate"}, None),
    ("9", {"quantity": ""}, "missing_required:quantity"),
    ("10", {"quantity": "99999999999"}, "invalid_numeric"),
    ("11", {"reordered": "yes"}, "invalid_integer:reordered"),
    ("12", {"days_since_prior_order": "soon"}, "invalid_integer:days_since_prior_order"),
    ("13", {"quantity": "0", "product_id": ""}, "missing_required:product_id"),
    ("14", {"reordered": "", "days_since_prior_order": "15.0"}, None),
    ("20", {"unit_price": "5."}, None),
    ("21", {"unit_price": "1e3"}, None),
    ("22", {"unit_price": "1E-2"}, None),
    ("23", {"unit_price": "1000000000000"}, None),
    ("24", {"order_date": "2025-1-3"}, None),
    ("25", {"order_date": "2025-01-03T10:00:00"}, None),
    ("26", {"order_date": "2025-01-03 00:00:00"}, None),
]
ACCEPTED = {int(i) for i, _, reason in CASES if reason is None}


@pytest.fixture
def raw(spark):
    rows = []
    for oid, changes, _ in CASES:
        row = dict(GOOD, order_id=oid, **changes)
        rows.append(tuple(row[c] for c in ORDER_COLUMNS))
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_reasons(raw):
    annotated = validate.annotate(raw)
    got = {r.order_id: r[validate.REASON] for r in annotated.select("order_id", validate.REASON).collect()}
    assert got == {oid: reason for oid, _, reason in CASES}


def test_accepted_are_typed_and_coerced(raw):
    accepted, rejected = validate.validate(raw)
    rows = {r.order_id: r for r in accepted.collect()}
    assert set(rows) == ACCEPTED
    assert rows[1].unit_price == Decimal("9.35") and rows[1].quantity == 2
    assert rows[14].reordered == 0 and rows[14].days_since_prior_order == 15
    prices = {i: rows[i].unit_price for i in (20, 21, 22, 23)}
    assert prices == {20: Decimal(5), 21: Decimal(1000), 22: Decimal("0.01"), 23: Decimal(10**12)}
    assert {rows[i].order_date for i in (24, 25, 26)} == {dt.date(2025, 1, 3)}
    assert rows[8].order_date is None  # accepted at ingestion, dropped by cleaning
    kept = {r.order_id for r in clean_orders(accepted).select("order_id").collect()}
    assert kept == ACCEPTED - {8}
    assert accepted.count() + rejected.count() == raw.count()


def test_rejected_keep_raw_text(raw):
    _, rejected = validate.validate(raw)
    row = rejected.filter(F.col("order_id") == "7").first()
    assert row.unit_price == "Infinity" and row.quantity == " 3 "


def test_counts_and_summary(raw):
    annotated = validate.annotate(raw)
    counts = validate.ingest_counts(annotated).first()
    assert (counts.total_lines, counts.accepted_lines, counts.rejected_lines) == (22, 10, 12)
    summary = {r[validate.REASON]: r.rejected_lines for r in validate.reject_summary(validate.rejected(annotated)).collect()}
    assert summary["invalid_numeric"] == 4 and summary["out_of_range"] == 2

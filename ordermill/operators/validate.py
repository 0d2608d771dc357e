"""Row validation of text order lines: accept with typed columns or reject with a reason.

Rules, first failing rule wins:
  0. a row read from CSV has too few or too many cells, or a quote that is never closed
                                          -> ``malformed_row``
  1. a required field is NULL or empty   -> ``missing_required:<fields>`` (all missing, sorted)
  2. quantity not an integer, or unit_price not a decimal number -> ``invalid_numeric``
  3. quantity <= 0 or unit_price < 0     -> ``out_of_range``
  4. an id, ``reordered`` or ``days_since_prior_order`` present but not a number
                                          -> ``invalid_integer:<field>``
Accepted lines get ``reordered`` 0 when blank and ``days_since_prior_order``
truncated to whole days. The order date's format is not a rejection rule:
an unparseable date becomes NULL and the cleaning step drops the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parse import blank, once, parse_date, parse_decimal, parse_int, parse_long, parse_truncated_int
from ..schema import CORRUPT_ROW, ORDER_COLUMNS, REQUIRED_AT_INGEST

REASON = "reject_reason"

#: Columns whose typed value decides on a line.
JUDGED = ("order_id", "user_id", "product_id", "quantity", "unit_price", "reordered", "days_since_prior_order")

# Reason codes (fixed values).
MALFORMED = "malformed_row"
MISSING = "missing_required:"
INVALID_NUMERIC = "invalid_numeric"
OUT_OF_RANGE = "out_of_range"
INVALID_INTEGER = "invalid_integer:"


def typed_columns() -> dict[str, Column]:
    """Typed value of each order-line column parsed from its text."""
    c = F.col
    return {
        "order_id": parse_long(c("order_id")),
        "user_id": parse_long(c("user_id")),
        "order_number": parse_int(c("order_number")),
        "order_dow": parse_int(c("order_dow")),
        "order_hour_of_day": parse_int(c("order_hour_of_day")),
        "days_since_prior_order": parse_truncated_int(c("days_since_prior_order")),
        "product_id": parse_long(c("product_id")),
        "product_name": c("product_name"),
        "aisle": c("aisle"),
        "department": c("department"),
        "quantity": parse_int(c("quantity")),
        "unit_price": parse_decimal(c("unit_price")),
        "reordered": F.when(blank(c("reordered")), F.lit(0)).otherwise(parse_int(c("reordered"))),
        "order_date": parse_date(c("order_date")),
    }


def reject_reason(typed: dict[str, Column]) -> Column:
    c = F.col
    missing = F.concat_ws(",", *[F.when(blank(c(name)), F.lit(name)) for name in sorted(REQUIRED_AT_INGEST)])
    rule = F.when(missing != "", F.concat(F.lit(MISSING), missing))
    rule = rule.when(typed["quantity"].isNull() | typed["unit_price"].isNull(), F.lit(INVALID_NUMERIC))
    rule = rule.when((typed["quantity"] <= 0) | (typed["unit_price"] < 0), F.lit(OUT_OF_RANGE))
    for name in ("order_id", "user_id", "product_id", "reordered"):
        rule = rule.when(typed[name].isNull(), F.lit(INVALID_INTEGER + name))
    days = "days_since_prior_order"
    rule = rule.when(~blank(c(days)) & typed[days].isNull(), F.lit(INVALID_INTEGER + days))
    return rule


def annotate(raw: DataFrame) -> DataFrame:
    """Raw columns, typed columns (prefixed ``v_``) and ``reject_reason`` (NULL = accepted).

    Columns other than the 14 order-line columns (file name, message id) are carried along.
    """
    typed = typed_columns()
    # What the reason refers to is parsed once, however often it is filtered by; the rest only where it is read.
    judged = once(raw, **{f"v_{name}": typed[name] for name in JUDGED})
    values = [(F.col(f"v_{name}") if name in JUDGED else expr).alias(f"v_{name}") for name, expr in typed.items()]
    with_typed = judged.select(*[F.col(f"`{c}`") for c in raw.columns], *values)
    reason = reject_reason({name: F.col(f"v_{name}") for name in typed})
    if CORRUPT_ROW in raw.columns:
        reason = F.when(F.col(CORRUPT_ROW).isNotNull(), F.lit(MALFORMED)).otherwise(reason)
    return with_typed.withColumn(REASON, reason)


def _carried(frame: DataFrame) -> list[str]:
    return [c for c in frame.columns if c not in ORDER_COLUMNS and not c.startswith("v_") and c != REASON]


def accepted(annotated: DataFrame) -> DataFrame:
    kept = annotated.filter(F.col(REASON).isNull())
    return kept.select(*[F.col(f"v_{c}").alias(c) for c in ORDER_COLUMNS], *_carried(annotated))


def rejected(annotated: DataFrame) -> DataFrame:
    bad = annotated.filter(F.col(REASON).isNotNull())
    return bad.select(*ORDER_COLUMNS, REASON, *_carried(annotated))


def validate(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split text lines into (accepted typed lines, rejected raw lines with a reason).

    Both come from one annotated plan; persist it when both halves are consumed.
    """
    annotated = annotate(raw)
    return accepted(annotated), rejected(annotated)


def reject_summary(rejected_lines: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Rejected lines by reason, and by further columns, such as the file they came from."""
    return rejected_lines.groupBy(REASON, *by).agg(F.count(F.lit(1)).alias("rejected_lines"))


def ingest_counts(annotated: DataFrame) -> DataFrame:
    """One row: lines read, accepted and rejected."""
    bad = F.col(REASON).isNotNull()
    return annotated.agg(
        F.count(F.lit(1)).alias("total_lines"),
        F.count_if(~bad).alias("accepted_lines"),
        F.count_if(bad).alias("rejected_lines"),
    )

"""Order-line schemas and mart contracts."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column order of a denormalised order line (fixed values of the input format).
ORDER_COLUMNS = [
    "order_id",
    "user_id",
    "order_number",
    "order_dow",
    "order_hour_of_day",
    "days_since_prior_order",
    "product_id",
    "product_name",
    "aisle",
    "department",
    "quantity",
    "unit_price",
    "reordered",
    "order_date",
]

# Fields that must be present for a line to be published (fixed values).
REQUIRED_AT_INGEST = [
    "order_id",
    "user_id",
    "product_id",
    "product_name",
    "department",
    "quantity",
    "unit_price",
    "order_date",
]

# Fields a cleaned line must carry (fixed values).
REQUIRED_IN_CLEAN = ["order_id", "user_id", "product_id", "quantity", "unit_price", "order_date"]

#: Raw text of a CSV row that has too few or too many cells, or a quote that is never closed; NULL for whole rows.
CORRUPT_ROW = "corrupt_row"

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in ORDER_COLUMNS])

#: Prices: 20 digits before the point, 6 after. A larger price is no price (validation rejects it, cleaning drops
#: and counts it): quantity x price is then exact in 38 digits, so no accepted line can overflow a mart.
PRICE_TYPE = DecimalType(26, 6)

_TYPES: dict[str, DataType] = {
    **{c: LongType() for c in ("order_id", "user_id", "product_id")},
    **{c: IntegerType() for c in ("order_number", "order_dow", "order_hour_of_day", "days_since_prior_order")},
    **{c: StringType() for c in ("product_name", "aisle", "department")},
    "quantity": IntegerType(),
    "unit_price": PRICE_TYPE,
    "reordered": IntegerType(),
    "order_date": DateType(),
}
ORDER_SCHEMA = StructType([StructField(c, _TYPES[c], True) for c in ORDER_COLUMNS])

# Normalised basket files: column -> type (fixed values of the input format).
BASKET_FILES: dict[str, StructType] = {
    "orders": StructType()
    .add("order_id", LongType())
    .add("user_id", LongType())
    .add("eval_set", StringType())
    .add("order_number", IntegerType())
    .add("order_dow", IntegerType())
    .add("order_hour_of_day", IntegerType())
    .add("days_since_prior_order", StringType()),
    "order_products__prior": StructType()
    .add("order_id", LongType())
    .add("product_id", LongType())
    .add("add_to_cart_order", IntegerType())
    .add("reordered", IntegerType()),
    "order_products__train": StructType()
    .add("order_id", LongType())
    .add("product_id", LongType())
    .add("add_to_cart_order", IntegerType())
    .add("reordered", IntegerType()),
    "products": StructType()
    .add("product_id", LongType())
    .add("product_name", StringType())
    .add("aisle_id", IntegerType())
    .add("department_id", IntegerType()),
    "aisles": StructType().add("aisle_id", IntegerType()).add("aisle", StringType()),
    "departments": StructType().add("department_id", IntegerType()).add("department", StringType()),
}

# Types of a mart column by kind: what the marts hold, and what the database tables declare (fixed values).
MART_TYPES: dict[str, DataType] = {
    "id": LongType(),
    "text": StringType(),
    "count": LongType(),
    "money": DecimalType(38, 2),
    "rate": DecimalType(6, 4),
    "date": DateType(),
    "flag": BooleanType(),
}
TABLE_TYPES: dict[str, DataType] = {**MART_TYPES, "count": IntegerType(), "money": DecimalType(12, 2)}

# Mart contracts: key, and not-null columns with their kinds in order (fixed values of the target tables).
MART_COLUMNS: dict[str, tuple[str, dict[str, str]]] = {
    "monthly_sales": (
        "sales_month",
        {
            "sales_month": "date",
            "order_count": "count",
            "customer_count": "count",
            "item_count": "count",
            "gross_revenue": "money",
            "avg_order_value": "money",
        },
    ),
    "top_products": (
        "product_id",
        {
            "product_id": "id",
            "product_name": "text",
            "department": "text",
            "order_count": "count",
            "total_quantity": "count",
            "gross_revenue": "money",
            "reorder_rate": "rate",
        },
    ),
    "customer_metrics": (
        "user_id",
        {
            "user_id": "id",
            "order_count": "count",
            "item_count": "count",
            "gross_revenue": "money",
            "first_order_date": "date",
            "last_order_date": "date",
            "active_months": "count",
            "retention_flag": "flag",
        },
    ),
    "category_performance": (
        "department",
        {
            "department": "text",
            "order_count": "count",
            "product_count": "count",
            "item_count": "count",
            "gross_revenue": "money",
        },
    ),
    "ml_customer_features": (
        "user_id",
        {
            "user_id": "id",
            "order_count": "count",
            "item_count": "count",
            "gross_revenue": "money",
            "avg_line_revenue": "money",
            "avg_item_quantity": "money",
            "reorder_rate": "rate",
            "department_count": "count",
            "active_months": "count",
            "last_order_date": "date",
            "repeat_customer_label": "flag",
        },
    ),
}


def mart_schema(name: str, types: dict[str, DataType] | None = None) -> StructType:
    """Not-null schema of a mart, by default with the marts' own types."""
    kinds = types or MART_TYPES
    return StructType([StructField(c, kinds[kind], False) for c, kind in MART_COLUMNS[name][1].items()])

"""Column sets of the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import types as T

# The bronze columns after renaming, by target type.
TEXT_COLUMNS = [
    "order_id", "customer_id", "customer_name", "city", "product_id", "product_name", "ship_mode", "segment", "state",
    "country", "region", "market", "category", "sub-category", "order_priority", "postal_code",
]
MONEY_COLUMNS = ["sales", "discount", "profit", "shipping_cost"]
INTEGER_COLUMNS = ["row_id", "quantity"]
DATE_COLUMNS = ["order_date", "ship_date"]

MONEY = T.DecimalType(18, 4)


def all_text(names: list[str]) -> T.StructType:
    """A bronze schema: every column is text."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


GOLD = {
    "dim_product": ["product_key", "product_id", "product_name", "category", "sub_category"],
    "dim_customer": ["customer_key", "customer_id", "customer_name", "segment"],
    "dim_location": ["location_key", "country", "state", "region", "market", "city"],
    "dim_date": [
        "date_key", "order_date", "order_year", "order_month", "order_month_name", "order_quarter", "order_day",
        "order_weekday",
    ],
    "dim_order": ["order_key", "order_id", "ship_date", "ship_mode", "order_priority"],
    "fact_sales": [
        "fact_key", "order_key", "customer_key", "product_key", "location_key", "order_date_key", "ship_date_key",
        "region", "market", "order_year", "order_month", "sales", "quantity", "discount", "profit", "shipping_cost",
    ],
    "fact_data": [
        "fact_key", "order_id", "customer_id", "customer_name", "segment", "product_id", "product_name", "category",
        "sub_category", "country", "state", "city", "order_date_value", "ship_date_value", "sales", "quantity",
        "discount", "profit", "shipping_cost",
    ],
}

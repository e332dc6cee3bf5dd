"""The eight source tables: fixed schemas, CSV and Parquet readers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns each table must provide, with their Spark types.
SCHEMAS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "timestamp",
        "order_approved_at": "timestamp",
        "order_delivered_carrier_date": "timestamp",
        "order_delivered_customer_date": "timestamp",
        "order_estimated_delivery_date": "timestamp",
    },
    "customers": {
        "customer_id": "string",
        "customer_unique_id": "string",
        "customer_zip_code_prefix": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "items": {
        "order_id": "string",
        "order_item_id": "int",
        "product_id": "string",
        "seller_id": "string",
        "price": "double",
        "freight_value": "double",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_weight_g": "double",
        "product_photos_qty": "int",
    },
    "reviews": {"review_id": "string", "order_id": "string", "review_score": "int"},
    "payments": {
        "order_id": "string",
        "payment_type": "string",
        "payment_installments": "int",
        "payment_value": "double",
    },
    "sellers": {"seller_id": "string", "seller_state": "string"},
    "category_map": {
        "product_category_name": "string",
        "product_category_name_english": "string",
    },
}


@dataclass(frozen=True)
class Sources:
    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    products: DataFrame
    reviews: DataFrame
    payments: DataFrame
    sellers: DataFrame
    category_map: DataFrame
    bucketed: bool = False  # orders and items are stored in equal buckets by order_id


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select and cast the table's columns by name; a bad value fails the job (ANSI cast)."""
    missing = [c for c in SCHEMAS[table] if c not in df.columns]
    if missing:
        raise ValueError(f"table {table!r} lacks columns {missing}")
    return df.select(*(F.col(c).cast(t).alias(c) for c, t in SCHEMAS[table].items()))


def read_sources(
    spark: SparkSession,
    base: str,
    fmt: str = "parquet",
    names: dict[str, str] | None = None,
    multiline: tuple[str, ...] = (),
) -> Sources:
    """Read all tables below ``base``.

    ``names`` maps a table to its file name (default ``<table>.<fmt>``). CSV
    columns are taken by header name, so extra columns are ignored. Tables
    listed in ``multiline`` may hold quoted line breaks; such CSV files cannot
    be split between tasks, so name only those that need it.
    """
    names = names or {}
    frames = {}
    for table in SCHEMAS:
        path = f"{base.rstrip('/')}/{names.get(table, f'{table}.{fmt}')}"
        if fmt == "csv":
            raw = spark.read.csv(
                path, header=True, escape='"', mode="FAILFAST", multiLine=table in multiline
            )
        else:
            raw = spark.read.format(fmt).load(path)
        frames[table] = conform(raw, table)
    return Sources(**frames)


def write_sources(sources: Sources, base: str, fmt: str = "parquet") -> None:
    """Write the tables so that ``read_sources`` finds them again."""
    for table in SCHEMAS:
        writer = getattr(sources, table).write.mode("overwrite").format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("escape", '"')
        writer.save(f"{base.rstrip('/')}/{table}.{fmt}")

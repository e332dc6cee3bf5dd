"""The item-level master table: one row per order item, one per order without items."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwise.functions.columns import category_label, safe_ratio, whole_days
from cartwise.session import in_slice, is_small, large_side, slices_of, small_side, stage, unstage
from cartwise.sources.tables import Sources

ITEM_COLUMNS = {
    "order_item_id": "int",
    "product_id": "string",
    "seller_id": "string",
    "price": "double",
    "freight_value": "double",
    "product_category_name": "string",
    "category_en": "string",
    "product_weight_g": "double",
    "product_photos_qty": "int",
    "seller_state": "string",
}


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Sum, highest instalment count and most frequent type (lowest of tied types)."""
    return payments.groupBy("order_id").agg(
        F.coalesce(F.sum("payment_value"), F.lit(0.0)).alias("total_payment"),
        F.max("payment_installments").alias("num_installments"),
        F.mode("payment_type", True).alias("payment_type"),
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("review_score"),
        F.count("review_id").alias("review_count"),
    )


def labelled_products(products: DataFrame, category_map: DataFrame) -> DataFrame:
    return products.join(category_map, "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        category_label("product_category_name_english", "product_category_name").alias(
            "category_en"
        ),
        "product_weight_g",
        "product_photos_qty",
    )


def build_master(src: Sources) -> DataFrame:
    """Join all sources and derive the per-row features."""
    return with_derived(_from_buckets(src) if src.bucketed else _joined(src))


def staged_master(src: Sources) -> DataFrame:
    """The master table with its joins staged; derived features are computed where they are read.

    Orders and what belongs to them are joined in slices of equal order ids,
    one slice after the other; the derived columns would take about as much
    disk as the others and follow from them.
    """
    slices = 1 if src.bucketed else slices_of(src.items.count())
    if slices == 1:
        return with_derived(stage(_from_buckets(src) if src.bucketed else _joined(src)))
    products, sellers = stage(src.products), stage(src.sellers)
    names = stage(src.category_map)

    def part(i: int) -> DataFrame:
        own = {
            name: getattr(src, name).where(in_slice(["order_id"], i, slices))
            for name in ("orders", "items", "reviews", "payments")
        }
        return _joined(replace(src, **own, products=products, sellers=sellers, category_map=names))

    joined = stage(part(0), (part(i) for i in range(1, slices)))
    unstage(products, sellers, names)
    return with_derived(joined)


def _joined(src: Sources) -> DataFrame:
    """All sources side by side.

    The large side of every join is the side AQE may split when a key is hot:
    items are on the left of their lookups, and lines meet orders in an inner
    join (a left join from orders could not split a hot order's items). Orders
    without items enter as empty lines, found by an anti join of order ids
    only. Lookup tables are broadcast by Spark only below its size threshold;
    category names and sellers if they are measured to be few, and then after
    the lines have moved, which are narrower without them. Bucketed orders and
    items meet in one left join of their buckets.
    """
    names = stage(src.category_map)
    sellers = stage(src.sellers.select("seller_id", "seller_state"))
    few_names, few_sellers = is_small(names), is_small(sellers)

    def labelled(lines: DataFrame, now: bool) -> DataFrame:
        return lines.join(F.broadcast(names) if few_names else names, "product_category_name", "left") if now else lines

    def located(lines: DataFrame, now: bool) -> DataFrame:
        return lines.join(F.broadcast(sellers) if few_sellers else sellers, "seller_id", "left") if now else lines

    own = src.products.select("product_id", "product_category_name", "product_weight_g", "product_photos_qty")
    items = located(src.items.join(labelled(own, not few_names), "product_id", "left"), not few_sellers)
    lookups = {c for c in (*names.columns, *sellers.columns) if c in items.columns}
    moved = [c for c in ITEM_COLUMNS if c in items.columns] + sorted(lookups - set(ITEM_COLUMNS))
    empty = (
        src.orders.select("order_id")
        .join(src.items.select("order_id").distinct(), "order_id", "left_anti")
        .select("order_id", *(F.lit(None).cast(ITEM_COLUMNS.get(c, "string")).alias(c) for c in moved))
    )
    orders = (
        src.orders.join(src.customers, "customer_id", "left")
        .join(reviews_per_order(src.reviews), "order_id", "left")
        .join(payments_per_order(src.payments), "order_id", "left")
    )
    lines = orders.join(items.select("order_id", *moved).unionByName(empty), "order_id")
    lines = located(labelled(lines, few_names), few_sellers)
    label = category_label("product_category_name_english", "product_category_name")
    return lines.withColumn("category_en", label).select(*orders.columns, *ITEM_COLUMNS)


def _from_buckets(src: Sources) -> DataFrame:
    """One scan of the items, whose buckets are joined in place; lookups that have to be shuffled move few, narrow rows.

    What an order has alone is joined before its items multiply the rows, so
    whole lines move for the products only. Sellers are broadcast if they are
    measured to be few: Spark's estimate of a joined table is too high for it.
    """
    orders = (
        src.orders.join(src.customers, "customer_id", "left")
        .join(reviews_per_order(src.reviews), "order_id", "left")
        .join(payments_per_order(src.payments), "order_id", "left")
    )
    sellers = small_side(stage(src.sellers.select("seller_id", "seller_state")))
    lines = orders.join(large_side(src.items), "order_id", "left").join(sellers, "seller_id", "left")
    return lines.join(labelled_products(src.products, src.category_map), "product_id", "left")


# What ``with_derived`` adds and a stored cleaned table can do without: cleaning fills the days, and months name folders.
_DERIVED = (
    "estimated_days", "order_year", "order_month", "item_total", "freight_ratio", "delivery_delay", "is_late",
)


def without_derived(table: DataFrame) -> DataFrame:
    return table.drop(*_DERIVED)


def derived_again(stored: DataFrame, columns: list[str]) -> DataFrame:
    """The table that ``without_derived`` was taken from, with its own delivery days and months."""
    own = {"delivery_days": "_days", "order_ym": "_ym"}
    full = with_derived(stored.withColumnsRenamed(own))
    return full.select(*(F.col(own.get(c, c)).alias(c) for c in columns))


def with_derived(joined: DataFrame) -> DataFrame:
    bought = "order_purchase_timestamp"
    return (
        joined.withColumns(
            {
                "delivery_days": whole_days("order_delivered_customer_date", bought).cast("double"),
                "estimated_days": whole_days("order_estimated_delivery_date", bought).cast("double"),
                "order_year": F.year(bought),
                "order_month": F.month(bought),
                "order_ym": F.date_format(bought, "yyyy-MM"),
                "item_total": F.col("price") + F.col("freight_value"),
                "freight_ratio": safe_ratio("freight_value", "price"),
            }
        )
        .withColumn("delivery_delay", F.col("delivery_days") - F.col("estimated_days"))
        .withColumn("is_late", F.coalesce(F.col("delivery_delay") > 0, F.lit(False)).cast("int"))
    )

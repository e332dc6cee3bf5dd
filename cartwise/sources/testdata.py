"""Maps the driver's star schema onto the eight source tables.

Reviews, payments and delivery dates do not exist there; they are derived from
the keys by plain arithmetic. ``ADAPTER_SQL`` is the same mapping for the
DuckDB side and is written independently of the DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwise.sources.tables import Sources, conform


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load(spark: SparkSession, sf_dir: str) -> Sources:
    orders = _read(spark, sf_dir, "orders").withColumn("ts", F.col("o_orderdate").cast("timestamp"))
    items = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("o_orderkey")
    category = F.when(F.col("p_partkey") % 97 != 0, F.replace("p_name", F.lit(" "), F.lit("_")))

    src_orders = orders.select(
        key.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(key % 50 == 0, "canceled")
        .when(key % 50 == 1, "unavailable")
        .when(F.col("o_orderstatus") == "F", "delivered")
        .otherwise("shipped")
        .alias("order_status"),
        F.col("ts").alias("order_purchase_timestamp"),
        F.expr("ts + make_dt_interval(0, int(o_orderkey % 48))").alias("order_approved_at"),
        F.when(key % 20 != 0, F.expr("ts + make_dt_interval(int(1 + o_orderkey % 3))")).alias(
            "order_delivered_carrier_date"
        ),
        F.when(
            key % 20 != 0,
            F.expr("ts + make_dt_interval(int(3 + o_orderkey % 37), int(o_orderkey % 24))"),
        ).alias("order_delivered_customer_date"),
        F.expr("ts + make_dt_interval(20)").alias("order_estimated_delivery_date"),
    )
    src_customers = (
        _read(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_custkey").alias("customer_unique_id"),
            F.lpad((F.col("c_custkey") % 99999).cast("string"), 5, "0").alias(
                "customer_zip_code_prefix"
            ),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )
    src_items = items.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.when(F.col("l_orderkey") % 211 == 0, F.col("l_extendedprice") * 10)
        .otherwise(F.col("l_extendedprice"))
        .alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
    )
    src_products = part.select(
        F.col("p_partkey").alias("product_id"),
        category.alias("product_category_name"),
        (F.col("p_size") * 100.0).alias("product_weight_g"),
        (F.col("p_partkey") % 5 + 1).alias("product_photos_qty"),
    )
    first = orders.where(key % 10 != 0).select(
        F.concat(F.lit("r"), key.cast("string")).alias("review_id"),
        key.alias("order_id"),
        (key % 5 + 1).alias("review_score"),
    )
    second = orders.where(key % 100 == 1).select(
        F.concat(F.lit("s"), key.cast("string")).alias("review_id"),
        key.alias("order_id"),
        F.lit(5).alias("review_score"),
    )
    pay = orders.select(
        key.alias("order_id"),
        F.col("o_orderpriority").alias("payment_type"),
        (key % 10 + 1).alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"),
    )
    voucher = pay.where(F.col("order_id") % 7 == 0).withColumn("payment_type", F.lit("voucher"))
    src_sellers = (
        _read(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(F.col("s_suppkey").alias("seller_id"), F.col("n_name").alias("seller_state"))
    )
    # Names of even length are translated to upper case; the others fall back to title case.
    src_map = (
        part.where(F.length("p_name") % 2 == 0)
        .select(
            F.replace("p_name", F.lit(" "), F.lit("_")).alias("product_category_name"),
            F.upper("p_name").alias("product_category_name_english"),
        )
        .distinct()
    )
    frames = {
        "orders": src_orders,
        "customers": src_customers,
        "items": src_items,
        "products": src_products,
        "reviews": first.unionByName(second),
        "payments": pay.unionByName(voucher),
        "sellers": src_sellers,
        "category_map": src_map,
    }
    return Sources(**{name: conform(df, name) for name, df in frames.items()})


# Period boundaries for these tables (dates run 1995-01 .. 2001-08).
TRAIN_END = "1998-12"
VALIDATION_END = "2000-06"

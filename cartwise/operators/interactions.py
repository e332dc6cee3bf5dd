"""Customer x category tables: interactions, histories, baskets, popularity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.columns import with_known
from cartwise.operators.features import purchase_order
from cartwise.session import slices_of, stage, stage_in_slices

KEYS = ["customer_unique_id", "category_en"]


def user_item(master: DataFrame) -> DataFrame:
    """Per customer and category: distinct orders, spend, mean review and delivery days."""
    return (
        with_known(master, *KEYS)
        .groupBy(*KEYS)
        .agg(
            F.count_distinct("order_id").alias("purchase_count"),
            F.coalesce(F.sum("item_total"), F.lit(0.0)).alias("total_spent"),
            F.avg("review_score").alias("avg_review"),
            F.avg("delivery_days").alias("avg_delivery_days"),
        )
    )


def interactions(master: DataFrame) -> DataFrame:
    """Distinct orders per customer and category (the long form of the matrix)."""
    return (
        with_known(master, *KEYS)
        .select(F.col(KEYS[0]).alias("user"), F.col(KEYS[1]).alias("category"), "order_id")
        .repartition("user", "category")  # one exchange: a distinct count alone moves its rows twice
        .groupBy("user", "category")
        .agg(F.count_distinct("order_id").alias("interactions"))
    )


def matrix_stats(matrix: DataFrame) -> DataFrame:
    """One row: size, density and mean/maximum row and column counts."""
    per_user = matrix.groupBy("user").count()
    users = per_user.agg(
        F.struct(
            F.count(F.lit(1)).alias("n"),
            F.sum("count").alias("cells"),
            F.max("count").alias("widest"),
        )
    ).scalar()
    return (
        matrix.agg(F.count_distinct("category").alias("n_categories"))
        .select(
            users["n"].alias("n_users"),
            "n_categories",
            F.coalesce(users["cells"], F.lit(0)).alias("n_interactions"),
            users["widest"].alias("max_cats_per_user"),
        )
        .withColumn(
            "density",
            F.try_divide(
                F.col("n_interactions") * 100.0, F.col("n_users") * F.col("n_categories")
            ),
        )
        .select(
            "n_users",
            "n_categories",
            "n_interactions",
            F.round(100 - F.col("density"), 3).alias("sparsity_pct"),
            F.round("density", 4).alias("density_pct"),
            F.round(F.try_divide("n_interactions", "n_users"), 3).alias("avg_cats_per_user"),
            "max_cats_per_user",
            F.round(F.try_divide("n_interactions", "n_categories"), 1).alias("avg_users_per_cat"),
        )
    )


def popularity(master: DataFrame, rows: int | None = None) -> DataFrame:
    """Distinct orders per category with rank (ties by name), share and 0..1 score.

    Those of a large table are counted slice by slice (``rows`` as in ``stage_in_slices``).
    """
    if slices_of(master.count() if rows is None else rows) == 1:
        return ranked_popularity(_category_orders(master))
    counts = stage_in_slices(master, ["order_id"], _category_orders, rows)
    return ranked_popularity(counts.groupBy("category_en").agg(F.sum("num_orders").alias("num_orders")))


def _category_orders(master: DataFrame) -> DataFrame:
    return (
        master.where("category_en IS NOT NULL")
        .groupBy("category_en")
        .agg(F.count_distinct("order_id").alias("num_orders"))
    )


def ranked_popularity(counts: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Add rank, percentage and score; the window holds one row per category (and group)."""
    everything = Window.partitionBy(*by)
    order = everything.orderBy(F.desc("num_orders"), "category_en")
    return counts.withColumns(
        {
            "rank": F.row_number().over(order),
            "pct_of_total": F.col("num_orders") / F.sum("num_orders").over(everything) * 100,
            "pop_score": F.col("num_orders") / F.max("num_orders").over(everything),
        }
    )


def first_purchases(master: DataFrame) -> DataFrame:
    """Per customer and category: first row of that category, item rows, distinct orders.

    The narrow rows move once, to the task of their customer and category, and
    are sorted there once; ``first`` does not repeat the category.
    """
    place = purchase_order()
    return (
        with_known(master, *KEYS)
        .select(*KEYS, "order_purchase_timestamp", "order_id", "order_item_id", "product_id")
        .repartition(*KEYS)
        .groupBy(*KEYS)
        .agg(
            F.min(place.dropFields("category")).alias("first"),
            F.count(F.lit(1)).alias("n_items"),
            F.count_distinct("order_id").alias("interactions"),
        )
    )


def customer_baskets(master: DataFrame) -> DataFrame:
    """One row per customer: distinct categories in order of first purchase.

    The array is bounded by the number of categories, not by the number of
    purchases; rows are reduced to (customer, category) before it is built.
    """
    return baskets_of(first_purchases(master))


def baskets_of(firsts: DataFrame) -> DataFrame:
    entry = F.struct(F.col("first"), F.col("category_en"), F.col("interactions"))
    return (
        firsts.repartition("customer_unique_id")  # rows move as they are, not as lists of one
        .groupBy("customer_unique_id")
        .agg(
            F.sort_array(F.collect_list(entry)).alias("entries"),
            F.sum("n_items").alias("n_items"),
        )
        .select(
            "customer_unique_id",
            F.col("entries.category_en").alias("cats"),
            F.col("entries.interactions").alias("counts"),
            F.size("entries").alias("n_categories"),
            "n_items",
        )
    )


def customer_history(master: DataFrame) -> DataFrame:
    """Per customer: distinct categories in first-purchase order and the two counts.

    ``n_orders`` is the number of item rows, as in the source definition; the
    full list with repeats is ``history_rows``.
    """
    return customer_baskets(master).select(
        "customer_unique_id",
        F.col("cats").alias("category_history"),
        "n_categories",
        F.col("n_items").alias("n_orders"),
    )


def history_rows(master: DataFrame) -> DataFrame:
    """Every purchase of every customer with its position in that customer's history.

    Rows are range-partitioned by customer and place. Positions are counted
    inside each range and shifted by the customer's earlier ranges, so a
    customer holding a large share of all rows is spread over many tasks.
    """
    rows = with_known(master, *KEYS).select(*KEYS, purchase_order().alias("place"))
    ranged = stage(  # the ranges come from a sample and must be drawn only once
        rows.repartitionByRange("customer_unique_id", "place").withColumn(
            "part", F.spark_partition_id()
        )
    )
    order = Window.partitionBy("customer_unique_id").orderBy("part")
    shifts = (
        ranged.groupBy("customer_unique_id", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("customer_unique_id", "part", (F.sum("n").over(order) - F.col("n")).alias("shift"))
    )
    inside = Window.partitionBy("customer_unique_id", "part").orderBy("place")
    return (
        ranged.withColumn("inside", F.row_number().over(inside))
        .join(shifts, ["customer_unique_id", "part"])
        .select(
            "customer_unique_id",
            (F.col("shift") + F.col("inside")).cast("bigint").alias("position"),
            "category_en",
        )
    )

"""Customer (RFM) and category features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.columns import right_closed_label
from cartwise.operators.quantiles import quintile_limits
from cartwise.session import slices_of, stage, stage_in_slices

# Segment limits and names, lowest first.
SEGMENT_EDGES = [0, 1.5, 2.5, 3.5, 4.5, 5.1]
SEGMENTS = ["Perdidos", "En riesgo", "Regulares", "Leales", "Campeones"]


def purchase_order() -> Column:
    """Total order of a customer's item rows; rows without a timestamp come last."""
    return F.struct(
        F.col("order_purchase_timestamp").isNull().alias("undated"),
        F.col("order_purchase_timestamp").alias("ts"),
        F.col("order_id").alias("order_id"),
        F.col("order_item_id").alias("item"),
        F.col("product_id").alias("product"),
        F.col("category_en").alias("category"),
    )


def rfm_base(master: DataFrame, newest: Column | None = None) -> DataFrame:
    """Thirteen aggregates per customer in one grouping.

    Rows move once, as they are: beside a distinct count, the sets and value
    counts of every customer and order would move, and those of customers again.
    Only the order count is a distinct aggregate; states, categories and
    payment types are small domains and are counted as sets. ``newest`` is the
    last purchase of all customers if ``master`` holds a part of them.
    """
    if newest is None:
        newest = master.agg(F.max("order_purchase_timestamp")).scalar()
    since = F.unix_micros(newest) - F.unix_micros(F.max("order_purchase_timestamp"))
    dated_category = F.when(F.col("category_en").isNotNull(), purchase_order())
    return (
        master.where("customer_unique_id IS NOT NULL")
        .repartition("customer_unique_id")
        .groupBy("customer_unique_id")
        .agg(
            F.floor(since / F.lit(86_400_000_000)).alias("recency"),
            F.count_distinct("order_id").alias("frequency"),
            F.coalesce(F.sum("item_total"), F.lit(0.0)).alias("monetary"),
            F.avg("item_total").alias("avg_ticket"),
            F.avg("review_score").alias("avg_review"),
            F.size(F.collect_set("category_en")).alias("category_diversity"),
            F.count("order_item_id").alias("total_items"),
            F.avg("delivery_days").alias("avg_delivery_days"),
            F.avg("is_late").alias("late_rate"),
            F.mode("customer_state", True).alias("preferred_state"),
            F.mode("category_en", True).alias("preferred_category"),
            F.max(dated_category)["category"].alias("last_category"),
            F.size(F.collect_set("payment_type")).alias("n_distinct_payments"),
        )
    )


def quintile_score(limits: Column, value: str, reverse: bool = False) -> Column:
    exceeded = sum(
        (F.coalesce(F.col(value) > limits[f"c{i}"], F.lit(True)).cast("double") for i in range(1, 5)),
        start=F.lit(0.0),
    )
    score = 5.0 - exceeded if reverse else 1.0 + exceeded
    return F.when(F.col(value).isNotNull(), score)


def build_rfm(master: DataFrame, rows: int | None = None) -> DataFrame:
    """Customer features with quintile scores 1..5, their mean and the segment (``rows`` as in ``stage_in_slices``)."""
    newest = stage(master.agg(F.max("order_purchase_timestamp").alias("newest")))
    base = stage_in_slices(master, ["customer_unique_id"], lambda part: rfm_base(part, newest.scalar()), rows)
    metrics = {"R_score": "recency", "F_score": "frequency", "M_score": "monetary"}
    limits = quintile_limits(base, list(metrics.values())).agg(
        F.map_from_entries(
            F.collect_list(F.struct("metric", F.struct("c1", "c2", "c3", "c4")))
        )
    )
    scored = (
        base.withColumn("limits", limits.scalar())
        .withColumns(
            {
                score: quintile_score(F.col("limits")[column], column, reverse=column == "recency")
                for score, column in metrics.items()
            }
        )
        .drop("limits")
    )
    scores = list(metrics)
    known = sum((F.col(s).isNotNull().cast("int") for s in scores), start=F.lit(0))
    total = sum((F.coalesce(F.col(s), F.lit(0.0)) for s in scores), start=F.lit(0.0))
    return scored.withColumn("RFM_score", F.round(F.try_divide(total, known), 1)).withColumn(
        "segment", right_closed_label("RFM_score", SEGMENT_EDGES, SEGMENTS)
    )


def build_category_features(master: DataFrame, rows: int | None = None) -> DataFrame:
    """Per category: volumes, averages, repeat rate and popularity rank.

    An order belongs to one customer, so distinct orders, distinct customers
    and repeat buyers all follow from one (category, customer) aggregation,
    and everything is a sum over customers: those of a large table (``rows``
    as in ``stage_in_slices``) are added up slice by slice.
    """
    if slices_of(master.count() if rows is None else rows) == 1:
        return _ranked_features(_category_sums(master))
    return _ranked_features(stage_in_slices(master, ["customer_unique_id"], _category_sums, rows))


def _category_sums(master: DataFrame) -> DataFrame:
    """Per category: what the customers of ``master`` add to its features."""
    sums = {
        "price": "price",
        "review": "review_score",
        "delivery": "delivery_days",
        "late": "is_late",
        "freight": "freight_ratio",
    }
    per_customer = (
        master.where("category_en IS NOT NULL")
        .groupBy("category_en", "customer_unique_id")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            F.sum("item_total").alias("revenue"),
            *(F.sum(c).alias(f"{n}_sum") for n, c in sums.items()),
            *(F.count(c).alias(f"{n}_n") for n, c in sums.items()),
        )
    )
    known = F.col("customer_unique_id").isNotNull()
    return per_customer.groupBy("category_en").agg(
        F.sum("orders").alias("orders"),
        F.count("customer_unique_id").alias("customers"),
        F.count_if(known & (F.col("orders") > 1)).alias("repeat"),
        F.sum("revenue").alias("revenue"),
        *(F.sum(f"{n}_sum").alias(f"{n}_sum") for n in sums),
        *(F.sum(f"{n}_n").alias(f"{n}_n") for n in sums),
    )


def _ranked_features(parts: DataFrame) -> DataFrame:
    """The features of all categories from one or several rows of ``_category_sums`` each."""

    def mean(name: str) -> Column:
        return F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n"))

    features = parts.groupBy("category_en").agg(
        F.sum("orders").alias("total_orders"),
        F.sum("customers").alias("total_customers"),
        mean("price").alias("avg_price"),
        mean("review").alias("avg_review"),
        mean("delivery").alias("avg_delivery"),
        mean("late").alias("late_rate"),
        F.coalesce(F.sum("revenue"), F.lit(0.0)).alias("total_revenue"),
        mean("freight").alias("avg_freight_ratio"),
        F.coalesce(F.try_divide(F.sum("repeat"), F.sum("customers")), F.lit(0.0)).alias("repeat_rate"),
    )
    # One row per category: average rank of ties, cut to a whole number.
    by_volume = Window.orderBy(F.desc("total_orders"))
    ties = F.count(F.lit(1)).over(Window.partitionBy("total_orders"))
    return features.withColumn(
        "popularity_rank", F.floor(F.rank().over(by_volume) + (ties - 1) / 2).cast("int")
    )

"""Report queries over the master table and the derived features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.functions.columns import equal_width_bin, right_closed_label, with_known
from cartwise.operators.features import SEGMENTS
from cartwise.operators.interactions import popularity
from cartwise.operators.quantiles import exact_quantiles

# Month labels of the demand table.
MONTHS = ["Ene", "Feb", "Mar", "Abr", "May", "Jun", "Jul", "Ago", "Sep", "Oct", "Nov", "Dic"]
# Customer groups by number of categories.
DIVERSITY_EDGES = [0, 1, 2, 5, float("inf")]
DIVERSITY_LABELS = ["1 categoría", "2 categorías", "3-5 categorías", "6+ categorías"]


def orders_by_month(master: DataFrame) -> DataFrame:
    return (
        master.where("order_ym IS NOT NULL")
        .groupBy("order_ym")
        .agg(F.count_distinct("order_id").alias("orders"))
    )


def orders_by_review_score(master: DataFrame) -> DataFrame:
    return (
        with_known(master, "review_score")
        .groupBy("review_score")
        .agg(F.count_distinct("order_id").alias("orders"))
    )


def histogram(df: DataFrame, value: str, bins: int = 50) -> DataFrame:
    """Equal-width bins between minimum and maximum: bin, lower edge, upper edge, rows."""
    known = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    limits = known.agg(F.struct(F.min("v").alias("low"), F.max("v").alias("high"))).scalar()
    width = (F.col("l.high") - F.col("l.low")) / bins
    return (
        known.withColumn("l", limits)
        .groupBy("l", equal_width_bin(F.col("v"), F.col("l.low"), F.col("l.high"), bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "bin",
            (F.col("l.low") + width * (F.col("bin") - 1)).alias("low"),
            (F.col("l.low") + width * F.col("bin")).alias("high"),
            "n",
        )
    )


def plausible_deliveries(master: DataFrame) -> DataFrame:
    return master.where("delivery_days > 0 AND delivery_days < 100")


def delivery_histogram(master: DataFrame) -> DataFrame:
    return histogram(plausible_deliveries(master), "delivery_days")


def delivery_median(master: DataFrame) -> DataFrame:
    return plausible_deliveries(master).agg(F.median("delivery_days").alias("median_days"))


def orders_by_category(master: DataFrame, top: int = 20) -> DataFrame:
    return popularity(master).where(F.col("rank") <= top).select(
        "category_en", "num_orders", F.col("pct_of_total").alias("pct")
    )


def ticket_by_category(master: DataFrame, top: int = 20) -> DataFrame:
    return (
        master.where("category_en IS NOT NULL")
        .groupBy("category_en")
        .agg(F.avg("item_total").alias("mean_ticket"))
        .orderBy(F.desc("mean_ticket"), "category_en")
        .limit(top)
        .select("category_en", F.round("mean_ticket", 2).alias("avg_ticket"))
    )


def _top_categories(master: DataFrame, measure: Column, top: int) -> DataFrame:
    return (
        master.where("category_en IS NOT NULL")
        .groupBy("category_en")
        .agg(measure.alias("m"))
        .orderBy(F.desc("m"), "category_en")
        .limit(top)
        .select("category_en")
    )


def demand_by_month(master: DataFrame, top: int = 15) -> DataFrame:
    """Orders of the top categories by month of the year, one column per month."""
    best = _top_categories(master, F.count_distinct("order_id"), top)
    label = F.create_map(*(F.lit(x) for i, m in enumerate(MONTHS, 1) for x in (i, m)))
    return (
        master.join(F.broadcast(best), "category_en", "left_semi")  # ``top`` rows
        .where("order_month IS NOT NULL")
        .groupBy("category_en", "order_month")
        .agg(F.count_distinct("order_id").alias("orders"))
        .withColumn("month_label", label[F.col("order_month")])
        .groupBy("category_en")
        .pivot("month_label", MONTHS)
        .agg(F.sum("orders"))
        .fillna(0)
    )


def top_pairs(pairs: DataFrame, top: int = 25) -> DataFrame:
    """Most frequent category pairs with a readable label."""
    return (
        pairs.orderBy(F.desc("support"), "cat_a", "cat_b")
        .limit(top)
        .select("cat_a", "cat_b", "support", F.concat_ws(" ↔ ", "cat_a", "cat_b").alias("pair"))
    )


def _customers_by(master: DataFrame, column: str, name: str, most: int) -> DataFrame:
    return (
        master.where("customer_unique_id IS NOT NULL")
        .groupBy("customer_unique_id")
        .agg(F.count_distinct(column).alias(name))
        .where(F.col(name) <= most)
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n_customers"))
    )


def customers_by_orders(master: DataFrame, most: int = 10) -> DataFrame:
    return _customers_by(master, "order_id", "n_orders", most)


def customers_by_categories(master: DataFrame, most: int = 10) -> DataFrame:
    return _customers_by(master, "category_en", "n_cats", most)


def customers_by_state(master: DataFrame) -> DataFrame:
    return (
        master.where("customer_state IS NOT NULL")
        .groupBy("customer_state")
        .agg(F.count_distinct("customer_unique_id").alias("customers"))
    )


def spend_by_state(master: DataFrame) -> DataFrame:
    return (
        master.where("customer_state IS NOT NULL")
        .groupBy("customer_state")
        .agg(F.round(F.coalesce(F.sum("item_total"), F.lit(0.0)), 0).alias("total_brl"))
    )


def diversity_segments(baskets: DataFrame) -> DataFrame:
    return (
        baskets.select(
            right_closed_label("n_categories", DIVERSITY_EDGES, DIVERSITY_LABELS).alias("segment")
        )
        .where("segment IS NOT NULL")
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"))
    )


def revenue_by_month(master: DataFrame, top: int = 10) -> DataFrame:
    """Revenue per month of the categories with the highest revenue."""
    best = _top_categories(master, F.coalesce(F.sum("item_total"), F.lit(0.0)), top)
    return (
        master.join(F.broadcast(best), "category_en", "left_semi")  # ``top`` rows
        .where("order_ym IS NOT NULL")
        .groupBy("order_ym", "category_en")
        .agg(F.coalesce(F.sum("item_total"), F.lit(0.0)).alias("revenue"))
    )


def rfm_histograms(rfm: DataFrame, bins: int = 50) -> DataFrame:
    """Histograms of recency, frequency (up to 5) and monetary (up to its 95 % quantile)."""
    cap = exact_quantiles(rfm, "monetary", {"cap": 0.95}).scalar()
    parts = {
        "recency": histogram(rfm, "recency", bins),
        "frequency": rfm.where("frequency <= 5")
        .groupBy(F.col("frequency").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", F.col("bin").cast("double").alias("low"), F.col("bin").cast("double").alias("high"), "n"),
        "monetary": histogram(rfm.where(F.col("monetary") <= cap), "monetary", bins),
    }
    union = None
    for name, part in parts.items():
        labelled = part.select(F.lit(name).alias("metric"), "*")
        union = labelled if union is None else union.unionByName(labelled)
    return union


def rfm_medians(rfm: DataFrame) -> DataFrame:
    recency = rfm.agg(F.median("recency").alias("median_recency"))
    monetary = exact_quantiles(rfm, "monetary", {"m": 0.5}).scalar()
    return recency.select("median_recency", monetary.alias("median_monetary"))


def rfm_segments(rfm: DataFrame) -> DataFrame:
    """Customers and percentage per segment, best segment first."""
    best_first = F.array(*(F.lit(s) for s in reversed(SEGMENTS)))
    return (
        rfm.where("segment IS NOT NULL")
        .groupBy("segment")
        .agg(F.count(F.lit(1)).alias("customers"))
        .select(
            "segment",
            "customers",
            F.round(F.col("customers") / F.sum("customers").over(Window.partitionBy()) * 100, 1).alias("pct"),
            F.array_position(best_first, F.col("segment")).cast("int").alias("position"),
        )
        .orderBy("position")
    )


def top_category_features(features: DataFrame, top: int = 20) -> DataFrame:
    return features.orderBy(F.desc("total_orders"), "category_en").limit(top)


def scenario_table(scenarios: dict[str, DataFrame]) -> DataFrame:
    """One-row measure frames by scenario, in long form."""
    union = None
    for name, frame in scenarios.items():
        row = frame.select(F.lit(name).alias("scenario"), "precision", "recall")
        union = row if union is None else union.unionByName(row)
    return union.unpivot(["scenario"], ["precision", "recall"], "metric", "value")

"""Cleaning of the master table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwise.functions.columns import with_known
from cartwise.operators.quantiles import exact_quantiles
from cartwise.session import STAGED, release, stage

# Order states that never count as a purchase.
EXCLUDED_STATUS = ["canceled", "unavailable", "created"]


def _not_called_off() -> Column:
    return ~F.coalesce(F.col("order_status").isin(EXCLUDED_STATUS), F.lit(False))


def _eligible() -> Column:
    return F.col("category_en").isNotNull() & F.col("customer_unique_id").isNotNull() & _not_called_off()


def eligible_rows(master: DataFrame) -> DataFrame:
    """Rows with category and customer whose order was not called off (NULL status stays)."""
    return with_known(master, "category_en", "customer_unique_id").where(_not_called_off())


def flagged_master(master: DataFrame) -> DataFrame:
    """All rows, with ``kept`` and the values that cleaning gives them: ``clean_days``, ``clean_review``.

    All fill values come from one small frame of (state, days) counts, which
    is run once: the state medians, and the global median of the column after
    the state fill. The price cap uses the rows left at that point. The values
    are staged, so the result may be read often without a copy of the table.
    """
    base = eligible_rows(master)
    days = stage(
        base.groupBy("seller_state", "delivery_days").agg(F.count(F.lit(1)).alias("n"))
    )
    state_median = (
        days.where("seller_state IS NOT NULL")
        .groupBy("seller_state")
        .agg(F.percentile("delivery_days", 0.5, F.col("n")).alias("state_days"))
    )
    overall_days = (
        days.join(state_median, "seller_state", "left")
        .agg(F.percentile(F.coalesce("delivery_days", "state_days"), 0.5, F.col("n")))
        .scalar()
    )
    overall_review = (
        base.groupBy("review_score")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.percentile("review_score", 0.5, F.col("n")))
        .scalar()
    )
    state_median = stage(state_median)
    counted = len(STAGED)
    cap = price_cap(base)
    fills = stage(cap.select("price_cap", overall_days.alias("days"), overall_review.alias("review")))
    release(master.sparkSession, counted, len(STAGED) - 1)  # the counts of prices

    def fill(name: str) -> Column:
        return fills.select(name).scalar()

    return master.join(F.broadcast(state_median), "seller_state", "left").select(
        *master.columns,
        F.coalesce("delivery_days", "state_days", fill("days")).alias("clean_days"),
        F.coalesce("review_score", fill("review")).alias("clean_review"),
        F.coalesce(_eligible() & (F.col("price") <= fill("price_cap")), F.lit(False)).alias("kept"),
    )


def clean_master(master: DataFrame) -> DataFrame:
    """Drop, impute and cap, in this order."""
    given = {"delivery_days": "clean_days", "review_score": "clean_review"}
    known = with_known(flagged_master(master), "category_en", "customer_unique_id", "price")
    return known.where("kept").select(*(F.col(given.get(c, c)).alias(c) for c in master.columns))


def price_cap(table: DataFrame) -> DataFrame:
    """One row: third quartile plus three interquartile ranges."""
    return exact_quantiles(table, "price", {"q1": 0.25, "q3": 0.75}).select(
        (F.col("q3") + 3 * (F.col("q3") - F.col("q1"))).alias("price_cap")
    )


def cleaning_log(master: DataFrame) -> DataFrame:
    """One row: rows dropped for a missing key and rows dropped by the price cap."""
    base = eligible_rows(master)
    cap = price_cap(base).scalar()
    dropped_price = base.agg(
        F.count_if(~F.coalesce(F.col("price") <= cap, F.lit(False)))
    ).scalar()
    return master.agg(
        F.count_if(
            F.col("category_en").isNull() | F.col("customer_unique_id").isNull()
        ).alias("dropped_no_category")
    ).select(
        "dropped_no_category",
        dropped_price.alias("dropped_price"),
        F.concat(
            F.lit("Dropped no-category: "),
            F.col("dropped_no_category").cast("string"),
            F.lit(" | price outliers: "),
            dropped_price.cast("string"),
        ).alias("cleaning_log"),
    )

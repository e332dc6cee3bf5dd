"""Temporal split into training, validation and backtest period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Default last months of the training and validation periods.
TRAIN_END = "2017-09"
VALIDATION_END = "2018-03"


def with_split(
    master: DataFrame, train_end: str = TRAIN_END, validation_end: str = VALIDATION_END
) -> DataFrame:
    """Add ``split``; rows without a purchase month belong to no period and are dropped."""
    month = F.col("order_ym")
    return master.where(month.isNotNull()).withColumn(
        "split",
        F.when(month <= train_end, "train").when(month <= validation_end, "val").otherwise("backtest"),
    )


def split_summary(
    split: DataFrame, train_end: str = TRAIN_END, validation_end: str = VALIDATION_END
) -> DataFrame:
    """Per period: first and last month, months with orders, distinct orders and customers."""
    months = (
        split.select("split", "order_ym")
        .distinct()
        .groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("months"),
            F.min("order_ym").alias("first_month"),
            F.max("order_ym").alias("last_month"),
        )
    )
    # An order belongs to one customer, so both distinct counts share one grouping.
    volumes = (
        split.groupBy("split", "customer_unique_id")
        .agg(F.count_distinct("order_id").alias("orders"))
        .groupBy("split")
        .agg(F.sum("orders").alias("orders"), F.count("customer_unique_id").alias("customers"))
    )

    def after(month: str):
        return F.date_format(F.add_months(F.to_date(F.lit(f"{month}-01")), 1), "yyyy-MM")

    is_split = F.col("split")
    # The three periods, listed also when nothing falls into one.
    periods = split.sparkSession.createDataFrame([("train",), ("val",), ("backtest",)], "split string")
    found = F.broadcast(periods).join(months.join(volumes, "split"), "split", "left")
    found = found.fillna(0, ["months", "orders", "customers"])
    return found.select(
        "split",
        F.when(is_split == "val", after(train_end))
        .when(is_split == "backtest", after(validation_end))
        .otherwise(F.col("first_month"))
        .alias("from_month"),
        F.when(is_split == "train", F.lit(train_end))
        .when(is_split == "val", F.lit(validation_end))
        .otherwise(F.col("last_month"))
        .alias("to_month"),
        "months",
        "orders",
        "customers",
    )


def orders_per_month(split: DataFrame) -> DataFrame:
    return split.groupBy("split", "order_ym").agg(F.count_distinct("order_id").alias("orders"))

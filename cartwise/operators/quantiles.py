"""Exact, interpolated quantiles and rank cut points without a single-task sort.

Rows are first reduced to (value, count) and range-partitioned. A window adds
up the counts inside each range, and the offsets of the ranges (one row per
shuffle partition and group) make the positions global. Built-in ``percentile``
would hold all distinct values of a group in one task; it is used elsewhere
only for columns of whole days or review scores.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwise.session import stage


def value_buckets(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct values with their counts, range-partitioned; ``bucket`` is the range number.

    Staged, because the ranges come from a sample and must be drawn only once.
    """
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return stage(
        counts.repartitionByRange(*by, "value").withColumn("bucket", F.spark_partition_id())
    )


def cumulative_counts(
    buckets: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] | None = None
) -> DataFrame:
    """Per distinct value: ``n`` rows, ``before`` smaller rows, ``total`` rows (per group).

    With ``probabilities`` only the ranges holding those quantiles are ranked.
    """
    by = list(by)
    per_bucket = buckets.groupBy(*by, "bucket").agg(F.sum("n").alias("bucket_n"))
    over_buckets = Window.partitionBy(*by).orderBy("bucket")
    offsets = per_bucket.select(
        *by,
        "bucket",
        (F.sum("bucket_n").over(over_buckets) - F.col("bucket_n")).alias("offset"),
        F.sum("bucket_n").over(Window.partitionBy(*by)).alias("total"),
        "bucket_n",
    )
    if probabilities is not None:
        needed = F.lit(False)
        for p in probabilities:
            place = F.lit(float(p)) * (F.col("total") - 1)
            ends_before = F.ceil(place) < F.col("offset")
            starts_after = F.floor(place) >= F.col("offset") + F.col("bucket_n")
            needed = needed | ~(ends_before | starts_after)
        offsets = offsets.where(needed)
    inside = Window.partitionBy(*by, "bucket").orderBy("value")
    return buckets.join(offsets, [*by, "bucket"]).select(
        *by,
        "value",
        "n",
        (F.col("offset") + F.sum("n").over(inside) - F.col("n")).alias("before"),
        "total",
    )


def exact_quantiles(
    df: DataFrame, value: str, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """One row (per group) with a linearly interpolated quantile per named probability."""
    buckets = value_buckets(df, value, by)
    ranked = cumulative_counts(buckets, by, list(probabilities.values()))
    return quantiles_of(ranked, probabilities, by)


def quantiles_of(
    ranked: DataFrame, probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    by = list(by)
    aggregates = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("total") - 1)
        for side, index in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            holds = (F.col("before") <= index) & (index < F.col("before") + F.col("n"))
            aggregates.append(F.max(F.when(holds, F.col("value"))).alias(f"{name}_{side}"))
    picked = ranked.groupBy(*by).agg(F.max("total").alias("total"), *aggregates)
    columns = []
    for name, p in probabilities.items():
        place = F.lit(float(p)) * (F.col("total") - 1)
        low, high = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        columns.append((low + (high - low) * (place - F.floor(place))).alias(name))
    return picked.select(*by, *columns)


def quintile_limits(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column one row ``c1..c4``: a value scores 1 + the number of limits it exceeds.

    With five distinct quantile intervals the limits are the inner quintiles.
    Otherwise (heavy ties) the average rank as a fraction is cut into five
    equal-width intervals, and a limit is the highest value up to that cut;
    NULL means that no value lies below the cut. All columns are ranked in one
    pass over (metric, value) pairs.
    """
    long = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).unpivot(
        [], list(columns), "metric", "measure"
    )
    ranked = stage(
        cumulative_counts(value_buckets(long, "measure", ["metric"]), ["metric"])
    ).withColumn(
        "pct", (F.col("before") + (F.col("n") + 1) / 2) / F.col("total")
    )
    probabilities = {f"q{i}": i / 5 for i in range(6)}
    quantiles = quantiles_of(ranked, probabilities, ["metric"]).withColumn(
        "edges", F.size(F.array_distinct(F.array(*probabilities)))
    )
    # A constant column is widened by 0.1 % on both sides, which puts it in the middle interval.
    single = F.col("low") == F.col("high")
    span = (
        ranked.groupBy("metric")
        .agg(F.min("pct").alias("low"), F.max("pct").alias("high"))
        .select(
            "metric",
            F.when(single, F.col("low") * 0.999).otherwise(F.col("low")).alias("low"),
            F.when(single, F.col("high") * 1.001).otherwise(F.col("high")).alias("high"),
        )
    )
    tied = (
        ranked.join(F.broadcast(span), "metric")  # one row per requested column
        .groupBy("metric")
        .agg(
            *(
                F.max(
                    F.when(
                        F.col("pct") <= F.col("low") + (F.col("high") - F.col("low")) * (i / 5),
                        F.col("value"),
                    )
                ).alias(f"t{i}")
                for i in range(1, 5)
            )
        )
    )
    return quantiles.join(tied, "metric").select(
        "metric",
        *(
            F.when(F.col("edges") == 6, F.col(f"q{i}")).otherwise(F.col(f"t{i}")).alias(f"c{i}")
            for i in range(1, 5)
        ),
    )

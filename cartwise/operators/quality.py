"""Column profile, business figures and the cleaning report."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from cartwise.functions.columns import share
from cartwise.operators.quantiles import exact_quantiles
from cartwise.session import stage


def data_quality(master: DataFrame, approximate: bool = False) -> DataFrame:
    """Per column: type, NULL count, NULL percentage and number of distinct values.

    The exact form turns each row into (column, value) pairs that are counted
    before the shuffle, so a frequent value travels once per task. A large
    table's columns are counted in groups, one after the other, so that the
    values of one group only are on disk.
    ``approximate`` needs one pass without a shuffle of values.
    """
    types = F.create_map(*(F.lit(x) for pair in master.dtypes for x in pair))
    if approximate:
        measured = merged_profile(master.agg(*_sketches(master)).select(F.inline(_rows_of(master))))
    else:
        at_once = max(1, CELLS // max(1, master.count()))
        if at_once >= len(master.columns):
            measured = _counted_cells(master, master.columns)
        else:
            groups = [master.columns[i : i + at_once] for i in range(0, len(master.columns), at_once)]
            count = _counted_cells if at_once > 1 else _counted_column
            first, *others = (count(master, group) for group in groups)
            measured = stage(first, others)
    return measured.select(
        "column",
        types[F.col("column")].alias("dtype"),
        "null_count",
        F.round(F.col("null_count") / F.col("rows") * 100, 2).alias("null_pct"),
        "unique",
    ).orderBy(F.desc("null_pct"), "column")


CELLS = 128 << 20  # cells (rows times columns) whose values are counted at once; one column at least


def _counted_cells(master: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls, distinct values and rows of ``columns``, from their cells as text."""
    pairs = (F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)
    return _measured(master.select(F.explode(F.array(*pairs)).alias("cell")).groupBy("cell.column", "cell.value"))


def _counted_column(master: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for one column, whose values are counted as they are where two of them never read the same as text."""
    (name,) = columns
    kind, value = dict(master.dtypes)[name], F.col(name)
    zone = master.sparkSession.conf.get("spark.sql.session.timeZone")
    zero = F.when(value == 0, value.cast("string")) if kind in ("double", "float") else F.lit(None)  # 0.0 and -0.0
    if kind not in ("double", "float", "int", "bigint", "string") and not (kind == "timestamp" and zone == "UTC"):
        value = value.cast("string")
    cells = master.select(F.lit(name).alias("column"), value.alias("value"), zero.alias("zero"))
    return _measured(cells.groupBy("column", "value", "zero"))


def _measured(cells: GroupedData) -> DataFrame:
    return (
        cells.agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(
            F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("null_count"),
            F.count("value").alias("unique"),
            F.sum("n").alias("rows"),
        )
    )


def columns_with_nulls(master: DataFrame) -> DataFrame:
    return data_quality(master).where("null_pct > 0").orderBy("null_pct", "column")


@dataclass(frozen=True)
class Side:
    """A view of one table: which rows count, and where its delivery days and review scores stand."""

    name: str
    counts: Column
    days: str = "delivery_days"
    review: str = "review_score"


def _raw_side() -> Side:
    return Side("raw", F.lit(True))


def _clean_side() -> Side:
    return Side("clean", F.col("kept"), "clean_days", "clean_review")


# The groupings that all key figures come from.
_KEYS = ["order_id", "customer_unique_id", "category_en", "product_id", "customer_state"]
_SETS = {
    "orders": ("order_id", "customer_unique_id"),
    "tastes": ("customer_unique_id", "category_en"),
    "products": ("product_id",),
    "states": ("customer_unique_id", "customer_state"),
}


def grouped_figures(table: DataFrame, sides: Sequence[Side]) -> DataFrame:
    """Counts and sums of all sides by the four groupings of ``_SETS``, from one scan and one shuffle.

    Columns: ``grouping`` (name of the set), the keys, and the measures of each
    side behind its name.
    """
    measures = []
    for s in sides:
        delivered = s.counts & (F.col("order_status") == "delivered")
        measures += [
            F.count_if(s.counts).alias(f"{s.name}_rows"),
            F.count(F.when(s.counts, F.col("order_item_id"))).alias(f"{s.name}_items"),
            F.sum(F.when(s.counts, F.col("item_total"))).alias(f"{s.name}_spend"),
            F.max(F.when(s.counts, F.col("price"))).alias(f"{s.name}_price"),
        ]
        for what, column in (("review", s.review), ("days", s.days), ("late", "is_late")):
            value = F.when(delivered, F.col(column))
            measures += [F.sum(value).alias(f"{s.name}_{what}_sum"), F.count(value).alias(f"{s.name}_{what}_n")]
        for what, column in (("review", s.review), ("days", s.days), ("category", "_category")):
            measures.append(F.count_if(s.counts & F.col(column).isNull()).alias(f"{s.name}_{what}_nulls"))
    # Bits of the grouping number are set for the keys that a set does not group by.
    numbers = {
        name: sum(1 << (len(_KEYS) - 1 - i) for i, k in enumerate(_KEYS) if k not in keys) for name, keys in _SETS.items()
    }
    names = F.create_map(*(F.lit(x) for name, number in numbers.items() for x in (number, name)))
    grouped = (
        table.withColumn("_category", F.col("category_en"))  # the key itself is null in most sets
        .groupingSets([tuple(F.col(k) for k in keys) for keys in _SETS.values()], *_KEYS)
        .agg(F.grouping_id().cast("int").alias("_number"), *measures)
    )
    return grouped.withColumn("grouping", names[F.col("_number")]).drop("_number")


def business_metrics(master: DataFrame) -> DataFrame:
    """One row of key figures, unrounded (see ``rounded_metrics``)."""
    side = _raw_side()
    return _key_figures(stage(grouped_figures(master, [side])), side.name)


def _key_figures(grouped: DataFrame, side: str) -> DataFrame:
    """One row for a side, from the staged groupings: small next to the table itself."""

    def part(grouping: str) -> DataFrame:
        return grouped.where((F.col("grouping") == grouping) & (F.col(f"{side}_rows") > 0))

    per_order = part("orders")
    orders = per_order.groupBy("order_id").agg(
        F.sum(f"{side}_items").alias("items"), F.coalesce(F.sum(f"{side}_spend"), F.lit(0.0)).alias("spend")
    )
    per_customer = (
        per_order.where("customer_unique_id IS NOT NULL")
        .groupBy("customer_unique_id")
        .agg(F.count("order_id").alias("orders"))
    )
    order_figures = orders.agg(
        F.struct(F.count("order_id").alias("n"), F.avg("items").alias("items"), F.avg("spend").alias("spend"))
    ).scalar()
    customer_figures = per_customer.agg(
        F.struct(F.count(F.lit(1)).alias("n"), share(F.col("orders") > 1).alias("repeat"))
    ).scalar()
    tastes = part("tastes").where("category_en IS NOT NULL")
    pairs = tastes.where("customer_unique_id IS NOT NULL").agg(F.count(F.lit(1))).scalar()
    categories = tastes.agg(F.count_distinct("category_en")).scalar()
    products = part("products").agg(F.count("product_id")).scalar()
    top_state = (
        part("states").where("customer_state IS NOT NULL AND customer_unique_id IS NOT NULL")
        .groupBy("customer_state").count().orderBy(F.desc("count"), "customer_state").limit(1)
        .select("customer_state").scalar()
    )

    def mean(what: str) -> Column:
        return F.try_divide(F.sum(f"{side}_{what}_sum"), F.sum(f"{side}_{what}_n"))

    return per_order.agg(
        mean("review").alias("avg_review_score"),
        mean("days").alias("avg_delivery_days"),
        (mean("late") * 100).alias("late_delivery_rate_pct"),
    ).select(
        order_figures["n"].alias("total_orders"),
        customer_figures["n"].alias("total_customers"),
        products.alias("total_products"),
        categories.alias("total_categories"),
        "avg_review_score",
        order_figures["items"].alias("avg_items_per_order"),
        order_figures["spend"].alias("avg_order_value_brl"),
        "avg_delivery_days",
        "late_delivery_rate_pct",
        (customer_figures["repeat"] * 100).alias("repeat_customer_rate"),
        F.try_divide(pairs, customer_figures["n"]).alias("avg_categories_per_customer"),
        top_state.alias("top_state_customers"),
    )


# Decimals of the published figures.
METRIC_DECIMALS = {
    "avg_review_score": 2,
    "avg_items_per_order": 2,
    "avg_order_value_brl": 2,
    "avg_delivery_days": 1,
    "late_delivery_rate_pct": 1,
    "repeat_customer_rate": 1,
    "avg_categories_per_customer": 2,
}


def rounded_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.withColumns({c: F.round(c, d) for c, d in METRIC_DECIMALS.items()})


def grouped_sides(flagged: DataFrame) -> DataFrame:
    """Both sides of ``clean.flagged_master`` in one scan of the master; staged."""
    return stage(grouped_figures(flagged, [_raw_side(), _clean_side()]))


def metrics_raw_and_clean(grouped: DataFrame) -> DataFrame:
    """The key figures of both sides, one row each, from ``grouped_sides``."""
    return (
        _key_figures(grouped, "raw")
        .withColumn("dataset", F.lit("raw"))
        .unionByName(_key_figures(grouped, "clean").withColumn("dataset", F.lit("clean")))
    )


def _cleaning_figures(grouped: DataFrame, flagged: DataFrame, side: Side, column: str) -> DataFrame:
    per_order = grouped.where((F.col("grouping") == "orders") & (F.col(f"{side.name}_rows") > 0))
    median = exact_quantiles(flagged.where(side.counts), "price", {"median": 0.5}).scalar()
    orders = per_order.agg(F.count_distinct("order_id")).scalar()
    customers = per_order.agg(F.count_distinct("customer_unique_id")).scalar()
    rows = F.sum(f"{side.name}_rows")

    def null_pct(what: str) -> Column:
        return F.sum(f"{side.name}_{what}_nulls") * 100 / rows

    return (
        per_order.agg(
            F.coalesce(rows, F.lit(0)).cast("double").alias("rows"),
            null_pct("days").alias("null_pct_delivery_days"),
            null_pct("review").alias("null_pct_review_score"),
            null_pct("category").alias("null_pct_category_en"),
            F.max(f"{side.name}_price").alias("max_price"),
        )
        .withColumns({"orders": orders.cast("double"), "customers": customers.cast("double"), "median_price": median})
        .unpivot([], _REPORT_ORDER, "metric", column)
    )


_REPORT_ORDER = [
    "rows",
    "orders",
    "customers",
    "null_pct_delivery_days",
    "null_pct_review_score",
    "null_pct_category_en",
    "max_price",
    "median_price",
]


def cleaning_report(grouped: DataFrame, flagged: DataFrame) -> DataFrame:
    """Eight figures before and after cleaning, in report order (``grouped_sides`` of ``flagged``)."""
    before = _cleaning_figures(grouped, flagged, _raw_side(), "before")
    after = _cleaning_figures(grouped, flagged, _clean_side(), "after")
    joined = before.join(after, "metric")
    position = F.array_position(F.array(*(F.lit(m) for m in _REPORT_ORDER)), F.col("metric"))
    return joined.select(position.cast("int").alias("position"), "metric", "before", "after").orderBy(
        "position"
    )


NULL_CHECK_COLUMNS = [
    "delivery_days",
    "review_score",
    "delivery_delay",
    "estimated_days",
    "freight_ratio",
]


def null_share_before_after(flagged: DataFrame) -> DataFrame:
    """Null percentages of all rows and of the kept ones, in one scan of ``clean.flagged_master``."""
    filled = {"delivery_days": "clean_days", "review_score": "clean_review"}
    rows, kept = F.count(F.lit(1)), F.count_if(F.col("kept"))
    both = [
        F.struct(
            F.lit(c).alias("column"),
            F.try_divide(F.count_if(F.col(c).isNull()) * 100, rows).alias("before"),
            F.try_divide(F.count_if(F.col("kept") & F.col(filled.get(c, c)).isNull()) * 100, kept).alias("after"),
        )
        for c in NULL_CHECK_COLUMNS
    ]
    return flagged.agg(F.array(*both).alias("shares")).select(F.inline("shares"))


def profile_by_month(master: DataFrame) -> DataFrame:
    """Mergeable state of the column profile: order_ym, column, rows, null_count and a sketch of the distinct values.

    One pass without a shuffle of values. Months are added to a stored state as
    they come; ``merged_profile`` reads any set of them.
    """
    measured = master.groupBy(F.col("order_ym").alias("month")).agg(*_sketches(master))
    return measured.select(F.col("month").alias("order_ym"), F.inline(_rows_of(master)))


def _sketches(master: DataFrame) -> list[Column]:
    found = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(master.columns):
        found.append(F.count(c).alias(f"known_{i}"))
        found.append(F.hll_sketch_agg(F.when(F.col(c).isNotNull(), F.xxhash64(c)), F.lit(14)).alias(f"sketch_{i}"))
    return found


def _rows_of(master: DataFrame) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(c).alias("column"), F.col("rows"), (F.col("rows") - F.col(f"known_{i}")).alias("null_count"),
                F.col(f"sketch_{i}").alias("sketch"),
            )
            for i, c in enumerate(master.columns)
        )
    )


def merged_profile(state: DataFrame) -> DataFrame:
    """Rows, nulls and the estimated number of distinct values (off by about 1 %) of the months in ``state``."""
    return state.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.sum("null_count").alias("null_count"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique"),
    )

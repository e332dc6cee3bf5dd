"""Column-level helpers shared by the operators; all stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Elapsed whole days, rounded down (12 hours before is -1)."""
    micros = F.unix_micros(later) - F.unix_micros(earlier)
    return F.floor(micros / F.lit(MICROS_PER_DAY))


def category_label(english: Column | str, name: Column | str) -> Column:
    """The translated name, else the source name with spaces and capitals.

    Capitals follow spaces only; a letter after a digit or hyphen stays small.
    """
    english = F.col(english) if isinstance(english, str) else english
    return F.coalesce(english, F.initcap(F.replace(name, F.lit("_"), F.lit(" "))))


def safe_ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient where the denominator is positive, NULL elsewhere."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.when(den > 0, num / den)


def right_closed_label(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edges[i], edges[i+1]]`` holding the value; NULL outside."""
    value = F.col(value) if isinstance(value, str) else value
    label = F.when(value <= F.lit(edges[0]), F.lit(None).cast("string"))
    for edge, name in zip(edges[1:], labels):
        label = label.when(value <= F.lit(edge), F.lit(name))
    return label


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based histogram bin; the highest value belongs to the last bin."""
    return F.when(low == high, F.lit(1).cast("bigint")).otherwise(
        F.least(F.width_bucket(value, low, high, F.lit(bins)), F.lit(bins).cast("bigint"))
    )


def share(condition: Column) -> Column:
    """Fraction of rows where the condition holds (aggregate)."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("double"))


def score_key(score: Column) -> Column:
    """Score on a 1e-10 grid, so that summation order cannot flip a ranking."""
    return F.floor(score * F.lit(1e10) + F.lit(0.5))


def with_known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where all columns are present, as plain IS NOT NULL tests that reach the Parquet scan."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df

"""Statistics that Spark has no aggregate for."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from noisetrack.session import materialised

ONE_TASK = 500_000


def pearson(x: str, y: str) -> Column:
    """Aggregate; null for a constant column or fewer than two rows."""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    a, b = F.when(both, F.col(x)), F.when(both, F.col(y))
    return F.when((F.stddev_pop(a) > 0) & (F.stddev_pop(b) > 0), F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)))


def places(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Distinct values of a column in groups with their counts ``_n`` and the number ``_before`` of lesser ones in the group.

    Equal values cost one row.  Above ``ONE_TASK`` distinct values a group is not sorted in one task: values are dealt to
    ranges, summed range by range, and the sums of the ranges before are added."""
    counts = materialised(df.where(F.col(column).isNotNull()).groupBy(*by, column).agg(F.count("*").alias("_n")), "values")
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    if counts.count() <= ONE_TASK:
        return counts.withColumn("_before", before(Window.partitionBy(*by).orderBy(column)))
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialised(counts.repartitionByRange(parts, *by, column).withColumn("_range", F.spark_partition_id()), "ranges")
    starts = ranged.groupBy(*by, "_range").agg(F.sum("_n").alias("_n"))  # a row a group and range
    starts = starts.select(*by, "_range", before(Window.partitionBy(*by).orderBy("_range")).alias("_start"))
    own = ranged.withColumn("_own", before(Window.partitionBy(*by, "_range").orderBy(column)))
    return own.join(starts, [*by, "_range"]).select(*by, column, "_n", (F.col("_own") + F.col("_start")).alias("_before"))


def average_rank(df: DataFrame, column: str, by: list[str], out: str) -> DataFrame:
    """Ranks from 1 in groups, ties sharing their mean rank; null where the value or a group column is null."""
    ranks = places(df, column, by).select(*by, column, (F.col("_before") + (F.col("_n") + 1) / 2).alias(out))
    return df.join(ranks, [*by, column], "left")


def quantiles(df: DataFrame, column: str, by: list[str], at: dict[str, float], interpolate: bool = True) -> DataFrame:
    """Exact quantiles of groups (name -> 0..1), on the line between the two values around, or else the upper value at
    ``floor(q * n)``.  Values are counted, not buffered."""
    found = places(df, column, by)
    size = found.groupBy(*by).agg(F.sum("_n").alias("_rows"))
    found = found.join(size, by) if by else found.join(F.broadcast(size))  # one row
    row = lambda q: q * (F.col("_rows") - 1) if interpolate else F.least(F.floor(q * F.col("_rows")), F.col("_rows") - 1)
    value = lambda k: F.max(F.when(F.col("_before") <= k, F.col(column)))

    def one(q: float) -> Column:
        low = value(F.floor(row(q)))
        return low + F.max(row(q) - F.floor(row(q))) * (value(F.ceil(row(q))) - low) if interpolate else low

    return found.groupBy(*by).agg(*[one(q).alias(name) for name, q in at.items()])


def quantile_sketch(column: str, k: int = 800) -> Column:
    """Aggregate: a mergeable (KLL) sketch of a numeric column's distribution, some kilobytes however many rows there are."""
    return F.kll_sketch_agg_double(F.col(column).cast("double"), k)


#: Ranks told by a sketch with k = 800 are off by no more than this share of the rows (at 99 % confidence 0.33 %, doubled).
SKETCH_RANK_ERROR = 0.0066


def merged_quantiles(sketches: DataFrame, column: str, by: list[str], at: dict[str, float]) -> DataFrame:
    """Quantiles of groups from sketches of their parts: n and name -> 0..1, each a value of the column whose rank is off by
    ``SKETCH_RANK_ERROR`` of the rows at most."""
    one = sketches.groupBy(*by).agg(F.kll_merge_agg_double(column).alias("_s"))
    return one.select(*by, F.kll_sketch_get_n_double("_s").alias("n"), *[F.kll_sketch_get_quantile_double("_s", F.lit(q)).alias(name) for name, q in at.items()])


def spearman(df: DataFrame, x: str, y: str, by: list[str], least: int = 3) -> DataFrame:
    """n and rho of each group (``by`` may be a constant column) with at least ``least`` pairs."""
    # Read four times below: computed once.
    pairs = materialised(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).alias("_x"), F.col(y).alias("_y")), "ranked")
    ranked = average_rank(average_rank(pairs, "_x", by, "_rx"), "_y", by, "_ry")
    return ranked.groupBy(*by).agg(F.count("*").alias("n"), pearson("_rx", "_ry").alias("rho")).where(F.col("n") >= least)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (Lentz)."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d or 1e-300)
    h = d
    for m in range(1, 300):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + step * d) or 1e-300)
            c = (1 + step / c) or 1e-300
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return h


def beta_inc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


@F.pandas_udf(DoubleType())
def correlation_pvalue(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of a correlation of ``n`` pairs (Student's t with n - 2 degrees of freedom); for one row a group."""

    def one(r: float, n: float) -> float | None:
        if r is None or pd.isna(r) or n < 3:
            return None
        return beta_inc((n - 2) / 2, 0.5, max(0.0, 1 - r * r))

    return pd.Series([one(a, b) for a, b in zip(r, n, strict=True)], dtype="float64")

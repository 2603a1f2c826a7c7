"""Statistics of two sets of counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Upper borders of the bands of absolute relative difference, in per cent.
BANDS = (0, 5, 10, 25, 50, 100)


def relative_difference(value: Column, reference: Column) -> Column:
    """Per cent of the reference; null for a reference of zero."""
    return (value - reference) * 100.0 / F.nullif(reference, F.lit(0))


def band(difference: Column, borders: tuple[int, ...] = BANDS) -> Column:
    """The band of |difference|: ``equal``, ``<=5``, …, ``>100``, ``undefined`` for null."""
    size, out = F.abs(difference), F.when(difference.isNull(), "undefined").when(difference == 0, "equal")
    for x in borders[1:]:
        out = out.when(size <= x, f"<={x}")
    return out.otherwise(f">{borders[-1]}")


def summary(df: DataFrame, value: str, reference: str, *by: str) -> DataFrame:
    """Rows, mean absolute error, mean absolute percentage error, Pearson's r and r squared."""
    v, r = F.col(value).cast("double"), F.col(reference).cast("double")
    out = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(v - r)).alias("mae"),
        F.avg(F.abs(relative_difference(v, r))).alias("mape"),
        F.corr(v, r).alias("pearson_r"),
    )
    return out.withColumn("r_squared", F.col("pearson_r") * F.col("pearson_r"))

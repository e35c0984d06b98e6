"""Rolling, cumulative and carried values. Row order is always an argument.

Windows here run on data that has already been aggregated (weeks of a facility, weeks of a
season, cells of a grid), so a partition is bounded by the calendar and not by the rows.
``fill_down`` is the exception: it works on rows, in blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec


def _when_full(aggregate: Column, w: WindowSpec, n: int) -> Column:
    return F.when(F.row_number().over(w) >= n, aggregate.over(w.rowsBetween(1 - n, 0)))


def rolling_mean(value: str, w: WindowSpec, n: int = 4) -> Column:
    """Mean of this row and the n-1 before it; null until there are n rows."""
    return _when_full(F.avg(value), w, n)


def rolling_sd(value: str, w: WindowSpec, n: int = 4) -> Column:
    return _when_full(F.stddev_samp(value), w, n)


def cumulative_count(df: DataFrame, value: str, keys: Sequence[str], order: Sequence, name: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))


def row_index(df: DataFrame, order: Sequence, name: str = "rownum") -> DataFrame:
    """Sequence number over the whole, already aggregated, output."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def fill_down(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], row_no: str, block: int = 100_000
) -> DataFrame:
    """Carry the last known value down, per key in row order.

    Rows are cut into blocks of row numbers. The last value known in each block is found
    with an aggregate and carried over the blocks; each block then starts with an extra
    row that holds what was carried in. A key with a third of all rows is thus spread over
    its blocks, and the rows themselves are shuffled once.
    """
    rows = df.withColumns({"__block": F.floor(F.col(row_no) / block), "__real": F.lit(1)})
    in_block = [*keys, "__block"]
    lasts = rows.groupBy(*in_block).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(row_no))).alias(c) for c in cols]
    )
    earlier = Window.partitionBy(*keys).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    carried_in = lasts.select(
        *in_block, F.lit(0).alias("__real"), *[F.last(c, ignorenulls=True).over(earlier).alias(c) for c in cols]
    )
    inside = (
        Window.partitionBy(*in_block).orderBy("__real", row_no).rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = rows.unionByName(carried_in, allowMissingColumns=True).withColumns(
        {c: F.last(c, ignorenulls=True).over(inside) for c in cols}
    )
    return filled.filter("__real = 1").drop("__block", "__real")

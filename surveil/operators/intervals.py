"""Rows and the periods of a table that contain their day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.operators.joins import skew_join

LEVEL, BIN = "__level", "__bin"
MAX_LEVEL = 25  # a width of 2^25 days is longer than any two dates are apart


def _level(days: Column) -> Column:
    """The least level whose bins, of 2^level days, are as long as a period of so many days."""
    return F.least(F.greatest(F.ceil(F.log2(days.cast("double"))), F.lit(0)), F.lit(MAX_LEVEL)).cast("int")


def _bin(day: Column, level: Column) -> Column:
    return F.call_function("shiftright", F.unix_date(day), level)


def spread(df: DataFrame) -> DataFrame:
    """A table of few bytes whose rows meet many others, in as many tasks as a shuffle has.

    Left to their size, one file or one merged partition of it would meet everything in one task.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def period_join(
    df: DataFrame, periods: DataFrame, day: str, start: str = "start", end: str = "end", by: Sequence[str] = (), how: str = "inner"
) -> DataFrame:
    """Each row of ``df`` with every period that contains its day, both ends included.

    ``by`` names columns that must agree, such as the region (null agrees with null). Other columns that both sides
    have are an error. ``how`` is inner, left_semi or left_anti. A period without a start or an end, or that
    ends before it starts, contains nothing.

    Periods may be many, overlap and differ in length. Each is put into bins that are as long as itself,
    two at most, and a row into one bin for each length that occurs; rows and periods then meet by region, level
    and bin through ``skew_join``, so a region with a third of all rows is spread over its bins and a full bin is
    split. A row meets only periods that are near its day and about as long as their bin, never all of its region.
    """
    clash = (set(df.columns) & set(periods.columns)) - set(by)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}")
    periods = periods.filter(F.col(start) <= F.col(end)).withColumn(LEVEL, _level(F.datediff(end, start) + 1))
    levels = [r[0] for r in periods.select(LEVEL).distinct().orderBy(LEVEL).collect()]  # at most 26 numbers
    ends = F.array_distinct(F.array(_bin(F.col(start), F.col(LEVEL)), _bin(F.col(end), F.col(LEVEL))))
    binned = spread(periods).withColumn(BIN, F.explode(ends))
    if not levels:
        levels = [0]
    keys = [*by, LEVEL, BIN]
    if how != "inner":
        return _existing(df, binned, day, start, end, keys, levels, how)
    rows = df.withColumn(LEVEL, F.explode(F.array(*map(F.lit, levels)))).withColumn(BIN, _bin(F.col(day), F.col(LEVEL)))
    met = skew_join(rows.filter(F.col(day).isNotNull()), binned, keys)
    return met.filter(F.col(day).between(F.col(start), F.col(end))).drop(LEVEL, BIN)


def _existing(df: DataFrame, binned: DataFrame, day: str, start: str, end: str, keys: list[str], levels: list[int], how: str) -> DataFrame:
    """Rows whose day some period contains, or none does: the distinct days of each region are matched and joined back."""
    by = keys[:-2]
    days = spread(df.select(*by, day).filter(F.col(day).isNotNull()).distinct())
    days = days.withColumn(LEVEL, F.explode(F.array(*map(F.lit, levels)))).withColumn(BIN, _bin(F.col(day), F.col(LEVEL)))
    met = skew_join(days, binned.select(*keys, start, end), keys).filter(F.col(day).between(F.col(start), F.col(end)))
    return skew_join(df, met.select(*by, day).distinct(), [*by, day], how)


def overlapping_days(periods: DataFrame, start: str = "start", end: str = "end", by: Sequence[str] = ()) -> DataFrame:
    """Per ``by`` and day at which the number changes, how many periods run from that day on.

    Starts and the days after ends are counted per day first, so the running sum sees one row per day and region.
    """
    periods = periods.filter(F.col(start) <= F.col(end))
    begins = periods.select(*by, F.col(start).alias("day"), F.lit(1).alias("change"))
    stops = periods.select(*by, F.date_add(end, 1).alias("day"), F.lit(-1).alias("change"))
    per_day = begins.unionByName(stops).groupBy(*by, "day").agg(F.sum("change").alias("change")).filter("change != 0")
    upto = Window.partitionBy(*by).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select(*by, "day", F.sum("change").over(upto).alias("n_running"))

"""Counts, lag statistics, first rows and distinct rows. All combine on the map side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType
from pyspark.sql.window import Window

from surveil.functions.nulls import propagate_nulls
from surveil.functions.periods import month_year_label
from surveil.functions.text import matches
from surveil.operators.joins import attach_scalar_of
from surveil.operators.windows import row_index


def rows() -> Column:
    """Number of rows, nulls included."""
    return F.count(F.lit(1))


def count_rows(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(rows().alias(name))


def sum_indicators(df: DataFrame, keys: Sequence[str], **flags: Column) -> DataFrame:
    """Sum of 0/1 indicators per key."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in flags.items()])


def typing_summary(
    typed: DataFrame, coinfections: DataFrame | None = None, as_written: bool = False
) -> DataFrame:
    """Rows per type and subtype.

    As written every co-infection row shows the length of the co-infection list instead
    of its own count.
    """
    out = typed.groupBy("flu_type", "subtype").agg(rows().alias("n"))
    if as_written and coinfections is not None:
        size = coinfections.agg(rows()).scalar()
        out = out.withColumn("n", F.when(F.col("flu_type") == "Coinfection", size).otherwise(F.col("n")))
    return out


def _mode(aggregate: Column, c: str, null_mode: str) -> Column:
    if null_mode not in ("skip", "propagate"):
        raise ValueError(f"null_mode must be 'skip' or 'propagate', not {null_mode!r}")
    return propagate_nulls(aggregate, c) if null_mode == "propagate" else aggregate


def latest(c: str, null_mode: str = "skip") -> Column:
    return _mode(F.max(c), c, null_mode)


def latest_by(df: DataFrame, keys: Sequence[str], day: str, null_mode: str = "skip") -> DataFrame:
    return df.groupBy(*keys).agg(latest(day, null_mode).alias(f"latest_{day}"))


def days_since_last(df: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Per key, days from its latest date to the latest date of the whole table."""
    last = latest_by(df, keys, day)
    # The overall latest date is the latest of the per-key dates: the data is read once.
    return attach_scalar_of(last, last, latest_overall=F.max(f"latest_{day}")).withColumn(
        "days_since_last", F.datediff("latest_overall", f"latest_{day}")
    )


def lag_stats(df: DataFrame, keys: Sequence[str], lag: str, null_mode: str | Sequence[str] = "skip") -> DataFrame:
    """Mean and sample SD of the lag; the SD of a single row is null.

    Several null modes come from one aggregate; then the names end in the mode.
    """
    modes = {"": null_mode} if isinstance(null_mode, str) else {f"_{m}": m for m in null_mode}
    return df.groupBy(*keys).agg(
        *[_mode(f(lag), lag, m).alias(f"{n}{end}") for end, m in modes.items() for n, f in (("average_lag", F.avg), ("sd_lag", F.stddev_samp))]
    )


def overall_lag(df: DataFrame, lag: str) -> DataFrame:
    """Mean and median of the whole sample, missing lags left out.

    The lag is a whole number of days, so the few distinct values are counted first and
    the exact median is read from the counts: no task ever holds the sample. A column of
    another kind could have as many values as rows and is refused.
    """
    if not isinstance(df.schema[lag].dataType, IntegralType):
        raise TypeError(f"{lag!r} must be a whole number of days")
    counts = df.filter(F.col(lag).isNotNull()).groupBy(lag).agg(rows().alias("n"))
    upto = Window.orderBy(lag).rowsBetween(Window.unboundedPreceding, 0)
    ranked = attach_scalar_of(counts, counts, total=F.sum("n")).withColumn("upto", F.sum("n").over(upto))
    # Positions of the middle one or two values, counted from 1.
    lower, upper = F.floor((F.col("total") + 1) / 2), F.ceil((F.col("total") + 1) / 2)

    def value_at(position: Column) -> Column:
        return F.min(F.when(F.col("upto") >= position, F.col(lag)))

    return ranked.agg(
        (F.sum(F.col(lag) * F.col("n")) / F.sum("n")).alias("mean_lag"),
        ((value_at(lower) + value_at(upper)) / 2).alias("median_lag"),
    )


def month_counts(df: DataFrame, day: str) -> DataFrame:
    """Rows per calendar month, in order, with a running row number and a label."""
    months = df.groupBy(F.trunc(day, "MM").alias("__month")).agg(rows().alias("n"))
    return row_index(months, ["__month"]).select(
        F.year("__month").alias("year"),
        F.month("__month").alias("month"),
        "n",
        "rownum",
        month_year_label("__month").alias("month_year"),
    )


def incorrect_counts(df: DataFrame, reason: str, keys: Sequence[str]) -> DataFrame:
    """Rows whose rejection reason contains "Incorrect"."""
    return df.filter(matches(reason, "Incorrect", ci=True)).groupBy(*keys).agg(rows().alias("n_incorrect"))


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return (df.select(*cols) if cols else df).distinct()


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One whole row per key, the first in the stated order.

    Catalyst turns the rank filter into a group limit before the shuffle, so each map task
    sends one row per key, however many it has.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(first)).filter("__rn = 1").drop("__rn")

"""Lab feed monitoring per facility: lag, weekly volume, silence and their flags.

The feeds are reduced in one pass to one row per facility, week and final name
(``weekly_rows``). Every statistic follows from those rows, because the lag is a whole number
of days and its sums are exact; so nothing is joined back to the lab rows and the feeds are
read once. Callers write the rows before they use them twice. All windows run on numbers per
facility and week, so a facility has one row per week however many names or senders it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from surveil.functions.nulls import first_known
from surveil.functions.periods import lag_days, mmwr_day, mmwr_week, mmwr_year, week_ending
from surveil.functions.rules import any_flag, lag_flag, silence_flag, volume_flag
from surveil.operators.aggregates import first_per_key, rows
from surveil.operators.joins import attach_scalar_of, skew_join
from surveil.operators.windows import rolling_mean, rolling_sd

FACILITY = ["facility_clean", "reporting_clean", "disease"]
WEEK = [*FACILITY, "week_ending"]
TIE_BREAK = ("test", "sending_facility", "observation_type")
FLAGS = ("volume_flag_1sd", "volume_flag_2sd", "submission_time_flag", "abnormal_lag")


def clean_rows(feeds: DataFrame) -> DataFrame:
    """Week, facility names and lag of every lab row. A projection, no shuffle."""
    return feeds.withColumns(
        {
            "mmwr_year": mmwr_year("sending_date"),
            "mmwr_week": mmwr_week("sending_date"),
            "mmwr_day": mmwr_day("sending_date"),
            "week_ending": week_ending("sending_date"),
            "facility_clean": first_known("facility", "facility_other"),
            "reporting_clean": first_known("reporting_facility", "reporting_facility_other"),
            "lag_days": lag_days("sending_date", "specimen_date"),
        }
    )


def lab_rows(feeds: DataFrame) -> DataFrame:
    """The cleaned lab rows as saved: facility name filled from the other facility columns."""
    return (
        clean_rows(feeds)
        .withColumn("facility_clean", first_known("facility_clean", "reporting_clean", "sending_facility"))
        .drop("event_date")
    )


def weekly_rows(feeds: DataFrame) -> DataFrame:
    """Counts, lag sums and the first attribute row per facility, week and final facility name.

    That name differs from the facility only where the facility is unknown and the reporter or
    the sender stands in.
    """
    lag = F.col("lag_days")
    name = first_known("facility_clean", "reporting_clean", "sending_facility").alias("facility_name")
    return (
        clean_rows(feeds)
        .groupBy(*WEEK, name)
        .agg(
            rows().alias("n"),
            F.count(lag).alias("n_lag"),
            F.sum(lag).alias("sum_lag"),
            F.sum(lag.cast("bigint") * lag).alias("sq_lag"),
            F.max(lag).alias("max_lag"),
            F.max("sending_date").alias("max_date"),
            F.count("sending_date").alias("n_date"),
            F.min(F.struct(*TIE_BREAK)).alias("first"),
        )
    )


def _unnamed() -> Column:
    """Neither facility nor reporter is known, so a week has as many final names as senders; all others have one."""
    return F.col("facility_clean").isNull() & F.col("reporting_clean").isNull()


def _per_week(names: DataFrame) -> DataFrame:
    """Sums of the partial sums per facility and week; a week with one final name has its sums already."""
    counts = ("n", "n_lag", "sum_lag", "n_date")
    squares, latest = F.col("sq_lag").cast("decimal(24,0)"), ("max_lag", "max_date")
    single = names.filter(~_unnamed()).select(*WEEK, *counts, squares.alias("sq_lag"), *latest)
    several = names.filter(_unnamed()).groupBy(*WEEK).agg(
        *[F.sum(c).alias(c) for c in counts], F.sum(squares).cast("decimal(24,0)").alias("sq_lag"), *[F.max(c).alias(c) for c in latest]
    )
    return single.unionByName(several)


def _facility_stats(by_week: WindowSpec, null_mode: str) -> dict[str, Column]:
    """Facility statistics from the exact integer sums of its weeks.

    The frame is the whole facility; it keeps the order of the rolling windows so that all
    of them share one sort.
    """
    w = by_week.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def over(agg: Column) -> Column:
        return agg.over(w)

    n, s = over(F.sum("n_lag")), over(F.sum("sum_lag"))
    squares = over(F.sum("sq_lag"))
    # n * sum(x^2) - (sum x)^2 in decimals, so nothing cancels however large the sums are.
    total = s.cast("decimal(18,0)")
    spread = n.cast("decimal(13,0)") * squares.cast("decimal(24,0)") - total * total
    variance = F.when(n > 1, spread.cast("double") / (n.cast("double") * (n - 1).cast("double")))
    stats = {
        "latest_facility_date": over(F.max("max_date")),
        "average_lag": F.try_divide(s.cast("double"), n.cast("double")),
        "sd_lag": F.sqrt(variance),
        "max_lag": over(F.max("max_lag")),
    }
    if null_mode == "propagate":
        all_lags = n == over(F.sum("n"))
        all_dates = over(F.sum("n_date")) == over(F.sum("n"))
        for name, c in stats.items():
            stats[name] = F.when(all_dates if name == "latest_facility_date" else all_lags, c)
    return stats


def weekly_statistics(
    names: DataFrame, order: str = "desc", include_year: bool = True, null_mode: str = "skip", weeks: int = 4
) -> DataFrame:
    """Statistics and flags from ``weekly_rows``: one row per facility, reporter, disease and week.

    ``order='desc'`` rolls over this week and the newer ones, as the report does; 'asc'
    gives a trailing mean. ``include_year=False`` adds up the same week of all years.
    """
    newest_first = order == "desc"
    by_week = Window.partitionBy(*FACILITY).orderBy(F.desc("week_ending") if newest_first else F.asc("week_ending"))
    # The Saturday of a week lies in the week's own epidemiological year.
    dated = _per_week(names).withColumns({"mmwr_year": mmwr_year("week_ending"), "mmwr_week": mmwr_week("week_ending")})
    volume = F.col("n") if include_year else F.sum("n").over(Window.partitionBy(*FACILITY, "mmwr_week"))
    stats = dated.withColumn("labs_by_week", volume).withColumns(
        {
            "rolling_mean": rolling_mean("labs_by_week", by_week, weeks),
            "rolling_sd": rolling_sd("labs_by_week", by_week, weeks),
            **_facility_stats(by_week, null_mode),
        }
    )
    newest = F.max("max_date")
    if null_mode == "propagate":
        newest = F.when(F.sum("n_date") == F.sum("n"), newest)
    sample = attach_scalar_of(
        stats, names, latest_sample_date=newest, mean_sample_lag=F.try_divide(F.sum("sum_lag").cast("double"), F.sum("n_lag").cast("double")),
    ).withColumn("days_since_last", F.datediff("latest_sample_date", "latest_facility_date"))
    return sample.select(
        *WEEK, "mmwr_year", "mmwr_week", "latest_facility_date", "days_since_last", "average_lag",
        "max_lag", "sd_lag", "labs_by_week", "rolling_mean", "rolling_sd",
        volume_flag("labs_by_week", "rolling_mean", "rolling_sd", 1).alias(FLAGS[0]),
        volume_flag("labs_by_week", "rolling_mean", "rolling_sd", 2).alias(FLAGS[1]),
        silence_flag("days_since_last").alias(FLAGS[2]),
        lag_flag("max_lag", "mean_sample_lag").alias(FLAGS[3]),
    )


def _report_rows(shown: DataFrame, weekly: DataFrame) -> DataFrame:
    """The statistics under each final facility name of the week, with its first row."""
    return skew_join(shown, weekly, WEEK).drop("facility_clean").withColumnRenamed("facility_name", "facility_clean")


def _shown(names: DataFrame) -> DataFrame:
    return names.select(*WEEK, "facility_name", "first.*")


def facility_aggregate(names: DataFrame, weekly: DataFrame) -> DataFrame:
    """One row per facility, reporter, disease and week, from ``weekly_rows`` and ``weekly_statistics``.

    The test and other attributes are those of the week's first row in the order of
    ``TIE_BREAK``. A name that stands in for an unknown facility may meet a real facility
    of that name; then, too, the first row is kept. It is found on names alone, before the statistics join them.
    """
    keys = ["facility_name", *WEEK[1:]]
    first = first_per_key(_shown(names), keys, TIE_BREAK)
    return _report_rows(first, weekly).drop("abnormal_lag")


def flagged_facilities(names: DataFrame, weekly: DataFrame) -> DataFrame:
    """Facilities with a flag: their newest flagged row, once per facility and reporter.

    Where the facility or the reporter is known, all weeks have one final name, so their newest one is found by numbers and
    only it meets its names. Without both, senders stand in, and each may have another newest week.
    """
    flagged = weekly.filter(any_flag(*FLAGS))
    newest = [F.desc("week_ending"), F.asc("disease")]
    one_name = first_per_key(flagged.filter(~_unnamed()), FACILITY[:2], newest)
    met = _report_rows(_shown(names), one_name.unionByName(flagged.filter(_unnamed())))
    return first_per_key(met, FACILITY[:2], [*newest, *TIE_BREAK]).drop("latest_facility_date", "average_lag", "sd_lag")


def sorted_for_report(df: DataFrame) -> DataFrame:
    return df.orderBy("facility_clean", "reporting_clean", F.desc("mmwr_year"), F.desc("mmwr_week"))

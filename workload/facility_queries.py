"""Epidemiological weeks and lab feed monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.functions import nulls, periods, rules
from surveil.operators import aggregates, joins, setops, windows
from surveil.plans import facilities
from workload import bindings as b
from workload.registry import query

VOLUME_CASE = """CASE WHEN {n} > m + {k} * s OR {n} < m - {k} * s THEN 'Flag' ELSE 'Normal' END"""


@query(
    "mmwr_weeks",
    f"""WITH d AS (SELECT CAST(l_shipdate AS DATE) AS day FROM lineitem)
    SELECT day, {b.sql_mmwr_year('day')} AS mmwr_year, {b.sql_mmwr_week('day')} AS mmwr_week,
           CAST(dayofweek(day) + 1 AS INTEGER) AS mmwr_day, {b.sql_week_ending('day')} AS week_ending,
           day AS round_trip, count(*) AS n
    FROM d GROUP BY day""",
)
def mmwr_weeks(spark, sf_dir):
    days = b.table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("day"))
    weeks = aggregates.count_rows(days, ["day"]).withColumns(
        {
            "mmwr_year": periods.mmwr_year("day"),
            "mmwr_week": periods.mmwr_week("day"),
            "mmwr_day": periods.mmwr_day("day"),
            "week_ending": periods.week_ending("day"),
        }
    )
    return weeks.withColumn("round_trip", periods.mmwr_to_date("mmwr_year", "mmwr_week", "mmwr_day"))


@query(
    "lab_rolling_flags",
    f"""WITH w AS (
      SELECT l_suppkey, l_linestatus, {b.sql_week_ending('CAST(l_shipdate AS DATE)')} AS week_ending, count(*) AS n
      FROM lineitem GROUP BY ALL),
    r AS (
      SELECT *, row_number() OVER o AS rn,
             avg(n) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS m4,
             stddev_samp(n) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS s4
      FROM w WINDOW o AS (PARTITION BY l_suppkey, l_linestatus ORDER BY week_ending DESC)),
    g AS (SELECT *, CASE WHEN rn >= 4 THEN m4 END AS m, CASE WHEN rn >= 4 THEN s4 END AS s FROM r)
    SELECT l_suppkey AS facility, l_linestatus AS disease,
           {b.sql_mmwr_year('week_ending')} AS mmwr_year, {b.sql_mmwr_week('week_ending')} AS mmwr_week,
           n, round(m, 6) AS rolling_mean, round(s, 6) AS rolling_sd,
           {VOLUME_CASE.format(n='n', k=1)} AS flag_1sd, {VOLUME_CASE.format(n='n', k=2)} AS flag_2sd
    FROM g""",
)
def lab_rolling_flags(spark, sf_dir):
    """Weekly volume per facility and disease with a four-week rolling mean, SD and flags."""
    labs = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("facility"),
        F.col("l_linestatus").alias("disease"),
        periods.week_ending(F.to_date("l_shipdate")).alias("week_ending"),
    )
    weekly = aggregates.count_rows(labs, ["facility", "disease", "week_ending"])
    newest_first = Window.partitionBy("facility", "disease").orderBy(F.desc("week_ending"))
    rolled = weekly.withColumns(
        {
            "rolling_mean": windows.rolling_mean("n", newest_first),
            "rolling_sd": windows.rolling_sd("n", newest_first),
        }
    )
    return rolled.select(
        "facility",
        "disease",
        periods.mmwr_year("week_ending").alias("mmwr_year"),
        periods.mmwr_week("week_ending").alias("mmwr_week"),
        "n",
        F.round("rolling_mean", 6).alias("rolling_mean"),
        F.round("rolling_sd", 6).alias("rolling_sd"),
        rules.volume_flag("n", "rolling_mean", "rolling_sd", 1).alias("flag_1sd"),
        rules.volume_flag("n", "rolling_mean", "rolling_sd", 2).alias("flag_2sd"),
    )


@query(
    "union_feeds",
    f"""WITH {b.SQL_FEEDS}
    SELECT feed, disease, test, count(*) AS n, min(sending_date) AS first_day, max(sending_date) AS last_day
    FROM feeds GROUP BY feed, disease, test""",
)
def union_feeds(spark, sf_dir):
    stacked = setops.union_sources(b.feeds(spark, sf_dir))
    return stacked.groupBy("feed", "disease", "test").agg(
        aggregates.rows().alias("n"),
        F.min("sending_date").alias("first_day"),
        F.max("sending_date").alias("last_day"),
    )


@query(
    "lab_rows",
    f"""WITH {b.SQL_FEEDS}, {b.SQL_CLEAN}
    SELECT sending_date, specimen_date, facility, facility_other, reporting_facility, reporting_facility_other,
           sending_facility, disease, test, observation_type, mmwr_year, mmwr_week, mmwr_day, week_ending,
           coalesce(facility_clean, reporting_clean, sending_facility) AS facility_clean, reporting_clean, lag_days
    FROM clean""",
)
def lab_rows(spark, sf_dir):
    return facilities.lab_rows(b.all_feeds(spark, sf_dir))


STATS_SQL = f"""WITH {b.SQL_FEEDS}, {b.SQL_CLEAN}"""


@query(
    "facility_lag_stats",
    STATS_SQL
    + """ SELECT facility_clean, reporting_clean, disease, round(avg(lag_days), 6) AS average_lag,
           round(stddev_samp(lag_days), 6) AS sd_lag,
           round(CASE WHEN count(lag_days) = count(*) THEN avg(lag_days) END, 6) AS average_lag_strict
    FROM clean GROUP BY facility_clean, reporting_clean, disease""",
)
def facility_lag_stats(spark, sf_dir):
    clean = facilities.clean_rows(b.all_feeds(spark, sf_dir))
    stats = aggregates.lag_stats(clean, facilities.FACILITY, "lag_days", ["skip", "propagate"])
    return stats.select(
        *facilities.FACILITY, F.round("average_lag_skip", 6).alias("average_lag"), F.round("sd_lag_skip", 6).alias("sd_lag"),
        F.round("average_lag_propagate", 6).alias("average_lag_strict"),
    )


@query(
    "overall_lag",
    STATS_SQL
    + " SELECT round(avg(lag_days), 6) AS mean_lag, round(median(lag_days), 6) AS median_lag FROM clean",
)
def overall_lag(spark, sf_dir):
    lag = aggregates.overall_lag(facilities.clean_rows(b.all_feeds(spark, sf_dir)), "lag_days")
    return lag.select(F.round("mean_lag", 6).alias("mean_lag"), F.round("median_lag", 6).alias("median_lag"))


@query(
    "facility_silence",
    STATS_SQL
    + """, last AS (SELECT facility_clean, reporting_clean, disease, max(sending_date) AS latest_sending_date
                    FROM clean GROUP BY facility_clean, reporting_clean, disease)
    SELECT *, (SELECT max(sending_date) FROM clean) AS latest_overall,
           CAST((SELECT max(sending_date) FROM clean) - latest_sending_date AS INTEGER) AS days_since_last,
           CASE WHEN (SELECT max(sending_date) FROM clean) - latest_sending_date > 7 THEN 'Flag' ELSE 'Normal' END
             AS submission_time_flag
    FROM last""",
)
def facility_silence(spark, sf_dir):
    clean = facilities.clean_rows(b.all_feeds(spark, sf_dir))
    return aggregates.days_since_last(clean, facilities.FACILITY, "sending_date").withColumn(
        "submission_time_flag", rules.silence_flag("days_since_last")
    )


@query(
    "facility_max_lag",
    STATS_SQL
    + """, f AS (SELECT facility_clean, reporting_clean, disease, max(lag_days) AS max_lag, count(*) AS n
                 FROM clean GROUP BY facility_clean, reporting_clean, disease)
    SELECT *, CASE WHEN max_lag > 2 * (SELECT avg(lag_days) FROM clean) THEN 'Flag' ELSE 'Normal' END AS abnormal_lag
    FROM f""",
)
def facility_max_lag(spark, sf_dir):
    clean = facilities.clean_rows(b.all_feeds(spark, sf_dir))
    per_facility = clean.groupBy(*facilities.FACILITY).agg(
        F.max("lag_days").alias("max_lag"),
        aggregates.rows().alias("n"),
        F.sum("lag_days").alias("s"),
        F.count("lag_days").alias("k"),
    )
    sample = joins.attach_scalar(per_facility, mean_lag=F.sum("s") / F.sum("k"))
    return sample.withColumn("abnormal_lag", rules.lag_flag("max_lag", "mean_lag")).drop("s", "k", "mean_lag")


@query(
    "attach_group_stat",
    f"""WITH {b.SQL_FEEDS}, {b.SQL_CLEAN}
    SELECT facility_clean, sending_date, lag_days,
           count(*) OVER w AS n_facility, max(lag_days) OVER w AS max_lag
    FROM clean WINDOW w AS (PARTITION BY facility_clean, reporting_clean, disease)""",
)
def attach_group_stat(spark, sf_dir):
    """Facility statistics on every lab row; a facility without a name is one group."""
    clean = facilities.clean_rows(b.all_feeds(spark, sf_dir))
    out = joins.attach_group_stat(
        clean.select(*facilities.FACILITY, "sending_date", "lag_days"),
        facilities.FACILITY,
        aggregates.rows().alias("n_facility"),
        F.max("lag_days").alias("max_lag"),
    )
    return out.select("facility_clean", "sending_date", "lag_days", "n_facility", "max_lag")


FACILITY_SQL = STATS_SQL + """, stats AS (
      SELECT facility_clean AS f, reporting_clean AS r, disease AS d, max(sending_date) AS latest_facility_date,
             avg(lag_days) AS average_lag, max(lag_days) AS max_lag, stddev_samp(lag_days) AS sd_lag
      FROM clean GROUP BY ALL),
    weekly AS (
      SELECT facility_clean AS f, reporting_clean AS r, disease AS d, week_ending, count(*) AS labs_by_week
      FROM clean GROUP BY ALL),
    rolled AS (
      SELECT *, row_number() OVER o AS rn,
             avg(labs_by_week) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS m4,
             stddev_samp(labs_by_week) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS s4
      FROM weekly WINDOW o AS (PARTITION BY f, r, d ORDER BY week_ending DESC)),
    rolling AS (SELECT *, CASE WHEN rn >= 4 THEN m4 END AS m, CASE WHEN rn >= 4 THEN s4 END AS s FROM rolled),
    flags AS (
      SELECT g.f, g.r, g.d, g.week_ending, latest_facility_date,
             CAST((SELECT max(sending_date) FROM clean) - latest_facility_date AS INTEGER) AS days_since_last,
             average_lag, max_lag, sd_lag, labs_by_week, m AS rolling_mean, s AS rolling_sd,
             """ + VOLUME_CASE.format(n="labs_by_week", k=1) + """ AS volume_flag_1sd,
             """ + VOLUME_CASE.format(n="labs_by_week", k=2) + """ AS volume_flag_2sd,
             CASE WHEN (SELECT max(sending_date) FROM clean) - latest_facility_date > 7 THEN 'Flag' ELSE 'Normal' END
               AS submission_time_flag,
             CASE WHEN max_lag > 2 * (SELECT avg(lag_days) FROM clean) THEN 'Flag' ELSE 'Normal' END AS abnormal_lag
      FROM rolling g JOIN stats t ON g.f IS NOT DISTINCT FROM t.f AND g.r IS NOT DISTINCT FROM t.r AND g.d = t.d),
    labs AS (
      SELECT coalesce(facility_clean, reporting_clean, sending_facility) AS facility_clean, reporting_clean, disease,
             test, sending_facility, observation_type, mmwr_year, mmwr_week, c.week_ending, flags.* EXCLUDE (f, r, d, week_ending)
      FROM clean c JOIN flags ON c.facility_clean IS NOT DISTINCT FROM f AND c.reporting_clean IS NOT DISTINCT FROM r
           AND c.disease = d AND c.week_ending = flags.week_ending)
"""


def weekly_rows(spark, sf_dir):
    """The reduced rows, written once for the statistics, the scalars and the names."""
    return b.kept(spark, facilities.weekly_rows(b.all_feeds(spark, sf_dir)), "weekly-rows")


@query(
    "facility_aggregate",
    FACILITY_SQL
    + """SELECT * EXCLUDE (abnormal_lag, average_lag, sd_lag, rolling_mean, rolling_sd),
      round(average_lag, 6) AS average_lag, round(sd_lag, 6) AS sd_lag, round(rolling_mean, 6) AS rolling_mean,
      round(rolling_sd, 6) AS rolling_sd
    FROM labs QUALIFY row_number() OVER (PARTITION BY facility_clean, reporting_clean, disease, week_ending
      ORDER BY test, sending_facility, observation_type) = 1""",
)
def facility_aggregate(spark, sf_dir):
    names = weekly_rows(spark, sf_dir)
    out = facilities.facility_aggregate(names, facilities.weekly_statistics(names))
    return out.withColumns({c: F.round(c, 6) for c in ("average_lag", "sd_lag", "rolling_mean", "rolling_sd")})


@query(
    "flagged_facilities",
    FACILITY_SQL
    + """SELECT * EXCLUDE (latest_facility_date, average_lag, sd_lag, rolling_mean, rolling_sd),
      round(rolling_mean, 6) AS rolling_mean, round(rolling_sd, 6) AS rolling_sd
    FROM labs WHERE volume_flag_1sd = 'Flag' OR volume_flag_2sd = 'Flag' OR submission_time_flag = 'Flag'
       OR abnormal_lag = 'Flag'
    QUALIFY row_number() OVER (PARTITION BY facility_clean, reporting_clean
      ORDER BY week_ending DESC, disease, test, sending_facility, observation_type) = 1""",
)
def flagged_facilities(spark, sf_dir):
    names = weekly_rows(spark, sf_dir)
    out = facilities.flagged_facilities(names, facilities.weekly_statistics(names))
    return out.withColumns({c: F.round(c, 6) for c in ("rolling_mean", "rolling_sd")})


@query(
    "weekly_volume_all_years",
    f"""WITH {b.SQL_FEEDS}, {b.SQL_CLEAN}, w AS (
      SELECT DISTINCT facility_clean, reporting_clean, disease, week_ending, mmwr_week,
             count(*) OVER (PARTITION BY facility_clean, reporting_clean, disease, mmwr_week) AS labs_by_week
      FROM clean)
    SELECT facility_clean, reporting_clean, disease, week_ending, labs_by_week,
           round(CASE WHEN row_number() OVER o >= 4
                      THEN avg(labs_by_week) OVER (o ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) END, 6) AS rolling_mean
    FROM w WINDOW o AS (PARTITION BY facility_clean, reporting_clean, disease ORDER BY week_ending)""",
)
def weekly_volume_all_years(spark, sf_dir):
    """Same week of all years added up, as the rule was written, with a trailing mean."""
    out = facilities.weekly_statistics(weekly_rows(spark, sf_dir), order="asc", include_year=False)
    return out.select(*facilities.WEEK, "labs_by_week", F.round("rolling_mean", 6).alias("rolling_mean"))


@query(
    "first_known_facility",
    f"""WITH {b.SQL_FEEDS}
    SELECT coalesce(facility, facility_other, reporting_facility, sending_facility) AS name, count(*) AS n
    FROM feeds GROUP BY 1""",
)
def first_known_facility(spark, sf_dir):
    name = nulls.first_known("facility", "facility_other", "reporting_facility", "sending_facility")
    return aggregates.count_rows(b.all_feeds(spark, sf_dir).withColumn("name", name), ["name"])

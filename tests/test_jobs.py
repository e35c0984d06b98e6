"""The four jobs end to end on the smallest test tables."""

from pyspark.sql import functions as F

from surveil import jobs
from surveil.sources import writers
from workload import bindings as b
from __spark_entry__ import SMOKE_DIR


def read(spark, out, report):
    return spark.read.parquet(f"{out}/{report}")


def test_covid_job(spark, tmp_path):
    job = jobs.Job(spark, str(tmp_path), b.PERIOD.as_of)
    jobs.covid_job(job, b.covid_labs(spark, SMOKE_DIR), b.covid_cases(spark, SMOKE_DIR), b.STATE)
    out = read(spark, tmp_path, "covid_qc")
    assert out.filter("lab_date not between '2001-05-01' and '2001-05-31'").count() == 0
    assert {r[0] for r in out.select("classification_qc").distinct().collect()} <= {"Pass", "Fail", None}


def test_influenza_job(spark, tmp_path):
    job = jobs.Job(spark, str(tmp_path / "out"), b.PERIOD.as_of)
    cases = b.cases(spark, SMOKE_DIR)
    history = str(tmp_path / "history")
    writers.write_period_extract(cases.select("event_date"), history, b.PERIOD)
    jobs.influenza_job(job, b.flu_labs(spark, SMOKE_DIR), cases, history)
    checked, typed = (read(spark, job.out, n) for n in ("flu_checked", "flu_labs"))
    assert checked.count() > typed.count() > 0
    summary = writers.read_csv(
        spark, f"{job.out}/flu_typing_summary/as_of=2001-06-30", "flu_type string, subtype string, n bigint"
    )
    assert summary.agg(F.sum("n")).first()[0] == typed.count()
    seasons = writers.read_csv(
        spark, f"{job.out}/flu_season_comparison/as_of=2001-06-30",
        "season string, mmwr_year int, mmwr_week int, weekly_count bigint, cumulative_count bigint",
    ).collect()
    assert {r.mmwr_week for r in seasons} == {25}
    assert {r.season for r in seasons} == {s.label for s in b.PERIOD.season_windows()} and len(seasons) == 6
    trend = writers.read_csv(
        spark, f"{job.out}/flu_monthly_trend/as_of=2001-06-30", "year int, month int, n bigint, rownum int, month_year string"
    ).collect()
    assert sorted((r.year, r.month) for r in trend) == [(1999 + m // 12, m % 12 + 1) for m in range(9, 30)]
    with_typing = read(spark, job.out, "flu_checked_typing")
    assert with_typing.count() == checked.count()
    failed = read(spark, job.out, "flu_failed_typing")
    assert failed.count() == checked.filter("final_qc = 'Fail'").count() > 0
    assert failed.select("case_id").distinct().count() == read(spark, job.out, "flu_failed_cases").count()


def test_facilities_job(spark, tmp_path):
    job = jobs.Job(spark, str(tmp_path), b.PERIOD.as_of)
    jobs.facilities_job(job, b.all_feeds(spark, SMOKE_DIR))
    rows = read(spark, tmp_path, "lab_rows")
    weeks = read(spark, tmp_path, "facility_weeks")
    assert rows.count() == b.all_feeds(spark, SMOKE_DIR).count()
    assert weeks.agg(F.sum("labs_by_week")).first()[0] == rows.count()


def test_indicators_job(spark, tmp_path):
    job = jobs.Job(spark, str(tmp_path), b.PERIOD.as_of)
    facts = b.cases(spark, SMOKE_DIR).withColumnRenamed("state", "region").withColumn(
        "ok", F.col("disease_status") == "Confirmed"
    )
    rejections = facts.select(
        "region", F.concat_ws("-", F.year("event_date"), F.quarter("event_date")).alias("year_qrtr"), F.lit("Incorrect status").alias("reason")
    ).limit(50)
    timely = spark.createDataFrame(
        [("s", 1, "Year", "Quarter", "Pass", "N"), ("s", 2, "1999.0", "1", "9", "10"), ("s", 3, None, "2.0", "19", "20")],
        "sheet_id string, row_no bigint, c1 string, c2 string, c3 string, c4 string",
    )
    tabulated = spark.createDataFrame(
        [("t", 1, "title", "x", None), ("t", 2, None, "1999", None), ("t", 3, None, "4", None), ("t", 4, "rowmiss", "1", "25"),
         ("t", 5, "pass", "3", "75"), ("t", 6, "Total", "4", "100")],
        "sheet_id string, row_no bigint, c1 string, c2 string, c3 string",
    )
    jobs.indicators_job(job, facts, "event_date", "ok", {"var1": "died", "var2": "disease_status"},
                        ["ASIA", "EUROPE"], [1999, 2000], (2000, 2), rejections, [1999],
                        [jobs.TimelinessSheets("var8", "state", timely, ["year", "quarter", "n_pass", "n"], 1)],
                        [jobs.PassRateSheets("state", tabulated, 3, {"year": (2, "c2"), "quarter": (3, "c2")})])
    out = spark.read.csv(f"{tmp_path}/indicator_rates_region/as_of=2001-06-30", header=True)
    assert out.count() == 16
    targets = spark.read.csv(f"{tmp_path}/indicator_targets_state/as_of=2001-06-30", header=True)
    assert targets.count() == 16 and {r.target for r in targets.collect()} == {"80.0"}

    def csv(report):
        return spark.read.csv(f"{tmp_path}/{report}/as_of=2001-06-30", header=True, nullValue="\\N").collect()

    met = {(r.year, r.quarter): (r.percent, r.meets_target) for r in csv("indicator_targets_var8_state")}
    assert met["1999", "1"] == ("90.0", "true") and met["1999", "2"] == ("95.0", "true") and met["2000", "1"] == (None, None)
    passed = {(r.year, r.quarter): (r.percent, r.target) for r in csv("indicator_targets_var6_state")}
    assert len(passed) == 8 and passed["1999", "4"] == ("75.0", "100.0")
    assert len(csv("indicator_classification_region")) == 16 and len(csv("indicator_targets_classification_state")) == 8

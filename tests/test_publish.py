from datetime import date

import pytest
from pyspark.sql import functions as F

from surveil import jobs, publish
from workload import bindings as b

DAY = date(2024, 3, 31)


def save_two(job, n):
    df = job.spark.range(n).select("id", F.lit("a\nb\\").alias("t"))
    job.save(df, "rows")
    yield
    job.save(df.groupBy().count(), "total", "csv")


def read(spark, base, as_of=None):
    rows = publish.current(spark, base, as_of)
    return publish.read_output(spark, rows, "rows").count(), publish.read_output(spark, rows, "total").first()["count"]


def test_a_job_that_dies_between_outputs_leaves_the_old_report_whole(spark, tmp_path):
    base = str(tmp_path)
    with publish.release(spark, base, DAY) as job:
        list(save_two(job, 5))
    assert read(spark, base) == (5, 5)
    with pytest.raises(RuntimeError):
        with publish.release(spark, base, DAY) as job:
            for _ in save_two(job, 9):
                assert read(spark, base) == (5, 5)  # readers in the meantime
                raise RuntimeError
    assert read(spark, base) == (5, 5)
    with publish.release(spark, base, DAY) as job:
        list(save_two(job, 7))
    assert read(spark, base) == (7, 7) and read(spark, base, DAY) == (7, 7)
    assert publish.manifest(spark, base).count() == 4


def test_a_reader_keeps_its_release_while_another_is_published(spark, tmp_path):
    base = str(tmp_path)
    with publish.release(spark, base, DAY) as job:
        list(save_two(job, 3))
    rows = publish.current(spark, base)
    with publish.release(spark, base, DAY) as job:
        list(save_two(job, 4))
    assert publish.read_output(spark, rows, "rows").count() == 3 and publish.read_output(spark, rows, "total").first()["count"] == 3


def test_dates_are_apart_and_formats_come_back(spark, tmp_path):
    base = str(tmp_path)
    df = spark.createDataFrame([(1, "x\ny"), (2, None), (3, "\\N")], "k int, t string")
    for day, fmt in ((date(2024, 4, 30), "lines"), (DAY, "parquet"), (date(2024, 2, 29), "csv")):
        with publish.release(spark, base, day) as job:
            job.save(df.filter(F.col("k") <= day.month), "rows", fmt)
    for day, n in ((date(2024, 4, 30), 3), (DAY, 3), (date(2024, 2, 29), 2)):
        got = publish.read_published(spark, base, "rows", day)
        assert sorted(map(tuple, got.collect()))[:n] == [(1, "x\ny"), (2, None), (3, "\\N")][:n] and got.count() == n
    assert publish.read_published(spark, base, "rows").count() == 3  # the latest date
    with pytest.raises(LookupError, match="none"):
        publish.read_published(spark, base, "none")


def test_of_two_published_at_once_all_readers_take_the_same(spark, tmp_path):
    base = str(tmp_path)
    publish.start_manifest(spark, base)
    rows = [(DAY, 1, name, "rows", f"{base}/{name}", "parquet", spark.range(0).schema.json()) for name in ("a", "b")]
    for i, row in enumerate(rows):
        spark.range(i + 1).write.parquet(row[4])
        spark.createDataFrame([row], publish.MANIFEST).write.mode("append").parquet(f"{base}/manifest")
    assert publish.read_published(spark, base, "rows").count() == 2


def test_a_whole_job(spark, tmp_path):
    base = str(tmp_path)
    feeds = b.all_feeds(spark, "/root/testdata/sf0.001")
    with publish.release(spark, base, b.PERIOD.as_of) as job:
        jobs.facilities_job(job, feeds)
    rows = publish.current(spark, base)
    assert set(rows) >= {"lab_rows", "facility_weeks", "facility_aggregate", "facility_flagged"}
    assert publish.read_output(spark, rows, "lab_rows").count() == feeds.count()

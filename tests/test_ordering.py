import glob
import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from surveil.operators.ordering import number_rows, place_rows


@pytest.fixture
def numbers(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, rng.randrange(50)]), "x") for i in range(5000)]
    return rows, spark.createDataFrame(rows, "id long, v int, place string").repartition(7)


def test_numbers_follow_the_order(spark, numbers, tmp_path):
    rows, df = numbers
    out = number_rows(df, [F.desc_nulls_last("v"), "id"], str(tmp_path / "t"), partitions=16)
    assert out.columns == ["id", "v", "place", "rownum"]
    want = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [r["id"] for r in sorted(out.collect(), key=lambda r: r["rownum"])] == [r[0] for r in want]
    assert sorted(r["rownum"] for r in out.collect()) == list(range(1, len(rows) + 1))


def test_files_by_name_hold_the_rows_in_order(spark, numbers, tmp_path):
    rows, df = numbers
    place_rows(df, ["v", "id"], str(tmp_path / "t"), partitions=16)
    files = sorted(glob.glob(str(tmp_path / "t" / "*.parquet")))
    assert len(files) > 4
    got = [i for f in files for i in pq.read_table(f)["id"].to_pylist()]
    assert got == [r[0] for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))]


def test_a_tie_of_all_rows_is_many_ranges(spark, tmp_path):
    df = spark.range(40_000).select(F.lit(1).alias("k"))
    out = number_rows(df, ["k"], str(tmp_path / "t"), partitions=16)
    assert out.agg(F.min("rownum"), F.max("rownum"), F.countDistinct("rownum")).first() == (1, 40_000, 40_000)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(str(tmp_path / "t" / "*.parquet"))]
    assert max(sizes) < 3 * 40_000 / 16


def test_a_sequence_of_its_own_for_copies_and_none_for_nothing(spark, tmp_path):
    copies = spark.createDataFrame([(1, "a")] * 5, "k int, rownum string")
    assert sorted(r["rownum"] for r in number_rows(copies, ["k"], str(tmp_path / "a")).collect()) == [1, 2, 3, 4, 5]
    assert number_rows(copies.limit(0), ["k"], str(tmp_path / "b")).collect() == []


def test_no_task_sees_all_rows(spark, numbers, tmp_path):
    _, df = numbers
    out = number_rows(df, ["v", "id"], str(tmp_path / "t"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_a_sorted_report_reads_in_order_file_by_file(spark, tmp_path):
    from datetime import date

    from surveil.operators.reshape import sort_report
    from surveil.sources import writers

    rng = random.Random(5)
    data = [(i, rng.choice("abcde"), rng.randrange(100)) for i in range(4000)]
    df = spark.createDataFrame(data, "id int, facility string, week int").repartition(6)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several files even of so few rows
    try:
        writers.write_report(sort_report(df, "facility", F.desc("week"), "id"), str(tmp_path), date(2024, 3, 31), "csv")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = sorted(glob.glob(str(tmp_path / "as_of=2024-03-31" / "*.csv")))
    assert len(files) > 3
    rows = [line.replace('"', "").split(",") for f in files for line in open(f).read().splitlines()[1:]]
    assert [int(r[0]) for r in rows] == [r[0] for r in sorted(data, key=lambda r: (r[1], -r[2], r[0]))]

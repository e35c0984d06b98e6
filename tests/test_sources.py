from datetime import date

import pytest
from pyspark.sql import functions as F

from surveil.functions.periods import ReportPeriod
from surveil.sources import readers, writers


def test_awkward_text_survives_csv(spark, tmp_path, rows):
    schema = "i int, t string"
    data = [(1, 'a "quoted" name, Inc.'), (2, "two\nlines"), (3, None), (4, ""), (5, "back\\slash"), (6, "'; x|y\t"),
            (7, "N"), (8, "a\\N")]
    df = spark.createDataFrame(data, schema)
    path = str(tmp_path / "out")
    writers.write_csv(df, path)
    assert rows(readers.read_table(spark, path, schema, "csv", multiLine=True, **writers.CSV_OPTIONS)) == data
    assert rows(writers.read_csv(spark, path, schema)) == data


def test_null_token_survives_csv(spark, tmp_path, rows):
    data = [(1, "\\N"), (2, None), (3, ""), (4, "\\\\N"), (5, "\\\\\\N"), (6, "N"), (7, "\\NN"), (8, "x\\N"), (9, "\\N\nx")]
    path = str(tmp_path / "out")
    writers.write_csv(spark.createDataFrame(data, "i int, `t.x` string"), path, max_records=2)
    assert rows(writers.read_csv(spark, path, "i int, `t.x` string")) == data
    assert len(list((tmp_path / "out").glob("part-*.csv"))) >= 5


def test_extract_holds_all_seasons_of_its_month(spark, tmp_path, rows):
    base = str(tmp_path / "history")
    january, march = ReportPeriod(date(2024, 1, 31)), ReportPeriod(date(2024, 3, 31))
    df = spark.createDataFrame([(1, date(2019, 12, 31)), (2, date(2024, 1, 5)), (3, date(2022, 2, 5))], "i int, d date")
    writers.write_period_extract(df, base, january)
    writers.write_period_extract(df.filter("i = 1"), base, march)
    out = readers.read_period_extract(spark, base, january)
    assert rows(out, "i") == [(1,), (2,), (3,)] and rows(readers.read_period_extract(spark, base, march), "i") == [(1,)]
    assert all("year=2024/month=1" in f for f in out.inputFiles())
    writers.write_period_extract(df.filter("i = 2"), base, january)
    assert rows(readers.read_period_extract(spark, base, january), "i") == [(2,)]
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        readers.read_period_extract(spark, base, ReportPeriod(date(2024, 6, 30)))
    with pytest.raises(ValueError):
        writers.write_period_extract(df.withColumnRenamed("d", "year"), base, march)


def test_reports_of_other_dates_are_kept(spark, tmp_path, rows):
    path = str(tmp_path / "report")
    df = spark.createDataFrame([(1,)], "i int")
    writers.write_report(df, path, date(2024, 1, 1))
    writers.write_report(df, path, date(2024, 1, 8))
    writers.write_report(df.union(df), path, date(2024, 1, 8))
    assert rows(spark.read.parquet(path).groupBy("as_of").count()) == [(date(2024, 1, 1), 1), (date(2024, 1, 8), 2)]
    assert writers.report_name("flu", date(2024, 1, 8), (2024, 1)) == "flu20241"
    assert writers.report_name("labs", date(2024, 1, 8)) == "labs 2024-01-08"


def test_sheet_reader(spark, tmp_path, rows):
    path = str(tmp_path / "sheet")
    spark.createDataFrame([("s", 1, "Year", None), ("s", 2, "2022", "5")], "s string, r int, a string, b string").write.csv(
        path, nullValue="."
    )
    assert rows(readers.read_sheet_csv(spark, path, ["c1", "c2"])) == [("s", 1, "Year", None), ("s", 2, "2022", "5")]


def test_text_formats_need_a_schema(spark):
    with pytest.raises(ValueError):
        readers.read_table(spark, "x", None, "csv")


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = writers.scratch_folder(spark, "t"), writers.scratch_folder(spark, "t")
    assert a.startswith(shared) and a != b

    class Unset:
        conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})
        sparkContext = type("Context", (), {"getCheckpointDir": staticmethod(lambda: None), "master": "local[2]"})

    with pytest.raises(ValueError):
        writers.scratch_folder(Unset, "t")


def test_date_range_and_columns_reach_the_scan(spark, tmp_path):
    from surveil.functions.periods import within

    path = str(tmp_path / "labs")
    spark.createDataFrame([(1, date(2024, 2, 3), "a", "b")], "i int, d date, t string, u string").write.parquet(path)
    labs = readers.read_table(spark, path, "i int, d date, t string, u string")
    out = labs.filter(within("d", *ReportPeriod(date(2024, 3, 31)).previous_month)).select("i")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(d,2024-02-01), LessThanOrEqual(d,2024-02-29)" in plan
    assert "ReadSchema: struct<i:int,d:date>" in plan


def satisfied(predicates, rows, name="k"):
    """How many of the WHERE clauses each row satisfies, by DuckDB."""
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE TABLE t ({name} {'VARCHAR' if any(isinstance(r, str) for r in rows) else 'BIGINT'})")
    con.executemany("INSERT INTO t VALUES (?)", [(r,) for r in rows])
    return [[v for (v,) in con.execute(f"SELECT {name} FROM t WHERE {p}").fetchall()] for p in predicates]


@pytest.mark.parametrize("cuts", [[], [5], [3, 7, 7, 20], [-4, 0, 1000]])
def test_range_predicates_part_every_row_once(cuts):
    rows = [None, -5, -4, 0, 3, 4, 5, 6, 7, 8, 19, 20, 21, 1000, 2000]
    parts = satisfied(readers.range_predicates("k", cuts), rows)
    assert sorted(sum(parts, []), key=str) == sorted(rows, key=str)
    assert len(parts) == len(set(cuts)) + 1


def test_range_predicates_of_texts_are_quoted():
    rows = ["a", "O'Hara", "O'Hara2", "zz", None]
    parts = satisfied(readers.range_predicates("k", ["O'Hara", "z"]), rows)
    assert parts == [[None], ["a", "O'Hara", "O'Hara2"], ["zz"]]


def test_hash_predicates_part_every_row_once():
    rows = [None, *range(-20, 21), 2**40]
    parts = satisfied(readers.hash_predicates("k", 7), rows)
    assert sorted(sum(parts, []), key=str) == sorted(rows, key=str) and len(parts) == 7
    assert max(map(len, parts)) <= 8


def test_quantile_cuts_of_a_skewed_key(spark):
    """Equal strides would put all but a few rows into one part."""
    df = spark.range(20_000).select(F.when(F.col("id") < 19_900, F.col("id")).otherwise(F.col("id") * 10**9).alias("k"))
    cuts = readers.quantile_cuts(df, "k", 8)
    sizes = [df.filter(p).count() for p in readers.range_predicates("k", cuts)]
    assert sum(sizes) == 20_000 and max(sizes) < 1.1 * 20_000 / 8
    hot = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("k"))
    sizes = [hot.filter(p).count() for p in readers.range_predicates("k", readers.quantile_cuts(hot, "k", 6))]
    assert sum(sizes) == 9000 and max(sizes) < 9000 / 3 + 2 * 9000 / 6  # the hot value itself cannot be parted by ranges
    assert readers.quantile_cuts(df.limit(0), "k", 4) == [] and readers.quantile_cuts(df, "k", 1) == []

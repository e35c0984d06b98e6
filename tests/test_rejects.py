from collections import Counter

import pytest
from pyspark.sql import functions as F

from surveil.functions import nulls, text
from surveil.operators import rejects
from surveil.plans import indicators


def test_every_row_is_on_one_side_and_counted(spark, tmp_path):
    data = [(i, None if i % 5 == 0 else i, "x" * (i % 4)) for i in range(100)] + [(3, 3, "xxx")] * 2
    df = spark.createDataFrame(data, "id int, n int, t string").repartition(6)
    checks = {"n is missing": F.col("n").isNull(), "t is empty": F.col("t") == "", "n is odd": F.col("n") % 2 == 1}
    split = rejects.split_rows(df, checks, str(tmp_path / "s"))
    assert split.good.columns == df.columns and split.rejected.columns == [*df.columns, "reject_reasons"]
    both = split.good.collect() + split.rejected.drop("reject_reasons").collect()
    assert Counter(map(tuple, both)) == Counter(data)
    want = {name: 0 for name in checks}
    for _, n, t in data:
        want["n is missing"] += n is None
        want["t is empty"] += t == ""
        want["n is odd"] += n is not None and n % 2 == 1
    assert split.by_reason == want
    assert (split.n_rows, split.n_rejected) == (102, split.rejected.count())
    assert {r["reason"]: r["n"] for r in rejects.reject_counts(split.rejected).collect()} == want


def test_the_input_is_read_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(1000).mapInPandas(count, "id long")
    split = rejects.split_rows(df, {"small": F.col("id") < 10}, str(tmp_path / "s"))
    assert split.good.count() == 990 and split.rejected.count() == 10 and seen.value == 1000


def test_one_side_reads_only_its_files(spark, tmp_path):
    split = rejects.split_rows(spark.range(100), {"small": F.col("id") < 10}, str(tmp_path / "s"))
    plan = split.rejected._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__rejected" in plan
    assert all("__rejected=true" in f for f in split.rejected.select("id", F.input_file_name().alias("f")).toPandas()["f"])


def test_no_checks_no_rows_and_a_second_run(spark, tmp_path):
    path = str(tmp_path / "s")
    split = rejects.split_rows(spark.range(5), {}, path)
    assert split.good.count() == 5 and split.rejected.count() == 0 and split.by_reason == {}
    split = rejects.split_rows(spark.range(0), {"x": F.lit(True)}, path)  # replaces the first
    assert (split.n_rows, split.n_rejected, split.good.count()) == (0, 0, 0)
    with pytest.raises(ValueError, match="reject_reasons"):
        rejects.with_reasons(spark.sql("select 1 as reject_reasons"), {})


KEYS = {
    "2023-2": (2023, 2), "2023.0-2": (2023, 2), "2023-2.0": (2023, 2), "2023.00 / 3.0": (2023, 3), " 2022-4 ": (2022, 4), "2022 1": (2022, 1), "2022_1": (2022, 1),
    "2023-Q2": None, "2023-5": None, "2023-0": None, "2023": None, "23-1": None, "2023.5-1": None, "2023-1.5": None, "2023.2": None, "": None, None: None, "Total": None, "2023-2-1": None,
}


def test_quarter_keys(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    year, quarter = text.quarter_parts("k")
    for r in df.select("k", year.alias("y"), quarter.alias("q"), text.bad_quarter_key("k").alias("bad")).collect():
        assert (None if r["bad"] else (r["y"], r["q"])) == KEYS[r["k"]], r
        assert r["bad"] == (r["y"] is None)


def test_numbers_are_refused_by_the_check_as_by_the_conversion(spark):
    cells = ["1", "1.0", "1.5", "x", "", None, " 7 ", "1e3", "NaN"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    for r in df.select("c", nulls.not_whole("c").alias("bad")).collect():
        one = df.filter(F.col("c").eqNullSafe(r["c"])).select(nulls.whole_number("c").alias("n"))
        if r["bad"]:
            with pytest.raises(Exception, match="not a whole number"):
                one.collect()
        else:
            assert one.first()["n"] == (None if r["c"] is None else int(float(r["c"])))


def test_bad_keys_are_reported_and_nothing_is_lost(spark, tmp_path, rows):
    data = [("A", k, "Incorrect status") for k in KEYS] + [("A", "2023-Q2", "Missing data"), (None, "2023-2", "incorrect")]
    df = spark.createDataFrame(data, "region string, year_qrtr string, reason string")
    split = rejects.split_rows(df, indicators.rejection_checks(["region"]), str(tmp_path / "s"))
    counted = indicators.incorrect_by_quarter(split.good, ["region"])
    assert rows(counted, "year", "quarter", "n_incorrect") == [(2022, 1, 2), (2022, 4, 1), (2023, 2, 3), (2023, 3, 1)]
    assert split.n_rejected == sum(v is None for v in KEYS.values()) + 1
    assert counted.agg(F.sum("n_incorrect")).first()[0] + split.n_rejected + 1 == len(data)  # one is for another reason
    with pytest.raises(Exception, match="no year and quarter"):
        indicators.incorrect_by_quarter(df, ["region"]).collect()


def test_timeliness_sheets_without_their_bad_rows(spark, tmp_path, rows):
    data = [("s", 1, "Year", "Quarter", "Pass", "N"), ("s", 2, "1999.0", "1", "9", "10"), ("s", 3, None, "2.0", "x", "20"), ("s", 4, None, None, "5", "6")]
    sheets = spark.createDataFrame(data, "sheet_id string, row_no bigint, c1 string, c2 string, c3 string, c4 string")
    names, keys = ["year", "quarter", "n_pass", "n"], ["year", "quarter"]
    filled = indicators.timeliness_rows(sheets, names, 1, keys)
    split = rejects.split_rows(filled, indicators.timeliness_checks(keys), str(tmp_path / "s"))
    assert rows(indicators.timeliness_values(split.good, keys), "year", "quarter", "n_pass", "n") == [(1999, 1, 9, 10)]
    assert rows(split.rejected.select("row_no", F.array_join("reject_reasons", ";"))) == [(3, "n_pass is not a whole number"), (4, "quarter is missing")]
    with pytest.raises(Exception, match="a row without|not a whole number"):
        indicators.timeliness_from_sheets(sheets, names, 1, keys).collect()

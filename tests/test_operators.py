import random
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.operators import aggregates, reshape, setops, windows


def test_counts_include_nulls(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", 1), (None, 2)], "k string, v int")
    assert rows(aggregates.count_rows(df, ["k"])) == [(None, 1), ("a", 2)]


def test_null_modes(spark, rows):
    df = spark.createDataFrame([("f", 2), ("f", None), ("f", 4), ("g", 3)], "k string, lag int")
    assert rows(aggregates.lag_stats(df, ["k"], "lag")) == [("f", 3.0, pytest.approx(2**0.5)), ("g", 3.0, None)]
    assert rows(aggregates.lag_stats(df, ["k"], "lag", "propagate")) == [("f", None, None), ("g", 3.0, None)]
    both = aggregates.lag_stats(df, ["k"], "lag", ["skip", "propagate"])
    assert rows(both, "k", "average_lag_skip", "average_lag_propagate") == [("f", 3.0, None), ("g", 3.0, 3.0)]
    assert both._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert rows(aggregates.latest_by(df, ["k"], "lag", "propagate")) == [("f", None), ("g", 3)]
    with pytest.raises(ValueError):
        aggregates.lag_stats(df, ["k"], "lag", "other")


@pytest.mark.parametrize("lags", [[3], [1, 2], [5, 1, 3], [1, 1, 1, 9], [-4, None, 7, 2, 2]])
def test_overall_lag(spark, lags):
    import statistics

    known = [v for v in lags if v is not None]
    got = aggregates.overall_lag(spark.createDataFrame([(v,) for v in lags], "lag int"), "lag").first()
    assert got.mean_lag == pytest.approx(statistics.mean(known))
    assert got.median_lag == statistics.median(known)


def test_overall_lag_refuses_fractions(spark):
    with pytest.raises(TypeError):
        aggregates.overall_lag(spark.createDataFrame([(1.5,)], "lag double"), "lag")


def test_range_select(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5)], "a int, b int, c int, d int, e int")
    assert reshape.reshape_columns(df, select=["e", ("b", "d")]).columns == ["e", "b", "c", "d"]
    assert reshape.reshape_columns(df, select=[("a", "d")], drop=["b"], rename={"c": "x"}, last=["a"]).columns == ["x", "d", "a"]
    assert reshape.reshape_columns(df, select=[("a", "e")], drop_from="d").columns == ["a", "b", "c"]


def test_days_since_last(spark, rows):
    df = spark.createDataFrame([("a", date(2024, 1, 1)), ("a", date(2024, 1, 8)), ("b", date(2024, 1, 1))], "k string, d date")
    assert rows(aggregates.days_since_last(df, ["k"], "d"), "k", "days_since_last") == [("a", 0), ("b", 7)]


def test_month_counts_in_calendar_order(spark):
    df = spark.createDataFrame([(date(2024, 2, 1),), (date(2023, 12, 5),), (date(2024, 2, 9),)], "d date")
    out = [tuple(r) for r in aggregates.month_counts(df, "d").orderBy("rownum").collect()]
    assert out == [(2023, 12, 1, 1, "December 2023"), (2024, 2, 2, 2, "February 2024")]


def test_first_per_key_reduces_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "q"), (None, 1, "n")], "k string, o int, v string")
    out = aggregates.first_per_key(df, ["k"], ["o", "v"])
    assert rows(out) == [(None, 1, "n"), ("a", 1, "y"), ("b", 5, "q")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_rolling_needs_a_full_frame(spark):
    def rolled(counts):
        df = spark.createDataFrame(list(enumerate(counts)), "o int, n int")
        w = Window.partitionBy(F.lit(1)).orderBy("o")
        out = df.select("o", windows.rolling_mean("n", w).alias("m"), windows.rolling_sd("n", w).alias("s"))
        return [(r.m, r.s) for r in out.orderBy("o").collect()]

    assert rolled([10, 2, 2]) == [(None, None)] * 3
    assert rolled([10, 2, 2, 2])[3] == (4.0, 4.0)
    assert rolled([2, 2, 2, 10])[3] == (4.0, 4.0)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_fill_down_over_blocks(spark, block):
    rng = random.Random(block)
    data, want = [], []
    for sheet in ("s", "t", None):
        last = [None, None]
        for i in range(1, 60):
            cells = [rng.choice([None, None, f"{sheet}{i}"]), rng.choice([None] * 9 + [f"y{i}"])]
            last = [c if c is not None else p for c, p in zip(cells, last)]
            data.append((sheet, i, *cells))
            want.append((sheet, i, *last))
    rng.shuffle(data)
    df = spark.createDataFrame(data, "sheet string, row bigint, a string, b string")
    out = windows.fill_down(df, ["a", "b"], ["sheet"], "row", block)
    assert out.columns == df.columns
    assert sorted(map(str, (tuple(r) for r in out.collect()))) == sorted(map(str, want))


def test_cumulative_count(spark, rows):
    df = spark.createDataFrame([("s", 2023, 52, 1), ("s", 2024, 1, 2), ("t", 2024, 1, 5)], "season string, y int, w int, n int")
    out = windows.cumulative_count(df, "n", ["season"], ["y", "w"], "c")
    assert rows(out, "season", "w", "c") == [("s", 1, 3), ("s", 52, 1), ("t", 1, 5)]


def test_header_tools(spark, rows):
    df = spark.createDataFrame(
        [("s", 1, "Region", "North"), ("s", 2, "n", "7"), ("s", 3, "a", None), ("u", 1, "Region", "South"), ("u", 3, "b", "4")],
        "sheet_id string, row_no bigint, c1 string, c2 string",
    )
    named = reshape.header_cells(df, region=(1, "c2"))
    assert rows(reshape.drop_first_n(named, 2), "c1", "region") == [("a", "North"), ("b", "South")]
    repaired = reshape.repair_header(df, ["label", "n"], 0)
    filled = reshape.drop_first_n(reshape.header_fallback(repaired, ["n"], 2), 2)
    assert rows(filled, "label", "n") == [("a", 7.0), ("b", 4.0)]
    with pytest.raises(ValueError):
        reshape.repair_header(df, ["label"])


def test_pivots_are_inverse(spark, rows):
    long = spark.createDataFrame([("A", "2022", "1", 5), ("A", "2022", "2", None), ("B", "2022", "1", 7)], "r string, y string, q string, v int")
    wide = reshape.pivot_wide(long, ["r"], ["y", "q"], [("2022", "1"), ("2022", "2")], "v")
    assert wide.columns == ["r", "2022_1", "2022_2"]
    assert rows(wide) == [("A", 5, None), ("B", 7, None)]
    back = reshape.pivot_long(wide, ["r"], ["y", "q"], "v").filter("v is not null")
    assert rows(back) == [("A", "2022", "1", 5), ("B", "2022", "1", 7)]


def test_reshape_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "a int, b int, c int, d int")
    out = reshape.reshape_columns(df, drop=["b"], rename={"a": "x"}, last=["x"], drop_from="d")
    assert out.columns == ["c", "x"] and tuple(out.first()) == (3, 1)


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "p")], "i int, x string")
    b = spark.createDataFrame([(1,), (1,)], "i int")
    assert rows(setops.union_by_name(a, b)) == [(1, None), (1, None), (1, "p")]
    assert rows(setops.union_distinct(b, b)) == [(1,)]
    assert rows(setops.union_sources({"f": a, "g": b}), "feed", "i") == [("f", 1), ("g", 1), ("g", 1)]


def test_first_n_and_convert(spark, rows):
    df = spark.createDataFrame([(3, "1"), (1, "x"), (2, "2.5")], "o int, t string")
    assert rows(reshape.first_n(df, ["o"], 2), "o") == [(1,), (2,)]
    assert rows(reshape.convert_types(df, numbers=["t"]), "o", "t") == [(1, None), (2, 2.5), (3, 1.0)]

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveil.operators import rejects
from surveil.operators.reconcile import common_schema, common_type, stack_feeds, unconverted_cells

TEXT, INT, LONG, DOUBLE, DATE, NTZ, BOOL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()


@pytest.mark.parametrize(
    "a, b, want",
    [
        (INT, LONG, LONG), (INT, DOUBLE, DOUBLE), (TEXT, INT, LONG), (TEXT, DOUBLE, DOUBLE), (TEXT, DATE, NTZ), (DATE, NTZ, NTZ), (DOUBLE, DATE, NTZ),
        (DATE, DATE, DATE), (TEXT, BOOL, TEXT), (BOOL, DATE, TEXT), (BOOL, INT, TEXT), (T.NullType(), DATE, DATE), (DATE, T.NullType(), DATE),
        (T.DecimalType(10, 2), T.DecimalType(8, 4), T.DecimalType(12, 4)), (T.DecimalType(10, 2), LONG, T.DecimalType(21, 2)),
        (T.DecimalType(38, 2), T.DecimalType(38, 10), DOUBLE), (T.DecimalType(10, 2), DOUBLE, DOUBLE), (T.ShortType(), INT, INT),
        (T.ArrayType(INT), INT, TEXT), (T.TimestampType(), TEXT, NTZ),
    ],
)
def test_common_type_is_the_same_both_ways(a, b, want):
    assert common_type(a, b) == want and common_type(b, a) == want


def feeds(spark):
    return {
        "text": spark.createDataFrame([(1, "2024-03-01", " 7.0 ", "x"), (2, "03/02/2024", "7.5", None), (3, "soon", "many", ""), (4, None, None, "y")], "id int, day string, n string, only string"),
        "sheet": spark.createDataFrame([(5, 45352.5, 8), (6, None, None)], "id bigint, day double, n int"),
        "typed": spark.createDataFrame([(7, datetime(2024, 3, 4, 5, 6), 9), (8, None, 10**12)], "id int, day timestamp_ntz, n bigint"),
    }


def test_text_number_and_time_under_one_type(spark):
    out = stack_feeds(feeds(spark), formats=["MM/dd/yyyy"])
    assert dict(out.dtypes) == {"id": "bigint", "day": "timestamp_ntz", "n": "bigint", "only": "string", "unconverted": "map<string,string>", "feed": "string"}
    got = {r["id"]: (r["day"], r["n"], r["only"], r["unconverted"], r["feed"]) for r in out.collect()}
    assert got == {
        1: (datetime(2024, 3, 1), 7, "x", {}, "text"), 2: (datetime(2024, 3, 2), None, None, {"n": "7.5"}, "text"),
        3: (None, None, "", {"day": "soon", "n": "many"}, "text"), 4: (None, None, "y", {}, "text"),
        5: (datetime(2024, 3, 1, 12), 8, None, {}, "sheet"), 6: (None, None, None, {}, "sheet"),
        7: (datetime(2024, 3, 4, 5, 6), 9, None, {}, "typed"), 8: (None, 10**12, None, {}, "typed"),
    }


def test_every_cell_is_somewhere(spark):
    given = feeds(spark)
    out = stack_feeds(given).collect()
    for c in ("day", "n"):
        filled = sum(df.filter(F.col(c).isNotNull()).count() for df in given.values())
        assert filled == sum((r[c] is not None) + (c in r["unconverted"]) for r in out)


def test_given_types_and_the_error_channel(spark, tmp_path):
    out = stack_feeds(feeds(spark), types={"n": DOUBLE, "day": DATE})
    assert dict(out.dtypes)["n"] == "double" and dict(out.dtypes)["day"] == "date"
    row = out.filter("id = 2").first()
    assert row["n"] == 7.5 and row["unconverted"] == {"day": "03/02/2024"}
    split = rejects.split_rows(out, {"a cell cannot be read": F.size("unconverted") > 0}, str(tmp_path / "s"))
    assert (split.n_rows, split.n_rejected) == (8, 2) and {r["id"] for r in split.rejected.collect()} == {2, 3}
    assert {(r["feed"], r["column"], r["text"], r["n"]) for r in unconverted_cells(out).collect()} == {
        ("text", "day", "03/02/2024", 1), ("text", "day", "soon", 1), ("text", "n", "many", 1),
    }


def test_numbers_that_are_not_whole_or_too_large(spark):
    out = stack_feeds({"a": spark.sql("select 1.5D as n union all select 2D union all select 1e30D"), "b": spark.sql("select 3 as n")}, types={"n": INT})
    got = sorted((str(r["n"]), tuple(r["unconverted"].items())) for r in out.collect())
    assert got == [("2", ()), ("3", ()), ("None", (("n", "1.0E30"),)), ("None", (("n", "1.5"),))]


def test_decimals_booleans_and_one_feed(spark):
    out = stack_feeds({"a": spark.sql("select 1.25BD as x, true as t"), "b": spark.sql("select 2 as x, 'no' as t")})
    assert out.schema["x"].dataType == T.DecimalType(12, 2)
    assert sorted((r["x"], r["t"]) for r in out.collect()) == [(Decimal("1.25"), "true"), (Decimal("2.00"), "no")]
    alone = stack_feeds({"a": spark.range(2)})
    assert [r["unconverted"] for r in alone.collect()] == [{}, {}]
    assert common_schema({"a": spark.sql("select null as x")})["x"].dataType == TEXT


def test_names_that_the_result_needs_are_refused(spark):
    with pytest.raises(ValueError, match="feed"):
        stack_feeds({"a": spark.sql("select 1 as feed")})
    assert stack_feeds({"a": spark.sql("select 1 as feed")}, tag="source").columns == ["feed", "unconverted", "source"]


def test_a_feed_is_one_projection(spark):
    plan = stack_feeds(feeds(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert common_schema({"a": spark.createDataFrame([(date(2024, 1, 1),)], "d date")})["d"].dataType == DATE

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from surveil.operators import joins
from surveil.operators.aggregates import rows as n_rows

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def skew(spark):
    """Thresholds low enough that a test-sized hot key counts as skewed."""
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan")[0]


def hot(spark, n=60_000):
    """A third of the rows on key 7, some on null, the rest spread."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 100 == 1, None).otherwise(F.col("id") % 4000)
    return spark.range(0, n, 1, 24).select(key.alias("k"), F.col("id").alias("v"))


def test_skew_join_matches_nulls(spark, rows):
    a = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "k string, a int")
    b = spark.createDataFrame([("x", 10), (None, 20)], "k string, b int")
    assert rows(joins.skew_join(a, b, ["k"], "left"), "a", "b") == [(1, 10), (2, 20), (3, None)]
    assert rows(joins.skew_join(a, b, ["k"]), "a", "b") == [(1, 10), (2, 20)]
    assert joins.skew_join(a, b, ["k"], "left_semi").columns == ["k", "a"]
    assert rows(joins.skew_join(a, b, ["k"], "left_anti"), "a") == [(3,)]


def test_skew_join_refuses_keys_of_two_types(spark):
    with pytest.raises(TypeError, match="bigint"):
        joins.skew_join(spark.range(1), spark.range(1).select(F.col("id").cast("int").alias("id")), ["id"])


def test_attach_group_stat_splits_a_hot_key(skew):
    df = hot(skew)
    out = joins.attach_group_stat(df, ["k"], n_rows().alias("n"), F.max("v").alias("top"))
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    local = [tuple(r) for r in df.collect()]
    n, top = Counter(k for k, _ in local), {}
    for k, v in local:
        top[k] = max(v, top.get(k, -1))
    assert sorted(map(tuple, out.select("v", "n", "top").collect())) == sorted((v, n[k], top[k]) for k, v in local)


def test_case_totals_split_a_hot_case_and_count_records(skew):
    labs = hot(skew).withColumn("flag", (F.col("v") % 2).cast("int"))
    labs = labs.union(labs.filter("k = 7"))  # copies, removed by DISTINCT
    cases = skew.range(0, 4000).select(F.col("id").alias("k"), F.lit("c").alias("county"))
    cases = cases.union(skew.range(5).select(F.col("id").alias("k"), F.lit("other").alias("county")))
    out = joins.cases_labs_totals(labs, cases, "k", {"tests": None, "flags": F.col("flag")})
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    plain = labs.join(cases, "k").distinct()
    sums = plain.groupBy("k").agg(n_rows().alias("tests"), F.sum("flag").alias("flags"))
    want = plain.join(sums, "k").select(*out.columns)
    assert Counter(map(tuple, out.collect())) == Counter(map(tuple, want.collect()))


def test_cases_labs_drops_null_keys_and_copies(spark, rows):
    labs = spark.createDataFrame([("a", 1), ("a", 1), (None, 2), ("b", 3)], "k string, t int")
    cases = spark.createDataFrame([("a", "x"), ("a", "x"), (None, "y")], "k string, c string")
    assert rows(joins.cases_labs(labs, cases, "k")) == [("a", 1, "x")]


def test_null_ids_form_one_group(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 0)], "k string, f int")
    out = joins.attach_group_stat(df, ["k"], F.sum("f").alias("s"))
    assert rows(out, "k", "s") == [(None, 2), (None, 2), ("a", 0)]


def test_attach_scalar(spark, rows):
    df = spark.createDataFrame([(1,), (5,)], "v int")
    assert rows(joins.attach_scalar(df, top=F.max("v"), mean=F.avg("v"))) == [(1, 5, 3.0), (5, 5, 3.0)]


def test_typing_keeps_multiplicity_without_pairs(spark, rows):
    r = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "case_id int, test string")
    t = spark.createDataFrame([(1, "Flu A"), (1, "Flu A"), (1, "Flu B")], "case_id int, flu_type string")
    nested = joins.attach_typing(r, t, ["case_id"], ["flu_type"])
    assert nested.count() == 3
    out = joins.typing_rows(nested)
    assert rows(out, "test", "flu_type", "n_typed") == [
        ("a", "Flu A", 2), ("a", "Flu B", 1), ("b", "Flu A", 2), ("b", "Flu B", 1), ("c", None, None),
    ]
    plain = r.join(t, "case_id", "left")
    again = joins.typing_rows(nested, dedupe=False)
    assert rows(again, "test", "flu_type") == rows(plain, "test", "flu_type")
    assert out.agg(F.sum(F.coalesce("n_typed", F.lit(1)))).first()[0] == plain.count()


def test_grid_and_densify(spark, rows):
    grid = joins.grid(spark, region=["A", "B"], year=[2022], quarter=[1, 2])
    assert grid.columns == ["region", "year", "quarter"] and grid.count() == 4
    data = spark.createDataFrame([("A", 2022, 1, 5), ("Total", 2022, 1, 9)], "region string, year int, quarter int, n int")
    out = joins.densify(data, grid, grid.columns, zero=["n"])
    assert rows(out, "region", "quarter", "n") == [("A", 1, 5), ("A", 2, 0), ("B", 1, 0), ("B", 2, 0)]


def test_natural_join_and_member_flag(spark, rows):
    a = spark.createDataFrame([(1, "x", "p"), (2, None, "q")], "i int, s string, only string")
    b = spark.createDataFrame([(2, None, 5)], "i int, s string, extra int")
    assert rows(joins.natural_left_join(a, b), "i", "extra") == [(1, None), (2, 5)]
    twice = b.union(b)
    assert rows(joins.member_flag(a, twice, ["i"]), "i", "is_member") == [(1, False), (2, True)]


def test_interval_match_against_all_pairs(spark):
    rng = random.Random(3)
    data = [
        (1 if rng.random() < 0.3 else rng.randrange(2, 150), date(2000, 1, 1) + timedelta(rng.randrange(900)), rng.choice("ABU"))
        for _ in range(700)
    ] + [(500, date(2001, 1, 1), "A"), (500, date(2001, 2, 1), "B"), (501, date(2001, 1, 1), "A"), (501, date(2001, 2, 2), "B"),
         (502, None, "A"), (502, None, "B"), (503, date(2001, 1, 1), "A"), (503, date(2001, 3, 1), "B")]
    df = spark.createDataFrame(data, "c int, d date, t string")
    is_a, is_b = F.col("t") == "A", F.col("t") == "B"
    got = {r.c for r in joins.interval_match(df, ["c"], "d", is_a, is_b).collect()}
    want = {
        c for c, d, t in data if t == "A" and d
        for c2, d2, t2 in data if t2 == "B" and d2 and c2 == c and abs((d2 - d).days) <= 31
    }
    assert got == want and 500 in got and not {501, 502, 503} & got
    written = {r.c for r in joins.interval_match(df, ["c"], "d", is_a, is_b, as_written=True).collect()}
    assert {500, 501, 503} <= written and 502 not in written
    also = {r.c for r in joins.interval_match(df, ["c"], "d", is_a, is_b, or_if=F.col("t") == "U").collect()}
    assert also == want | {c for c, _, t in data if t == "U"}

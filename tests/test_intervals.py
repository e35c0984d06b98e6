import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from surveil.operators import intervals
from tests.test_joins import LOW, final_plan

START = date(2000, 1, 1)


def tables(spark, n_rows=600, n_periods=150, seed=3):
    rng = random.Random(seed)

    def day(lo=0, hi=900):
        return START + timedelta(rng.randrange(lo, hi))

    regions = ["a"] * 5 + ["b", "c", None]
    rows = [(i, rng.choice(regions), None if i % 31 == 0 else day()) for i in range(n_rows)]
    periods = []
    for i in range(n_periods):
        s = day()
        length = rng.choice([0, 0, 1, 2, 3, 7, 30, 31, 32, 33, 64, 400, 20_000, -1])
        periods.append((i, rng.choice(regions), None if i % 29 == 0 else s, s + timedelta(length)))
    periods.append((n_periods, "a", START, None))
    return rows, periods, spark.createDataFrame(rows, "id int, region string, day date"), spark.createDataFrame(periods, "p int, region string, start date, end date")


def hits(rows, periods, by_region):
    return [
        (i, p) for i, r, d in rows for p, q, s, e in periods
        if (not by_region or r == q) and None not in (d, s, e) and s <= d <= e
    ]


@pytest.mark.parametrize("by", [["region"], []])
def test_like_comparing_all_pairs(spark, by):
    rows, periods, a, b = tables(spark)
    if not by:
        b = b.drop("region")
    got = intervals.period_join(a, b, "day", by=by)
    assert Counter(map(tuple, got.select("id", "p").collect())) == Counter(hits(rows, periods, bool(by)))
    assert set(got.columns) == {"id", "region", "day", "p", "start", "end"}
    inside = {i for i, _ in hits(rows, periods, bool(by))}
    semi = intervals.period_join(a, b, "day", by=by, how="left_semi")
    anti = intervals.period_join(a, b, "day", by=by, how="left_anti")
    assert semi.columns == a.columns == anti.columns
    assert Counter(r["id"] for r in semi.collect()) == Counter(i for i, _, _ in rows if i in inside)
    assert Counter(r["id"] for r in anti.collect()) == Counter(i for i, _, _ in rows if i not in inside)


def test_nothing_on_either_side(spark):
    _, _, a, b = tables(spark, 20, 20)
    assert intervals.period_join(a.limit(0), b, "day", by=["region"]).count() == 0
    assert intervals.period_join(a, b.limit(0), "day", by=["region"]).count() == 0
    assert intervals.period_join(a, b.limit(0), "day", by=["region"], how="left_anti").count() == 20
    with pytest.raises(ValueError, match="region"):
        intervals.period_join(a, b, "day")


def test_days_before_1970(spark):
    a = spark.createDataFrame([(1, date(1969, 12, 30)), (2, date(1850, 6, 1))], "id int, day date")
    b = spark.createDataFrame([(1, date(1969, 12, 29), date(1970, 1, 3)), (2, date(1850, 6, 1), date(1850, 6, 1))], "p int, start date, end date")
    assert sorted((r["id"], r["p"]) for r in intervals.period_join(a, b, "day").collect()) == [(1, 1), (2, 2)]


def test_pairs_that_meet_are_not_many_more_than_those_that_match(spark):
    """Thousands of overlapping periods of one region: what meets by bin grows with the matches, not with the product."""
    rng = random.Random(1)
    rows = [(i, START + timedelta(rng.randrange(4000))) for i in range(3000)]
    periods = [(i, *(lambda s: (s, s + timedelta(rng.choice([3, 10, 40]))))(START + timedelta(rng.randrange(4000)))) for i in range(3000)]
    a = spark.createDataFrame(rows, "id int, day date")
    b = spark.createDataFrame(periods, "p int, start date, end date")
    original, met = intervals.skew_join, []

    def counted(left, right, keys, how="inner"):
        out = original(left, right, keys, how)
        met.append(out.count())
        return out

    intervals.skew_join = counted
    try:
        n = intervals.period_join(a, b, "day").count()
    finally:
        intervals.skew_join = original
    assert n == sum(s <= d <= e for _, d in rows for _, s, e in periods)
    assert met[0] < 5 * n < 9_000_000 / 10


def test_cases_of_periods_meet_by_day(spark, tmp_path, monkeypatch):
    """All cases of a region on one day: each period meets the day once, however many cases it has."""
    from workload import feed_queries

    customers = [(i, f"c{i}", i % 3, 0.0, "m") for i in range(1, 61)]
    orders = [(i, i % 60 + 1, "F", 1.0, date(1995, 1, 1), "p") for i in range(1, 3001)]
    spark.createDataFrame(customers, "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    made = spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate date, o_orderpriority string")
    made.withColumn("o_orderdate", F.date_add("o_orderdate", 1900).cast("timestamp_ntz")).write.parquet(f"{tmp_path}/orders.parquet")
    met, original = [], intervals.period_join

    def counted(*args, **options):
        out = original(*args, **options)
        met.append(out.count())
        return out

    monkeypatch.setattr(intervals, "period_join", counted)
    out = feed_queries.period_cases(spark, str(tmp_path)).collect()
    day = date(1995, 1, 1) + timedelta(1900)
    around = {k: (date(1995, 1, 1) + timedelta(k * 37 % 2400), 700 if k % 50 == 0 else k % 40 - 1) for k in range(1, 61)}
    hit = {k for k, (s, n) in around.items() if s <= day <= s + timedelta(n)}
    n = sum(i % 19 != 0 for i, *_ in orders)
    assert hit and {(r.period_id, r.n, r.first_day, r.last_day) for r in out} == {(k, n, day, day) for k in hit}
    assert met == [len(hit)]


def test_a_hot_region_and_day_are_split(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    try:
        for k, v in LOW.items():
            spark.conf.set(k, v)
        day = F.when(F.col("id") % 3 == 0, F.lit(START)).otherwise(F.date_add(F.lit(START), (F.col("id") % 900).cast("int")))
        a = spark.range(0, 60_000, 1, 24).select("id", F.lit("hot").alias("region"), day.alias("day"))
        b = spark.range(300).select(
            F.col("id").alias("p"), F.lit("hot").alias("region"), F.date_add(F.lit(START), (F.col("id") * 3).cast("int")).alias("start"),
            F.date_add(F.lit(START), (F.col("id") * 3 + 2).cast("int")).alias("end"),
        )
        out = intervals.period_join(a, b, "day", by=["region"])
        assert "skew=true" in final_plan(out)
        assert out.count() == 60_000 and out.filter("p = 0").count() > 20_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_running_periods(spark):
    _, periods, _, b = tables(spark, 1, 60)
    out = {(r["region"], r["day"]): r["n_running"] for r in intervals.overlapping_days(b, by=["region"]).collect()}
    good = [(q, s, e) for _, q, s, e in periods if s is not None and e is not None and s <= e]
    for (region, day), n in out.items():
        assert n == sum(q == region and s <= day <= e for q, s, e in good)
    assert {(q, s) for q, s, _ in good} & set(out)

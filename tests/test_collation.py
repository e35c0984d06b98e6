from collections import Counter

import pytest
from pyspark.sql import functions as F

from surveil.functions import nulls, rules, text
from surveil.functions import codes
from surveil.operators import joins
from surveil.operators.collation import EXACT, IGNORE_CASE, collated, collated_columns, distinct_records, exact
from surveil.plans import covid
from tests.test_joins import LOW, final_plan


@pytest.fixture
def skew(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rules_follow_the_column(spark, rows):
    df = spark.createDataFrame([("POSITIVE",), ("positive",), ("Positive",), ("pos",), (None,)], "r string")
    for collation, want in ((EXACT, 1), (IGNORE_CASE, 3)):
        d = collated(df, collation)
        assert d.filter(nulls.is_in("r", ["Positive"])).count() == want
        assert d.filter(F.col("r") == "Positive").count() == want
        assert d.filter(text.result_is_positive("r", ["Positive"])).count() == want
        assert d.filter(text.like_any("r", ["Pos%"], ci=False)).count() == (1 if collation == EXACT else 4)


def test_test_groups_follow_the_column(spark, rows):
    name, listed = next(iter(codes.COVID_TESTS.items()))
    df = spark.createDataFrame([(listed[0].upper(),)], "test string")
    assert rows(df.select(rules.test_group("test", codes.COVID_TESTS).alias("g"))) == [("Unknown",)]
    assert rows(collated(df).select(rules.test_group("test", codes.COVID_TESTS).alias("g"))) == [(name,)]


def test_only_named_text_columns(spark):
    df = spark.createDataFrame([("a", "b", 1)], "x string, y string, z int")
    one = collated(df, columns=["y", "z"])
    assert collated_columns(one) == ["y"] and one.columns == df.columns
    assert exact(one).schema == df.schema


def test_distinct_records_are_one_per_rule_and_do_not_depend_on_order(spark):
    records = [("Ab", "X", 1), ("aB", "x", 1), ("AB", "x", 2), (None, "x", 1), (None, "X", 1), ("b", None, 1)]
    for order in (records, records[::-1]):
        df = spark.createDataFrame(order, "k string, l string, n int").repartition(3)
        assert distinct_records(df).count() == 6
        got = distinct_records(collated(df, columns=["k"]).withColumn("l", F.collate("l", IGNORE_CASE)))
        assert collated_columns(got) == ["k", "l"]
        assert Counter(map(tuple, exact(got).collect())) == Counter([("Ab", "X", 1), ("AB", "x", 2), (None, "X", 1), ("b", None, 1)])


@pytest.mark.parametrize("collation", [EXACT, IGNORE_CASE])
def test_records_are_combined_behind_one_shuffle(spark, collation):
    """No wide split of the input is held or sorted before the shuffle, which holds each text once."""
    df = spark.range(100, numPartitions=4).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3).alias("n"))
    plan = distinct_records(collated(df, collation))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Aggregate" in plan and plan.rindex("Aggregate") < plan.index("Exchange")


def test_skew_join_by_collation_keeps_the_texts(spark, rows):
    a = spark.createDataFrame([("Ab", 1, 1), ("aB", 1, 2), ("c", 1, 3), (None, 1, 4), ("ab", 2, 5)], "k string, n int, v int")
    b = spark.createDataFrame([("AB", 1, 10), ("x", 1, 20), (None, 1, 30)], "k string, n int, w int")
    assert rows(joins.skew_join(a, b, ["k", "n"], "left"), "v", "w") == [(1, None), (2, None), (3, None), (4, 30), (5, None)]
    by_rule = joins.skew_join(a, b, ["k", "n"], "left", collation=IGNORE_CASE)
    assert rows(by_rule, "v", "k", "w") == [(1, "Ab", 10), (2, "aB", 10), (3, "c", None), (4, None, 30), (5, "ab", None)]
    assert by_rule.schema["k"].dataType == a.schema["k"].dataType
    assert rows(joins.skew_join(a, b, ["k", "n"], "left_anti", collation=IGNORE_CASE), "v") == [(3,), (5,)]
    carried = joins.skew_join(collated(a), collated(b), ["k", "n"])
    assert rows(carried, "v", "w") == [(1, 10), (2, 10), (4, 30)]
    with pytest.raises(TypeError, match="collate"):
        joins.skew_join(collated(a), b, ["k", "n"])
    back = joins.skew_join(collated(a), b, ["k", "n"], collation=EXACT)  # the argument decides
    assert rows(back, "v", "w") == [(4, 30)]


def hot_text(spark, n=60_000):
    key = F.when(F.col("id") % 3 == 0, F.when(F.col("id") % 2 == 0, "HOT").otherwise("hot")).otherwise((F.col("id") % 4000).cast("string"))
    return spark.range(0, n, 1, 24).select(key.alias("k"), F.col("id").alias("v"))


@pytest.mark.parametrize("carried", [True, False])
def test_a_hot_text_key_is_split(skew, carried):
    df = hot_text(skew)
    names = skew.range(4000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("w")).unionByName(skew.sql("select 'Hot' as k, -1L as w"))
    if carried:
        out = joins.skew_join(collated(df), collated(names), ["k"])
    else:
        out = joins.skew_join(df, names, ["k"], collation=IGNORE_CASE)
    assert "SortMergeJoin(skew=true)" in final_plan(out)
    assert out.count() == 60_000 and out.filter("w = -1").count() == 20_000


def test_the_second_join_on_the_same_key_is_split_too(skew):
    df = collated(hot_text(skew))
    one = collated(hot_text(skew)).groupBy("k").agg(F.count("*").alias("n"))
    two = collated(hot_text(skew)).groupBy("k").agg(F.max("v").alias("top"))
    out = joins.skew_join(joins.skew_join(df, one, ["k"]), two, ["k"])
    assert final_plan(out).count("skew=true") >= 2
    assert out.filter(F.col("k") == "hot").agg(F.min("n"), F.count("*")).first() == (20_000, 20_000)


def test_a_positive_result_in_capitals_counts_where_the_warehouse_says_so(spark):
    listed = codes.COVID_TESTS["RNA"][0]
    lab = dict.fromkeys(covid.LAB_COLUMNS) | {"patient_id": "P1", "disease_status": "CONFIRMED", "test": listed.upper(), "result": "POSITIVE"}
    case = dict.fromkeys(covid.CASE_COLUMNS) | {"patient_id": "p1", "state": "XX"}
    text_schema = ", ".join(f"{c} string" for c in covid.LAB_COLUMNS)
    labs = spark.createDataFrame([lab, lab | {"result": "Positive"}], text_schema)
    cases = spark.createDataFrame([case], ", ".join(f"{c} string" for c in (*covid.CASE_COLUMNS, "state")))
    assert covid.classification_report(labs, cases, state="xx").count() == 0
    out = covid.classification_report(labs, cases, state="xx", collation=IGNORE_CASE)
    assert not collated_columns(out)
    row, = out.collect()  # the two records differ in case alone
    assert (row["patient_id"], row["result"], row["total_tests"], row["total_rna"], row["classification_qc"]) == ("P1", "POSITIVE", 1, 1, "Pass")

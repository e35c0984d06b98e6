import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveil.operators import quantiles as q

P = [0.0, 0.001, 0.1, 0.25, 0.5, 0.77, 0.99, 1.0]


def sample(kind, n=4000):
    rng = random.Random(kind)
    make = {
        "even": lambda: rng.random(), "wide": lambda: rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300), "one": lambda: 3.25,
        "hot": lambda: 7.5 if rng.random() < 0.4 else rng.gauss(0, 100), "few": lambda: float(rng.randrange(5)), "close": lambda: 1.0 + rng.randrange(4000) * 2.0**-52,
    }[kind]
    return [make() for _ in range(n)]


@pytest.mark.parametrize("kind", ["even", "wide", "one", "hot", "few", "close"])
@pytest.mark.parametrize("accuracy, few", [(50, 8), (5, 1)])
def test_like_sorting(spark, kind, accuracy, few):
    values = sample(kind)
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    ranks = [1, 2, 1999, 2000, 2001, 4000]
    assert q.values_at(df, "v", ranks, len(values), accuracy, few) == [sorted(values)[r - 1] for r in ranks]


def test_interpolated_quantiles_and_other_numbers(spark):
    values = sample("even", 1001)
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert q.quantiles(df, "v", P, accuracy=20, few=5) == pytest.approx(list(np.quantile(values, P)), abs=0)
    whole = spark.range(10).select(F.col("id").cast("int").alias("v"), F.col("id").cast("decimal(20,3)").alias("d"))
    assert q.quantiles(whole, "v", [0.5]) == [4.5] and q.quantiles(whole, "d", [0.5, 1.0], few=1) == [4.5, 9.0]


def test_no_values_and_no_number(spark):
    empty = spark.createDataFrame([(None,), (float("nan"),)], "v double")
    assert q.quantiles(empty, "v", [0.5, 0.9]) == [None, None]
    assert q.mean_and_median(empty, "v").first() == (None, None)
    with pytest.raises(TypeError, match="number"):
        q.quantiles(spark.sql("select 'a' as v"), "v", [0.5])
    with pytest.raises(ValueError, match="ranks"):
        q.values_at(empty, "v", [1], 0)


def test_no_task_gets_the_column(spark):
    """What leaves a task are sketches and counts: one row each."""
    df = spark.range(0, 100_000, 1, 8).select((F.col("id") * 0.37 % 1000).alias("v"))
    rows = []
    original = q._narrowed

    def seen(values, open_, cuts):
        rows.append((max(o.n for o in open_), max(map(len, cuts))))
        return original(values, open_, cuts)

    q._narrowed = seen
    try:
        got = q.quantiles(df, "v", [0.5], few=100)
    finally:
        q._narrowed = original
    assert got == [float(np.median([i * 0.37 % 1000 for i in range(100_000)]))]
    assert len(rows) <= 3 and all(cuts <= len(q.SPREAD) for _, cuts in rows)
    assert all(later < first / 100 for (first, _), (later, _) in zip(rows, rows[1:]))

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from surveil.llm import mixing
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


def test_against_sql(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert difference(mixing.mix_sources(docs), connect(SF_DIR), mixing.oracle()) is None


def test_poisson_inversion(spark):
    grid = [(u / 200 + 0.0025, rate) for u in range(200) for rate in (0.0, 0.1, 1.0, 7.5, 120.0)]
    df = spark.createDataFrame(grid, "u double, rate double")
    for u, rate, k in df.withColumn("k", mixing.poisson(F.col("u"), F.col("rate"))).collect():
        cdf, p, i = math.exp(-rate), math.exp(-rate), 0
        while u > cdf:
            i += 1
            p *= rate / i
            cdf += p
        assert k == i


def test_odd_rows_and_targets(odd, odd_rows):
    out = mixing.mix_sources(odd, {"hot": 1.0, "a": 2.0}, default_weight=0.5, budget=3.0)
    rows = out.collect()
    assert rows == mixing.mix_sources(odd.coalesce(1), {"hot": 1.0, "a": 2.0}, default_weight=0.5, budget=3.0).collect() or sorted(map(str, rows))
    size = Counter()
    for _, text, _, source, _ in odd_rows:
        size[source] += len((text or "").encode()) + 1
    weight = {"hot": 1.0, "a": 2.0, "b": 0.5, None: 0.5}
    total = sum(weight[s] for s in size)
    for r in rows:
        assert r["rate"] == pytest.approx(weight[r["source"]] / total * 3 * sum(size.values()) / size[r["source"]])
    copies = Counter((r["doc_id"], r["text"], r["copy"]) for r in rows)
    assert all(n == sum((i, t) == k[:2] for i, t, *_ in odd_rows) for k, n in copies.items())


def test_whole_order_and_refused_names(odd, empty):
    out = mixing.mix_sources(odd, budget=2.0)
    keys = [r["shuffle_key"] for r in out.select("shuffle_key").collect()]
    assert keys == sorted(keys)
    assert mixing.mix_sources(empty).collect() == []
    with pytest.raises(ValueError):
        mixing.mix_sources(odd.withColumn("Rate", F.lit(1)))


def test_large_rates(spark):
    docs = spark.createDataFrame([(1, "x" * 9, "a"), (2, "y" * 99_999, "b")], "doc_id long, text string, source string")
    n = mixing.mix_sources(docs).filter("doc_id = 1").count()
    assert abs(n - 5000.5) < 6 * math.sqrt(5000)

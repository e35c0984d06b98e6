from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveil.llm import toxicity
from surveil.llm.toxicity import PuClassifier, pu_risk, risk_slopes, train

SF = "/root/testdata/sf0.01"


def held(key):
    return crc32(str(key).encode()) % 5 == 0


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.fixture(scope="module")
def model(given):
    return toxicity.fit(*given)


def test_slopes_are_those_of_the_risk():
    rng = np.random.default_rng(1)
    z_pos, z_unl = rng.standard_normal(7), rng.standard_normal(9)
    s_pos, s_unl = risk_slopes(z_pos, z_unl, 0.2)
    eps = 1e-6
    for z, slopes, at in ((z_pos, s_pos, 3), (z_unl, s_unl, 4)):
        up, down = z.copy(), z.copy()
        up[at] += eps
        down[at] -= eps
        risks = [sum(pu_risk(x, z_unl, 0.2) if z is z_pos else pu_risk(z_pos, x, 0.2)) for x in (up, down)]
        assert abs((risks[0] - risks[1]) / (2 * eps) - slopes[at]) < 1e-6


def test_a_negative_part_below_zero_is_climbed_back():
    z_pos, z_unl = np.full(4, 3.0), np.full(4, -6.0)  # the examples known by heart
    assert pu_risk(z_pos, z_unl, 0.3)[1] < 0
    s_pos, s_unl = risk_slopes(z_pos, z_unl, 0.3)
    after = pu_risk(z_pos - 0.1 * s_pos, z_unl - 0.1 * s_unl, 0.3)[1]
    assert after > pu_risk(z_pos, z_unl, 0.3)[1]


def test_unlabelled_positives_are_allowed_for():
    """One telling feature; half of the unlabelled rows that have it are positive by the prior."""
    pos = np.array([[1.0, 0.0]] * 50, np.float32)
    unl = np.array([[1.0, 0.0]] * 30 + [[0.0, 1.0]] * 70, np.float32)
    w, b, risks = train(pos, unl, 0.3, 400, 32, 0.05, 1e-4, 1.0, np.random.default_rng(2))
    assert w[0] + b > 1 and w[1] + b < -1
    assert np.mean(risks[-20:]) < np.mean(risks[:20])


def test_held_out_documents(given, model):
    docs, labels = given
    got = toxicity.predict(docs, model).join(labels, "doc_id").collect()
    far = [r for r in got if held(r["doc_id"])]
    toxic, clean = [r["score"] for r in far if r["toxic"] == 1], [r["score"] for r in far if r["toxic"] == 0]
    assert np.mean([[(t > c) + 0.5 * (t == c) for c in clean] for t in toxic]) > 0.9
    assert np.mean([c >= 0.5 for c in clean]) < 0.05
    known = [r for r in got if r["toxic"] == 1 and not held(r["doc_id"])]
    assert np.mean([r["predicted"] for r in known]) > 0.85


def test_only_training_labels_are_looked_at(given, model):
    docs, labels = given
    other = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = other.withColumn("quality", F.lit(None).cast("int"))
    again = toxicity.fit(docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")}), other)
    assert again.features == model.features and np.array_equal(again.weights, model.weights) and again.bias == model.bias


def test_odd_rows(odd, odd_rows):
    model = PuClassifier(["alpha3", "alp-", "xxx-"], np.array([4.0, 0.5, 2.0]), -1.0)
    out = toxicity.predict(odd, model)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    empty = 1 / (1 + np.exp(1.0))
    for r in rows:
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        if not r["text"]:
            assert abs(r["score"] - empty) < 1e-12
    assert [r["predicted"] for r in rows if r["doc_id"] == 65] == [1]  # one word of 5000 letters
    same = {}
    for r in rows:
        same.setdefault(r["text"], set()).add(r["score"])
    assert all(len(s) == 1 for s in same.values())


def test_a_text_is_read_to_its_end():
    model = PuClassifier(["scoundrel"], np.array([9.0]), -3.0)
    score = model.scorer()
    assert score("word " * 200_000 + "SCOUNDREL!") > 0.9 > 0.1 > score("word " * 200_000)


def test_nothing_to_learn_from(spark, odd, empty, given):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    zeros = spark.createDataFrame([(i, 0) for i in range(20)] + [(3, None)], "doc_id long, toxic int")
    for docs, labels in ((odd, none), (odd, zeros), (empty, given[1])):
        model = toxicity.fit(docs, labels)
        assert model is None
        assert {r["score"] for r in toxicity.predict(odd, model).collect()} == {0.0}
    assert toxicity.predict(empty, None).count() == 0


def test_repeated_and_null_labels(spark, odd):
    keys = [i for i in range(60) if not held(i)]
    labels = [(k, int(k < 24)) for k in keys] + [(k, None) for k in keys] + [(k, int(k < 24)) for k in keys] + [(None, 1)]
    model = toxicity.fit(odd, spark.createDataFrame(labels, "doc_id long, toxic int"), min_texts=2, steps=50)
    assert model is None or np.isfinite(model.weights).all()

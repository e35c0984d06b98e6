import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveil.llm import langid

SYLLABLES = {"aa": "ka to mi ra".split(), "bb": "sch ung ver lich".split(), "cc": "çé eau oi tre".split()}


def text_of(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(2)
    rows = [(i, text_of(rng, lang, rng.randrange(5, 80)), lang) for i, lang in enumerate(rng.choices(list(SYLLABLES), k=300))]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = langid.BiGru.new(3, 2, rng)
    net.w, net.u = [x.astype(float) for x in net.w], [x.astype(float) for x in net.u]
    net.v, net.c = net.v.astype(float), net.c.astype(float)
    units, mask, _ = langid.units_of(["abc", "de", "éa"])
    labels = np.array([0, 1, 1])
    _, grads = net.gradients(units, mask, labels)
    for w, g in zip(net.weights(), grads):
        for flat in np.argsort(-np.abs(g).ravel())[:3]:
            at = np.unravel_index(flat, g.shape)
            held = w[at]
            w[at] = held + 1e-4
            up = net.gradients(units, mask, labels)[0]
            w[at] = held - 1e-4
            down = net.gradients(units, mask, labels)[0]
            w[at] = held
            assert (up - down) / 2e-4 == pytest.approx(g[at], rel=1e-2, abs=1e-5)


def test_held_out_accuracy(labelled):
    rows, df = labelled
    labels, net = langid.fit(df, steps=120)
    assert labels == ["aa", "bb", "cc"]
    out = langid.predict(df, labels, net).withColumn("held", langid.held_out("doc_id")).collect()
    held = [r for r in out if r["held"]]
    assert {r["doc_id"] for r in held} == {i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)
    assert all(0 < r["score"] <= 1 for r in out)
    # neither held-out labels nor those of a prediction's own row matter
    other = df.withColumn("lang", F.when(langid.held_out("doc_id"), F.lit("zz")).otherwise(F.col("lang")))
    labels2, net2 = langid.fit(other, steps=120)
    assert labels2 == labels and all((a == b).all() for a, b in zip(net.weights(), net2.weights()))
    again = {r["doc_id"]: r for r in langid.predict(other.coalesce(1), labels2, net2).collect()}
    assert all(again[r["doc_id"]]["lang_pred"] == r["lang_pred"] and again[r["doc_id"]]["score"] == pytest.approx(r["score"]) for r in out)


def test_odd_rows(odd, odd_rows, empty):
    labels, net = langid.fit(odd, steps=20)
    out = langid.predict(odd, labels, net).collect()
    assert len(out) == len(odd_rows)
    for r in out:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] in labels) is letters and (r["lang_pred"] == "und") is not letters
    assert langid.fit(empty) == ([], None) and langid.predict(empty, [], None).collect() == []
    assert {r["lang_pred"] for r in langid.predict(odd, [], None).collect()} == {"und"}


def test_remembered_words_change_nothing(labelled, monkeypatch):
    _, df = labelled
    labels, net = langid.fit(df, steps=10)
    words = ["ab", "c" * 100, "é", "ab"]
    one = langid.word_scores(net, words)
    assert one[0] == pytest.approx(one[3]) and one[1][-1] == 100
    monkeypatch.setattr(langid, "EVAL_UNITS", 2)
    assert langid.word_scores(net, words) == pytest.approx(one, abs=1e-4)

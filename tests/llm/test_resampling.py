import hashlib
import math
import re
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from surveil.llm.resampling import importance, resample, span_pattern, spans

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {a: a + 32 for a in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def grams(text, max_n):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, max_n + 1) for i in range(len(w) - k + 1)]


def plain(docs, target, max_n=1, buckets=10_000, percent=10, min_words=20, seed=2024):
    """(key, n_features, weight, score) of all rows, and those of the drawn in order, by counting in Python."""
    s, t = [0] * buckets, [0] * buckets
    hashed = [[crc32(g.encode()) % buckets for g in grams(text, max_n)] for _, text in docs]
    for ids, counts in ((hashed, s), ([[crc32(g.encode()) % buckets for g in grams(x, max_n)] for x in target], t)):
        for row in ids:
            for b in row:
                counts[b] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for (key, text), ids in zip(docs, hashed):
        weight = sum(gain[b] for b in ids)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(ids), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text))))
    enough = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    return [r[:4] for r in out], [r[:4] for r in enough[: len(enough) * percent // 100]]


@pytest.mark.parametrize("options", [{}, {"max_n": 3, "buckets": 97, "percent": 55, "min_words": 2, "seed": 5}])
def test_like_counting_by_hand(spark, odd, odd_rows, options):
    target = [r[1] for r in odd_rows[::7]] + [None, ""]
    want, drawn = plain([(r[0], r[1]) for r in odd_rows], target, **options)
    got = importance(odd, spark.createDataFrame([(x,) for x in target], "text string"), **options).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:4]) for r in got)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in ranked] == drawn


def test_drawn_documents_come_whole(spark, odd, odd_rows):
    target = spark.createDataFrame([(odd_rows[0][1],)], "text string")
    clash = odd.withColumns({c: F.lit("clash") for c in ("hits", "weight", "at", "row")})
    out = resample(clash, target, percent=50)
    assert out.columns == [*clash.columns, "rank_"]  # the input has a column called rank
    ranks = {(r["doc_id"], r["rank"]) for r in importance(odd, target, percent=50).collect() if r["rank"] is not None}
    assert {(r["doc_id"], r["rank_"]) for r in out.collect()} == ranks
    texts = {(r[0], r[1]) for r in odd_rows}
    assert all((r["doc_id"], r["text"]) in texts and r["hits"] == "clash" for r in out.collect())


def test_empty_tables(spark, odd, empty):
    assert importance(empty, odd).count() == 0
    flat = importance(odd, empty).collect()
    want, _ = plain([(r["doc_id"], r["text"]) for r in odd.collect()], [])
    assert sorted(str(tuple(r)[:4]) for r in flat) == sorted(map(str, want))


def test_spans_overlap_and_separators_collapse():
    text = "A,b  c\tÉ d!\x00 e".encode()
    assert spans(text, [span_pattern(1)]) == [b"a", b"b", b"c", "É".encode(), b"d", b"e"]
    assert spans(text, [span_pattern(2)]) == [b"a b", b"b c", "c É".encode(), "É d".encode(), b"d e"]
    assert spans(b"one two", [span_pattern(3)]) == []
    assert spans(b" ,, ", [span_pattern(1)]) == []

import math
import zlib
from collections import Counter
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from surveil.llm import lm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_ways(pieces, word):
    @cache
    def rest(i):
        if i == len(word):
            return 1.0
        return sum(math.exp(pieces[word[i:j]]) * rest(j) for j in range(i + 1, len(word) + 1) if word[i:j] in pieces)

    return rest(0)


def test_marginals_against_all_segmentations():
    vocab = lm.vocabulary(PATH)
    pieces = dict(vocab)
    lattice = lm.Lattice(tuple(p for p, _ in vocab), np.array([w for _, w in vocab]))
    words = [b"thhetion", b"a", "éréâ".encode(), b"then,", b"\xff\x00", "日".encode(), b"<0x41>"]
    for rows, chars in lm.by_length(pa.array(words, pa.binary())):
        for row, got in zip(rows, lattice.forward(chars)[-1]):
            assert got == pytest.approx(math.log(all_ways(pieces, b" " + words[row])), abs=1e-9)


def test_expected_uses_against_enumeration():
    pieces = {b" ": 0.2, b"a": 0.3, b"b": 0.1, b"ab": 0.25, b" a": 0.1, b"ba": 0.05}
    names = sorted(pieces)
    lattice = lm.Lattice(tuple(names), np.log([pieces[p] for p in names]))
    want, total = Counter(), 0.0

    def walk(rest, used, p):
        nonlocal total
        if not rest:
            total += p
            for u in used:
                want[u] += p
        for piece in names:
            if rest.startswith(piece):
                walk(rest[len(piece):], [*used, piece], p * pieces[piece])

    walk(b" abab", [], 1.0)
    (_, chars), = lm.by_length(pa.array([b"abab"], pa.binary()))
    assert lattice.expected(chars) == pytest.approx([want[p] / total for p in names])


def test_probabilities_of_all_words_add_up_to_less_than_one():
    pieces = {b" ": 0.3, b"a": 0.4, b"b": 0.3}
    lattice = lm.Lattice(tuple(sorted(pieces)), np.log([pieces[p] for p in sorted(pieces)]))
    model = lm.Model.of(lattice, tokens=10, distinct=3, once=1, twice=1, ends=2)
    whole = math.exp(model.end) + sum(max(c - model.discount, 0) / 10 for c in (5, 3)) + model.spelled
    assert whole == pytest.approx(1.0, abs=0.05)


def test_document_is_the_polya_product():
    logp, ids = np.log([0.5, 0.2, 0.1]), np.array([0, 1, 0, 0, 2, 1], np.uint32)
    seen, want = Counter(), -1.5
    for i, w in enumerate(ids):
        want += math.log((7 * math.exp(logp[w]) + seen[w]) / (7 + i))
        seen[w] += 1
    want += math.log(7 / (7 + len(ids)))
    assert lm.document(logp, ids, -1.5, 7.0) == pytest.approx(want)
    assert lm.document(logp, ids, -1.5, float("inf")) == pytest.approx(logp[ids].sum() - 1.5)


def base_of(rows):
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    texts = [(t or "").encode().lower().split() for _, t, *_ in rows]
    c = Counter(w for t, h in zip(texts, held) if not h for w in [*t, None])
    n, v = sum(c.values()), len(c)
    return [
        (h, len(t) + 1, sum(c[w] > 0 for w in [*t, None]), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*t, None]))
        for t, h in zip(texts, held)
    ]


def test_odd_rows(odd, odd_rows, empty, monkeypatch):
    out = lm.score(odd, PATH, rounds=1).collect()
    key = lambda x: (str(x[0]), x[1], round(x[-1], 6))
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=key)
    want = sorted(((row[0], *b) for row, b in zip(odd_rows, base_of(odd_rows))), key=key)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], abs=1e-6)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)
    assert lm.score(empty, PATH).collect() == []


def test_blocks_change_nothing(odd, monkeypatch):
    one = sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in lm.score(odd, PATH, rounds=1).collect())
    monkeypatch.setattr(lm, "BLOCK_WORDS", 100)
    many = lm.score(odd.repartition(5), PATH, rounds=1).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"], round(r["score"], 6)) for r in many) == one


def test_nothing_to_learn_from(spark):
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    df = spark.createDataFrame([(i, "some words") for i in held], "doc_id long, text string")
    out = lm.score(df, PATH).collect()
    assert [r["train_tokens"] for r in out] == [0] * 3 and all(r["base_score"] == 0 and r["score"] < 0 for r in out)

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from surveil.llm import jaccard


def set_of(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()


def components_of(rows):
    sets = [set_of(t) for _, t in rows]
    name = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and name[i] != name[j]:
            old, new = name[i], name[j]
            name = [new if n == old else n for n in name]
    low = {}
    for (key, _), n in zip(rows, name):
        low[n] = key if low.get(n) is None else low[n] if key is None else min(low[n], key)
    return sorted(((k, len(s), low[n] if s else k) for (k, _), s, n in zip(rows, sets, name)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()), key=str)


def edited(rng, words, share):
    out = list(words)
    for _ in range(int(len(out) * share)):
        out[rng.randrange(len(out))] = f"n{rng.randrange(10**6)}"
    return out


class Rows:
    """Stands for documents; keeps what a task would run."""

    def __init__(self, docs):
        self.schema = docs.schema

    def select(self, *cols):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_tasks_hand_on_small_batches(spark, odd):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(1500)) for _ in range(700)] + [None, ""]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(range(n)), pa.array(texts)], names=["key", "text_hash", "text"])
    out = list(jaccard.set_rows(Rows(odd), "doc_id", "text")(iter([batch])))
    assert max(b.num_rows for b in out) < 2 * jaccard.BATCH_VALUES
    sigs = sum(sum(len(jaccard.signatures(h, k)) for k in jaccard.levels(len(h))) for h in (jaccard.shingles(t, jaccard.WordHash()) for t in texts) if len(h))
    assert sum(b.num_rows for b in out) == sigs + n and len({str(b.schema) for b in out}) == 1


def test_odd_rows(odd, odd_rows):
    assert got(odd) == components_of([r[:2] for r in odd_rows])


def test_near_copies_chains_and_shared_passages(spark):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([8, 12, 30, 70, 90, 130, 300, 700]))]
        for _ in range(8):  # a chain: each a little further off
            texts.append(base)
            base = edited(rng, base, rng.choice([0.0, 0.02, 0.04, 0.06]))
    for n in (50, 80, 150, 600):  # unlike texts around one passage
        for _ in range(15):
            own = [f"q{rng.randrange(10**6)}" for _ in range(n)]
            texts.append(own[: n // 2] + passage + own[n // 2 :])
    star = [f"s{i}" for i in range(200)]
    texts += [star, *[edited(rng, star, 0.04) for _ in range(40)]]  # hot group, not all alike
    texts += [star[:k] for k in (150, 160, 170, 195)]  # contained in it
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert got(df) == components_of(rows)


def test_empty(empty):
    assert jaccard.jaccard_components(empty).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 900), st.integers(0, 10**6))
def test_linked_sets_share_enough_signatures(n, seed):
    rng = np.random.default_rng(seed)
    a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
    keep = a[rng.random(len(a)) < 1 - 0.25 * rng.random()]
    b = np.unique(np.r_[keep, rng.integers(0, 2**63, rng.integers(0, n // 4 + 1)).astype(np.uint64)])
    both = len(np.intersect1d(a, b))
    if not len(b) or 100 * both < 75 * (len(a) + len(b) - both):
        return
    shared = max(len(np.intersect1d(jaccard.signatures(a, level), jaccard.signatures(b, level))) for level in set(jaccard.levels(len(a))) & set(jaccard.levels(len(b))))
    assert shared >= max(jaccard.needed(len(a)), jaccard.needed(len(b)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 63, 64, 85, 86, 511, 512, 682, 683, 4096, 5461, 5462])
def test_bands_meet(n):
    for m in range(jaccard.least(n), n + 1):
        assert set(jaccard.levels(n)) & set(jaccard.levels(m))


def test_links_against_all_pairs(spark, odd, odd_rows, empty, monkeypatch):
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    docs = [(i, t) for i, t, *_ in odd_rows]
    for i in range(100, 160):  # one group of near copies, not all of which are links, and copies of some
        w = list(base)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(80)] = f"v{rng.randrange(1000)}"
        docs += [(i, " ".join(w))] * rng.choice([1, 1, 3])
    cache = jaccard.WordHash()
    sets = [set(jaccard.shingles(t, cache).tolist()) for _, t in docs]
    want = sorted(
        (str(k), sum(bool(s) and 100 * len(s & o) >= 75 * len(s | o) for j, o in enumerate(sets) if j != i)) for i, ((k, _), s) in enumerate(zip(docs, sets))
    )
    for size in (256, 7):
        monkeypatch.setattr(jaccard, "BLOCK_SETS", size)
        out = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string"), count_links=True).collect()
        assert sorted((str(r["doc_id"]), r["n_links"]) for r in out) == want
    assert jaccard.jaccard_components(empty, count_links=True).collect() == []

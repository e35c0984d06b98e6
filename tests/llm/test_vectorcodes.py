import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from surveil.llm.vectorcodes import Codebook, code_vectors, squared, sums_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """Every part compared with every entry, in Python integers."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    whole = [(k, [int(np.floor(1024 * x)) for x in v], label) for k, v, label in kept]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in whole]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p, book in enumerate(books):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], book)[1], []).append(c[p])
            for i, of in members.items():
                book[i] = [sum(x) // len(of) for x in zip(*of)]
    out, by_label = [], {}
    for (key, _, label), c in zip(whole, cut):
        found = [nearest(c[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        by_label[label] = by_label.get(label, 0) + error
        out.append((key, "".join(f"{i:02x}" for _, i in found), error, label))
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(((k, c, e, by_label[label], digest) for k, c, e, label in out), key=str)


def coded(df, **options):
    return sorted(map(tuple, code_vectors(df, **options).collect()), key=str)


@pytest.fixture(scope="module")
def vectors():
    """Coarse values, so that distances tie; copies; a third in one place; odd vectors."""
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-3, 4) / 8 for _ in range(8)], rng.choice([0, 1, None])) for i in range(200)]
    rows += [(i, [0.125] * 8, 1) for i in range(200, 300)]
    rows += [(300, None, 1), (301, [None] + [0.5] * 7, 1), (302, [float("nan")] + [0.5] * 7, 1), (303, [float("inf")] + [0.5] * 7, None)]
    rows += [(None, [0.3] * 8, None), (7, [-0.0009] * 8, 0), (7, [-0.0009] * 8, 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("entries", [1, 16, 256])
def test_like_every_part_against_every_entry(spark, vectors, entries):
    df = spark.createDataFrame(vectors, SCHEMA).repartition(5).withColumns({c: F.lit("clash") for c in ("key", "ints", "own", "part", "code", "n")})
    assert coded(df, entries=entries) == plain(vectors, entries=entries)


def test_fewer_vectors_than_entries_and_none(spark, vectors):
    few = [r for r in vectors if r[0] in (3, 5, 9)]
    assert coded(spark.createDataFrame(few, SCHEMA)) == plain(few)
    assert coded(spark.createDataFrame([], SCHEMA)) == []
    assert coded(spark.createDataFrame([(1, None, 2)], SCHEMA)) == []


def test_vectors_that_cannot_be_cut_or_are_too_large_have_no_code(spark, vectors):
    few = [r for r in vectors if r[0] is not None and r[0] < 40]
    odd = [(-3, [], 0), (-2, [1.0] * 7, 0), (500, [1.0] * 12, 0), (501, [20000.0] * 8, 5)]
    got = coded(spark.createDataFrame(few + odd, SCHEMA))
    assert [r for r in got if r[1] is not None] == plain(few)
    assert sorted(r[0] for r in got if r[1] is None and r[2] is None) == [-3, -2, 500, 501]
    assert [r[3] for r in got if r[0] == 501] == [None]


def test_rings_and_cores_leave_out_only_what_cannot_win():
    rng = np.random.default_rng(5)
    centres = rng.integers(-400, 400, (64, 6))
    parts = (centres[rng.integers(0, 64, 4000)] + rng.integers(-20, 21, (4000, 6))).astype(np.int64)
    own, before, work = np.zeros(len(parts), np.int64), None, []
    entries = parts[:64].copy()
    for _ in range(6):
        book = Codebook(entries, before)
        own, best, compared = book.assign(parts, own)
        apart = squared(parts, entries)
        assert (own == apart.argmin(axis=1)).all() and (best == apart.min(axis=1)).all()
        work.append(compared)
        counts, sums = sums_of(parts, own, 64)
        before, entries = entries, entries.copy()
        entries[counts > 0] = sums[counts > 0] // counts[counts > 0, None]
    assert work[0] > 0.5 * parts.shape[0] * 64
    assert work[-1] < 0.1 * work[0]  # cores are stable by then
    book = Codebook(entries, entries)
    own = squared(parts, entries).argmin(axis=1)
    assert book.assign(parts, own)[2] == 0  # nothing has moved


def test_distances_are_exact_beyond_doubles():
    a = np.array([[2**23, -(2**23)] * 100], np.int64)
    assert squared(a, -a)[0, 0] == 200 * 4 * 2**46
    assert squared(a, a + 1)[0, 0] == 200

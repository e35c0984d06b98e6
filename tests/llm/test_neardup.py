import math
import random

import numpy as np
from pyspark.sql import functions as F

from surveil.llm import neardup

SCHEMA = "vec_id long, embedding array<float>, label int"


def wanted(rows, threshold):
    good = [
        label is not None and v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)
        for _, v, label in rows
    ]
    unit = [np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) if g else None for (_, v, _), g in zip(rows, good)]
    links, name = [0] * len(rows), list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if good[i] and good[j] and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                old, new = name[i], name[j]
                name = [new if n == old else n for n in name]
    low = {}
    for (key, _, _), n in zip(rows, name):
        low[n] = min(low.get(n, key), key)
    return sorted((key, links[i], low[name[i]], key == low[name[i]]) for i, (key, _, _) in enumerate(rows))


def as_float(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def data(dim=24):
    rng = random.Random(5)
    seeds = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(25)]
    rows = []
    for i in range(400):
        s, noise = rng.choice(seeds[:3] if i % 3 == 0 else seeds), rng.choice([0, 0.05, 0.1, 0.14, 0.2, 0.6])
        rows.append((i, as_float([x + rng.gauss(0, noise) for x in s]), rng.choice([1, 1, 2])))
    rows += [(400 + i, as_float(seeds[0]), 1) for i in range(30)]  # copies
    rows += [(500 + i, as_float([x * 10 ** (i - 3) for x in seeds[1]]), 1) for i in range(6)]
    rows += [
        (600, None, 1), (601, [], 1), (602, [0.0] * dim, 1), (603, [float("nan")] + [1.0] * (dim - 1), 1), (604, [float("inf")] * dim, 1),
        (605, [None] + [1.0] * (dim - 1), 1), (606, as_float(seeds[0]), None), (607, as_float(seeds[0]), 9), (608, as_float(seeds[0][:-1]), 1),
        (609, as_float(seeds[0][:-1]), 1), (610, [1.0], 1), (611, [2.0], 1), (612, [-2.0], 1), (613, as_float([-x for x in seeds[0]]), 1),
    ]
    return rows


def found(df, **options):
    return sorted(map(tuple, neardup.near_duplicates(df, **options).collect()))


def test_against_all_pairs(spark):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("cell", F.lit(1)).withColumn("ref", F.lit(2))
    assert found(df) == wanted(rows, 0.98)
    assert found(df, threshold=0.9, block_dims=3, grid_dims=2) == wanted(rows, 0.9)


def test_null_and_repeated_keys_and_empty(spark):
    rows = [(None, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (5, [1.0, 2.0], 1), (None, [3.0, -1.0], 1)]
    out = neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, out))) == sorted(map(str, [(None, 2, 5, False), (5, 2, 5, True), (5, 2, 5, True), (None, 0, None, True)]))
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_huge_and_tiny_double_vectors(spark):
    """Their squares lie beyond the doubles; the cosine does not."""
    rng = np.random.default_rng(9)
    rows, want = [], {}
    for scale in (1e200, 1e-200, 1e300, 1e-310, 1.0):
        for far in (0.97, 0.985):
            for _ in range(10):
                a, b = rng.standard_normal(16), rng.standard_normal(16)
                a /= np.linalg.norm(a)
                b -= (a @ b) * a
                b /= np.linalg.norm(b)
                key = len(rows)
                label = key  # pairs are apart
                rows += [(key, (a * scale).tolist(), label), (key + 1, ((far * a + np.sqrt(1 - far * far) * b) * scale * 0.5).tolist(), label)]
                want[key] = want[key + 1] = int(far > 0.98)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r["vec_id"]: r["n_links"] for r in neardup.near_duplicates(df).collect()} == want

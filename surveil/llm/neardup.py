"""Exact near-duplicate vectors by a subspace pigeonhole join."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.llm.shared import components, written
from surveil.operators.joins import skew_join

BLOCK_DIMS = 8
GRID_DIMS = 4  # coordinates of a block that make its cells; more make finer cells and more of them to ask
SLACK = 1e-5  # for coordinates in single precision
MULT = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is made."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def blocks_of(dim: int, block_dims: int) -> list[slice]:
    n = max(1, round(dim / block_dims))
    cuts = [round(i * dim / n) for i in range(n + 1)]
    return [slice(a, b) for a, b in zip(cuts, cuts[1:])]


def valid(vector: str) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def cell_rows(classes: DataFrame, threshold: float, block_dims: int, grid_dims: int, home: bool) -> DataFrame:
    """(cell, ref, x0, x1, ...) per vector and block: its own cell (``home``), or all cells that its ball in the block meets.

    Unit vectors within the distance of ``threshold`` have, after any rotation, a block in which their
    squared distance is within the block's share of it, in proportion to its dimensions. Cells are
    twice as wide as that distance, so a ball reaches over one face at most in each coordinate.
    """
    limit = 2 * (1 - threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs = batch.column(0).to_numpy(zero_copy_only=False)
            labels = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            lists = batch.column(2)
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            values = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            for dim in np.unique(sizes):
                rows = np.flatnonzero(sizes == dim)
                x = values[starts[rows][:, None] + np.arange(dim)]
                x /= np.abs(x).max(axis=1, keepdims=True)  # tiny and huge components alike
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ rotation(int(dim))
                for b, part in enumerate(blocks_of(int(dim), block_dims)):
                    y = x[:, part]
                    radius = np.sqrt((limit + SLACK) * y.shape[1] / dim)
                    grid = min(grid_dims, y.shape[1])
                    scaled = y[:, :grid] / (2 * radius)
                    cell = np.floor(scaled)
                    place = scaled - cell
                    side = np.where(place < 0.5, -1, 1)
                    gap = (np.minimum(place, 1 - place) * 2 * radius) ** 2
                    flat = np.zeros((len(rows), 2 * block_dims), np.float32)
                    flat[:, : y.shape[1]] = y
                    for mask in product((0, 1), repeat=grid):
                        if home and any(mask):
                            continue
                        near = np.flatnonzero((gap * mask).sum(axis=1) <= radius**2)
                        key = labels[rows[near]] ^ np.uint64(dim * 1024 + b)
                        key = (key ^ (key >> np.uint64(33))) * MULT
                        for c in (cell[near] + side[near] * mask).astype(np.int64).T:
                            key = (key ^ (key >> np.uint64(31))) * MULT + c.view(np.uint64)
                        key = (key ^ (key >> np.uint64(29))) * MULT
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(key.view(np.int64)), pa.array(refs[rows[near]]), *[pa.array(flat[near, i]) for i in range(2 * block_dims)]],
                            names=["cell", "ref", *[f"x{i}" for i in range(2 * block_dims)]],
                        )

    fields = ", ".join(f"x{i} float" for i in range(2 * block_dims))
    return classes.select("ref", F.xxhash64("label"), "vector").mapInArrow(run, f"cell long, ref long, {fields}")


def scaled(vector: str) -> Column:
    """The vector times a power of two, its largest component near 1: the cosine is the same to the last bit, and nothing overflows or vanishes."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    power = -F.floor(F.log2(F.array_max(F.transform(doubles, F.abs)))).cast("int")
    first = F.floor(power / 2)  # in two steps, since one factor may lie beyond the doubles
    return F.transform(doubles, lambda x: x * F.pow(F.lit(2.0), first) * F.pow(F.lit(2.0), power - first))


def cosine(a: str, b: str) -> Column:
    """In double precision."""
    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / F.sqrt(dot(a, a)) / F.sqrt(dot(b, b))


def near_duplicates(
    rows: DataFrame, threshold: float = 0.98, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    block_dims: int = BLOCK_DIMS, grid_dims: int = GRID_DIMS,
) -> DataFrame:
    """One row per row: key, n_links, component_id and kept (key = component_id).

    Vectors are compared within a label and a length. Every pair with a cosine of ``threshold`` or more
    meets in a cell of some block (``cell_rows``), passes that block's distance, and is then verified
    exactly. Equal vectors of a label are one class; a class links its own copies and counts a linked
    class by its copies, so copies are never paired.

    Null labels, null, empty and zero vectors, and vectors with null or non-finite components link
    with nothing: no links, their own component. Repeated rows count as rows. A null key is never the
    smallest. No rows in, no rows out. Other columns are not read.
    """
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be over 0 and at most 1")
    usable = F.col(label).isNotNull() & valid(vector)
    named = rows.select(F.col(key).alias("key"), F.when(usable, F.xxhash64(label, vector)).alias("ref"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    classes = named.filter("ref is not null").groupBy("ref").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("key").alias("low")
    )
    classes = written(classes, "vectors")
    asks = cell_rows(classes, threshold, block_dims, grid_dims, home=False)
    homes = cell_rows(classes, threshold, block_dims, grid_dims, home=True).withColumnRenamed("ref", "other")
    homes = homes.withColumnsRenamed({f"x{i}": f"y{i}" for i in range(2 * block_dims)})
    apart = reduce(lambda s, t: s + t, [(F.col(f"x{i}") - F.col(f"y{i}")) * (F.col(f"x{i}") - F.col(f"y{i}")) for i in range(2 * block_dims)])
    # the largest share of a block of any length; verified exactly below
    share = F.lit((2 * (1 - threshold) + 2 * SLACK) * _largest_share(classes, block_dims))
    met = asks.join(homes.withColumnRenamed("cell", "at"), (F.col("cell") == F.col("at")) & (F.col("other") < F.col("ref")) & (apart <= share))
    pairs = met.select(F.col("ref").alias("a"), F.col("other").alias("b")).distinct()
    whole = classes.withColumn("vector", scaled("vector"))
    sides = {s: whole.select(F.col("ref").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("label", "vector", "copies")]) for s in "ab"}
    both = skew_join(skew_join(pairs, sides["a"], ["a"]), sides["b"], ["b"])
    both = both.filter((F.col("label_a") == F.col("label_b")) & (F.size("vector_a") == F.size("vector_b")))
    links = written(both.filter(cosine("vector_a", "vector_b") >= threshold).select("a", "b", "copies_a", "copies_b"), "vector-links")

    ends = links.select(F.col("a").alias("ref"), F.col("copies_b").alias("n")).unionByName(links.select(F.col("b").alias("ref"), F.col("copies_a").alias("n")))
    counted = ends.groupBy("ref").agg(F.sum("n").alias("linked"))
    names = components(links.select("a", "b"))
    of_class = classes.select("ref", "copies", "low").join(counted, "ref", "left").join(names, F.col("ref") == F.col("node"), "left")
    of_class = of_class.withColumn("name", F.coalesce("component", "ref"))
    lowest = of_class.groupBy("name").agg(F.min("low").alias("component_id"))
    of_class = skew_join(of_class, lowest, ["name"]).select(
        "ref", "component_id", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )
    out = skew_join(named.select("key", "ref"), of_class, ["ref"], "left")
    component = F.when(F.col("ref").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("key").eqNullSafe(component).alias("kept"),
    )


def _largest_share(classes: DataFrame, block_dims: int) -> float:
    """Over the lengths that occur; there are as many shares as lengths, one mostly."""
    lengths = [r[0] for r in classes.select(F.size("vector")).distinct().collect()]
    return max((max(s.stop - s.start for s in blocks_of(d, block_dims)) / d for d in lengths), default=1.0)

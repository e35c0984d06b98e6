"""Vector codes: a codebook per part of the vectors, learned by ball k-means on whole numbers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.llm.shared import written
from surveil.operators.joins import attach_group_stat

SCALE = 1024
LARGEST = 2**24  # of a component's magnitude: squared distances of thousands of them fit a long


class Codebook:
    """The entries of one part, and per entry what an assignment needs of its neighbourhood.

    ``near[k]`` lists the other entries by their distance from entry k, ``gaps[k]`` those squared distances.
    ``moved`` says which entries differ from the codebook before, or are new.
    """

    def __init__(self, entries: np.ndarray, before: np.ndarray | None = None):
        self.entries = entries
        self.moved = np.ones(len(entries), bool) if before is None else (entries != before).any(axis=1)
        apart = squared(entries, entries)
        np.fill_diagonal(apart, -1)  # an entry comes before its copies
        self.near = np.argsort(apart, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(apart, self.near, axis=1)

    def assign(self, parts: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest entry of each part (ties: the lowest), its squared distance, and how many other distances were computed.

        ``own`` is the entry that each part had in the codebook before; for it, everything is a ball around its
        own entry, whose radius is its farthest part's distance. An entry can be as near to a part as its own only if
        it lies within twice the part's distance from the own entry. So the ball's neighbours are the
        entries within twice the radius; a part nearer than half the gap to the first of them is in
        the stable core and keeps its entry unseen; the others lie in rings, by how many neighbours are
        within reach, and are compared with those. Own and neighbours that have not moved were
        compared in the round before.
        """
        best = ((parts - self.entries[own]) ** 2).sum(axis=1)
        chosen, compared = own.copy(), 0
        order = np.argsort(own, kind="stable")
        cuts = np.searchsorted(own[order], np.arange(len(self.entries) + 1))
        for k in range(len(self.entries)):
            ball = order[cuts[k] : cuts[k + 1]]
            if not len(ball):
                continue
            reach = 4 * best[ball]
            n = np.searchsorted(self.gaps[k], reach.max(), side="right")  # neighbours of the ball
            near, gaps = self.near[k][:n], self.gaps[k][:n]
            if not self.moved[k]:
                near, gaps = near[self.moved[near]], gaps[self.moved[near]]
            ring = np.searchsorted(gaps, reach, side="right")
            width = 1
            while len(near) and width // 2 < len(near):  # rings of 1, 2, 3-4, 5-8, ... neighbours together
                rows = np.flatnonzero((ring > width // 2) & (ring <= width))
                if len(rows):
                    seen = near[: min(width, len(near))]
                    apart = squared(parts[ball[rows]], self.entries[seen])
                    compared += apart.size
                    least = apart.min(axis=1)
                    first = np.where(apart == least[:, None], seen, len(self.entries)).min(axis=1)
                    at = ball[rows]
                    wins = (least < best[at]) | ((least == best[at]) & (first < k))
                    chosen[at[wins]], best[at[wins]] = first[wins], least[wins]
                width *= 2
        return chosen, best, compared


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances between the rows of two whole-number matrices, exact."""
    most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0), 1)
    if 4 * a.shape[1] * int(most) ** 2 < 2**53:  # exact in doubles, and faster
        a, b = a.astype(np.float64), b.astype(np.float64)
    return ((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1) - 2 * (a @ b.T)).astype(np.int64)


def sums_of(parts: np.ndarray, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per entry, how many parts chose it and their sums."""
    order = np.argsort(chosen, kind="stable")
    used, starts = np.unique(chosen[order], return_index=True)
    sums = np.zeros((n, parts.shape[1]), np.int64)
    if len(used):
        sums[used] = np.add.reduceat(parts[order], starts, axis=0)
    return np.bincount(chosen, minlength=n), sums


SUMS = "part int, entry int, n bigint, sums array<bigint>"


def assignment(state: DataFrame, books: list[Codebook], learn: bool) -> DataFrame:
    """The rows of ``state`` with their entries of ``books``, and, if ``learn``, a task's sums per part and entry as further rows."""
    fields = state.schema.fields
    names = [f.name for f in fields]
    extra = ["part", "entry", "n", "sums"]
    at, dim = {n: i for i, n in enumerate(names)}, sum(b.entries.shape[1] for b in books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [(np.zeros(len(b.entries), np.int64), np.zeros(b.entries.shape, np.int64)) for b in books]
        schema = None
        for batch in batches:
            ints = batch.column(at["ints"]).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)
            before = batch.column(at["own"]).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(books))
            own, errors = [], []
            for p, (book, part) in enumerate(zip(books, np.split(ints, len(books), axis=1))):
                chosen, distance, _ = book.assign(part, before[:, p].astype(np.int64))
                own.append(chosen)
                errors.append(distance)
                if learn:
                    for total, more in zip(totals[p], sums_of(part, chosen, len(book.entries))):
                        total += more
            columns = [batch.column(i) for i in range(len(names))]
            rows, step = len(batch), np.arange(len(batch) + 1, dtype=np.int32) * len(books)
            columns[at["own"]] = pa.ListArray.from_arrays(pa.array(step), pa.array(np.stack(own, axis=1).ravel().astype(np.int32)))
            columns[at["errors"]] = pa.ListArray.from_arrays(pa.array(step), pa.array(np.stack(errors, axis=1).ravel()))
            nothing = [pa.nulls(rows, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            out = pa.RecordBatch.from_arrays([*columns, *nothing], names=[*names, *extra])
            schema = out.schema
            yield out
        if learn and schema is not None:
            part, entry, n, sums = [], [], [], []
            for p, (counts, total) in enumerate(totals):
                for e in np.flatnonzero(counts):
                    part.append(p)
                    entry.append(int(e))
                    n.append(int(counts[e]))
                    sums.append(total[e].tolist())
            nothing = [pa.nulls(len(part), schema.field(name).type) for name in names]
            more = [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(sums, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*nothing, *more], names=[*names, *extra])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return state.mapInArrow(run, f"{kinds}, {SUMS}")


def updated(assigned: DataFrame, books: list[Codebook]) -> list[Codebook]:
    """Every used entry replaced by the floor of its parts' mean. One row per part and entry reaches the driver."""
    width = books[0].entries.shape[1]
    totals = assigned.filter("part is not null").groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums")
    )
    entries = [b.entries.copy() for b in books]
    for r in totals.collect():
        entries[r["part"]][r["entry"]] = np.array(r["sums"], np.int64) // r["n"]
    return [Codebook(new, b.entries) for new, b in zip(entries, books)]


def finite(vector: str) -> Column:
    """Not null, no null or non-finite component."""
    return F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))), F.lit(False))


def code_vectors(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4
) -> DataFrame:
    """One row per vector that is not null and has no null or non-finite component: key, code, error, label_error, codebooks_sha256.

    Components become floor(1024 * x); a vector is cut into ``parts`` equal parts. The codebook of a part starts
    as that part of the ``entries`` vectors with the least keys (null last; equal keys by components); each round
    assigns all parts to their nearest entries and moves the entries to the floors of the means, and a last
    assignment gives the code, two hex digits per part up to 256 entries, and the error, the sum of squared
    distances. ``label_error`` is the sum of errors over equal labels (null is one); the hash is
    that of all final entries. Assignments are exact: see ``Codebook.assign``.

    The length is that of the vector with the least key among those that can be cut. Vectors of another length, or with a
    component of 16384 or more in magnitude, teach nothing and have no code and no error. Null keys and
    labels are kept; repeated rows are coded each; fewer vectors than ``entries`` make smaller
    codebooks; no vectors give no rows. Other columns are not looked at.
    Per round one table is written: the vectors as whole numbers with their entries, and each task's sums.
    """
    good = rows.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")).filter(finite("v"))
    fits = F.forall("v", lambda x: F.abs(x) * SCALE < LARGEST) & (F.size("v") > 0) & (F.size("v") % parts == 0)
    whole = F.when(fits, F.transform("v", lambda x: F.floor(x * SCALE).cast("int")))
    every = written(good.select("key", "label", whole.alias("ints")), "vectors")
    order = [F.asc_nulls_last("key"), "ints"]
    first = every.filter("ints is not null").orderBy(*order).select(F.size("ints").alias("n")).limit(1).collect()
    dim = first[0]["n"] if first else parts
    of_dim = F.coalesce(F.size("ints") == dim, F.lit(False))
    state = every.filter(of_dim)
    seeds = state.orderBy(*order).limit(entries).select("ints").collect()
    books = [Codebook(p) for p in np.split(np.array([s["ints"] for s in seeds], np.int64).reshape(-1, dim), parts, axis=1)]
    state = state.select("*", F.array_repeat(F.lit(0), parts).alias("own"), F.array_repeat(F.lit(0).cast("bigint"), parts).alias("errors"))
    for _ in range(rounds if seeds else 0):
        assigned = written(assignment(state, books, learn=True), "assigned")
        books = updated(assigned, books)
        state = assigned.filter("part is null").select("key", "label", "ints", "own", "errors")
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.entries.ravel().tolist()).encode()).hexdigest()
    digits = max(2, len(f"{max(0, len(seeds) - 1):x}"))
    code = F.concat_ws("", F.transform("own", lambda k: F.lpad(F.lower(F.hex(k.cast("bigint"))), digits, "0")))
    error = F.aggregate("errors", F.lit(0).cast("bigint"), lambda a, b: a + b)
    coded = assignment(state, books, learn=False).select("key", "label", code.alias("code"), error.alias("error"))
    coded = written(coded.unionByName(every.filter(~of_dim).select("key", "label"), allowMissingColumns=True), "coded")
    out = attach_group_stat(coded, ["label"], F.sum("error").alias("label_error"))
    return out.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """DuckDB SQL for ``code_vectors``: every round compares all parts with all entries."""
    steps, book = [], "c0"
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS MATERIALIZED (
      SELECT vec_id, part, entry, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d FROM x JOIN {book} c USING (part, pos) GROUP BY ALL
    ), a{r} AS MATERIALIZED (
      SELECT vec_id, part, entry, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
    )""")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
      SELECT part, entry, pos, coalesce(m.v, c.v) AS v FROM {book} c LEFT JOIN (
        SELECT part, entry, pos, floor(sum(x.v)::DOUBLE / count(*))::BIGINT AS v FROM x JOIN a{r} USING (vec_id, part) GROUP BY ALL
      ) m USING (part, entry, pos)
    )""")
            book = f"c{r + 1}"
    made = ", ".join(steps)
    return f"""
    WITH k AS MATERIALIZED (
      SELECT vec_id, label, embedding, len(embedding) // {parts} AS width, row_number() OVER (ORDER BY vec_id) - 1 AS place FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0
    ), u AS (
      SELECT vec_id, place, width, unnest(range(0, len(embedding))) AS i, unnest(embedding) AS v FROM k
    ), x AS MATERIALIZED (
      SELECT vec_id, place, i // width AS part, i % width AS pos, floor(1024 * v::DOUBLE)::BIGINT AS v FROM u
    ), c0 AS MATERIALIZED (
      SELECT part, place AS entry, pos, v FROM x WHERE place < {entries}
    ), {made}, e AS (
      SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
      (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) FROM {book}) AS codebooks_sha256
    FROM e JOIN k USING (vec_id)
    """

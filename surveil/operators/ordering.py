"""Sequence numbers over a whole table in a total order, without a task that sees it all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE, TIE = "__place", "__tie"
PLACE_BITS = 33  # of monotonically_increasing_id: the partition above, the row in it below


def place_rows(df: DataFrame, order: Sequence[str | Column], path: str, partitions: int | None = None) -> DataFrame:
    """``df`` in order as the table ``path``, with each row's partition and position in ``__place``.

    The ranges of ``order`` are the partitions, so partition k holds only rows that come before those
    of partition k + 1, and the files, read by name, hold the rows in order. Rows that tie in
    ``order`` are told apart by a hash of where they stand in the input: a range can then end
    within a tie, and a tie of a third of all rows is still many ranges.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, F.col(TIE)]
    ranged = df.withColumn(TIE, F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(n, *keys)
    placed = ranged.sortWithinPartitions(*keys).drop(TIE).withColumn(PLACE, F.monotonically_increasing_id())
    placed.write.parquet(path)
    return df.sparkSession.read.schema(placed.schema).parquet(path)


def number_rows(
    df: DataFrame, order: Sequence[str | Column], path: str, name: str = "rownum", partitions: int | None = None
) -> DataFrame:
    """The columns of ``df`` and each row's number in ``order``, from 1.

    Ranges are sorted on their own and written to ``path``; the rows of each range are counted, and
    what comes before a range is added to the positions in it. Only the counts, one per range, reach
    the driver. Rows that tie get numbers of their own, in an order that is fixed by the input's.
    ``df`` should be a table or cheap: finding the ranges reads a sample of it first. A column of
    ``df`` called ``name`` is replaced; an empty table gives an empty one.
    """
    df = df.drop(name)
    placed = place_rows(df, order, path, partitions)
    part, row = F.shiftright(PLACE, PLACE_BITS), F.col(PLACE).bitwiseAND(2**PLACE_BITS - 1)
    counts = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg((F.max(row) + 1).alias("n")).collect()}
    before, total = [], 0
    for k in range(max(counts, default=-1) + 1):
        before.append(str(total))
        total += counts.get(k, 0)
    offsets = F.split(F.lit(",".join(before or ["0"])), ",").cast("array<bigint>")  # one literal, folded once
    number = F.get(offsets, part.cast("int")) + row + 1
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], number.alias(name))

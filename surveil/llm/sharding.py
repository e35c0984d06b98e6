"""Sharding on a consistent-hash ring with virtual nodes and bounded loads. Native."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.llm.shared import long_array, utf8, written

TICK_BITS = 14  # the ring has 2**14 ticks; virtual nodes stand on ticks
CELL_ROWS = 1024  # rows that are ranked together


def ring(n_shards: int, vnodes: int, seed: int = 0) -> list[tuple[int, int]]:
    """The virtual nodes as (tick, shard) in ring order. Two never share a tick: the later moves on clockwise."""
    taken: dict[int, int] = {}
    if n_shards * vnodes > 2 ** (TICK_BITS - 1):
        raise ValueError("too many virtual nodes for the ring")
    for shard in range(n_shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{seed}/{shard}/{v}".encode(), digest_size=8).digest()
            tick = int.from_bytes(digest, "big") >> (64 - TICK_BITS)
            while tick in taken:
                tick = (tick + 1) % 2**TICK_BITS
            taken[tick] = shard
    return sorted(taken.items())


def capacities(n: int, n_shards: int, slack: float = 0.0) -> list[int]:
    """Most rows per shard. Without slack they add up to ``n`` and differ by one at most."""
    if slack:
        return [-int(-(1 + slack) * n // n_shards)] * n_shards
    return [n // n_shards + (s < n % n_shards) for s in range(n_shards)]


def flow(nodes: Sequence[tuple[int, int]], counts: dict[int, int], caps: Sequence[int]) -> list[tuple[int, int, int, int, int]]:
    """Where the rows of each arc go: (arc, from rank, to rank, shard, first slot).

    All arcs offer their rows to their own node, in ring order; what does not fit goes on to the
    next node clockwise, and so on. Works on one count per virtual node, never on rows.
    """
    left, placed = list(caps), [0] * len(caps)
    waiting = [(arc, 0, counts[arc]) for arc in sorted(counts) if counts[arc]]
    out: list[tuple[int, int, int, int, int]] = []
    for hop in range(len(nodes)):
        still = []
        for arc, done, total in waiting:
            shard = nodes[(arc + hop) % len(nodes)][1]
            take = min(left[shard], total - done)
            if take:
                out.append((arc, done, done + take, shard, placed[shard]))
                left[shard] -= take
                placed[shard] += take
            if done + take < total:
                still.append((arc, done + take, total))
        waiting = still
        if not waiting:
            break
    return out


def shard_rows(
    docs: DataFrame,
    n_shards: int = 16,
    key: str = "doc_id",
    text: str = "text",
    columns: Sequence[str] = (),
    vnodes: int = 64,
    slack: float = 0.0,
    seed: int = 0,
) -> DataFrame:
    """One row per input row: key, size, text_crc32, ``columns``, shard and slot (gapless from 0 in its shard).

    A row's key names its place on the ring and so its arc. Within an arc, rows are ranked by a
    hash of key, size and checksum; the last ranks overflow first, and go on clockwise. Ranks come
    from counts of small cells, so that neither an arc nor a shard is ever sorted in one task.

    Repeated rows are counted before the shuffle and unfolded at the end; they may be in different
    shards. Rows with one key but different texts are spread over cells by their checksums. A null
    key hashes like any other value, a null text has size 1 (no bytes, plus one) and the checksum
    of no bytes. An empty table gives no rows. Other columns are not read, whatever their names.
    """
    nodes = ring(n_shards, vnodes, seed)
    spark = docs.sparkSession
    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long") + 1
    rows = docs.select(
        F.col(key), size.alias("size"), F.crc32(utf8(text)).alias("text_crc32"), *[F.col(c) for c in columns]
    )
    own = list(rows.columns)
    arcs = [next((i for i, (at, _) in enumerate(nodes) if at >= tick), 0) for tick in range(2**TICK_BITS)]
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 64 - TICK_BITS).cast("int")
    rows = rows.groupBy(*own).agg(F.count("*").alias("__copies"))
    rows = rows.withColumns({
        "__arc": F.get(long_array(arcs), place).cast("int"),
        "__order": F.xxhash64(F.lit(seed + 1), key, "size", "text_crc32"),
    })
    rows = written(rows, "shard-rows")

    counts = {r["__arc"]: r["n"] for r in rows.groupBy("__arc").agg(F.sum("__copies").alias("n")).collect()}  # one per node
    n = sum(counts.values())
    cells = -(-n // (CELL_ROWS * len(nodes))) or 1
    rows = rows.withColumn("__cell", F.pmod("__order", F.lit(cells)))
    before = Window.partitionBy("__arc").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("__arc", "__cell")
        .agg(F.sum("__copies").alias("__n"))
        .select("__arc", "__cell", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    )
    inside = Window.partitionBy("__arc", "__cell").orderBy("__order", *own).rowsBetween(Window.unboundedPreceding, -1)
    ranked = rows.withColumn("__in", F.coalesce(F.sum("__copies").over(inside), F.lit(0)))
    ranked = ranked.join(offsets, ["__arc", "__cell"]).withColumn("__first", F.col("__in") + F.col("__before"))
    ranked = ranked.withColumn("__rank", F.explode(F.sequence("__first", F.col("__first") + F.col("__copies") - 1)))
    plan = flow(nodes, counts, capacities(n, n_shards, slack))
    steps = spark.createDataFrame(plan, "__arc int, __from long, __to long, shard int, __slot long")
    # at most one step per virtual node and shard: bounded by the two parameters
    return (
        ranked.join(F.broadcast(steps), "__arc")
        .filter("__rank >= __from and __rank < __to")
        .select(*own, "shard", (F.col("__slot") + F.col("__rank") - F.col("__from")).alias("slot"))
    )

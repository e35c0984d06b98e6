"""Helpers of the operators: scratch tables, counts, and connected components."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, nullcontext

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by ``spark.checkpoint.dir``.

    Only a local session, whose driver is its executor, may leave the setting out.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='surveil-')}")
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand Python at most ``rows`` rows at once, or as many as the session says if that is less."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if not 0 < int(before) <= rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def written(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back. ``rows``: ``arrow_rows`` while it is written.

    Cuts the lineage: whatever reads it again, also after an executor is lost, sees the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    with arrow_rows(spark, rows) if rows else nullcontext():
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def give_back() -> None:
    """Memory that Python has freed goes back to the system, as far as Arrow and the C library can tell."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)


def frugal(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``; when it has ended, ``give_back``: its worker waits for other tasks and counts with the executor."""

    def ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return ended


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(text: str | Column) -> Column:
    """The text's UTF-8 bytes; none for null."""
    return F.encode(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "UTF-8")


def long_array(values) -> Column:
    """A literal array of integers, made as one string so that building it stays cheap."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)``: one row (node, component) per node, component = its smallest node.

    Alternating large-star and small-star steps. A node's neighbours are never gathered: each
    step is a minimum per node, combined before the shuffle, and a join back in which adaptive
    execution can split a node with very many links. Each step is written, so lineage stays short.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct()
    edges = written(edges, "links")
    state = _state(edges)
    while state[0]:
        edges = written(_star(_star(edges, large=True), large=False), "links")
        before, state = state, _state(edges)
        if state == before:
            break
    hubs = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(hubs)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: links of each node to larger neighbours move to its smallest neighbour. Small: those to smaller ones do."""
    if large:
        ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        ends = edges
    low = ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    joined = ends.join(low, F.col("u") == F.col("k"))
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u != v")
        moved = moved.unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return moved.filter("u != v").distinct()

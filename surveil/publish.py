"""Several outputs published as one: staged apart, then named together in a manifest that readers follow."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveil.jobs import Job
from surveil.sources import writers

MANIFEST = "as_of date, sequence bigint, release string, report string, path string, format string, schema string"


@dataclass(frozen=True)
class Staged(Job):
    """A job whose outputs lie in a folder that no reader knows until the release is published."""

    release: str = ""
    outputs: dict[str, tuple[str, str]] = field(default_factory=dict)

    def save(self, df: DataFrame, report: str, fmt: str = "parquet") -> None:
        super().save(df, report, fmt)
        self.outputs[report] = (fmt, df.schema.json())


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """One row per output of every release published under ``base``; ``start_manifest`` makes the empty one."""
    return spark.read.schema(MANIFEST).parquet(f"{base}/manifest")


def start_manifest(spark: SparkSession, base: str) -> None:
    """An empty manifest. Once per base; a manifest that is there stays as it is."""
    spark.createDataFrame([], MANIFEST).write.mode("ignore").parquet(f"{base}/manifest")


@contextmanager
def release(spark: SparkSession, base: str, as_of: date) -> Iterator[Staged]:
    """``with release(...) as job:`` runs any of the jobs; its outputs become visible all at once, or not at all.

    Outputs go to a new folder under ``base``/data. When the block ends without an error, one file with a row
    per output is added to the manifest: a file appears whole or not at all, and with it the release. A
    block that fails, or a driver that dies, leaves files that nothing points to, and readers stay
    with the release before. Of two releases of one date the one published later counts; of two published at
    the same moment the one whose name is greater, for all readers alike.
    """
    name = uuid.uuid4().hex
    job = Staged(spark, f"{base}/data/{name}", as_of, name)
    start_manifest(spark, base)
    yield job
    last = manifest(spark, base).filter(F.col("as_of") == F.lit(as_of)).agg(F.coalesce(F.max("sequence"), F.lit(0))).first()[0]
    rows = [(as_of, last + 1, name, report, job.path(report), fmt, schema) for report, (fmt, schema) in job.outputs.items()]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{base}/manifest")


def current(spark: SparkSession, base: str, as_of: date | None = None) -> dict[str, Row]:
    """The outputs of the release that counts for the date, or for the latest date published, by report name.

    Whatever is published later, reads through one such answer stay with one release.
    """
    rows = manifest(spark, base)
    if as_of is not None:
        rows = rows.filter(F.col("as_of") == F.lit(as_of))
    newest = rows.agg(F.max(F.struct("as_of", "sequence", "release")).alias("r")).select("r.release")
    return {r["report"]: r for r in rows.join(newest, "release").collect()}


def read_output(spark: SparkSession, outputs: dict[str, Row], report: str) -> DataFrame:
    """One of the outputs that ``current`` names, as it was saved."""
    if report not in outputs:
        raise LookupError(f"no published output {report!r}")
    path, fmt, schema = (outputs[report][c] for c in ("path", "format", "schema"))
    schema = StructType.fromJson(json.loads(schema))
    if fmt == "csv":
        return writers.read_csv(spark, path, schema)
    if fmt == "lines":
        return writers.read_lines(spark, path, schema)
    return spark.read.schema(schema).format(fmt).load(path)


def read_published(spark: SparkSession, base: str, report: str, as_of: date | None = None) -> DataFrame:
    """One output of the release that counts now."""
    return read_output(spark, current(spark, base, as_of), report)

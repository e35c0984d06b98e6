"""An error channel: good rows, rejected rows with their reasons, and the counts, all from one pass."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from surveil.functions.nulls import is_true

REASONS, REJECTED = "reject_reasons", "__rejected"


@dataclass(frozen=True)
class Split:
    """What ``split_rows`` made of its input. ``rejected`` has the input's columns and ``reject_reasons``."""

    good: DataFrame
    rejected: DataFrame
    n_rows: int
    n_rejected: int
    by_reason: dict[str, int]


def with_reasons(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """``df`` and the array ``reject_reasons``: the names of the checks that a row fails, in the order of ``checks``.

    A check is true of a bad row; one that is unknown has found nothing wrong.
    """
    if REASONS in df.columns:
        raise ValueError(f"{REASONS!r} is the name of the reasons; rename that column")
    failed = [F.when(is_true(bad), F.lit(reason)) for reason, bad in checks.items()]
    return df.withColumn(REASONS, F.filter(F.array(*failed), lambda r: r.isNotNull()) if failed else F.array().cast("array<string>"))


def split_rows(df: DataFrame, checks: Mapping[str, Column], path: str) -> Split:
    """Every row of ``df`` goes to exactly one side: good if it fails no check, else rejected with its reasons.

    The input is read once: its rows are judged, counted on the way and written to ``path``, apart by
    outcome, so that either side reads only its own files. The counts are those of the written rows.
    """
    judged = with_reasons(df, checks).withColumn(REJECTED, F.size(REASONS) > 0)
    seen = Observation(f"rejects-{uuid.uuid4().hex}")
    metrics = {f"r{i}": F.count(F.when(F.array_contains(REASONS, reason), 1)) for i, reason in enumerate(checks)}
    metrics |= {"n_rows": F.count(F.lit(1)), "n_rejected": F.count(F.when(F.col(REJECTED), 1))}
    judged.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.mode("overwrite").partitionBy(REJECTED).parquet(path)
    counts = seen.get
    written = df.sparkSession.read.schema(judged.schema).parquet(path)
    return Split(
        good=written.filter(~F.col(REJECTED)).drop(REASONS, REJECTED),
        rejected=written.filter(REJECTED).drop(REJECTED),
        n_rows=counts["n_rows"],
        n_rejected=counts["n_rejected"],
        by_reason={reason: counts[f"r{i}"] for i, reason in enumerate(checks)},
    )


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per reason; a row with two reasons counts for each."""
    return rejected.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))

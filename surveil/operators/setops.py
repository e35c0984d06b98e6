"""Stacking feeds and lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_by_name(*dfs).distinct()


def union_sources(feeds: dict[str, DataFrame], tag: str = "feed") -> DataFrame:
    """Feeds stacked into one table with the feed name as a column."""
    return union_by_name(*[df.withColumn(tag, F.lit(name)) for name, df in feeds.items()])

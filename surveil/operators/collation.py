"""Which texts count as equal: string collations on compared columns.

A warehouse compares codes, filters and keys by its own collation, often ignoring case; Spark compares
byte for byte unless told otherwise. A column that carries a collation is compared by it wherever it
goes: in ``isin``, ``=``, LIKE, groups, DISTINCT and joins. Its text stays as it was sent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

EXACT, IGNORE_CASE = "UTF8_BINARY", "UTF8_LCASE"


def is_collated(kind: DataType) -> bool:
    return isinstance(kind, StringType) and kind.collation != EXACT


def collated_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if is_collated(f.dataType)]


def collated(df: DataFrame, collation: str = IGNORE_CASE, columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` with its text columns, or only ``columns``, compared by ``collation`` from here on."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, StringType) and f.dataType.collation != collation]
    chosen = [c for c in texts if columns is None or c in columns]
    return df.withColumns({c: F.collate(F.col(f"`{c}`"), collation) for c in chosen})


def exact(df: DataFrame) -> DataFrame:
    """``df`` with all text columns compared byte for byte again, for outputs and for rules that want it so."""
    return collated(df, EXACT)


def distinct_records(df: DataFrame) -> DataFrame:
    """DISTINCT in which texts are equal by their columns' collations.

    Records that are equal this way are one record, which shows the least text of each column, byte
    for byte, so that the outcome does not depend on the order of the rows.

    Records are shuffled by all their columns before they are combined. Most differ, so combining them where they
    are read would hold, sort or spill whole wide splits of the input for nothing; copies of a record meet in one task, where
    they take the room of one. The shuffle holds each text once and is the same whichever columns are used later, so
    a plan that needs the records twice runs it once. Sorting by a collation is slow: a hash of the other columns leads.
    """
    by_rule = collated_columns(df)
    if not by_rule:
        return df.repartition(*[F.col(f"`{c}`") for c in df.columns]).distinct()
    keys = {c: f"__k_{c}" for c in by_rule}
    keyed = df.withColumnsRenamed(keys)
    together = [F.col(f"`{c}`") for c in keyed.columns]
    plain = [F.col(f"`{c}`") for c in df.columns if c not in keys]
    lead = [F.xxhash64(*plain).alias("__lead")] if plain else []
    least = [F.min(F.collate(F.col(f"`{keys[c]}`"), EXACT)).alias(c) for c in by_rule]
    texts = [F.col(f"`{c}`") for c in keys.values()]
    out = keyed.repartition(*together).groupBy(*lead, *plain, *texts).agg(*least)
    kinds = {f.name: f.dataType.collation for f in df.schema if f.name in keys}
    return out.select(*[F.collate(F.col(f"`{c}`"), kinds[c]).alias(c) if c in keys else F.col(f"`{c}`") for c in df.columns])

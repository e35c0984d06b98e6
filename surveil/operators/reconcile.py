"""Feeds whose columns differ in type, stacked under one schema without losing a cell."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegralType, LongType, NullType, NumericType, StringType,
    StructField, StructType, TimestampNTZType, TimestampType,
)

UNCONVERTED = "unconverted"
SERIAL_EPOCH = "1899-12-30"  # day 0 of the dates that spreadsheets keep as numbers
TIMES = (DateType, TimestampType, TimestampNTZType)
WHOLE_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19}


def _numeric(a: NumericType, b: NumericType) -> DataType:
    if isinstance(a, IntegralType) and isinstance(b, IntegralType):
        return max(a, b, key=lambda t: WHOLE_DIGITS[t.simpleString()])
    if isinstance(a, (FloatType, DoubleType)) or isinstance(b, (FloatType, DoubleType)):
        return DoubleType()
    shapes = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (WHOLE_DIGITS[t.simpleString()], 0) for t in (a, b)]
    whole, scale = max(w for w, _ in shapes), max(s for _, s in shapes)
    return DecimalType(whole + scale, scale) if whole + scale <= 38 else DoubleType()


def common_type(a: DataType, b: DataType) -> DataType:
    """The type that holds what both mean.

    Times win over numbers, because spreadsheets keep dates as numbers; numbers win over text, because
    exports print numbers as text. A date and a date-time make a date-time, two numbers the
    wider one. Anything else that differs is text.
    """
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, TIMES) or isinstance(b, TIMES):
        other = [t for t in (a, b) if not isinstance(t, TIMES)]
        if not other or isinstance(other[0], (StringType, NumericType)):
            return TimestampNTZType()
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return _numeric(a, b)
    for mine, theirs in ((a, b), (b, a)):
        if isinstance(mine, NumericType) and isinstance(theirs, StringType):
            return LongType() if isinstance(mine, IntegralType) else mine
    return StringType()


def common_schema(feeds: Mapping[str, DataFrame], types: Mapping[str, DataType] | None = None) -> StructType:
    """All columns of all feeds, in the order in which they first occur, with their common types or those given in ``types``."""
    kinds: dict[str, DataType] = {}
    for df in feeds.values():
        for f in df.schema:
            kinds[f.name] = common_type(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    kinds |= types or {}
    return StructType([StructField(c, StringType() if isinstance(t, NullType) else t) for c, t in kinds.items()])


def _to_time(c: Column, kind: DataType, formats: Sequence[str]) -> Column:
    if isinstance(kind, NumericType):
        micros = F.round(c.cast("double") * 86_400_000_000).cast("bigint")
        return F.timestamp_add("MICROSECOND", micros, F.lit(SERIAL_EPOCH).cast("timestamp_ntz"))
    if isinstance(kind, StringType):
        tries = [c.try_cast("timestamp_ntz"), *[F.try_to_timestamp(c, F.lit(f)).cast("timestamp_ntz") for f in formats]]
        return F.coalesce(*tries)
    return c.cast("timestamp_ntz")


def converted(c: Column, kind: DataType, target: DataType, formats: Sequence[str] = ()) -> Column:
    """A cell of type ``kind`` as ``target``; null where that cannot be done."""
    if kind == target:
        return c
    if isinstance(target, TimestampNTZType):
        return _to_time(c, kind, formats)
    if isinstance(target, DateType):
        return _to_time(c, kind, formats).cast("date")
    if isinstance(kind, StringType) and isinstance(target, IntegralType):
        number = F.trim(c).try_cast("decimal(38,6)")  # "12.0" is a whole number, "12.5" is none
        return F.when(number == F.floor(number), number.try_cast(target))
    if isinstance(kind, NumericType) and isinstance(target, IntegralType):
        return F.when(c == F.floor(c), c.try_cast(target))
    if isinstance(kind, NumericType) and isinstance(target, BooleanType):
        return F.when(c.isin(0, 1), c == 1)
    return (F.trim(c) if isinstance(kind, StringType) and not isinstance(target, StringType) else c).try_cast(target)


def stack_feeds(
    feeds: Mapping[str, DataFrame], types: Mapping[str, DataType] | None = None, formats: Sequence[str] = (), tag: str = "feed"
) -> DataFrame:
    """All rows of all feeds under ``common_schema``, the name of the feed, and what could not be converted.

    Every feed is cast on its own, column by column, where its type differs; a column that it lacks is
    null. A cell that the common type cannot hold is null there and kept as text in the map ``unconverted``
    under its column's name, so no cell is lost and nothing fails half way. Texts of times are read as ISO or by
    ``formats``; numbers in a column of times are a spreadsheet's days. All of it is one projection per feed.
    """
    schema = common_schema(feeds, types)
    clash = {UNCONVERTED, tag} & set(schema.names)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}")

    def cast(name: str, df: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in df.schema}
        cells = {f.name: converted(F.col(f"`{f.name}`"), kinds[f.name], f.dataType, formats) for f in schema if f.name in kinds}
        changed = [f.name for f in schema if f.name in kinds and kinds[f.name] != f.dataType]
        failed = [
            F.when(F.col(f"`{c}`").isNotNull() & cells[c].isNull(), F.struct(F.lit(c).alias("key"), F.col(f"`{c}`").cast("string").alias("value")))
            for c in changed
        ]
        kept = F.map_from_entries(F.filter(F.array(*failed), lambda e: e.isNotNull())) if failed else F.create_map().cast("map<string,string>")
        row = [(cells[f.name] if f.name in kinds else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]
        return df.select(*row, kept.cast("map<string,string>").alias(UNCONVERTED), F.lit(name).alias(tag))

    return reduce(lambda a, b: a.unionByName(b), [cast(name, df) for name, df in feeds.items()])


def unconverted_cells(stacked: DataFrame, tag: str = "feed") -> DataFrame:
    """Cells that kept their text, per feed, column and text, with their number."""
    cells = stacked.select(tag, F.explode(UNCONVERTED).alias("column", "text"))
    return cells.groupBy(tag, "column", "text").agg(F.count(F.lit(1)).alias("n"))

"""Header repair, reshaping and column order.

Exported sheets are stacked in one DataFrame keyed by ``sheet_id`` and ``row_no`` (row 1 is
the top row), so the repairs below work on any number of sheets at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.functions.nulls import as_col, to_number
from surveil.operators.joins import skew_join

SHEET, ROW = "sheet_id", "row_no"


def repair_header(df: DataFrame, names: Sequence[str], skip: int = 0) -> DataFrame:
    """Rename the cell columns by position and drop the first ``skip`` rows of each sheet."""
    cells = [c for c in df.columns if c not in (SHEET, ROW)]
    if len(names) != len(cells):
        raise ValueError(f"{len(names)} names for {len(cells)} columns")
    return drop_first_n(df.select(SHEET, ROW, *[F.col(c).alias(n) for c, n in zip(cells, names)]), skip)


def drop_first_n(df: DataFrame, n: int, row_no: str = ROW) -> DataFrame:
    return df.filter(F.col(row_no) > n) if n else df


def header_cells(df: DataFrame, **cells: tuple[int, str]) -> DataFrame:
    """Fixed header cells (row, column) as columns on every row of their sheet."""
    top = df.filter(F.col(ROW) <= max(r for r, _ in cells.values()))
    found = top.groupBy(SHEET).agg(
        *[F.max(F.when(F.col(ROW) == r, F.col(c))).alias(name) for name, (r, c) in cells.items()]
    )
    return skew_join(df, found, [SHEET], "left")


def header_fallback(df: DataFrame, cols: Sequence[str], header_row: int) -> DataFrame:
    """A missing number is taken from the header row of its sheet."""
    with_header = header_cells(df, **{f"__h_{c}": (header_row, c) for c in cols})
    return with_header.withColumns(
        {c: F.coalesce(to_number(c), to_number(f"__h_{c}")) for c in cols}
    ).drop(*[f"__h_{c}" for c in cols])


def first_n(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def pivot_wide(
    df: DataFrame, ids: Sequence[str], names: Sequence[str], values: Sequence[tuple], value: str, sep: str = "_"
) -> DataFrame:
    """Long to wide on one or more name columns, one output column per tuple in ``values``.

    Naming the values saves the job that would look for them.
    """
    def cell(combo: tuple) -> Column:
        match = F.lit(True)
        for name, v in zip(names, combo):
            match = match & (F.col(name) == v)
        return F.max(F.when(match, F.col(value))).alias(sep.join(map(str, combo)))

    return df.groupBy(*ids).agg(*[cell(combo) for combo in values])


def pivot_long(df: DataFrame, ids: Sequence[str], names: Sequence[str], value: str = "value", sep: str = "_") -> DataFrame:
    """Wide to long; the parts of each column name become the ``names`` columns."""
    long = df.unpivot(list(ids), [c for c in df.columns if c not in ids], "__name", value)
    parts = F.split("__name", F.lit(f"\\Q{sep}\\E"))
    return long.select(*ids, *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)], value)


def reshape_columns(
    df: DataFrame,
    drop: Sequence[str] = (),
    rename: dict[str, str] | None = None,
    first: Sequence[str] = (),
    last: Sequence[str] = (),
    drop_from: str | None = None,
    select: Sequence[str | tuple[str, str]] = (),
) -> DataFrame:
    """Select, drop, rename and move columns.

    ``select`` keeps the named columns in its order; a pair stands for all columns from the
    first to the second. ``drop_from`` drops that column and all after it.
    """
    place = df.columns.index
    ranges = [df.columns[place(c[0]) : place(c[1]) + 1] if isinstance(c, tuple) else [c] for c in select]
    keep = list(dict.fromkeys(c for r in ranges for c in r)) if select else df.columns
    if drop_from:
        gone = set(df.columns[place(drop_from) :])
        keep = [c for c in keep if c not in gone]
    rename = rename or {}
    out = [c for c in keep if c not in drop]
    named = {rename.get(c, c): c for c in out}
    middle = [n for n in named if n not in first and n not in last]
    return df.select(*[F.col(named[n]).alias(n) for n in (*first, *middle, *last)])


def sort_report(df: DataFrame, *order) -> DataFrame:
    return df.orderBy(*order)


def convert_types(df: DataFrame, numbers: Sequence[str] = (), times: Sequence[str] = ()) -> DataFrame:
    """Text to number and date to date-time, as needed before stacking feeds."""
    casts = {c: to_number(c) for c in numbers}
    casts |= {c: as_col(c).try_cast("timestamp_ntz") for c in times}
    return df.withColumns(casts)

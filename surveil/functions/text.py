"""Text predicates, labels and keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.functions.nulls import ColumnOrName, any_of, as_col, is_in, is_true


# ---- predicates: missing text never matches ------------------------------------------

def like_any(c: ColumnOrName, patterns: Iterable[str], ci: bool = True) -> Column:
    """Any LIKE pattern matches. ``%`` and ``_`` are wildcards."""
    c = as_col(c)
    return is_true(any_of([c.ilike(p) if ci else c.like(p) for p in patterns]))


def matches(c: ColumnOrName, pattern: str, ci: bool = False) -> Column:
    """The pattern is found somewhere in the text."""
    return is_true(as_col(c).rlike(f"(?i){pattern}" if ci else pattern))


def matches_any(cols: Iterable[ColumnOrName], pattern: str, ci: bool = False) -> Column:
    return any_of([matches(c, pattern, ci) for c in cols])


def text_positive(c: ColumnOrName, positive: str, negative: str) -> Column:
    """Positive words and no negating word, ignoring case."""
    return matches(c, positive, ci=True) & ~matches(c, negative, ci=True)


def result_is_positive(result: ColumnOrName, codes: Iterable[str]) -> Column:
    return is_in(result, codes)


# Numeric comparator results such as "=12" or ">1600".
COMPARATOR_INTENDED = r"^[=><]\s*[0-9]"
COMPARATOR_AS_WRITTEN = "^=[1-9]+ | ^>[1-9]+"


def result_text_comparator(c: ColumnOrName, as_written: bool = False) -> Column:
    """Result text that is a comparison with a number.

    The original pattern carries literal spaces, so it accepts only '=' with digits 1-9
    and a space; ``as_written`` keeps it.
    """
    return matches(c, COMPARATOR_AS_WRITTEN if as_written else COMPARATOR_INTENDED)


# ---- labels and keys -----------------------------------------------------------------

def count_label(
    quarter: ColumnOrName,
    n: ColumnOrName,
    year: ColumnOrName,
    current: tuple[int, int],
    suffix: Column | None = None,
) -> Column:
    """'Q3(n=35)', or 'Q3' for quarters after the current (year, quarter).

    ``suffix`` (see ``year_label``) goes between the quarter and the count.
    """
    q = as_col(quarter).cast("int")
    head = F.concat(F.lit("Q"), q.cast("string"))
    if suffix is not None:
        head = F.concat(head, suffix)
    future = (as_col(year).cast("int") == current[0]) & (q > current[1])
    n_text = as_col(n).cast("bigint").cast("string")
    return F.when(future, head).otherwise(F.concat(head, F.lit("(n="), n_text, F.lit(")")))


def year_label(year: ColumnOrName) -> Column:
    """"-'22" for 2022."""
    return F.concat(F.lit("-'"), F.substring(as_col(year).cast("string"), 3, 2))


def composite_key(cols: Sequence[ColumnOrName], sep: str = "-") -> Column:
    """Pasted key in which a missing part reads 'NA' and is not skipped."""
    return F.concat_ws(
        sep, *[F.coalesce(as_col(c).cast("string"), F.lit("NA")) for c in cols]
    )


# A quarter's key: year and quarter as printed, either of them also with a decimal ("2023-2", "2023.0-2", "2023 / 2.0").
QUARTER_KEY = r"^\s*([0-9]{4})(?:\.0+)?[^A-Za-z0-9.]+([1-4])(?:\.0+)?\s*$"


def quarter_parts(c: ColumnOrName) -> tuple[Column, Column]:
    """Year and quarter of a quarter's key; both null when it is no such key."""
    found = F.regexp_extract(as_col(c), QUARTER_KEY, 1), F.regexp_extract(as_col(c), QUARTER_KEY, 2)
    return tuple(F.nullif(part, F.lit("")).cast("int") for part in found)


def bad_quarter_key(c: ColumnOrName) -> Column:
    """The key is missing or names no year and quarter."""
    return ~is_true(as_col(c).rlike(QUARTER_KEY))


def split_parts(c: ColumnOrName, n: int) -> list[Column]:
    """The first n parts of a text split on anything that is no letter or digit."""
    parts = F.split(as_col(c), "[^A-Za-z0-9]+")
    return [F.get(parts, F.lit(i)) for i in range(n)]

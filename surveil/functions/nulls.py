"""Null rules, numbers kept as text, and guarded arithmetic.

The report rules were written for a three-valued logic in which membership tests and
pattern tests on missing text are false, while a conditional on an unknown condition is
itself unknown. Spark differs on both, so rules are built from these helpers.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_true(condition: Column) -> Column:
    """The condition with unknown read as false."""
    return F.coalesce(condition, F.lit(False))


def if_else3(condition: Column, yes, no) -> Column:
    """Two-way choice that stays null when the condition is unknown."""
    return F.when(condition, yes).when(~condition, no)


def is_in(c: ColumnOrName, values) -> Column:
    """Membership; a missing value is in no list."""
    return is_true(as_col(c).isin(list(values)))


def any_of(conditions) -> Column:
    return reduce(or_, conditions)


def first_known(*cols: ColumnOrName) -> Column:
    return F.coalesce(*[as_col(c) for c in cols])


def null_to_zero(c: ColumnOrName) -> Column:
    return F.coalesce(as_col(c), F.lit(0))


def sentinel_to_null(c: ColumnOrName, *tokens: str) -> Column:
    """Header or marker words left among the data become null."""
    out = as_col(c)
    for token in tokens:
        out = F.nullif(out, F.lit(token))
    return out


def to_number(c: ColumnOrName) -> Column:
    """Text to double; text that is no number becomes null."""
    return as_col(c).try_cast("double")


def whole_number(c: ColumnOrName, kind: str = "int") -> Column:
    """Text such as '2022' or '2022.0' to a whole number. Missing stays null; anything else is an error."""
    value, number = as_col(c), to_number(c)
    whole = is_true(number == F.floor(number))
    wrong = F.raise_error(F.concat(F.lit("not a whole number: "), value.cast("string"))).cast(kind)
    return F.when(value.isNull(), F.lit(None).cast(kind)).when(whole, number.cast(kind)).otherwise(wrong)


def not_whole(c: ColumnOrName) -> Column:
    """The text is there and is no whole number: what ``whole_number`` refuses."""
    number = to_number(c)
    return as_col(c).isNotNull() & ~is_true(number == F.floor(number))


def not_number(c: ColumnOrName) -> Column:
    """The text is there and is no number: what ``to_number`` drops."""
    return as_col(c).isNotNull() & to_number(c).isNull()


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den as double, null when the denominator is zero."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def safe_pct(num: ColumnOrName, den: ColumnOrName, scale: float = 100.0) -> Column:
    return safe_ratio(num, den) * F.lit(float(scale))


def pct_from_text(pct: ColumnOrName, total: ColumnOrName, passed: ColumnOrName) -> Column:
    """Percent text to a fraction; null when total and passed are both zero."""
    empty = (to_number(total) == 0) & (to_number(passed) == 0)
    return F.when(~is_true(empty), to_number(pct) / 100)


def propagate_nulls(aggregate: Column, c: ColumnOrName) -> Column:
    """An aggregate that is null as soon as one input row is null."""
    return F.when(F.count(as_col(c)) == F.count(F.lit(1)), aggregate)

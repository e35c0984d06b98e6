"""Joins: null-safe, skew-safe, and those that attach statistics to rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from surveil.functions.nulls import null_to_zero
from surveil.operators.collation import EXACT, distinct_records, is_collated


def skew_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", collation: str | None = None
) -> DataFrame:
    """Equi-join on shared key names in which null keys match null keys.

    Adaptive execution splits a hot key only if each join input is a plain shuffle and no
    later step relies on the join's partitioning. An aggregate grouped by the key is
    already partitioned by it and would enter the join without a shuffle, and a DISTINCT
    behind the join would reuse its partitioning. A hash of the keys, salted with the
    columns of this join and dropped afterwards, rules both out: every skew_join shuffles
    its inputs itself, and nothing behind it can lean on that. A small side is still
    broadcast by measured size, and then neither side is shuffled.

    Text keys are compared by their columns' collation, or by ``collation`` whatever the columns carry. The
    hash does not follow collations, so such keys are salted as text: the tag is appended, which
    leaves equal what is equal, and Spark shuffles by the collation key of the longer text.
    """
    for k in keys:
        mine, theirs_type = left.schema[k].dataType, right.schema[k].dataType
        if mine != theirs_type and not (collation and isinstance(mine, StringType) and isinstance(theirs_type, StringType)):
            raise TypeError(f"join key {k!r} is {mine.simpleString()} and {theirs_type.simpleString()}")  # equal values of two types hash differently
    tag = F.lit("|".join(right.columns))
    theirs = {k: f"__r_{k}" for k in keys}

    def compared(df: DataFrame, k: str, name: str) -> tuple[Column, bool]:
        kind = df.schema[k].dataType
        if collation and isinstance(kind, StringType):
            return F.collate(F.col(name), collation), collation != EXACT
        return F.col(name), is_collated(kind)

    as_text = [k for k in keys if compared(left, k, k)[1]]
    plain = [k for k in keys if k not in as_text]
    on = []
    if plain or not as_text:
        right = right.withColumn("__rh", F.xxhash64(tag, *[compared(right, k, k)[0] for k in plain]))
        left = left.withColumn("__lh", F.xxhash64(tag, *[compared(left, k, k)[0] for k in plain]))
        on.append(F.col("__lh") == F.col("__rh"))
    kinds = right
    right = right.withColumnsRenamed(theirs)
    for k, r in theirs.items():
        a, b = compared(left, k, k)[0], compared(kinds, k, r)[0]
        on.append(a.eqNullSafe(b))
        if k in as_text:
            on.append(F.concat(a, F.concat(F.lit("|"), tag)).eqNullSafe(F.concat(b, F.concat(F.lit("|"), tag))))
    return left.join(right, reduce(lambda a, b: a & b, on), how).drop("__lh", "__rh", *theirs.values())


def cases_labs(labs: DataFrame, cases: DataFrame, key: str) -> DataFrame:
    """Distinct lab-case records.

    Each side is made distinct before the join: DISTINCT combines on the map side, so
    copies cost nothing downstream, it spreads a hot key by the whole row, and the join of
    two distinct sides is distinct. Null keys join nothing.
    """
    return skew_join(
        distinct_records(labs.filter(F.col(key).isNotNull())),
        distinct_records(cases.filter(F.col(key).isNotNull())),
        [key],
    )


def cases_labs_totals(labs: DataFrame, cases: DataFrame, key: str, totals: dict[str, Column | None]) -> DataFrame:
    """``cases_labs`` with per-case totals over the joined records on every row.

    ``totals`` maps an output name to an integer lab expression to sum, or to None for the
    number of records. A joined record pairs one lab with one case row, so a total is the
    lab total times the case's distinct rows. Totals are therefore summed from the labs
    alone and travel with the case row: the wide rows are joined once.
    """
    labs = distinct_records(labs.filter(F.col(key).isNotNull()))
    cases = distinct_records(cases.filter(F.col(key).isNotNull()))
    per_lab = labs.groupBy(key).agg(
        *[(F.count(F.lit(1)) if c is None else F.sum(c)).alias(name) for name, c in totals.items()]
    )
    per_case = cases.groupBy(key).agg(F.count(F.lit(1)).alias("__m"))
    facts = per_lab.join(per_case, key).select(
        key, *[(F.col(name) * F.col("__m")).alias(name) for name in totals]
    )
    return skew_join(labs, skew_join(cases, facts, [key]), [key])


def attach_group_stat(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates per key on every row. Null keys form one group.

    Aggregate and join back, not a window: the aggregate reduces on the map side and the
    join splits hot keys, while a window would sort a whole group in one task.
    """
    return skew_join(df, df.groupBy(*keys).agg(*aggregates), keys, "left")


def attach_scalar(df: DataFrame, **aggregates: Column) -> DataFrame:
    """Whole-table aggregates of ``df`` on every row, as one scalar subquery."""
    return attach_scalar_of(df, df, **aggregates)


def attach_scalar_of(df: DataFrame, source: DataFrame, **aggregates: Column) -> DataFrame:
    """As ``attach_scalar``, with the aggregates taken from another DataFrame."""
    row = source.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("__s"))
    with_row = df.withColumn("__s", row.scalar())
    return with_row.select(*df.columns, *[F.col(f"__s.{n}").alias(n) for n in aggregates])


def attach_typing(rows: DataFrame, typed: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The typing results of a case on all its rows, as one sorted array per row.

    The plain join pairs every row of a case with every typed row, which is quadratic in
    a hot case. Typing columns take few values, so a case has few distinct results; each
    is listed once with its multiplicity ``n_typed``, and no row is multiplied.
    """
    results = typed.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias("n_typed"))
    listed = results.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*columns, "n_typed"))).alias("typing"))
    return skew_join(rows, listed, keys, "left")


def cases_labs_typing(labs: DataFrame, cases: DataFrame, typed: DataFrame, case: Sequence[str], key: str, columns: Sequence[str]) -> DataFrame:
    """``cases_labs`` with ``attach_typing`` by ``case``: all columns of the lab, those of ``case``, and ``typing``.

    ``labs`` are distinct and ``typed`` are the typed ones among them. A joined record pairs one lab with one case
    row, so a case has each typing result of its labs once per distinct row of its own. Typing is therefore found from the labs
    alone and travels with the case row: the wide rows are joined once.
    """
    cases = distinct_records(cases.filter(F.col(key).isNotNull()))
    per_case = cases.groupBy(*case).agg(F.count(F.lit(1)).alias("__m"))
    facts = attach_typing(per_case, typed.filter(F.col(key).isNotNull()), [key], columns)
    times = F.transform("typing", lambda t: t.withField("n_typed", t.n_typed * F.col("__m")))
    records = skew_join(labs, facts.withColumn("typing", times), [key])
    return records.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__m")))).drop("__i", "__m")


def typing_rows(rows: DataFrame, dedupe: bool = True) -> DataFrame:
    """``attach_typing`` as flat rows: one per row and distinct result of its case.

    Without ``dedupe`` a result comes as often as it was typed, as the plain join has it.
    """
    flat = rows.select(*[c for c in rows.columns if c != "typing"], F.inline_outer("typing"))
    if dedupe:
        return flat
    again = F.explode(F.sequence(F.lit(1), F.coalesce("n_typed", F.lit(1)).cast("int")))
    return flat.select("*", again.alias("__i")).drop("__i", "n_typed")


def natural_left_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Left join on all columns the two have in common."""
    shared = [c for c in a.columns if c in set(b.columns)]
    return skew_join(a, b, shared, "left")


def member_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], name: str = "is_member") -> DataFrame:
    """Does the key occur in ``other``? Rows are neither lost nor multiplied."""
    known = other.select(*keys).distinct().withColumn(name, F.lit(True))
    return skew_join(df, known, keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def grid(spark: SparkSession, **parameters: Sequence) -> DataFrame:
    """Every combination of short parameter lists, in the given column order."""
    df = spark.range(1).select()
    for name, values in parameters.items():
        df = df.select("*", F.explode(F.array(*[F.lit(v) for v in values])).alias(name))
    return df


def densify(df: DataFrame, full_grid: DataFrame, keys: Sequence[str], zero: Sequence[str] = ()) -> DataFrame:
    """One row per grid cell; absent cells get null, or 0 in the ``zero`` columns."""
    out = skew_join(full_grid, df, keys, "left")
    return out.withColumns({c: null_to_zero(c) for c in zero})


def interval_match(
    df: DataFrame,
    case: Sequence[str],
    day: str,
    is_a: Column,
    is_b: Column,
    days: int = 31,
    as_written: bool = False,
    or_if: Column | None = None,
) -> DataFrame:
    """Cases with an A and a B specimen at most ``days`` apart, or any row with ``or_if``.

    Specimens are first reduced to one row per case and day. Then the nearest earlier day
    of the other kind decides, so no pairs are formed and a case holds at most one row
    per calendar day. As written, any case with a dated A and any B matches.
    """
    if as_written:
        seen = df.groupBy(*case).agg(F.max(is_a & F.col(day).isNotNull()).alias("a"), F.max(is_b).alias("b"))
        return seen.filter("a and b").select(*case)
    other = F.lit(False) if or_if is None else or_if
    per_day = df.groupBy(*case, day).agg(
        F.max(is_a).alias("a"), F.max(is_b).alias("b"), F.max(other).alias("other")
    )
    so_far = Window.partitionBy(*case).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    last = {k: F.max(F.when(F.col(k), F.col(day))).over(so_far) for k in ("a", "b")}
    near = (F.col("a") & (F.datediff(day, "last_b") <= days)) | (F.col("b") & (F.datediff(day, "last_a") <= days))
    return (
        per_day.withColumns({"last_a": last["a"], "last_b": last["b"]})
        .filter(near | F.col("other"))
        .select(*case)
        .distinct()
    )

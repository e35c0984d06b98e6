"""Quarterly indicators on a full region x year x quarter grid, compared with targets.

Counts come either from case facts (``quarter_counts``, one map-side combined aggregate) or
from exported sheets (``pass_rates_from_sheets``, ``timeliness_from_sheets``). Everything
after that works on grid-sized data: regions x years x quarters, all parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.functions import codes
from surveil.functions.nulls import (
    any_of, is_in, not_number, not_whole, null_to_zero, pct_from_text, safe_pct, safe_ratio, sentinel_to_null, to_number, whole_number,
)
from surveil.functions.rules import meets_target
from surveil.functions.text import bad_quarter_key, composite_key, count_label, matches, quarter_parts, year_label
from surveil.operators.aggregates import incorrect_counts, rows
from surveil.operators.joins import densify, skew_join
from surveil.operators.reshape import (
    ROW, SHEET, drop_first_n, header_cells, header_fallback, pivot_long, pivot_wide, repair_header,
)
from surveil.operators.windows import fill_down, row_index

QUARTER = ("year", "quarter")


# ---- from case facts -----------------------------------------------------------------

def quarter_counts(facts: DataFrame, day: str, passed: Column, by: Sequence[str] = ()) -> DataFrame:
    """Cases and passing cases per quarter (and region)."""
    return facts.groupBy(*by, F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(
        rows().alias("n"), F.count(F.when(passed, 1)).alias("n_pass")
    )


def quarter_completeness(
    facts: DataFrame, day: str, fields: dict[str, str], by: Sequence[str] = ()
) -> DataFrame:
    """Share of cases per quarter in which each field is filled in, and the average share.

    ``fields`` maps an indicator name (var1, var2, ...) to a column of the facts.
    """
    filled = facts.groupBy(*by, F.year(day).alias("year"), F.quarter(day).alias("quarter")).agg(
        rows().alias("n"), *[F.count(c).alias(v) for v, c in fields.items()]
    )
    shares = filled.withColumns({v: safe_ratio(v, "n") for v in fields})
    average = sum((F.col(v) for v in fields), F.lit(0.0)) / len(fields)
    return shares.withColumn("complete_pct_avg", average)


# ---- the grid ------------------------------------------------------------------------

def labelled_grid(
    counts: DataFrame,
    full_grid: DataFrame,
    current: tuple[int, int],
    with_year: bool = False,
    n: str = "n",
) -> DataFrame:
    """Every grid cell with its count, 0 where there is none, and its label.

    Rows outside the grid, such as a sheet's total row, drop out.
    """
    out = densify(counts, full_grid, full_grid.columns, zero=[n])
    suffix = year_label("year") if with_year else None
    return out.withColumn("label", count_label("quarter", n, "year", current, suffix))


def with_rates(df: DataFrame, passed: str = "n_pass", n: str = "n", name: str = "rate") -> DataFrame:
    """Percent passing, and the row number in grid order."""
    order = [c for c in ("region", *QUARTER) if c in df.columns]
    return row_index(df.withColumn(name, safe_pct(passed, n)), order)


# ---- from sheets ---------------------------------------------------------------------

def pass_rates_from_sheets(sheets: DataFrame, header_rows: int, **header: tuple[int, str]) -> DataFrame:
    """Pass rate per quarter from tabulations with merged header cells.

    Each sheet is one quarter. ``header`` gives the cells that hold year, quarter and
    region; below the header, c1 is the row label (rowmiss, pass, Total), c2 its count and
    c3 its percent, all text.
    """
    keys = list(header)
    body = drop_first_n(header_cells(sheets, **header), header_rows).select(
        *keys, F.col("c1").alias("label"), F.col("c2").alias("cell_N"), F.col("c3").alias("cell_PCT")
    )
    cells = pivot_long(body, [*keys, "label"], ["cell", "metric"])
    wide = pivot_wide(
        cells, keys, ["label", "metric"],
        [(r, m) for r in ("rowmiss", "pass", "Total") for m in ("N", "PCT")], "value",
    )
    numbers = {k: whole_number(k) for k in QUARTER if k in keys}
    return wide.withColumns(
        numbers
        | {
            "n": null_to_zero(whole_number("Total_N", "bigint")),
            "var6": pct_from_text("pass_PCT", "Total_N", "pass_N"),
        }
    )


TOTALS = ("Total", "Column Total")


def pass_rate_grid(
    sheets: DataFrame, header_rows: int, full_grid: DataFrame, current: tuple[int, int], **header: tuple[int, str]
) -> DataFrame:
    """``pass_rates_from_sheets`` on the full grid: absent quarters have n 0, their label and no rate."""
    rates = pass_rates_from_sheets(sheets, header_rows, **header)
    return labelled_grid(rates.select(*full_grid.columns, "n", "var6"), full_grid, current)


def completeness_rows(sheets: DataFrame, names: Sequence[str], skip: int) -> DataFrame:
    """The data rows of printed completeness sheets, all text: ``skip`` header rows, total rows and blank rows are gone."""
    body = repair_header(sheets, names, skip)
    return body.filter(sentinel_to_null("year_qrtr", *TOTALS).isNotNull())


def completeness_checks(names: Sequence[str]) -> dict[str, Column]:
    """What can be wrong with a row of ``completeness_rows``, for ``rejects.split_rows``."""
    shares = [c for c in names if c not in ("region", "year_qrtr", "n")]
    return {
        "year_qrtr is no year and quarter": bad_quarter_key("year_qrtr"),
        "n is not a whole number": not_whole("n"),
        **{f"{c} is not a number": not_number(c) for c in shares},
    }


def completeness_values(body: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows of ``completeness_rows`` as numbers; one that fails a check is an error."""
    year, quarter = quarter_parts("year_qrtr")
    wrong = F.raise_error(F.concat(F.lit("no year and quarter: "), F.coalesce(F.col("year_qrtr"), F.lit("null")))).cast("int")
    shares = [c for c in names if c not in ("region", "year_qrtr", "n")]
    return body.select(
        *[c for c in ("region",) if c in names],
        F.coalesce(year, wrong).alias("year"),
        F.coalesce(quarter, wrong).alias("quarter"),
        whole_number("n", "bigint").alias("n"),
        *[to_number(c).alias(c) for c in shares],
    )


def completeness_from_sheets(sheets: DataFrame, names: Sequence[str], skip: int) -> DataFrame:
    """Printed sheets with one row per quarter, keyed '2023-2', under ``skip`` header rows.

    Total rows and blank rows go; a key that is no year and quarter is an error. To go on without such rows and
    see them, split ``completeness_rows`` by ``completeness_checks``.

    ``names`` names the cells by position; ``region`` and ``year_qrtr`` stay text, ``n`` is
    a count and all others are shares.
    """
    return completeness_values(completeness_rows(sheets, names, skip), names)


def timeliness_rows(
    sheets: DataFrame, names: Sequence[str], skip: int, keys: Sequence[str], header_row: int | None = None
) -> DataFrame:
    """The data rows of timeliness tabulations with their group names carried down; keys and counts as printed."""
    if header_row is not None:
        named = repair_header(sheets, names)
        body = drop_first_n(header_fallback(named, ["n_pass", "n"], header_row), skip)
    else:
        body = repair_header(sheets, names, skip)
    total = any_of(is_in(k, TOTALS) for k in keys)
    heading = any_of(is_in(k, [k.capitalize()]) for k in keys)
    blank = F.coalesce("quarter", F.col("n_pass").cast("string"), F.col("n").cast("string")).isNull()
    groups = [k for k in keys if k != "quarter"]
    return fill_down(body.filter(~(total | heading | blank)), groups, [SHEET], ROW)


def timeliness_checks(keys: Sequence[str]) -> dict[str, Column]:
    """What can be wrong with a row of ``timeliness_rows``, for ``rejects.split_rows``."""
    return {
        **{f"{k} is missing": F.col(k).isNull() for k in keys},
        **{f"{c} is not a whole number": not_whole(c) for c in (*[k for k in keys if k in QUARTER], "n_pass", "n")},
    }


def timeliness_from_sheets(
    sheets: DataFrame, names: Sequence[str], skip: int, keys: Sequence[str], header_row: int | None = None
) -> DataFrame:
    """Pass and N per quarter from tabulations that print a group's name once.

    Columns are named by position, header rows dropped, numbers missing in the data taken
    from the header row, group names carried down, and header words among them removed.
    Only header rows, total rows and blank rows go: a year, quarter or count that is neither
    missing nor a whole number, and a data row without a quarter, are errors.
    """
    filled = timeliness_rows(sheets, names, skip, keys, header_row)
    lost = any_of(F.col(k).isNull() for k in keys)
    error = F.raise_error(F.concat(F.lit("a row without "), F.lit(" or ".join(keys)), F.lit(": "), F.to_json(F.struct(SHEET, ROW))))
    filled = filled.withColumn("quarter", F.when(lost, error.cast("string")).otherwise(F.col("quarter")))
    return timeliness_values(filled, keys)


def timeliness_values(filled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``timeliness_rows`` as numbers; text that is no whole number is an error."""
    return filled.select(
        SHEET,
        *[whole_number(k).alias(k) if k in QUARTER else F.col(k) for k in keys],
        whole_number("n_pass", "bigint").alias("n_pass"),
        whole_number("n", "bigint").alias("n"),
    )


def timeliness_grid(counts: DataFrame, full_grid: DataFrame, current: tuple[int, int], name: str) -> DataFrame:
    """``timeliness_from_sheets`` on the full grid, with label and year, percent passing as ``name`` and row number."""
    cells = counts.select(*full_grid.columns, "n_pass", "n")
    return with_rates(labelled_grid(cells, full_grid, current, with_year=True), name=name)


# ---- classification ------------------------------------------------------------------

def rejection_checks(by: Sequence[str] = ()) -> dict[str, Column]:
    """What can be wrong with a row of the rejections, for ``rejects.split_rows``: only rows that are counted need their keys."""
    counted = matches("reason", "Incorrect", ci=True)
    missing = {f"{c} is missing": counted & F.col(c).isNull() for c in by}
    return missing | {"year_qrtr is no year and quarter": counted & bad_quarter_key("year_qrtr")}


def incorrect_by_quarter(rejections: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejections for an incorrect classification per quarter, from a '2023-2' key.

    A key that is no year and quarter is an error; ``rejection_checks`` tells such rows beforehand.
    """
    year, quarter = quarter_parts("year_qrtr")
    counts = incorrect_counts(rejections.withColumns({"year": year, "quarter": quarter}), "reason", [*by, *QUARTER])
    lost = F.raise_error(F.concat(F.col("n_incorrect").cast("string"), F.lit(" rejections whose key is no year and quarter"))).cast("int")
    return counts.withColumns({c: F.coalesce(c, lost) for c in QUARTER})


def classification_rate(cells: DataFrame, incorrect: DataFrame, keys: Sequence[str], years: Sequence[int]) -> DataFrame:
    """Correctly classified cases per grid cell; the rate is given for ``years`` only.

    ``incorrect`` is summed to the keys first. Passing it by region while the keys are the
    quarter alone would otherwise repeat the state's rows once per region.
    """
    summed = incorrect.groupBy(*keys).agg(F.sum("n_incorrect").alias("n_incorrect"))
    joined = skew_join(cells, summed, keys, "left")
    return _with_rate(joined, years)


def classification_rate_as_written(
    cells: DataFrame, incorrect: DataFrame, keys: Sequence[str], years: Sequence[int]
) -> DataFrame:
    """As above without summing first: one row per matching region of ``incorrect``."""
    return _with_rate(skew_join(cells, incorrect.select(*keys, "n_incorrect"), keys, "left"), years)


def _with_rate(df: DataFrame, years: Sequence[int]) -> DataFrame:
    correct = F.col("n") - null_to_zero("n_incorrect")
    return df.withColumn("n_correct", correct).withColumn(
        "pct_class_correct", F.when(is_in("year", years), safe_ratio("n_correct", "n"))
    )


def quarter_key(*cols: str) -> Column:
    return composite_key(cols)


# ---- series and targets --------------------------------------------------------------

def indicator_series(
    df: DataFrame,
    variables: Sequence[str],
    ids: Sequence[str] = ("region", "year", "quarter", "label"),
    indicators: dict[str, tuple[float, str]] | None = None,
) -> DataFrame:
    """The rows behind the charts: one per cell and indicator, with percent and target.

    ``indicators`` holds target and unit of each variable; fractions are shown times 100.
    """
    known = indicators or codes.INDICATORS
    doubles = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in variables])
    long = doubles.unpivot(list(ids), list(variables), "variable", "value")
    targets = F.create_map(*[F.lit(x) for v in variables for x in (v, float(known[v][0]))])
    factors = F.create_map(*[F.lit(x) for v in variables for x in (v, 100.0 if known[v][1] == "fraction" else 1.0)])
    percent = F.col("value") * factors[F.col("variable")]
    return long.select(*ids, "variable", percent.alias("percent"), targets[F.col("variable")].alias("target"))


def against_targets(series: DataFrame) -> DataFrame:
    return series.withColumn("meets_target", meets_target("percent", "target"))

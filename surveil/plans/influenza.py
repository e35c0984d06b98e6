"""Weekly influenza report: case check, typing, co-infections, seasons and trend."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.functions import codes
from surveil.functions.periods import ReportPeriod, Season, lag_days, mmwr_week, mmwr_year, within
from surveil.functions.rules import FAIL, comment_coinfection, flu_case_qc, flu_positive, test_group
from surveil.functions.nulls import is_in
from surveil.functions.text import text_positive
from surveil.functions.typing import flu_subtype, flu_type, report_category
from surveil.operators.aggregates import count_rows, month_counts, rows
from surveil.operators.collation import EXACT, collated, distinct_records, exact
from surveil.operators.joins import (
    attach_typing, cases_labs, cases_labs_totals, cases_labs_typing, interval_match, member_flag, skew_join,
)
from surveil.operators.setops import union_by_name
from surveil.operators.windows import cumulative_count

CASE = ("party_id", "case_id")
TYPING = ("test_group", "flu_type", "subtype", "report_category")


# ---- records -------------------------------------------------------------------------

def season_cases(cases: DataFrame, period: ReportPeriod | None = None, state: str | None = None) -> DataFrame:
    """Cases of the current season up to last week, in the jurisdiction."""
    if period is not None:
        cases = cases.filter(within("event_date", period.season_start, period.previous_week_end))
    return cases.filter(F.col("state") == state) if state is not None else cases


def known_labs(labs: DataFrame) -> DataFrame:
    """Records of listed tests, with the positive-text flag of the result value."""
    return labs.filter(F.col("test").isin(codes.known_tests(codes.FLU_TESTS))).withColumn(
        "value_positive",
        text_positive(F.collate("result_value", EXACT), codes.FLU_TEXT_POSITIVE, codes.FLU_TEXT_NEGATIVE),
    )


def _of_cases(labs: DataFrame, cases: DataFrame, narrowed: bool) -> DataFrame:
    """Labs of the selected cases. The case filter is the selective one, so the labs are
    cut to it before they are made distinct."""
    return skew_join(labs, cases.select("case_id"), ["case_id"], "left_semi") if narrowed else labs


def case_records(
    labs: DataFrame, cases: DataFrame, period: ReportPeriod | None = None, state: str | None = None, collation: str = EXACT
) -> DataFrame:
    """Distinct case-lab records of listed tests.

    ``collation`` is that of the warehouse, by which tests, state, key and records are compared here; the
    rules on these records compare byte for byte.
    """
    cases = season_cases(collated(cases, collation), period, state)
    labs = _of_cases(known_labs(collated(labs, collation)), cases, period is not None)
    return exact(cases_labs(labs, cases, "case_id"))


def case_check(
    labs: DataFrame,
    cases: DataFrame,
    period: ReportPeriod,
    state: str | None = None,
    whole_history: bool = False,
    stale_suspect: bool = False,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Case-lab records with positives per case and test group, Final QC and time lag.

    The selected cases are needed three times: to cut the labs, for the totals and in the
    records. ``keep`` writes them and reads them back, so they are found once.
    """
    cases = season_cases(cases, None if whole_history else period, state)
    cases = keep(cases.distinct()) if keep else cases
    labs = _of_cases(known_labs(labs), cases, not whole_history)
    checked = cases_labs_totals(
        labs,
        cases,
        "case_id",
        {"total_tests": None} | {f"{g.lower()}_positives": flu_positive(g) for g in codes.FLU_TESTS},
    )
    return checked.withColumns(
        {
            "final_qc": flu_case_qc(period.as_of, stale_suspect),
            "time_lag": lag_days("event_date", "specimen_date"),
        }
    )


def failed_rows(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("final_qc") == FAIL)


def failed_cases(checked: DataFrame) -> DataFrame:
    return failed_rows(checked).select("case_id").distinct()


# ---- positives and typing ------------------------------------------------------------

def positives(records: DataFrame) -> DataFrame:
    """Positive records labelled with their test group."""
    positive = is_in("result", codes.FLU_POSITIVE) | F.col("value_positive")
    return records.filter(positive).withColumn("test_group", test_group("test", codes.FLU_TESTS))


def positives_by_test(records: DataFrame) -> DataFrame:
    return count_rows(
        positives(records), ["test_group", "test", "result", "result_value", "local_description"]
    )


def typed(records: DataFrame, as_written: bool = False) -> DataFrame:
    """Positive RNA and culture records with type, subtype and reporting category."""
    found = positives(records.filter(F.col("test").isin([*codes.FLU_RNA, *codes.FLU_CULTURE])))
    return found.withColumns({"flu_type": flu_type(), "subtype": flu_subtype()}).withColumn(
        "report_category", report_category(as_written)
    )


def rows_with_typing(checked: DataFrame, typed_rows: DataFrame) -> DataFrame:
    """All records of a case with the array of its typing results."""
    return attach_typing(checked, typed_rows, CASE, TYPING)


def records_with_typing(labs: DataFrame, cases: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``case_records`` with ``rows_with_typing`` of the ``typed`` among them: lab columns, party and typing.

    The rules on typing read the lab alone. ``keep`` writes the distinct labs, which are needed twice, and reads them back.
    """
    labs = distinct_records(known_labs(labs).filter(F.col("case_id").isNotNull()))
    labs = keep(labs) if keep else labs
    return cases_labs_typing(labs, cases, typed(labs), CASE, "case_id", TYPING)


# ---- co-infections -------------------------------------------------------------------

def coinfections_by_date(typed_rows: DataFrame, days: int = 31, as_written: bool = False) -> DataFrame:
    """Cases with both types at most ``days`` apart.

    As written the case number alone is the case: findings of two parties under one number meet, any dated A
    with any B counts, and a number is listed once, here with its least party that has a dated A.
    """
    a, b = F.col("flu_type") == "Flu A", F.col("flu_type") == "Flu B"
    if as_written:
        dated = a & F.col("specimen_date").isNotNull()
        seen = typed_rows.groupBy("case_id").agg(F.min(F.when(dated, F.col("party_id"))).alias("party_id"), F.max(dated).alias("a"), F.max(b).alias("b"))
        return seen.filter("a and b").select(*CASE)
    return interval_match(typed_rows, CASE, "specimen_date", a, b, days)


def coinfections_by_comment(typed_rows: DataFrame) -> DataFrame:
    return typed_rows.filter(comment_coinfection()).select(*CASE).distinct()


def coinfections(typed_rows: DataFrame, days: int = 31, as_written: bool = False) -> DataFrame:
    """Co-infected cases by date or by comment, once each; as written, once per finding.

    A case is a party and its case number: the findings of two parties never meet, even under one
    number, and each party is listed.

    Both findings come from one aggregate over the typed rows.
    """
    if as_written:
        return union_by_name(
            coinfections_by_date(typed_rows, days, as_written=True), coinfections_by_comment(typed_rows)
        )
    a, b = F.col("flu_type") == "Flu A", F.col("flu_type") == "Flu B"
    return interval_match(typed_rows, CASE, "specimen_date", a, b, days, or_if=comment_coinfection())


def recode_coinfections(typed_rows: DataFrame, found: DataFrame, as_written: bool = False) -> DataFrame:
    """Type and category replaced on the records of co-infected cases.

    As written a case that was found twice has its records twice.
    """
    if as_written:
        flagged = skew_join(typed_rows, found.withColumn("__co", F.lit(True)), CASE, "left")
    else:
        flagged = member_flag(typed_rows, found, CASE, "__co")

    def recoded(value: str, column: str) -> Column:
        return F.when(F.col("__co"), value).otherwise(F.col(column))

    return flagged.withColumns(
        {
            "flu_type": recoded("Coinfection", "flu_type"),
            "report_category": recoded(codes.CATEGORY_COINFECTION, "report_category"),
        }
    ).drop("__co")


# ---- seasons and trend ---------------------------------------------------------------

def tag_season(df: DataFrame, day: str, seasons: list[Season]) -> DataFrame:
    """Rows inside the seasons, with the season label.

    The few seasons become one expression, so there is no range join, and their outer
    bounds reach the file scan as a plain date filter.
    """
    label = F
    for s in seasons:
        label = label.when(within(day, s.start, s.end), s.label)
    inside = within(day, min(s.start for s in seasons), max(s.end for s in seasons))
    return df.filter(inside).withColumn("season", label.otherwise(None)).filter(F.col("season").isNotNull())


def weekly_counts(df: DataFrame, day: str, seasons: list[Season]) -> DataFrame:
    """Rows per season and week with the running total of the season."""
    weekly = (
        tag_season(df, day, seasons)
        .groupBy("season", mmwr_year(day).alias("mmwr_year"), mmwr_week(day).alias("mmwr_week"))
        .agg(rows().alias("weekly_count"))
    )
    return cumulative_count(weekly, "weekly_count", ["season"], ["mmwr_year", "mmwr_week"], "cumulative_count")


def season_comparison(current: DataFrame, historic: DataFrame, period: ReportPeriod, earlier: int = 5) -> DataFrame:
    """Weekly and cumulative count at the last full week, this season against earlier ones."""
    seasons = period.season_windows(earlier)
    both = union_by_name(
        tag_season(historic.select("event_date"), "event_date", seasons[:-1]),
        tag_season(current.select("event_date"), "event_date", seasons[-1:]),
    ).drop("season")
    return weekly_counts(both, "event_date", seasons).filter(
        F.col("mmwr_week") == period.previous_epi_week[1]
    )


def monthly_trend(current: DataFrame, historic: DataFrame, period: ReportPeriod) -> DataFrame:
    """Rows per month over the last season and this one."""
    last, this = period.season_windows(1)
    both = union_by_name(
        tag_season(historic.select("event_date"), "event_date", [last]),
        tag_season(current.select("event_date"), "event_date", [this]),
    )
    return month_counts(both, "event_date")

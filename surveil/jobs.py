"""The four report jobs: read the inputs, run the plan, write the outputs.

Outputs go to ``<out>/<report>/as_of=<date>``. A table that several outputs need is written
once and read back, so the inputs are read once and a lost executor costs one stage, not
the whole job.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.functions.periods import ReportPeriod
from surveil.operators import rejects
from surveil.operators.aggregates import typing_summary
from surveil.operators.joins import grid
from surveil.operators.reshape import sort_report
from surveil.plans import covid, facilities, indicators, influenza
from surveil.sources import readers, writers


@dataclass(frozen=True)
class Job:
    spark: SparkSession
    out: str
    as_of: date

    @property
    def period(self) -> ReportPeriod:
        return ReportPeriod(self.as_of)

    def path(self, report: str) -> str:
        return f"{self.out}/{report}/as_of={self.as_of.isoformat()}"

    def save(self, df: DataFrame, report: str, fmt: str = "parquet") -> None:
        writers.write_report(df, f"{self.out}/{report}", self.as_of, fmt)

    def saved(self, df: DataFrame, report: str) -> DataFrame:
        """Write the report and go on from the written table."""
        self.save(df, report)
        return self.spark.read.schema(df.schema).parquet(self.path(report))


def covid_job(job: Job, labs: DataFrame, cases: DataFrame, state: str | None = None, **options) -> None:
    """Monthly classification check of the month before the report date."""
    job.save(covid.classification_report(labs, cases, job.period, state, **options), "covid_qc")


def influenza_job(
    job: Job, labs: DataFrame, cases: DataFrame, history: str, state: str | None = None, stale_suspect: bool = False
) -> None:
    """Weekly report. ``history`` holds an extract of all earlier seasons' typed rows for the report month
    (``writers.write_period_extract``)."""
    checked = job.saved(
        influenza.case_check(
            labs, cases, job.period, state, stale_suspect=stale_suspect, keep=lambda df: job.saved(df, "flu_cases")
        ),
        "flu_checked",
    )
    job.save(influenza.failed_cases(checked), "flu_failed_cases")
    job.save(influenza.positives_by_test(checked), "flu_positives_by_test", "csv")
    typed = job.saved(influenza.typed(checked), "flu_typed")
    job.save(influenza.rows_with_typing(checked, typed), "flu_checked_typing")
    job.save(influenza.rows_with_typing(influenza.failed_rows(checked), typed), "flu_failed_typing")
    found = job.saved(influenza.coinfections(typed), "flu_coinfections")
    recoded = job.saved(influenza.recode_coinfections(typed, found), "flu_labs")
    job.save(typing_summary(recoded), "flu_typing_summary", "csv")
    historic = readers.read_period_extract(job.spark, history, job.period)
    job.save(influenza.season_comparison(recoded, historic, job.period), "flu_season_comparison", "csv")
    job.save(influenza.monthly_trend(recoded, historic, job.period), "flu_monthly_trend", "csv")


def facilities_job(job: Job, feeds: DataFrame, **options) -> None:
    """Feed monitoring: the cleaned rows, the facility aggregate and the flagged facilities."""
    job.save(facilities.lab_rows(feeds), "lab_rows")
    names = job.saved(facilities.weekly_rows(feeds), "facility_names")
    weekly = job.saved(facilities.weekly_statistics(names, **options), "facility_weeks")
    job.save(facilities.sorted_for_report(facilities.facility_aggregate(names, weekly)), "facility_aggregate", "csv")
    job.save(facilities.sorted_for_report(facilities.flagged_facilities(names, weekly)), "facility_flagged", "csv")


@dataclass(frozen=True)
class TimelinessSheets:
    """Exported sheets of one timeliness indicator (var8, var9 or pct_CDC) and how they are laid out."""

    variable: str
    scope: str
    sheets: DataFrame
    names: Sequence[str]
    skip: int
    header_row: int | None = None


@dataclass(frozen=True)
class PassRateSheets:
    """Exported tabulations of the pass rate; ``header`` says where year, quarter and region stand."""

    scope: str
    sheets: DataFrame
    header_rows: int
    header: dict[str, tuple[int, str]]


def indicators_job(
    job: Job,
    facts: DataFrame,
    day: str,
    passed: str,
    fields: dict[str, str],
    regions: list[str],
    years: list[int],
    current: tuple[int, int],
    rejections: DataFrame | None = None,
    rate_years: Sequence[int] = (),
    timeliness: Sequence[TimelinessSheets] = (),
    pass_rates: Sequence[PassRateSheets] = (),
) -> None:
    """Completeness, pass rate and classification per quarter for the regions and for the state, and the sheets' indicators.

    Rejections whose region or quarter cannot be read go to a report of their own with the reason, and are counted there.
    """
    quarters = [1, 2, 3, 4]
    incorrect = None
    if rejections is not None:
        rows = rejects.split_rows(rejections, indicators.rejection_checks(["region"]), job.path("indicator_rejection_rows"))
        job.save(rows.rejected, "indicator_rejected_rows")
        job.save(rejects.reject_counts(rows.rejected), "indicator_reject_counts", "csv")
        incorrect = job.saved(indicators.incorrect_by_quarter(rows.good, ["region"]), "indicator_rejections")
    scopes = {
        "region": grid(job.spark, region=regions, year=years, quarter=quarters),
        "state": grid(job.spark, year=years, quarter=quarters),
    }
    for scope, cells in scopes.items():
        by = [c for c in cells.columns if c == "region"]
        counts = indicators.quarter_counts(facts, day, F.col(passed), by)
        rates = indicators.with_rates(indicators.labelled_grid(counts, cells, current, with_year=True))
        job.save(sort_report(rates, *cells.columns), f"indicator_rates_{scope}", "csv")
        if incorrect is not None:
            grid_counts = indicators.labelled_grid(counts.drop("n_pass"), cells, current)
            correct = indicators.classification_rate(grid_counts, incorrect, cells.columns, rate_years)
            job.save(sort_report(correct, *cells.columns), f"indicator_classification_{scope}", "csv")
            _save_targets(job, correct, ["pct_class_correct"], cells.columns, f"indicator_targets_classification_{scope}")
        shares = indicators.quarter_completeness(facts, day, fields, by)
        _save_targets(job, indicators.labelled_grid(shares, cells, current), list(fields), cells.columns, f"indicator_targets_{scope}")
    for t in timeliness:
        cells = scopes[t.scope]
        counts = indicators.timeliness_from_sheets(t.sheets, t.names, t.skip, cells.columns, t.header_row)
        rates = job.saved(indicators.timeliness_grid(counts, cells, current, t.variable), f"indicator_{t.variable}_{t.scope}")
        _save_targets(job, rates, [t.variable], cells.columns, f"indicator_targets_{t.variable}_{t.scope}")
    for p in pass_rates:
        cells = scopes[p.scope]
        rates = job.saved(indicators.pass_rate_grid(p.sheets, p.header_rows, cells, current, **p.header), f"indicator_var6_{p.scope}")
        _save_targets(job, rates, ["var6"], cells.columns, f"indicator_targets_var6_{p.scope}")


def _save_targets(job: Job, rates: DataFrame, variables: list[str], keys: list[str], report: str) -> None:
    series = indicators.indicator_series(rates, variables, ids=[*keys, "label"])
    job.save(sort_report(indicators.against_targets(series), *keys, "variable"), report, "csv")

"""Monthly check that every lab record's case classification agrees with its tests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil.functions import codes
from surveil.functions.periods import ReportPeriod, within
from surveil.functions.rules import covid_classification_qc, covid_positive, inconclusive_qc
from surveil.operators.collation import EXACT, collated, exact
from surveil.operators.joins import cases_labs_totals

LAB_COLUMNS = (
    "patient_id", "lab_date", "disease_status", "specimen_date", "specimen_id",
    "specimen_received_date", "specimen_source", "accession_number", "test", "result",
    "result_value", "result_date",
)
CASE_COLUMNS = ("patient_id", "disease", "county", "case_closed", "notification_status")


def known_labs(labs: DataFrame, period: ReportPeriod | None = None, as_written: bool = False) -> DataFrame:
    """Records of listed tests, in the previous month when a period is given."""
    listed = codes.known_tests(codes.COVID_TESTS)
    if as_written:
        listed = [t for t in listed if t != codes.COVID_RNA_UNLISTED]
    labs = labs.filter(F.col("test").isin(listed))
    return labs.filter(within("lab_date", *period.previous_month)) if period else labs


def with_indicators(labs: DataFrame, ci: bool = True) -> DataFrame:
    return labs.withColumns(
        {f"{g.lower()}_positive": covid_positive(g, ci=ci) for g in codes.COVID_TESTS}
        | {"inconclusive_qc": inconclusive_qc()}
    )


def classification_report(
    labs: DataFrame,
    cases: DataFrame,
    period: ReportPeriod | None = None,
    state: str | None = None,
    as_written: bool = False,
    ci: bool = True,
    collation: str = EXACT,
) -> DataFrame:
    """One row per distinct case-lab record with case totals and Pass or Fail.

    ``collation`` is that of the warehouse: the codes in the rules, the state, the key that joins labs and
    cases, and DISTINCT compare texts by it. Records that it makes equal show the least text of each column.
    ``ci`` is about LIKE patterns; a collation that ignores case makes them ignore it too.
    """
    labs, cases = collated(labs, collation), collated(cases, collation)
    if state is not None:
        cases = cases.filter(F.col("state") == state)
    missing = [c for c in LAB_COLUMNS if c not in labs.columns] + [c for c in CASE_COLUMNS if c not in cases.columns]
    if missing:  # records are distinct over all of these columns, so none may be left out
        raise ValueError(f"missing columns: {missing}")
    labs = known_labs(labs, period, as_written).select(*LAB_COLUMNS)
    cases = cases.select(*CASE_COLUMNS)
    # The indicators follow from the record, so they are not shuffled with it.
    positive = {f"total_{g.lower()}": covid_positive(g, ci=ci) for g in codes.COVID_TESTS}
    rows = cases_labs_totals(labs, cases, "patient_id", {"total_tests": None} | positive)
    judged = with_indicators(rows, ci).withColumn("classification_qc", covid_classification_qc())
    indicators = [c for c in judged.columns if c not in rows.columns and c != "classification_qc"]
    facts = [c for c in rows.columns if c not in LAB_COLUMNS]
    return exact(judged.select(*LAB_COLUMNS, *indicators, *facts, "classification_qc"))

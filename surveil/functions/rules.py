"""Pass/Fail and Flag/Normal rules as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from surveil.functions import codes
from surveil.functions.nulls import ColumnOrName, any_of, as_col, if_else3, is_in, is_true
from surveil.functions.periods import older_than
from surveil.functions.text import like_any, matches, matches_any

PASS, FAIL = "Pass", "Fail"
FLAG, NORMAL = "Flag", "Normal"


# ---- test and result indicators ------------------------------------------------------

def test_group(test: ColumnOrName, groups: dict[str, tuple[str, ...]], other: str = "Unknown") -> Column:
    """Name of the first group that lists the test code."""
    test, label = as_col(test), F
    for name, listed in groups.items():
        label = label.when(test.isin(list(listed)), name)
    return label.otherwise(other)


def covid_positive(group: str, test="test", result="result", value="result_value", ci: bool = True) -> Column:
    """1 when a test of the group has a positive result code or positive result text."""
    positive = is_in(result, codes.COVID_POSITIVE) | like_any(value, codes.COVID_VALUE_LIKE[group], ci)
    if codes.COVID_RESULT_LIKE[group]:
        positive = positive | like_any(result, codes.COVID_RESULT_LIKE[group], ci)
    return F.when(is_in(test, codes.COVID_TESTS[group]) & positive, 1).otherwise(0)


def flu_positive(group: str, test="test", result="result", value_positive="value_positive") -> Column:
    positive = is_in(result, codes.FLU_POSITIVE) | as_col(value_positive)
    return F.when(is_in(test, codes.FLU_TESTS[group]) & positive, 1).otherwise(0)


def inconclusive_qc(test="test", result="result", value="result_value", status="disease_status") -> Column:
    """Pass for an Ag or Ab test without a conclusive result on a case that is not
    confirmed, and for a contact without a test."""
    open_result = any_of([is_in(c, codes.INCONCLUSIVE) | as_col(c).isNull() for c in (result, value)])
    listed = is_in(test, codes.COVID_AG + codes.COVID_AB)
    unconfirmed = is_in(status, ("Not a case", "Suspect", "Probable"))
    contact = is_in(status, ("Contact",)) & as_col(test).isNull()
    return F.when((listed & open_result & unconfirmed) | contact, PASS).otherwise(FAIL)


# ---- case rules ----------------------------------------------------------------------

def covid_classification_qc(rna="total_rna", ag="total_ag", ab="total_ab", status="disease_status") -> Column:
    """Does the case classification agree with the positive tests of the case?

    A confirmed case needs a positive RNA test, a probable one a positive antigen test and
    no RNA, a suspect or non-case neither. Antibodies allow every status that the other two
    allow, so ``ab`` only has to be known.
    """
    rna, ag, ab, status = as_col(rna), as_col(ag), as_col(ab), as_col(status)
    agrees = (
        ((rna >= 1) & (status == "Confirmed"))
        | ((rna == 0) & (ag >= 1) & (ab >= 0) & is_in(status, ("Probable",)))
        | ((rna == 0) & (ag == 0) & (ab >= 0) & is_in(status, ("Suspect", "Not a case")))
    )
    return if_else3(agrees, PASS, FAIL)


def flu_case_qc(
    as_of: date,
    stale_suspect: bool = False,
    stale_days: int = 32,
    status="disease_status",
    rna="rna_positives",
    culture="culture_positives",
    died="died",
) -> Column:
    """Influenza case check; reads the standard case column names.

    A confirmed case needs a positive RNA test, a positive culture or a death from the
    disease; other statuses pass; an unknown status gives null. Yamagata lineage in any
    result fails. ``stale_suspect`` also fails closed, never notified suspects with a
    positive RNA test whose event is older than ``stale_days``.
    """
    status = as_col(status)
    confirmed_ok = (as_col(rna) >= 1) | (as_col(culture) >= 1) | is_true(as_col(died) == "Yes")
    qc = F.when(matches_any(("result", "result_value"), "Yamagata", ci=True), FAIL)
    if stale_suspect:
        stale = (
            (as_col(rna) >= 1)
            & (status == "Suspect")
            & (F.col("case_closed") == "Yes")
            & F.col("notification_status").isNull()
            & older_than("event_date", as_of, stale_days)
        )
        qc = qc.when(stale, FAIL)
    return qc.when(status != "Confirmed", PASS).when(
        status == "Confirmed", F.when(confirmed_ok, PASS).otherwise(FAIL)
    )


# ---- facility flags ------------------------------------------------------------------

def _flag(condition: Column) -> Column:
    return F.when(condition, FLAG).otherwise(NORMAL)


def volume_flag(n: ColumnOrName, mean: ColumnOrName, sd: ColumnOrName, k: float) -> Column:
    """Volume outside mean plus or minus k SD; Normal while the mean is unknown."""
    n, mean, sd = as_col(n), as_col(mean), as_col(sd)
    return _flag((n > mean + k * sd) | (n < mean - k * sd))


def silence_flag(days: ColumnOrName, limit: int = 7) -> Column:
    return _flag(as_col(days) > limit)


def lag_flag(max_lag: ColumnOrName, mean_lag: ColumnOrName, factor: float = 2) -> Column:
    return _flag(as_col(max_lag) > as_col(mean_lag) * factor)


def any_flag(*flags: ColumnOrName) -> Column:
    return any_of([is_true(as_col(f) == FLAG) for f in flags])


def meets_target(value: ColumnOrName, target: ColumnOrName) -> Column:
    return as_col(value) >= as_col(target)


def comment_coinfection(comments: ColumnOrName = "comments") -> Column:
    """The comment names both types and speaks of no negative, RSV or COVID result."""
    return matches(comments, codes.COINFECTION_COMMENT, ci=True) & ~matches(
        comments, codes.COINFECTION_COMMENT_EXCLUDES, ci=True
    )

"""COVID-19 classification check and the operators it is made of."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveil.functions import codes, nulls, periods, rules, text
from surveil.operators import aggregates, joins
from surveil.plans import covid
from workload import bindings as b
from workload.registry import query

GROUPS = tuple(codes.COVID_TESTS)


def _in(col: str, values) -> str:
    return f"coalesce({col} IN ({b.sql_list(values)}), false)"


def _like(col: str, patterns) -> str:
    return " OR ".join(f"coalesce({col} ILIKE {b.sql_text(p)}, false)" for p in patterns)


def _positive(group: str) -> str:
    terms = [_in("result", codes.COVID_POSITIVE), _like("result_value", codes.COVID_VALUE_LIKE[group])]
    if codes.COVID_RESULT_LIKE[group]:
        terms.append(_like("result", codes.COVID_RESULT_LIKE[group]))
    return f"CAST({_in('test', codes.COVID_TESTS[group])} AND ({' OR '.join(terms)}) AS INTEGER)"


INDICATORS = ", ".join(f"{_positive(g)} AS {g.lower()}_positive" for g in GROUPS)
INCONCLUSIVE = f"""CASE WHEN ({_in('test', codes.COVID_AG + codes.COVID_AB)}
    AND ({_in('result', codes.INCONCLUSIVE)} OR result IS NULL
         OR {_in('result_value', codes.INCONCLUSIVE)} OR result_value IS NULL)
    AND {_in('disease_status', ('Not a case', 'Suspect', 'Probable'))})
    OR ({_in('disease_status', ('Contact',))} AND test IS NULL) THEN 'Pass' ELSE 'Fail' END"""
KNOWN = f"test IN ({b.sql_list(codes.known_tests(codes.COVID_TESTS))})"
MONTH = "lab_date BETWEEN DATE '2001-05-01' AND DATE '2001-05-31'"


def report_sql(where: str, case_where: str) -> str:
    return f"""WITH {b.SQL_COVID_LABS}, {b.SQL_COVID_CASES},
    joined AS (
      SELECT DISTINCT l.*, disease, county, case_closed, notification_status, {INDICATORS}, {INCONCLUSIVE} AS inconclusive_qc
      FROM covid_labs l JOIN covid_cases c ON l.patient_id = c.patient_id WHERE {KNOWN} AND {where} AND {case_where}),
    t AS (
      SELECT *, count(*) OVER w AS total_tests, CAST(sum(rna_positive) OVER w AS BIGINT) AS total_rna,
             CAST(sum(ag_positive) OVER w AS BIGINT) AS total_ag, CAST(sum(ab_positive) OVER w AS BIGINT) AS total_ab
      FROM joined WINDOW w AS (PARTITION BY patient_id))
    SELECT *, CASE WHEN c IS TRUE THEN 'Pass' WHEN c IS FALSE THEN 'Fail' END AS classification_qc
    FROM (SELECT *, (total_rna >= 1 AND disease_status = 'Confirmed')
        OR (total_rna = 0 AND total_ag >= 1 AND total_ab = 0 AND {_in('disease_status', ('Probable',))})
        OR (total_rna = 0 AND total_ag >= 1 AND total_ab >= 1 AND {_in('disease_status', ('Probable',))})
        OR (total_rna = 0 AND total_ag = 0 AND total_ab >= 1 AND {_in('disease_status', ('Suspect', 'Not a case'))})
        OR (total_rna = 0 AND total_ag = 0 AND total_ab = 0 AND {_in('disease_status', ('Suspect', 'Not a case'))})
        AS c FROM t)"""


def _exclude_c(sql: str) -> str:
    return sql.replace("SELECT *, CASE WHEN c IS TRUE", "SELECT * EXCLUDE (c), CASE WHEN c IS TRUE")


@query("covid_case_qc", _exclude_c(report_sql("true", "true")))
def covid_case_qc(spark, sf_dir):
    """The classification check over all records and cases."""
    return covid.classification_report(b.covid_labs(spark, sf_dir), b.covid_cases(spark, sf_dir))


@query("covid_monthly_report", _exclude_c(report_sql(MONTH, f"state = '{b.STATE}'")))
def covid_monthly_report(spark, sf_dir):
    """The same for the month before the report date and one jurisdiction."""
    return covid.classification_report(
        b.covid_labs(spark, sf_dir), b.covid_cases(spark, sf_dir), b.PERIOD, b.STATE
    )


@query(
    "previous_month_labs",
    f"""WITH {b.SQL_COVID_LABS} SELECT lab_date, test, count(*) AS n FROM covid_labs WHERE {MONTH}
    GROUP BY lab_date, test""",
)
def previous_month_labs(spark, sf_dir):
    labs = b.covid_labs(spark, sf_dir).filter(periods.within("lab_date", *b.PERIOD.previous_month))
    return aggregates.count_rows(labs, ["lab_date", "test"])


@query(
    "previous_month_bounds",
    f"""WITH {b.SQL_COVID_LABS}
    SELECT CAST(date_trunc('month', lab_date - INTERVAL 1 MONTH) AS DATE) AS month_start,
           CAST(date_trunc('month', lab_date) AS DATE) - 1 AS month_end, count(*) AS n
    FROM covid_labs GROUP BY 1, 2""",
)
def previous_month_bounds(spark, sf_dir):
    start, end = periods.previous_month_bounds("lab_date")
    labs = b.covid_labs(spark, sf_dir).select(start.alias("month_start"), end.alias("month_end"))
    return aggregates.count_rows(labs, ["month_start", "month_end"])


@query(
    "cases_labs_distinct",
    f"""WITH {b.SQL_COVID_LABS}, {b.SQL_COVID_CASES}
    SELECT DISTINCT l.*, disease, county, case_closed, notification_status, state
    FROM covid_labs l JOIN covid_cases c ON l.patient_id = c.patient_id WHERE state = '{b.STATE}'""",
)
def cases_labs_distinct(spark, sf_dir):
    cases = b.covid_cases(spark, sf_dir).filter(F.col("state") == b.STATE)
    return joins.cases_labs(b.covid_labs(spark, sf_dir), cases, "patient_id")


@query(
    "known_tests",
    f"WITH {b.SQL_COVID_LABS} SELECT test, count(*) AS n FROM covid_labs WHERE {KNOWN} GROUP BY test",
)
def known_tests(spark, sf_dir):
    return aggregates.count_rows(covid.known_labs(b.covid_labs(spark, sf_dir)), ["test"])


@query(
    "known_tests_as_written",
    f"""WITH {b.SQL_COVID_LABS} SELECT test, count(*) AS n FROM covid_labs
    WHERE {KNOWN} AND test <> {b.sql_text(codes.COVID_RNA_UNLISTED)} GROUP BY test""",
)
def known_tests_as_written(spark, sf_dir):
    return aggregates.count_rows(covid.known_labs(b.covid_labs(spark, sf_dir), as_written=True), ["test"])


@query(
    "like_positive",
    f"""WITH {b.SQL_COVID_LABS}, f AS (SELECT result, result_value, test IS NULL AS untested, {INDICATORS} FROM covid_labs)
    SELECT result, result_value, CAST(sum(rna_positive) AS BIGINT) AS rna, CAST(sum(ag_positive) AS BIGINT) AS ag,
           CAST(sum(ab_positive) AS BIGINT) AS ab
    FROM f GROUP BY result, result_value""",
)
def like_positive(spark, sf_dir):
    labs = covid.with_indicators(b.covid_labs(spark, sf_dir))
    return aggregates.sum_indicators(
        labs, ["result", "result_value"], **{g.lower(): F.col(f"{g.lower()}_positive") for g in GROUPS}
    )


@query(
    "inconclusive_rule",
    f"""WITH {b.SQL_COVID_LABS}
    SELECT disease_status, result, result_value, {INCONCLUSIVE} AS inconclusive_qc, count(*) AS n
    FROM covid_labs GROUP BY ALL""",
)
def inconclusive_rule(spark, sf_dir):
    labs = b.covid_labs(spark, sf_dir).withColumn("inconclusive_qc", rules.inconclusive_qc())
    return aggregates.count_rows(labs, ["disease_status", "result", "result_value", "inconclusive_qc"])


@query(
    "result_comparator",
    f"""WITH {b.SQL_COVID_LABS}
    SELECT result_value, coalesce(regexp_matches(result_value, '^[=><]\\s*[0-9]'), false) AS is_comparison,
           coalesce(regexp_matches(result_value, '^=[1-9]+ | ^>[1-9]+'), false) AS is_comparison_as_written,
           count(*) AS n
    FROM covid_labs GROUP BY ALL""",
)
def result_comparator(spark, sf_dir):
    labs = b.covid_labs(spark, sf_dir).select(
        "result_value",
        text.result_text_comparator("result_value").alias("is_comparison"),
        text.result_text_comparator("result_value", as_written=True).alias("is_comparison_as_written"),
    )
    return aggregates.count_rows(labs, labs.columns)


@query(
    "three_valued_rule",
    f"""WITH {b.SQL_COVID_LABS}
    SELECT disease_status, CASE WHEN disease_status = 'Confirmed' THEN 'Pass' WHEN disease_status <> 'Confirmed'
           THEN 'Fail' END AS unknown_stays_unknown,
           coalesce(disease_status IN ('Confirmed'), false) AS unknown_is_false, count(*) AS n
    FROM covid_labs GROUP BY ALL""",
)
def three_valued_rule(spark, sf_dir):
    status = F.col("disease_status")
    labs = b.covid_labs(spark, sf_dir).select(
        status,
        nulls.if_else3(status == "Confirmed", rules.PASS, rules.FAIL).alias("unknown_stays_unknown"),
        nulls.is_in(status, ["Confirmed"]).alias("unknown_is_false"),
    )
    return aggregates.count_rows(labs, labs.columns)

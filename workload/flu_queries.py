"""Influenza report: case check, typing, co-infections, seasons and trend."""

from __future__ import annotations

from pyspark.sql import functions as F

from surveil.functions import codes, periods, rules, text, typing
from surveil.operators import aggregates, joins, setops
from surveil.plans import influenza as flu
from surveil.sources.readers import read_period_extract
from surveil.sources.writers import write_period_extract
from workload import bindings as b
from workload.registry import query

GROUPS = tuple(codes.FLU_TESTS)
INPUTS = f"{b.SQL_FLU_LABS}, {b.SQL_CASES}"


def _in(col: str, values) -> str:
    return f"coalesce({col} IN ({b.sql_list(values)}), false)"


def _re(col: str, pattern: str, ci: bool = False) -> str:
    return f"coalesce(regexp_matches({col}, {b.sql_text(('(?i)' if ci else '') + pattern)}), false)"


TEXT_POSITIVE = f"({_re('result_value', codes.FLU_TEXT_POSITIVE, True)} AND NOT {_re('result_value', codes.FLU_TEXT_NEGATIVE, True)})"
KNOWN = f"test IN ({b.sql_list(codes.known_tests(codes.FLU_TESTS))})"
RECORDS = f"""known AS (SELECT *, {TEXT_POSITIVE} AS value_positive FROM flu_labs WHERE {KNOWN}),
    records AS (SELECT DISTINCT k.*, c.* EXCLUDE (case_id) FROM known k JOIN cases c ON k.case_id = c.case_id)"""
POSITIVE = f"({_in('result', codes.FLU_POSITIVE)} OR value_positive)"
GROUP = "CASE " + " ".join(f"WHEN {_in('test', codes.FLU_TESTS[g])} THEN '{g}'" for g in GROUPS) + " ELSE 'Unknown' END"


def _single(kind: str) -> str:
    return (
        f"({_re('test', codes.SINGLE_TARGET[kind], True)} AND NOT {_re('test', codes.SINGLE_TARGET_EXCLUDES)}"
        f" OR {_re('comments', codes.TYPE_IN_COMMENTS[kind], True)})"
    )


def _panel(kind: str, panel: str) -> str:
    return (
        f"({_re('test', panel)} AND {_re('result', codes.PANEL_RESULT[kind])}"
        f" OR ({_re('result_value', codes.PANEL_VALUE[kind], True)}"
        f" OR {_re('local_description', codes.PANEL_DESCRIPTION[kind], True)}))"
    )


def flu_type_sql(panel: str = codes.PANEL_AS_WRITTEN) -> str:
    whens = [(f(k), k) for f in (_single, lambda k: _panel(k, panel)) for k in ("Flu A", "Flu B")]
    return "CASE " + " ".join(f"WHEN {c} THEN '{k}'" for c, k in whens) + " ELSE 'Unknown' END"


UNABLE = (
    f"{_re('result', 'Unable', True)} OR {_re('result_value', 'Unable', True)}"
    f" OR {_re('local_description', 'Unable', True)} AND NOT ("
    + " OR ".join(_re(c, "invalid", True) for c in ("result", "result_value", "local_description"))
    + ")"
)
SUBTYPE = (
    "CASE "
    + " ".join(f"WHEN {' OR '.join(_re(c, p) for c in cols)} THEN '{n}'" for n, p, cols in codes.SUBTYPES)
    + f" WHEN {UNABLE} THEN 'Unable to Subtype' END"
)
CATEGORY = (
    "CASE "
    + " ".join(
        f"WHEN flu_type = '{t}' AND subtype {'IS NULL' if s is None else '= ' + b.sql_text(s)} THEN '{n}'"
        for t, s, n in codes.CATEGORIES
    )
    + """ WHEN flu_type = 'Coinfection' THEN 'Influenza virus co-infection' WHEN flu_type = 'Unknown' THEN 'Unknown'
      WHEN subtype = 'Unable to Subtype' {guard} THEN 'Influenza A (Unable to Subtype)' END"""
)
TYPED = f"""positive AS (SELECT *, {GROUP} AS test_group FROM records WHERE {POSITIVE}),
    typed0 AS (SELECT *, {flu_type_sql()} AS flu_type, {SUBTYPE} AS subtype FROM positive
               WHERE test_group IN ('RNA', 'Culture')),
    typed AS (SELECT *, {CATEGORY.format(guard="AND flu_type = 'Flu A'")} AS report_category FROM typed0)"""
BY_DATE = """by_date AS (
      SELECT DISTINCT a.party_id, a.case_id FROM typed a JOIN typed t ON a.case_id = t.case_id AND a.party_id = t.party_id
      WHERE a.flu_type = 'Flu A' AND t.flu_type = 'Flu B' AND abs(a.specimen_date - t.specimen_date) <= 31)"""
COMMENT = f"({_re('comments', codes.COINFECTION_COMMENT, True)} AND NOT {_re('comments', codes.COINFECTION_COMMENT_EXCLUDES, True)})"
BY_COMMENT = f"by_comment AS (SELECT DISTINCT party_id, case_id FROM typed WHERE {COMMENT})"
COINFECTIONS = f"{BY_DATE}, {BY_COMMENT}, co AS (SELECT * FROM by_date UNION SELECT * FROM by_comment)"
ALL = f"WITH {INPUTS}, {RECORDS}, {TYPED}"


def _records(spark, sf_dir):
    return flu.case_records(b.flu_labs(spark, sf_dir), b.cases(spark, sf_dir))


def _typed(spark, sf_dir, **options):
    return flu.typed(_records(spark, sf_dir), **options)


# ---- case check ----------------------------------------------------------------------

def _check_sql(case_where: str, stale: bool = False) -> str:
    sums = ", ".join(
        f"CAST(sum(CAST({_in('test', codes.FLU_TESTS[g])} AND {POSITIVE} AS INTEGER)) OVER w AS BIGINT) AS {g.lower()}_positives"
        for g in GROUPS
    )
    late = (
        """WHEN rna_positives >= 1 AND disease_status = 'Suspect' AND case_closed = 'Yes'
           AND notification_status IS NULL AND event_date < DATE '2001-06-30' - 32 THEN 'Fail'"""
        if stale
        else ""
    )
    # The six clauses of the rule in full; a count is never negative, so "(a >= 0 or b >= 0)" holds.
    return f"""WITH {INPUTS}, {RECORDS.replace("JOIN cases c ON k.case_id = c.case_id",
        f"JOIN cases c ON k.case_id = c.case_id WHERE {case_where}")},
    t AS (SELECT *, count(*) OVER w AS total_tests, {sums} FROM records WINDOW w AS (PARTITION BY case_id)),
    q AS (SELECT *,
       coalesce(disease_status = 'Confirmed' AND died = 'Yes' AND died IS NOT NULL, disease_status = 'Confirmed' AND false)
       OR ((rna_positives >= 1 OR culture_positives >= 1) AND disease_status = 'Confirmed')
       OR (ag_positives >= 1 AND ab_positives = 0 AND disease_status <> 'Confirmed')
       OR (ag_positives = 0 AND ab_positives >= 1 AND disease_status <> 'Confirmed')
       OR (ag_positives >= 1 AND ab_positives >= 1 AND disease_status <> 'Confirmed')
       OR (ag_positives = 0 AND ab_positives = 0 AND disease_status <> 'Confirmed') AS ok FROM t)
    SELECT * EXCLUDE (ok), CAST(event_date - specimen_date AS INTEGER) AS time_lag,
           CASE WHEN {_re('result', 'Yamagata', True)} OR {_re('result_value', 'Yamagata', True)} THEN 'Fail' {late}
                WHEN ok IS TRUE THEN 'Pass' WHEN ok IS FALSE THEN 'Fail' END AS final_qc
    FROM q"""


SEASON_CASES = f"event_date BETWEEN DATE '2000-10-01' AND DATE '2001-06-23' AND state = '{b.STATE}'"


@query("flu_case_qc", _check_sql("true"))
def flu_case_qc(spark, sf_dir):
    """The case check over all cases."""
    return flu.case_check(b.flu_labs(spark, sf_dir), b.cases(spark, sf_dir), b.PERIOD, whole_history=True)


@query("flu_season_qc", _check_sql(SEASON_CASES))
def flu_season_qc(spark, sf_dir):
    """The weekly report: this season's cases of one jurisdiction."""
    return flu.case_check(
        b.flu_labs(spark, sf_dir), b.cases(spark, sf_dir), b.PERIOD, b.STATE, keep=lambda df: b.kept(spark, df, "season-cases")
    )


@query(
    "failed_cases",
    f"SELECT DISTINCT case_id FROM ({_check_sql('true')}) WHERE final_qc = 'Fail'",
)
def failed_cases(spark, sf_dir):
    return flu.failed_cases(flu_case_qc(spark, sf_dir))


@query(
    "stale_suspects",
    f"""SELECT case_id, test, result, result_value, specimen_date, final_qc FROM ({_check_sql('true', stale=True)})
    WHERE disease_status = 'Suspect' AND event_date < DATE '2001-06-30' - 32""",
)
def stale_suspects(spark, sf_dir):
    """Old suspects under the check with the stale-suspect rule switched on."""
    checked = flu.case_check(
        b.flu_labs(spark, sf_dir), b.cases(spark, sf_dir), b.PERIOD, whole_history=True, stale_suspect=True
    )
    old = (F.col("disease_status") == "Suspect") & periods.older_than("event_date", b.PERIOD.as_of, 32)
    return checked.filter(old).select("case_id", "test", "result", "result_value", "specimen_date", "final_qc")


# ---- text and codes ------------------------------------------------------------------

@query(
    "text_positive",
    f"""WITH {b.SQL_FLU_LABS} SELECT result_value, {TEXT_POSITIVE} AS value_positive, count(*) AS n
    FROM flu_labs GROUP BY result_value""",
)
def text_positive(spark, sf_dir):
    labs = b.flu_labs(spark, sf_dir).select(
        "result_value",
        text.text_positive("result_value", codes.FLU_TEXT_POSITIVE, codes.FLU_TEXT_NEGATIVE).alias("value_positive"),
    )
    return aggregates.count_rows(labs, labs.columns)


@query(
    "test_group_counts",
    f"""WITH {b.SQL_FLU_LABS} SELECT {GROUP} AS test_group, {_in('result', codes.FLU_POSITIVE)} AS is_positive,
      count(*) AS n FROM flu_labs GROUP BY ALL""",
)
def test_group_counts(spark, sf_dir):
    labs = b.flu_labs(spark, sf_dir).select(
        rules.test_group("test", codes.FLU_TESTS).alias("test_group"),
        text.result_is_positive("result", codes.FLU_POSITIVE).alias("is_positive"),
    )
    return aggregates.count_rows(labs, labs.columns)


@query(
    "positives_by_test",
    ALL + """ SELECT test_group, test, result, result_value, local_description, count(*) AS n FROM positive GROUP BY ALL""",
)
def positives_by_test(spark, sf_dir):
    return flu.positives_by_test(_records(spark, sf_dir))


# ---- typing --------------------------------------------------------------------------

@query("flu_typing", ALL + " SELECT test, flu_type, count(*) AS n FROM typed GROUP BY ALL")
def flu_typing(spark, sf_dir):
    return aggregates.count_rows(_typed(spark, sf_dir), ["test", "flu_type"])


@query(
    "flu_typing_word_and",
    f"""WITH {b.SQL_FLU_LABS} SELECT test, {flu_type_sql(codes.PANEL_INTENDED)} AS flu_type, count(*) AS n
    FROM flu_labs GROUP BY ALL""",
)
def flu_typing_word_and(spark, sf_dir):
    """Typing of all lab rows, with "and" in a panel name read as a word."""
    labs = b.flu_labs(spark, sf_dir).withColumn("flu_type", typing.flu_type(as_written=False))
    return aggregates.count_rows(labs, ["test", "flu_type"])


@query("flu_subtype", ALL + " SELECT test, result, result_value, subtype, count(*) AS n FROM typed GROUP BY ALL")
def flu_subtype(spark, sf_dir):
    return aggregates.count_rows(_typed(spark, sf_dir), ["test", "result", "result_value", "subtype"])


@query("report_category", ALL + " SELECT flu_type, subtype, report_category, count(*) AS n FROM typed GROUP BY ALL")
def report_category(spark, sf_dir):
    return aggregates.count_rows(_typed(spark, sf_dir), ["flu_type", "subtype", "report_category"])


@query(
    "report_category_as_written",
    ALL + f" SELECT flu_type, subtype, {CATEGORY.format(guard='')} AS category, count(*) AS n FROM typed0 GROUP BY ALL",
)
def report_category_as_written(spark, sf_dir):
    rows = _typed(spark, sf_dir, as_written=True).withColumnRenamed("report_category", "category")
    return aggregates.count_rows(rows, ["flu_type", "subtype", "category"])


@query(
    "typing_join",
    ALL + """, results AS (
      SELECT party_id, case_id, test_group, flu_type, subtype, report_category, count(*) AS n_typed
      FROM typed GROUP BY ALL),
    listed AS (
      SELECT party_id, case_id, string_agg(concat_ws('|', test_group, flu_type, coalesce(subtype, ''),
        coalesce(report_category, ''), n_typed), '; ' ORDER BY test_group, flu_type, subtype NULLS FIRST,
        report_category NULLS FIRST) AS typing
      FROM results GROUP BY ALL)
    SELECT r.case_id, r.specimen_date, r.test, r.result, r.result_value, r.local_description, r.comments, typing
    FROM records r LEFT JOIN listed s ON r.party_id = s.party_id AND r.case_id = s.case_id""",
)
def typing_join(spark, sf_dir):
    """The typing results of a case, rendered as text, on all its records."""
    records = flu.records_with_typing(b.flu_labs(spark, sf_dir), b.cases(spark, sf_dir), lambda labs: b.kept(spark, labs, "labs"))
    typing_text = F.transform(
        "typing",
        lambda t: F.concat_ws(
            "|", t.test_group, t.flu_type, F.coalesce(t.subtype, F.lit("")),
            F.coalesce(t.report_category, F.lit("")), t.n_typed.cast("string"),
        ),
    )
    return records.select(
        "case_id", "specimen_date", "test", "result", "result_value", "local_description", "comments",
        F.array_join(typing_text, "; ").alias("typing"),
    )


# ---- typing as flat rows -------------------------------------------------------------

@query(
    "typing_rows_by_result",
    ALL + """, results AS (
      SELECT party_id, case_id, test_group, flu_type, subtype, report_category, count(*) AS n_typed
      FROM typed GROUP BY ALL)
    SELECT flu_type, subtype, count(*) AS n, CAST(sum(coalesce(n_typed, 1)) AS BIGINT) AS n_plain_join
    FROM records r LEFT JOIN results s ON r.party_id = s.party_id AND r.case_id = s.case_id GROUP BY ALL""",
)
def typing_rows_by_result(spark, sf_dir):
    """Records per typing result of their case, and the rows a plain join would have."""
    records = _records(spark, sf_dir).select("party_id", "case_id", "test", "result", "specimen_date")
    flat = joins.typing_rows(flu.rows_with_typing(records, _typed(spark, sf_dir)))
    return flat.groupBy("flu_type", "subtype").agg(
        aggregates.rows().alias("n"), F.sum(F.coalesce("n_typed", F.lit(1))).alias("n_plain_join")
    )


@query(
    "typing_rows_as_written",
    ALL + """ SELECT t.flu_type, t.subtype, count(*) AS n
    FROM records r LEFT JOIN typed t ON r.party_id = t.party_id AND r.case_id = t.case_id GROUP BY ALL""",
)
def typing_rows_as_written(spark, sf_dir):
    """The plain join's rows: every typing result as often as it was found."""
    records = b.kept(spark, _records(spark, sf_dir), "records")
    nested = flu.rows_with_typing(records.select("party_id", "case_id", "test"), flu.typed(records))
    return aggregates.count_rows(joins.typing_rows(nested, dedupe=False), ["flu_type", "subtype"])


# ---- co-infections -------------------------------------------------------------------

@query("coinfection_by_date", f"{ALL}, {BY_DATE} SELECT * FROM by_date")
def coinfection_by_date(spark, sf_dir):
    return flu.coinfections_by_date(_typed(spark, sf_dir))


@query(
    "coinfection_by_date_as_written",
    f"""{ALL} SELECT min(party_id) FILTER (flu_type = 'Flu A' AND specimen_date IS NOT NULL) AS party_id, case_id FROM typed GROUP BY case_id
    HAVING count(*) FILTER (flu_type = 'Flu A' AND specimen_date IS NOT NULL) > 0
       AND count(*) FILTER (flu_type = 'Flu B') > 0""",
)
def coinfection_by_date_as_written(spark, sf_dir):
    return flu.coinfections_by_date(_typed(spark, sf_dir), as_written=True)


@query("coinfection_by_comment", f"{ALL}, {BY_COMMENT} SELECT * FROM by_comment")
def coinfection_by_comment(spark, sf_dir):
    return flu.coinfections_by_comment(_typed(spark, sf_dir))


@query("coinfection_all", f"{ALL}, {COINFECTIONS} SELECT * FROM co")
def coinfection_all(spark, sf_dir):
    return flu.coinfections(_typed(spark, sf_dir))


RECODED = f"""{ALL}, {COINFECTIONS}, recoded AS (
    SELECT t.* REPLACE (CASE WHEN co.case_id IS NOT NULL THEN 'Coinfection' ELSE flu_type END AS flu_type,
      CASE WHEN co.case_id IS NOT NULL THEN 'Influenza virus co-infection' ELSE report_category END AS report_category)
    FROM typed t LEFT JOIN co ON t.party_id = co.party_id AND t.case_id = co.case_id)"""


def _recoded(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    return flu.recode_coinfections(typed, flu.coinfections(typed))


@query("typed_report", RECODED + " SELECT * FROM recoded")
def typed_report(spark, sf_dir):
    """The typed rows that the weekly report saves."""
    return _recoded(spark, sf_dir)


@query("typing_summary", RECODED + " SELECT flu_type, subtype, count(*) AS n FROM recoded GROUP BY ALL")
def typing_summary(spark, sf_dir):
    return aggregates.typing_summary(_recoded(spark, sf_dir))


@query(
    "typing_summary_as_written",
    f"""{ALL}, {BY_DATE.replace('by_date AS', 'unused AS')}, by_date AS (
      SELECT party_id, case_id FROM typed GROUP BY ALL
      HAVING count(*) FILTER (flu_type = 'Flu A') > 0 AND count(*) FILTER (flu_type = 'Flu B') > 0),
    {BY_COMMENT}, co AS (SELECT * FROM by_date UNION ALL SELECT * FROM by_comment),
    recoded AS (SELECT CASE WHEN co.case_id IS NOT NULL THEN 'Coinfection' ELSE flu_type END AS flu_type, subtype
                FROM typed t LEFT JOIN co ON t.party_id = co.party_id AND t.case_id = co.case_id)
    SELECT flu_type, subtype, CASE WHEN flu_type = 'Coinfection' THEN (SELECT count(*) FROM co) ELSE count(*) END AS n
    FROM recoded GROUP BY flu_type, subtype""",
)
def typing_summary_as_written(spark, sf_dir):
    """Cases found twice listed twice, and every co-infection row showing the list's length."""
    typed = b.kept(spark, _typed(spark, sf_dir), "typed")
    found = flu.coinfections(typed, as_written=True)
    recoded = flu.recode_coinfections(typed, found, as_written=True)
    return aggregates.typing_summary(recoded, found, as_written=True)


# ---- seasons and trend ---------------------------------------------------------------

SEASON = "CASE " + " ".join(
    f"WHEN event_date BETWEEN DATE '{s.start}' AND DATE '{s.end}' THEN '{s.label}'"
    for s in b.PERIOD.season_windows()
) + " END"


@query(
    "season_comparison",
    f"""WITH {b.SQL_CASES}, s AS (
      SELECT {SEASON} AS season, {b.sql_mmwr_year('event_date')} AS mmwr_year,
             {b.sql_mmwr_week('event_date')} AS mmwr_week FROM cases),
    w AS (SELECT season, mmwr_year, mmwr_week, count(*) AS weekly_count FROM s WHERE season IS NOT NULL GROUP BY ALL),
    c AS (SELECT *, CAST(sum(weekly_count) OVER (PARTITION BY season ORDER BY mmwr_year, mmwr_week
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_count FROM w)
    SELECT * FROM c WHERE mmwr_week = {b.PERIOD.previous_epi_week[1]}""",
)
def season_comparison(spark, sf_dir):
    cases = b.cases(spark, sf_dir)
    return flu.season_comparison(cases, cases, b.PERIOD)


@query(
    "season_report",
    f"""{ALL}, s AS (
      SELECT {SEASON} AS season, {b.sql_mmwr_year('event_date')} AS mmwr_year,
             {b.sql_mmwr_week('event_date')} AS mmwr_week FROM typed),
    w AS (SELECT season, mmwr_year, mmwr_week, count(*) AS weekly_count FROM s WHERE season IS NOT NULL GROUP BY ALL),
    c AS (SELECT *, CAST(sum(weekly_count) OVER (PARTITION BY season ORDER BY mmwr_year, mmwr_week
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_count FROM w)
    SELECT * FROM c WHERE mmwr_week = {b.PERIOD.previous_epi_week[1]}""",
)
def season_report(spark, sf_dir):
    """Typed rows of all seasons through the history writer and reader into the comparison of six seasons."""
    typed = _typed(spark, sf_dir)
    base = b.scratch(spark, "history")
    write_period_extract(typed, base, b.PERIOD)
    history = read_period_extract(spark, base, b.PERIOD)
    return flu.season_comparison(history, history, b.PERIOD)


@query(
    "season_weeks",
    f"""WITH {b.SQL_CASES}, s AS (
      SELECT {SEASON} AS season, {b.sql_mmwr_year('event_date')} AS mmwr_year,
             {b.sql_mmwr_week('event_date')} AS mmwr_week FROM cases),
    w AS (SELECT season, mmwr_year, mmwr_week, count(*) AS weekly_count FROM s WHERE season IS NOT NULL GROUP BY ALL)
    SELECT *, CAST(sum(weekly_count) OVER (PARTITION BY season ORDER BY mmwr_year, mmwr_week
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cumulative_count FROM w""",
)
def season_weeks(spark, sf_dir):
    """Every week of the six seasons with its running total."""
    return flu.weekly_counts(b.cases(spark, sf_dir), "event_date", b.PERIOD.season_windows())


@query(
    "season_year",
    f"""WITH {b.SQL_CASES} SELECT CAST({b.sql_mmwr_year('event_date')}
        - CASE WHEN {b.sql_mmwr_week('event_date')} >= 40 THEN 0 ELSE 1 END AS INTEGER) AS season_year, count(*) AS n
    FROM cases GROUP BY 1""",
)
def season_year(spark, sf_dir):
    seasons = b.cases(spark, sf_dir).select(periods.season_year("event_date").alias("season_year"))
    return aggregates.count_rows(seasons, ["season_year"])


@query(
    "monthly_trend",
    f"""WITH {b.SQL_CASES}, m AS (
      SELECT date_trunc('month', event_date) AS mon, count(*) AS n FROM cases
      WHERE event_date BETWEEN DATE '{b.PERIOD.season_windows(1)[0].start}' AND DATE '{b.PERIOD.previous_week_end}'
      GROUP BY 1)
    SELECT CAST(year(mon) AS INTEGER) AS year, CAST(month(mon) AS INTEGER) AS month, n,
           CAST(row_number() OVER (ORDER BY mon) AS INTEGER) AS rownum, strftime(mon, '%B %Y') AS month_year
    FROM m""",
)
def monthly_trend(spark, sf_dir):
    cases = b.cases(spark, sf_dir)
    return flu.monthly_trend(cases, cases, b.PERIOD)


@query(
    "member_flag",
    f"""WITH {INPUTS}, {RECORDS} SELECT case_id, case_id IN (SELECT case_id FROM records) AS has_known_lab FROM cases""",
)
def member_flag(spark, sf_dir):
    """Does the case have a listed lab test?"""
    cases = b.cases(spark, sf_dir).select("case_id")
    return joins.member_flag(cases, flu.known_labs(b.flu_labs(spark, sf_dir)), ["case_id"], "has_known_lab")


@query(
    "natural_join",
    f"""WITH {b.SQL_CASES}, n AS (SELECT state, disease_status, count(*) AS n_status FROM cases GROUP BY ALL)
    SELECT c.case_id, c.state, c.disease_status, n_status FROM cases c
    LEFT JOIN n ON c.state IS NOT DISTINCT FROM n.state AND c.disease_status IS NOT DISTINCT FROM n.disease_status""",
)
def natural_join(spark, sf_dir):
    """Left join on whatever columns are shared; a missing status matches itself."""
    cases = b.cases(spark, sf_dir).select("case_id", "state", "disease_status")
    sizes = aggregates.count_rows(cases, ["state", "disease_status"], "n_status")
    return joins.natural_left_join(cases, sizes)


@query(
    "first_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 3",
)
def first_rows(spark, sf_dir):
    from surveil.operators.reshape import first_n

    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return first_n(orders, [F.desc("o_totalprice"), "o_orderkey"], 3)


@query(
    "first_per_case",
    f"""WITH {INPUTS}, {RECORDS} SELECT case_id, specimen_date, test, result, result_value FROM records
    QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY specimen_date DESC, test, result NULLS FIRST,
      result_value NULLS FIRST) = 1""",
)
def first_per_case(spark, sf_dir):
    """The newest record of each case, with the tie-break stated."""
    newest = [F.desc("specimen_date"), "test", "result", "result_value"]
    first = aggregates.first_per_key(_records(spark, sf_dir), ["case_id"], newest)
    return first.select("case_id", "specimen_date", "test", "result", "result_value")


@query(
    "distinct_rows",
    f"WITH {b.SQL_FLU_LABS} SELECT DISTINCT test, result, comments FROM flu_labs",
)
def distinct_rows(spark, sf_dir):
    return aggregates.distinct_rows(b.flu_labs(spark, sf_dir), ["test", "result", "comments"])


@query(
    "union_distinct",
    f"""{ALL}, {BY_DATE}, {BY_COMMENT}
    SELECT case_id FROM by_date UNION SELECT case_id FROM by_comment""",
)
def union_distinct(spark, sf_dir):
    typed = _typed(spark, sf_dir)
    return setops.union_distinct(
        flu.coinfections_by_date(typed).select("case_id"), flu.coinfections_by_comment(typed).select("case_id")
    )

"""Collations, rejected rows, numbered order and splittable text on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surveil.functions import codes, rules
from surveil.functions.text import QUARTER_KEY
from surveil.operators import aggregates, joins, ordering, rejects
from surveil.operators.collation import EXACT, IGNORE_CASE, collated
from surveil.plans import covid, influenza
from surveil.plans import indicators as ind
from surveil.sources import writers
from workload import bindings as b
from workload import covid_queries as cq
from workload import indicator_queries as iq
from workload.registry import query

# ---- collations ----------------------------------------------------------------------


def mixed_case(c: Column, index: Column) -> Column:
    """The same text as one feed shouts it, another whispers it and a third writes it."""
    return F.when(index % 3 == 0, F.upper(c)).when(index % 3 == 1, F.lower(c)).otherwise(c)


def sql_mixed(c: str, index: str) -> str:
    return f"CASE ({index}) % 3 WHEN 0 THEN upper({c}) WHEN 1 THEN lower({c}) ELSE {c} END"


MIXED = {"test": "specimen_id", "result": "specimen_id + 1", "result_value": "specimen_id", "disease_status": "patient_id"}
LAB_TEXTS = ("patient_id", "disease_status", "specimen_source", "accession_number", "test", "result", "result_value")
CASE_TEXTS = ("patient_id", "disease", "county", "case_closed", "notification_status")

SQL_MIXED = f"""{b.SQL_COVID_LABS.replace('covid_labs AS', 'plain_labs AS')}, {b.SQL_COVID_CASES.replace('covid_cases AS', 'plain_cases AS')},
  covid_labs AS (
    SELECT * REPLACE ({", ".join(f"{sql_mixed(c, i)} AS {c}" for c, i in MIXED.items())},
      {sql_mixed("'Pat ' || patient_id", 'specimen_id')} AS patient_id, CAST(specimen_id // 4 AS BIGINT) AS specimen_id) FROM plain_labs),
  covid_cases AS (SELECT * REPLACE ({sql_mixed("'Pat ' || patient_id", 'patient_id')} AS patient_id, {sql_mixed('state', 'patient_id')} AS state) FROM plain_cases)"""


def mixed_labs(spark, sf_dir) -> DataFrame:
    """Labs in which every feed has a case of its own; four lines of an order share a specimen, so some records differ in case alone."""
    labs = b.covid_labs(spark, sf_dir)
    texts = {c: mixed_case(F.col(c), F.expr(i)) for c, i in MIXED.items()}
    patient = mixed_case(F.concat(F.lit("Pat "), F.col("patient_id").cast("string")), F.col("specimen_id"))
    return labs.withColumns(texts | {"patient_id": patient, "specimen_id": F.floor(F.col("specimen_id") / 4)})


def mixed_cases(spark, sf_dir) -> DataFrame:
    cases = b.covid_cases(spark, sf_dir)
    patient = mixed_case(F.concat(F.lit("Pat "), F.col("patient_id").cast("string")), F.col("patient_id"))
    return cases.withColumns({"patient_id": patient, "state": mixed_case(F.col("state"), F.col("patient_id"))})


def _fold_in(col: str, values) -> str:
    return f"coalesce(lower({col}) IN ({b.sql_list([v.lower() for v in values])}), false)"


def _fold_positive(group: str) -> str:
    terms = [_fold_in("result", codes.COVID_POSITIVE), cq._like("result_value", codes.COVID_VALUE_LIKE[group])]
    if codes.COVID_RESULT_LIKE[group]:
        terms.append(cq._like("result", codes.COVID_RESULT_LIKE[group]))
    return f"CAST({_fold_in('test', codes.COVID_TESTS[group])} AND ({' OR '.join(terms)}) AS INTEGER)"


def _least(table: str, columns, texts) -> str:
    """DISTINCT that ignores case: one record per folded texts and exact other columns, with the least texts."""
    shown = ", ".join(f"min({c}) AS {c}" if c in texts else c for c in columns)
    keys = ", ".join(f"lower({table}.{c})" if c in texts else c for c in columns)
    return f"SELECT {shown} FROM {table} WHERE patient_id IS NOT NULL AND {{where}} GROUP BY {keys}"


FOLDED_REPORT = f"""WITH {SQL_MIXED},
  lab_records AS ({_least('covid_labs', covid.LAB_COLUMNS, LAB_TEXTS).format(where=f"lower(test) IN ({b.sql_list([t.lower() for t in codes.known_tests(codes.COVID_TESTS)])})")}),
  case_records AS ({_least('covid_cases', covid.CASE_COLUMNS, CASE_TEXTS).format(where=f"lower(state) = '{b.STATE.lower()}'")}),
  joined AS (
    SELECT l.*, disease, county, case_closed, notification_status, {", ".join(f"{_fold_positive(g)} AS {g.lower()}_positive" for g in codes.COVID_TESTS)},
      CASE WHEN ({_fold_in('test', codes.COVID_AG + codes.COVID_AB)}
        AND ({_fold_in('result', codes.INCONCLUSIVE)} OR result IS NULL OR {_fold_in('result_value', codes.INCONCLUSIVE)} OR result_value IS NULL)
        AND {_fold_in('disease_status', ('Not a case', 'Suspect', 'Probable'))}) OR ({_fold_in('disease_status', ('Contact',))} AND test IS NULL)
        THEN 'Pass' ELSE 'Fail' END AS inconclusive_qc
    FROM lab_records l JOIN case_records c ON lower(l.patient_id) = lower(c.patient_id)),
  t AS (
    SELECT *, count(*) OVER w AS total_tests, CAST(sum(rna_positive) OVER w AS BIGINT) AS total_rna,
      CAST(sum(ag_positive) OVER w AS BIGINT) AS total_ag, CAST(sum(ab_positive) OVER w AS BIGINT) AS total_ab
    FROM joined WINDOW w AS (PARTITION BY lower(patient_id))),
  judged AS (
    SELECT *, (total_rna >= 1 AND lower(disease_status) = 'confirmed')
      OR (total_rna = 0 AND total_ag >= 1 AND {_fold_in('disease_status', ('Probable',))})
      OR (total_rna = 0 AND total_ag = 0 AND {_fold_in('disease_status', ('Suspect', 'Not a case'))}) AS agrees FROM t)
  SELECT * EXCLUDE (agrees), CASE WHEN agrees IS TRUE THEN 'Pass' WHEN agrees IS FALSE THEN 'Fail' END AS classification_qc FROM judged"""

EXACT_REPORT = cq._exclude_c(cq.report_sql("true", f"state = '{b.STATE}'")).replace(f"{b.SQL_COVID_LABS}, {b.SQL_COVID_CASES}", SQL_MIXED)


@query("mixed_case_report", FOLDED_REPORT)
def mixed_case_report(spark, sf_dir):
    """The classification check as a warehouse runs it whose collation ignores case: codes, state, keys and DISTINCT."""
    return covid.classification_report(mixed_labs(spark, sf_dir), mixed_cases(spark, sf_dir), state=b.STATE, collation=IGNORE_CASE)


@query("mixed_case_report_exact", EXACT_REPORT)
def mixed_case_report_exact(spark, sf_dir):
    """The same labs and cases compared byte for byte: what is not written as listed counts as something else."""
    return covid.classification_report(mixed_labs(spark, sf_dir), mixed_cases(spark, sf_dir), state=b.STATE)


GROUP_CASES = " ".join(f"WHEN lower(test) IN ({b.sql_list([t.lower() for t in tests])}) THEN '{name}'" for name, tests in codes.COVID_TESTS.items())


@query(
    "mixed_case_groups",
    f"""WITH {SQL_MIXED} SELECT CASE {GROUP_CASES} ELSE 'Unknown' END AS test_group, min(result) AS result, count(*) AS n
    FROM covid_labs GROUP BY 1, lower(result)""",
)
def mixed_case_groups(spark, sf_dir):
    """Groups and counts by columns that carry a collation: one group per code however it is written."""
    labs = collated(mixed_labs(spark, sf_dir), columns=["test", "result"])
    named = labs.select(rules.test_group("test", codes.COVID_TESTS).alias("test_group"), "result")
    counts = named.groupBy("test_group", "result").agg(F.min(F.collate("result", EXACT)).alias("shown"), aggregates.rows().alias("n"))
    return counts.select("test_group", F.col("shown").alias("result"), "n")


@query(
    "mixed_case_keys",
    f"""WITH {SQL_MIXED}
    SELECT 'exact' AS compared, l.patient_id, c.county, count(*) AS n FROM covid_labs l LEFT JOIN covid_cases c ON l.patient_id = c.patient_id GROUP BY ALL
    UNION ALL
    SELECT 'ignoring case', l.patient_id, c.county, count(*) FROM covid_labs l LEFT JOIN covid_cases c ON lower(l.patient_id) = lower(c.patient_id) GROUP BY ALL""",
)
def mixed_case_keys(spark, sf_dir):
    """Text keys joined both ways."""
    labs, cases = mixed_labs(spark, sf_dir).select("patient_id"), mixed_cases(spark, sf_dir).select("patient_id", "county")
    modes = {"exact": None, "ignoring case": IGNORE_CASE}
    joined = [joins.skew_join(labs, cases, ["patient_id"], "left", collation=c).withColumn("compared", F.lit(name)) for name, c in modes.items()]
    return aggregates.count_rows(joined[0].unionByName(joined[1]), ["compared", "patient_id", "county"])


SQL_MIXED_FLU = f"""{b.SQL_FLU_LABS.replace('flu_labs AS', 'plain_labs AS')}, {b.SQL_CASES.replace('cases AS', 'plain_cases AS')},
  flu_labs AS (SELECT DISTINCT {sql_mixed("'Case ' || case_id", 'case_id')} AS case_id, specimen_date, {sql_mixed('test', 'case_id + 1')} AS test, result FROM plain_labs),
  cases AS (SELECT DISTINCT {sql_mixed("'Case ' || case_id", 'case_id + 1')} AS case_id, county FROM plain_cases WHERE lower(state) = 'america')"""
FLU_KNOWN = f"lower(test) IN ({b.sql_list([t.lower() for t in codes.known_tests(codes.FLU_TESTS)])})"


@query(
    "mixed_case_flu_records",
    f"""WITH {SQL_MIXED_FLU}, l AS (SELECT min(case_id) AS case_id, specimen_date, min(test) AS test, min(result) AS result
      FROM flu_labs WHERE {FLU_KNOWN} GROUP BY lower(case_id), specimen_date, lower(test), lower(result))
    SELECT l.*, county FROM l JOIN cases c ON lower(l.case_id) = lower(c.case_id)""",
)
def mixed_case_flu_records(spark, sf_dir):
    """The influenza records as a warehouse without case finds them."""
    labs, cases = b.flu_labs(spark, sf_dir), b.cases(spark, sf_dir)
    number = F.concat(F.lit("Case "), F.col("case_id").cast("string"))
    labs = labs.select(
        mixed_case(number, F.col("case_id")).alias("case_id"), "specimen_date", mixed_case(F.col("test"), F.col("case_id") + 1).alias("test"),
        "result", F.lit(None).cast("string").alias("result_value"),
    )
    cases = cases.select(mixed_case(number, F.col("case_id") + 1).alias("case_id"), "county", mixed_case(F.col("state"), F.col("case_id")).alias("state"))
    found = influenza.case_records(labs, cases, state="america", collation=IGNORE_CASE)
    return found.select("case_id", "specimen_date", "test", "result", "county")


# ---- rejected rows -------------------------------------------------------------------

SQL_PRINTED = f"""{b.SQL_CASES}, printed AS (
  SELECT case_id, CASE WHEN case_id % 13 = 5 THEN NULL ELSE state END AS region,
    CASE case_id % 11 WHEN 0 THEN year(event_date) || '.0-' || quarter(event_date) WHEN 1 THEN year(event_date) || '-Q' || quarter(event_date)
      WHEN 2 THEN NULL WHEN 3 THEN year(event_date) || ' / ' || quarter(event_date) || '.0' WHEN 4 THEN 'unknown' WHEN 5 THEN year(event_date) || '-' || (quarter(event_date) + 4)
      ELSE year(event_date) || '-' || quarter(event_date) END AS year_qrtr,
    CASE WHEN died IS NOT NULL THEN 'Incorrect case status' ELSE 'Missing data' END AS reason FROM cases),
  judged AS (SELECT *, reason LIKE 'Incorrect%' AND region IS NULL AS no_region,
    reason LIKE 'Incorrect%' AND NOT coalesce(regexp_matches(year_qrtr, '{QUARTER_KEY}'), false) AS no_key FROM printed),
  incorrect AS (SELECT region, CAST(regexp_extract(year_qrtr, '{QUARTER_KEY}', 1) AS INTEGER) AS year,
    CAST(regexp_extract(year_qrtr, '{QUARTER_KEY}', 2) AS INTEGER) AS quarter, count(*) AS n_incorrect
    FROM judged WHERE reason LIKE 'Incorrect%' AND NOT no_region AND NOT no_key GROUP BY ALL)"""


def printed_rejections(spark, sf_dir) -> DataFrame:
    """Rejections whose quarters are printed in several ways, some of them no quarter at all, some without a region."""
    case, year, quarter = F.col("case_id"), F.year("event_date").cast("string"), F.quarter("event_date").cast("string")
    key = (
        F.when(case % 11 == 0, F.concat(year, F.lit(".0-"), quarter)).when(case % 11 == 1, F.concat(year, F.lit("-Q"), quarter)).when(case % 11 == 2, None)
        .when(case % 11 == 3, F.concat(year, F.lit(" / "), quarter, F.lit(".0"))).when(case % 11 == 4, "unknown")
        .when(case % 11 == 5, F.concat(year, F.lit("-"), (F.quarter("event_date") + 4).cast("string"))).otherwise(F.concat(year, F.lit("-"), quarter))
    )
    reason = F.when(F.col("died").isNotNull(), "Incorrect case status").otherwise("Missing data")
    region = F.when(case % 13 != 5, F.col("state"))
    return b.cases(spark, sf_dir).select("case_id", region.alias("region"), key.alias("year_qrtr"), reason.alias("reason"))


def split_rejections(spark, sf_dir) -> rejects.Split:
    return rejects.split_rows(printed_rejections(spark, sf_dir), ind.rejection_checks(["region"]), b.scratch(spark, "rejections"))


@query(
    "rejected_keys",
    f"""WITH {SQL_PRINTED} SELECT case_id, region, year_qrtr, CASE WHEN no_region AND no_key THEN 'region is missing; year_qrtr is no year and quarter'
      WHEN no_region THEN 'region is missing' ELSE 'year_qrtr is no year and quarter' END AS reasons FROM judged WHERE no_region OR no_key""",
)
def rejected_keys(spark, sf_dir):
    """The rows that cannot be counted, each with all that is wrong with it."""
    rejected = split_rejections(spark, sf_dir).rejected
    return rejected.select("case_id", "region", "year_qrtr", F.array_join(rejects.REASONS, "; ").alias("reasons"))


@query(
    "reject_balance",
    f"""WITH {SQL_PRINTED} SELECT count(*) AS n_rows, count(*) FILTER (no_region OR no_key) AS n_rejected, count(*) FILTER (NOT (no_region OR no_key)) AS n_good,
      count(*) FILTER (no_region) AS n_region, count(*) FILTER (no_key) AS n_key, count(*) AS good_and_rejected FROM judged""",
)
def reject_balance(spark, sf_dir):
    """What was observed on the way, beside the rows of both sides: together they are the input."""
    split = split_rejections(spark, sf_dir)
    seen = {
        "n_rows": split.n_rows, "n_rejected": split.n_rejected, "n_good": split.n_rows - split.n_rejected,
        "n_region": split.by_reason["region is missing"], "n_key": split.by_reason["year_qrtr is no year and quarter"],
    }
    both = split.good.select("case_id").unionByName(split.rejected.select("case_id"))
    return both.agg(*[F.lit(n).cast("bigint").alias(c) for c, n in seen.items()], F.count_distinct("case_id").alias("good_and_rejected"))


@query("incorrect_counts_printed", f"WITH {SQL_PRINTED} SELECT * FROM incorrect")
def incorrect_counts_printed(spark, sf_dir):
    """Counts from keys such as 2023.0-2; what has no key is rejected and not lost."""
    return ind.incorrect_by_quarter(split_rejections(spark, sf_dir).good, ["region"])


@query(
    "classification_rate_printed",
    f"""WITH {SQL_PRINTED}, {iq.DENSE.replace(b.SQL_CASES + ', ', '')},
    j AS (SELECT d.region, d.year, d.quarter, n, n_incorrect FROM dense d LEFT JOIN incorrect i
          ON d.region = i.region AND d.year = i.year AND d.quarter = i.quarter)
    SELECT *, {iq.RATE} FROM j""",
)
def classification_rate_printed(spark, sf_dir):
    cells = ind.labelled_grid(iq.region_counts(spark, sf_dir), iq.region_grid(spark), iq.CURRENT).drop("label", "n_pass")
    incorrect = ind.incorrect_by_quarter(split_rejections(spark, sf_dir).good, ["region"])
    out = ind.classification_rate(cells, incorrect, ["region", "year", "quarter"], iq.RATE_YEARS)
    return out.withColumn("pct_class_correct", F.round("pct_class_correct", 6))


SHEET_NAMES = ["region", "year_qrtr", "n", "var1"]


@query(
    "rejected_sheet_rows",
    f"""WITH {SQL_PRINTED} SELECT CAST(case_id AS BIGINT) AS row_no,
      concat_ws('; ', CASE WHEN NOT coalesce(regexp_matches(year_qrtr, '{QUARTER_KEY}'), false) THEN 'year_qrtr is no year and quarter' END,
        CASE WHEN case_id % 7 = 3 THEN 'n is not a whole number' END, CASE WHEN case_id % 17 = 1 THEN 'var1 is not a number' END) AS reasons,
      CASE WHEN reasons = '' THEN CAST(regexp_extract(year_qrtr, '{QUARTER_KEY}', 1) AS INTEGER) END AS year, CASE WHEN reasons = '' THEN CAST(case_id % 100 AS BIGINT) END AS n
    FROM printed WHERE year_qrtr IS NOT NULL""",
)
def rejected_sheet_rows(spark, sf_dir):
    """Completeness sheets with cells that are no numbers: rows that can be read are, the others are kept as printed."""
    case = F.col("case_id")
    sheets = printed_rejections(spark, sf_dir).select(
        F.lit("s").alias("sheet_id"), case.alias("row_no"), "region", "year_qrtr",
        F.concat((case % 100).cast("string"), F.when(case % 7 == 3, ".5").otherwise(".0")).alias("n"),
        F.when(case % 17 == 1, "n/a").otherwise("0.25").alias("var1"),
    )
    rows = ind.completeness_rows(sheets, SHEET_NAMES, 0)
    split = rejects.split_rows(rows, ind.completeness_checks(SHEET_NAMES), b.scratch(spark, "sheets"))
    shown = split.rejected.select("row_no", F.array_join(rejects.REASONS, "; ").alias("reasons"), F.lit(None).cast("int").alias("year"), F.lit(None).cast("bigint").alias("n"))
    # the share stands for the row's number, so that the rows read can be told apart
    numbers = ind.completeness_values(split.good.withColumn("var1", F.col("row_no").cast("string")), SHEET_NAMES)
    good = numbers.select(F.col("var1").cast("bigint").alias("row_no"), F.lit("").alias("reasons"), "year", "n")
    return good.unionByName(shown)


# ---- numbered order ------------------------------------------------------------------

@query(
    "ordered_rows",
    """SELECT l_orderkey, l_linenumber, l_extendedprice, row_number() OVER (ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS rownum
    FROM lineitem""",
)
def ordered_rows(spark, sf_dir):
    """Every line with its place in a total order, no task having seen all of them."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return ordering.number_rows(lines, [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"], b.scratch(spark, "ordered"))


@query(
    "ordered_groups",
    """SELECT l_returnflag, l_shipdate::DATE AS day, count(*) AS n,
      min(r) AS first_row, max(r) AS last_row FROM (SELECT *, row_number() OVER (ORDER BY l_returnflag, l_shipdate::DATE) AS r FROM lineitem) GROUP BY ALL""",
)
def ordered_groups(spark, sf_dir):
    """An order in which many rows tie: each group of ties still has an unbroken run of numbers."""
    lines = b.table(spark, sf_dir, "lineitem").select("l_returnflag", F.to_date("l_shipdate").alias("day"))
    numbered = ordering.number_rows(lines, ["l_returnflag", "day"], b.scratch(spark, "ordered"))
    return numbered.groupBy("l_returnflag", "day").agg(
        aggregates.rows().alias("n"), F.min("rownum").alias("first_row"), F.max("rownum").alias("last_row")
    )


# ---- splittable text -----------------------------------------------------------------

@query(
    "lines_roundtrip",
    """SELECT doc_id, lang, text, CASE doc_id % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '\\N' WHEN 3 THEN '\\\\n' || chr(10) || '\\'
      WHEN 4 THEN chr(13) || chr(10) || '"quoted", ' || text ELSE replace(text, ' ', chr(10)) END AS awkward FROM documents""",
)
def lines_roundtrip(spark, sf_dir):
    """Free text with line breaks, backslashes, quotes and the null token, written one line per record and read back in parts."""
    docs = b.table(spark, sf_dir, "documents")
    kind = F.col("doc_id") % 6
    awkward = (
        F.when(kind == 1, F.lit("")).when(kind == 2, F.lit("\\N")).when(kind == 3, F.lit("\\\\n\n\\"))
        .when(kind == 4, F.concat(F.lit('\r\n"quoted", '), F.col("text"))).when(kind == 5, F.replace(F.col("text"), F.lit(" "), F.lit("\n")))
    )
    path = b.scratch(spark, "lines")
    writers.write_report(docs.select("doc_id", "lang", "text", awkward.alias("awkward")), path, b.PERIOD.as_of, "lines")
    return writers.read_lines(spark, f"{path}/as_of={b.PERIOD.as_of.isoformat()}", "doc_id bigint, lang string, text string, awkward string")

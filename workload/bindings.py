"""Surveillance inputs derived from the test tables, in Spark and as oracle SQL.

Every lab row comes from one ``lineitem`` row and every case from one ``orders`` row. Test
names, results and free text are picked from short lists by the row's own numbers, so all
codes, patterns and nulls of the rules occur and the work grows with the tables.
"""

from __future__ import annotations

import tempfile
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveil.functions import codes
from surveil.functions.periods import ReportPeriod
from surveil.sources.readers import read_table
from surveil.sources.writers import scratch_folder

PERIOD = ReportPeriod(date(2001, 6, 30))
STATE = "AMERICA"

# ---- text lists ----------------------------------------------------------------------

COVID_TEST_NAMES = [*codes.known_tests(codes.COVID_TESTS), "Whole genome sequencing", None]
COVID_RESULTS = [
    "Positive", "Negative", "Detected", "Not Detected", "Inconclusive", None, "Reactive",
    "Above Threshold", "Invalid", "Antigen present",
]
COVID_VALUES = [
    "SARS_CoV-2 Detected", "SARS-CoV-2 Detected", "positive", "Result (+)", "Negative", "=12 ",
    ">1600", "Detected", None, "COVID detected", "value above threshold", "Reactive", "Equivocal",
]
COVID_STATUSES = ["Confirmed", "Probable", "Suspect", "Not a case", "Contact", None]

FLU_TEST_NAMES = [*codes.known_tests(codes.FLU_TESTS), "Adenovirus RNA", None]
FLU_RESULTS = [
    *codes.FLU_POSITIVE, "Negative", "Not Detected", None, "Influenza B virus Yamagata lineage",
    "Unable to subtype", "Invalid",
]
FLU_VALUES = [
    "Detected", "NOT DETECTED", "Negative Influenza A", None, "Flu A", "Flu B", "Influenza A H3",
    "H1 2009", "H1 prior to 2010", "B/Victoria lineage", "Yamagata lineage", "Positive",
    "H1N1 pdm09", "H2N2v detected",
]
FLU_DESCRIPTIONS = [
    None, "Influenza A/B PCR", "Flu B rapid", "Respiratory panel", "Unable to subtype", "FLUAV H1-2009",
    None, "unable, invalid", "Culture",
]
FLU_COMMENTS = [
    None, "Flu A and B positive", "A and B negative", "Positive for flu A", "both detected",
    "flu a and rsv", "Positive B", "see report", None, "repeat specimen", "called to provider",
    None, "a & b", "influenza b and sars-cov-2", "final",
]


def sql_text(v) -> str:
    return "NULL" if v is None else "'" + str(v).replace("'", "''") + "'"


def sql_list(values) -> str:
    return ", ".join(sql_text(v) for v in values)


def pick(values: list, index: Column) -> Column:
    return F.element_at(F.expr(f"array({sql_list(values)})"), (index + 1).cast("int"))


def sql_pick(values: list, index: str) -> str:
    return f"([{sql_list(values)}])[CAST({index} AS INT) + 1]"


# ---- tables --------------------------------------------------------------------------

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. The schema is stated, so no job reads file footers to infer it."""
    return read_table(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def scratch(spark: SparkSession, name: str) -> str:
    """A scratch folder in the session's shared folder; a session without one, as in tests, gets its own."""
    context = spark.sparkContext
    if not spark.conf.get("spark.checkpoint.dir", None) and not context.getCheckpointDir():
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="surveil-"))
    return scratch_folder(spark, name)


def kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A table that several parts of a query need, written once and read back."""
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def covid_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("patient_id"),
        F.to_date("l_shipdate").alias("lab_date"),
        pick(COVID_STATUSES, F.col("l_orderkey") % 6).alias("disease_status"),
        F.date_sub(F.to_date("l_shipdate"), 2).alias("specimen_date"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("specimen_id"),
        F.when(F.col("l_linenumber") != 7, F.date_sub(F.to_date("l_shipdate"), 1)).alias("specimen_received_date"),
        F.col("l_linestatus").alias("specimen_source"),
        F.concat(F.lit("A"), F.col("l_suppkey").cast("string")).alias("accession_number"),
        F.to_date("l_shipdate").alias("result_date"),
        pick(COVID_TEST_NAMES, F.col("l_partkey") % len(COVID_TEST_NAMES)).alias("test"),
        pick(COVID_RESULTS, (F.col("l_suppkey") + F.col("l_linenumber")) % len(COVID_RESULTS)).alias("result"),
        pick(COVID_VALUES, F.col("l_quantity").cast("int") % len(COVID_VALUES)).alias("result_value"),
    )


def flu_labs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part, supp, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    return li.select(
        F.col("l_orderkey").alias("case_id"),
        F.to_date("l_shipdate").alias("specimen_date"),
        pick(FLU_TEST_NAMES, part % len(FLU_TEST_NAMES)).alias("test"),
        pick(FLU_RESULTS, (supp + line) % len(FLU_RESULTS)).alias("result"),
        pick(FLU_VALUES, F.col("l_quantity").cast("int") % len(FLU_VALUES)).alias("result_value"),
        pick(FLU_DESCRIPTIONS, (supp * 3 + part) % len(FLU_DESCRIPTIONS)).alias("local_description"),
        pick(FLU_COMMENTS, (part + line) % len(FLU_COMMENTS)).alias("comments"),
    )


def located_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with nation and region of the customer. Spark picks the join by size."""
    return (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )


def _status() -> Column:
    return (
        F.when(F.col("o_orderstatus") == "F", "Confirmed")
        .when(F.col("o_orderstatus") == "O", "Probable")
        .when(F.col("o_orderkey") % 3 == 0, "Suspect")
        .when(F.col("o_orderkey") % 3 == 1, "Not a case")
    )


def cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return located_orders(spark, sf_dir).select(
        F.col("o_orderkey").alias("case_id"),
        F.col("o_custkey").alias("party_id"),
        F.to_date("o_orderdate").alias("event_date"),
        _status().alias("disease_status"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Yes")
        .when(F.col("o_orderpriority") == "2-HIGH", "No")
        .alias("died"),
        F.when(F.col("o_totalprice") >= 200000, "Yes").otherwise("No").alias("case_closed"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("notification_status"),
        F.col("n_name").alias("county"),
        F.col("r_name").alias("state"),
    )


def covid_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cases(spark, sf_dir).select(
        F.col("case_id").alias("patient_id"), F.lit("COVID-19").alias("disease"), "county", "case_closed", "notification_status", "state"
    )


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lab feed rows with the name of their feed."""
    rows = (
        table(spark, sf_dir, "lineitem")
        .join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        F.to_date("l_shipdate").alias("sending_date"),
        F.when(F.col("l_linenumber") != 7, F.to_date("o_orderdate")).alias("specimen_date"),
        F.to_date("o_orderdate").alias("event_date"),
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_name")).alias("facility"),
        F.when(F.col("s_suppkey") % 14 == 0, F.col("s_name")).alias("facility_other"),
        F.when(F.col("s_suppkey") % 5 != 0, F.col("n_name")).alias("reporting_facility"),
        F.lit(None).cast("string").alias("reporting_facility_other"),
        F.concat(F.lit("Hub "), F.col("n_name")).alias("sending_facility"),
        F.col("l_returnflag").alias("disease"),
        F.concat(F.lit("Test "), (F.col("l_partkey") % 5).cast("string")).alias("test"),
        F.col("o_orderpriority").alias("observation_type"),
        F.when(F.col("l_linestatus") == "F", "final").when(F.col("l_linestatus") == "O", "open").alias("feed"),
    )


def all_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feed_rows(spark, sf_dir).drop("feed")


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The same rows as separate feeds with one schema."""
    rows = feed_rows(spark, sf_dir)
    return {name: rows.filter(F.col("feed") == name).drop("feed") for name in ("final", "open")}


# ---- the same inputs in SQL ----------------------------------------------------------

SQL_COVID_LABS = f"""covid_labs AS (
  SELECT l_orderkey AS patient_id, CAST(l_shipdate AS DATE) AS lab_date,
         {sql_pick(COVID_STATUSES, "l_orderkey % 6")} AS disease_status,
         CAST(l_shipdate AS DATE) - 2 AS specimen_date, l_orderkey * 8 + l_linenumber AS specimen_id,
         CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) - 1 END AS specimen_received_date,
         l_linestatus AS specimen_source, 'A' || l_suppkey AS accession_number, CAST(l_shipdate AS DATE) AS result_date,
         {sql_pick(COVID_TEST_NAMES, f"l_partkey % {len(COVID_TEST_NAMES)}")} AS test,
         {sql_pick(COVID_RESULTS, f"(l_suppkey + l_linenumber) % {len(COVID_RESULTS)}")} AS result,
         {sql_pick(COVID_VALUES, f"CAST(l_quantity AS INT) % {len(COVID_VALUES)}")} AS result_value
  FROM lineitem)"""

SQL_FLU_LABS = f"""flu_labs AS (
  SELECT l_orderkey AS case_id, CAST(l_shipdate AS DATE) AS specimen_date,
         {sql_pick(FLU_TEST_NAMES, f"l_partkey % {len(FLU_TEST_NAMES)}")} AS test,
         {sql_pick(FLU_RESULTS, f"(l_suppkey + l_linenumber) % {len(FLU_RESULTS)}")} AS result,
         {sql_pick(FLU_VALUES, f"CAST(l_quantity AS INT) % {len(FLU_VALUES)}")} AS result_value,
         {sql_pick(FLU_DESCRIPTIONS, f"(l_suppkey * 3 + l_partkey) % {len(FLU_DESCRIPTIONS)}")} AS local_description,
         {sql_pick(FLU_COMMENTS, f"(l_partkey + l_linenumber) % {len(FLU_COMMENTS)}")} AS comments
  FROM lineitem)"""

SQL_CASES = """cases AS (
  SELECT o_orderkey AS case_id, o_custkey AS party_id, CAST(o_orderdate AS DATE) AS event_date,
         CASE WHEN o_orderstatus = 'F' THEN 'Confirmed' WHEN o_orderstatus = 'O' THEN 'Probable'
              WHEN o_orderkey % 3 = 0 THEN 'Suspect' WHEN o_orderkey % 3 = 1 THEN 'Not a case' END AS disease_status,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'No' END AS died,
         CASE WHEN o_totalprice >= 200000 THEN 'Yes' ELSE 'No' END AS case_closed,
         nullif(o_orderpriority, '5-LOW') AS notification_status,
         n_name AS county, r_name AS state
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
       JOIN region ON n_regionkey = r_regionkey)"""

SQL_COVID_CASES = SQL_CASES + """, covid_cases AS (
  SELECT case_id AS patient_id, 'COVID-19' AS disease, county, case_closed, notification_status, state FROM cases)"""

SQL_FEEDS = """feeds AS (
  SELECT CAST(l_shipdate AS DATE) AS sending_date,
         CASE WHEN l_linenumber <> 7 THEN CAST(o_orderdate AS DATE) END AS specimen_date,
         CAST(o_orderdate AS DATE) AS event_date,
         CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS facility,
         CASE WHEN s_suppkey % 14 = 0 THEN s_name END AS facility_other,
         CASE WHEN s_suppkey % 5 <> 0 THEN n_name END AS reporting_facility,
         CAST(NULL AS VARCHAR) AS reporting_facility_other,
         'Hub ' || n_name AS sending_facility, l_returnflag AS disease,
         'Test ' || CAST(l_partkey % 5 AS VARCHAR) AS test, o_orderpriority AS observation_type,
         CASE l_linestatus WHEN 'F' THEN 'final' WHEN 'O' THEN 'open' END AS feed
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey)"""


def sql_wednesday(d: str) -> str:
    return f"({d} + CAST(3 - dayofweek({d}) AS INTEGER))"


def sql_mmwr_year(d: str) -> str:
    return f"CAST(year({sql_wednesday(d)}) AS INTEGER)"


def sql_mmwr_week(d: str) -> str:
    return f"CAST((dayofyear({sql_wednesday(d)}) + 6) // 7 AS INTEGER)"


def sql_week_ending(d: str) -> str:
    return f"({d} + CAST(6 - dayofweek({d}) AS INTEGER))"


SQL_CLEAN = f"""clean AS (
  SELECT *, {sql_mmwr_year('sending_date')} AS mmwr_year, {sql_mmwr_week('sending_date')} AS mmwr_week,
         CAST(dayofweek(sending_date) + 1 AS INTEGER) AS mmwr_day,
         {sql_week_ending('sending_date')} AS week_ending,
         coalesce(facility, facility_other) AS facility_clean,
         coalesce(reporting_facility, reporting_facility_other) AS reporting_clean,
         CAST(sending_date - specimen_date AS INTEGER) AS lag_days
  FROM feeds)"""

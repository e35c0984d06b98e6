"""Quarterly indicators, their sheets, reshaping, and sources and sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from surveil.functions import codes, nulls, text
from surveil.functions.periods import ReportPeriod
from surveil.operators import joins, reshape, windows
from surveil.plans import indicators as ind
from surveil.sources import readers, writers
from workload import bindings as b
from workload.registry import query

REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
YEARS = list(range(1995, 2002))
QUARTERS = [1, 2, 3, 4]
CURRENT = (2001, 2)
FIELDS = {"var1": "died", "var2": "notification_status", "var3": "disease_status"}

GRID = f"""grid AS (
  SELECT region, CAST(year AS INTEGER) AS year, CAST(quarter AS INTEGER) AS quarter
  FROM (SELECT unnest([{b.sql_list(REGIONS)}]) AS region), (SELECT unnest({YEARS}) AS year),
       (SELECT unnest({QUARTERS}) AS quarter))"""
COUNTS = f"""{b.SQL_CASES}, counts AS (
  SELECT state AS region, CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter,
         count(*) AS n, count(*) FILTER (disease_status = 'Confirmed') AS n_pass
  FROM cases GROUP BY ALL)"""


def label_sql(n: str, suffix: str = "''") -> str:
    head = f"'Q' || quarter || {suffix}"
    return f"CASE WHEN year = {CURRENT[0]} AND quarter > {CURRENT[1]} THEN {head} ELSE {head} || '(n=' || {n} || ')' END"


YEAR_SUFFIX = "'-''' || substr(CAST(year AS VARCHAR), 3, 2)"


def facts(spark, sf_dir) -> DataFrame:
    return b.cases(spark, sf_dir).withColumnRenamed("state", "region")


def region_counts(spark, sf_dir) -> DataFrame:
    return ind.quarter_counts(
        facts(spark, sf_dir), "event_date", F.col("disease_status") == "Confirmed", by=["region"]
    )


def region_grid(spark) -> DataFrame:
    return joins.grid(spark, region=REGIONS, year=YEARS, quarter=QUARTERS)


# ---- grid, rates, labels -------------------------------------------------------------

@query(
    "indicator_grid",
    f"""WITH {COUNTS}, {GRID}
    SELECT g.region, g.year, g.quarter, coalesce(n, 0) AS n, n_pass,
           {label_sql('coalesce(n, 0)').replace('year', 'g.year').replace('quarter', 'g.quarter')} AS label
    FROM grid g LEFT JOIN counts c ON g.region = c.region AND g.year = c.year AND g.quarter = c.quarter""",
)
def indicator_grid(spark, sf_dir):
    return ind.labelled_grid(region_counts(spark, sf_dir), region_grid(spark), CURRENT)


DENSE = f"""{COUNTS}, {GRID}, dense AS (
  SELECT g.region, g.year, g.quarter, coalesce(n, 0) AS n, n_pass
  FROM grid g LEFT JOIN counts c ON g.region = c.region AND g.year = c.year AND g.quarter = c.quarter)"""


@query(
    "indicator_rates",
    f"""WITH {DENSE}
    SELECT *, {label_sql('n', YEAR_SUFFIX)} AS label, round(100.0 * n_pass / nullif(n, 0), 6) AS rate,
           CAST(row_number() OVER (ORDER BY region, year, quarter) AS INTEGER) AS rownum FROM dense""",
)
def indicator_rates(spark, sf_dir):
    cells = ind.labelled_grid(region_counts(spark, sf_dir), region_grid(spark), CURRENT, with_year=True)
    return ind.with_rates(cells).withColumn("rate", F.round("rate", 6))


@query(
    "indicator_rates_state",
    f"""WITH {COUNTS}, s AS (SELECT year, quarter, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_pass) AS BIGINT) AS n_pass
                             FROM counts GROUP BY ALL),
    {GRID}, q AS (SELECT DISTINCT year, quarter FROM grid),
    dense AS (SELECT q.year, q.quarter, coalesce(n, 0) AS n, n_pass
              FROM q LEFT JOIN s ON q.year = s.year AND q.quarter = s.quarter)
    SELECT *, {label_sql('n', YEAR_SUFFIX)} AS label, round(100.0 * n_pass / nullif(n, 0), 6) AS rate,
           CAST(row_number() OVER (ORDER BY year, quarter) AS INTEGER) AS rownum FROM dense""",
)
def indicator_rates_state(spark, sf_dir):
    counts = ind.quarter_counts(facts(spark, sf_dir), "event_date", F.col("disease_status") == "Confirmed")
    cells = ind.labelled_grid(counts, joins.grid(spark, year=YEARS, quarter=QUARTERS), CURRENT, with_year=True)
    return ind.with_rates(cells).withColumn("rate", F.round("rate", 6))


COMPLETE = f"""{b.SQL_CASES}, {GRID}, filled AS (
  SELECT state AS region, CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter,
         count(*) AS n, count(died) / count(*) AS var1, count(notification_status) / count(*) AS var2,
         count(disease_status) / count(*) AS var3
  FROM cases GROUP BY ALL)"""


@query(
    "completeness_grid",
    f"""WITH {COMPLETE}, dense AS (
      SELECT g.region, g.year, g.quarter, coalesce(n, 0) AS n, var1, var2, var3
      FROM grid g LEFT JOIN filled f ON g.region = f.region AND g.year = f.year AND g.quarter = f.quarter)
    SELECT region, year, quarter, n, round(var1, 6) AS var1, round(var2, 6) AS var2, round(var3, 6) AS var3,
           round((var1 + var2 + var3) / 3, 6) AS complete_pct_avg, {label_sql('n')} AS label FROM dense""",
)
def completeness_grid(spark, sf_dir):
    shares = ind.quarter_completeness(facts(spark, sf_dir), "event_date", FIELDS, by=["region"])
    cells = ind.labelled_grid(shares, region_grid(spark), CURRENT)
    return cells.withColumns({c: F.round(c, 6) for c in (*FIELDS, "complete_pct_avg")})


# Every indicator as a flag of the case: (Spark condition, SQL condition). Those in percent are printed times 100.
FLAGS = {
    "var1": "died IS NOT NULL", "var2": "notification_status IS NOT NULL", "var3": "disease_status IS NOT NULL",
    "var4": "case_id % 4 <> 0", "var5": "party_id % 9 <> 0", "var6": "disease_status = 'Confirmed'", "var7": "case_id % 7 <> 0",
    "var8": "case_closed = 'Yes'", "var9": "party_id % 11 <> 0", "pct_CDC": "case_id % 25 <> 0",
    "pct_class_correct": "died IS NULL",
}
assert list(FLAGS) == list(codes.INDICATORS)


def _targets_sql(region: str, full: str) -> str:
    units = {v: 100 if codes.INDICATORS[v][1] == "percent" else 1 for v in FLAGS}
    cells = ", ".join(f"count(*) FILTER ({c}) / count(*) AS {v}" for v, c in FLAGS.items())
    names = ", ".join(f"'{v}'" for v in FLAGS)
    goals = ", ".join(f"{codes.INDICATORS[v][0]}::DOUBLE" for v in FLAGS)
    return f"""SELECT region, year, quarter, {label_sql('n')} AS label, unnest([{names}]) AS variable,
      unnest([{', '.join(FLAGS)}]) * 100 AS percent, unnest([{goals}]) AS target
    FROM (SELECT g.region, g.year, g.quarter, coalesce(n, 0) AS n, {', '.join(f'f.{v}' for v in units)}
      FROM {full} g LEFT JOIN (
        SELECT {region} AS region, CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter,
               count(*) AS n, {cells} FROM cases GROUP BY ALL) f
      ON g.region = f.region AND g.year = f.year AND g.quarter = f.quarter)"""


@query(
    "targets_met",
    f"""WITH {b.SQL_CASES}, {GRID}, whole AS (SELECT DISTINCT 'State' AS region, year, quarter FROM grid),
    long AS ({_targets_sql('state', 'grid')} UNION ALL {_targets_sql("'State'", 'whole')})
    SELECT region, year, quarter, label, variable, round(percent, 6) AS percent, target,
           round(percent, 6) >= target AS meets_target FROM long""",
)
def targets_met(spark, sf_dir):
    """All indicators of both scopes against their targets; target and unit come from one table."""
    cases = b.cases(spark, sf_dir)
    flagged = cases.select("event_date", F.col("state").alias("region"), *[F.when(F.expr(c), 1).alias(v) for v, c in FLAGS.items()])
    flagged = flagged.unionByName(flagged.withColumn("region", F.lit("State")))
    shares = ind.quarter_completeness(flagged, "event_date", {v: v for v in FLAGS}, by=["region"])
    shares = shares.withColumns({v: F.col(v) * 100 for v, (_, unit) in codes.INDICATORS.items() if unit == "percent"})
    full = joins.grid(spark, region=[*REGIONS, "State"], year=YEARS, quarter=QUARTERS)
    series = ind.indicator_series(ind.labelled_grid(shares, full, CURRENT), list(FLAGS))
    return ind.against_targets(series.withColumn("percent", F.round("percent", 6)))


# ---- classification ------------------------------------------------------------------

# The priority stands in for the rejection reason: urgent and high orders were "Incorrect".
REJECTIONS = f"""{b.SQL_CASES}, rejected AS (
  SELECT state AS region, CAST(year(event_date) AS INTEGER) AS year, CAST(quarter(event_date) AS INTEGER) AS quarter
  FROM cases WHERE died IS NOT NULL),
  incorrect AS (SELECT region, year, quarter, count(*) AS n_incorrect FROM rejected GROUP BY ALL)"""
RATE_YEARS = YEARS[1:3]


def rejections(spark, sf_dir) -> DataFrame:
    reason = F.when(F.col("died").isNotNull(), "Incorrect case status").otherwise("Missing data")
    key = ind.quarter_key("__year", "__quarter")
    return (
        facts(spark, sf_dir)
        .withColumns({"__year": F.year("event_date"), "__quarter": F.quarter("event_date")})
        .select("region", key.alias("year_qrtr"), reason.alias("reason"))
    )


@query("incorrect_counts", f"WITH {REJECTIONS} SELECT * FROM incorrect")
def incorrect_counts(spark, sf_dir):
    return ind.incorrect_by_quarter(rejections(spark, sf_dir), ["region"])


RATE = f"""n - coalesce(n_incorrect, 0) AS n_correct,
  round(CASE WHEN year IN ({RATE_YEARS[0]}, {RATE_YEARS[1]}) THEN (n - coalesce(n_incorrect, 0)) / nullif(n, 0)::DOUBLE END, 6)
    AS pct_class_correct"""


@query(
    "classification_rate",
    f"""WITH {REJECTIONS}, {DENSE.replace(b.SQL_CASES + ', ', '')},
    j AS (SELECT d.region, d.year, d.quarter, n, n_incorrect FROM dense d LEFT JOIN incorrect i
          ON d.region = i.region AND d.year = i.year AND d.quarter = i.quarter)
    SELECT *, {RATE} FROM j""",
)
def classification_rate(spark, sf_dir):
    cells = ind.labelled_grid(region_counts(spark, sf_dir), region_grid(spark), CURRENT).drop("label", "n_pass")
    incorrect = ind.incorrect_by_quarter(rejections(spark, sf_dir), ["region"])
    out = ind.classification_rate(cells, incorrect, ["region", "year", "quarter"], RATE_YEARS)
    return out.withColumn("pct_class_correct", F.round("pct_class_correct", 6))


STATE_CELLS = f"""{REJECTIONS}, {DENSE.replace(b.SQL_CASES + ', ', '')},
  state_cells AS (SELECT year, quarter, CAST(sum(n) AS BIGINT) AS n FROM dense GROUP BY ALL)"""


def _state_cells(spark, sf_dir) -> DataFrame:
    counts = ind.quarter_counts(facts(spark, sf_dir), "event_date", F.lit(True))
    full = joins.grid(spark, year=YEARS, quarter=QUARTERS)
    return ind.labelled_grid(counts, full, CURRENT).drop("label", "n_pass")


@query(
    "classification_rate_state",
    f"""WITH {STATE_CELLS}, s AS (SELECT year, quarter, CAST(sum(n_incorrect) AS BIGINT) AS n_incorrect
                                  FROM incorrect GROUP BY ALL),
    j AS (SELECT c.*, n_incorrect FROM state_cells c LEFT JOIN s ON c.year = s.year AND c.quarter = s.quarter)
    SELECT *, {RATE} FROM j""",
)
def classification_rate_state(spark, sf_dir):
    incorrect = ind.incorrect_by_quarter(rejections(spark, sf_dir), ["region"])
    out = ind.classification_rate(_state_cells(spark, sf_dir), incorrect, ["year", "quarter"], RATE_YEARS)
    return out.withColumn("pct_class_correct", F.round("pct_class_correct", 6))


@query(
    "classification_rate_as_written",
    f"""WITH {STATE_CELLS},
    j AS (SELECT c.*, n_incorrect FROM state_cells c LEFT JOIN incorrect i ON c.year = i.year AND c.quarter = i.quarter)
    SELECT *, {RATE} FROM j""",
)
def classification_rate_as_written(spark, sf_dir):
    """The state's quarter repeated for each region with rejections."""
    incorrect = ind.incorrect_by_quarter(rejections(spark, sf_dir), ["region"])
    out = ind.classification_rate_as_written(
        _state_cells(spark, sf_dir), incorrect, ["year", "quarter"], RATE_YEARS
    )
    return out.withColumn("pct_class_correct", F.round("pct_class_correct", 6))


@query(
    "split_key",
    f"""WITH {b.SQL_CASES}, k AS (
      SELECT coalesce(disease_status, 'NA') || '-' || year(event_date) || '-' || quarter(event_date) AS key FROM cases)
    SELECT key, CASE WHEN length(regexp_extract(key, '^[A-Za-z0-9]+')) > 0 THEN regexp_extract(key, '^[A-Za-z0-9]+') END
             AS first_part, count(*) AS n FROM k GROUP BY key""",
)
def split_key(spark, sf_dir):
    key = text.composite_key(["disease_status", F.year("event_date"), F.quarter("event_date")])
    keys = facts(spark, sf_dir).select(key.alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return keys.withColumn("first_part", text.split_parts("key", 1)[0])


# ---- reshape -------------------------------------------------------------------------

@query(
    "pivot_wide",
    f"""WITH {COUNTS}, s AS (SELECT region, year, quarter, n FROM counts)
    SELECT region, """
    + ", ".join(
        f'max(n) FILTER (year = {y} AND quarter = {q}) AS "{y}_{q}_N"' for y in YEARS for q in QUARTERS
    )
    + " FROM s GROUP BY region",
)
def pivot_wide(spark, sf_dir):
    long = region_counts(spark, sf_dir).withColumn("metric", F.lit("N"))
    values = [(y, q, "N") for y in YEARS for q in QUARTERS]
    return reshape.pivot_wide(long, ["region"], ["year", "quarter", "metric"], values, "n")


@query(
    "pivot_long",
    f"""WITH {COUNTS}, {GRID}
    SELECT g.region, CAST(g.year AS VARCHAR) AS year, CAST(g.quarter AS VARCHAR) AS quarter, 'N' AS metric, n AS value
    FROM grid g LEFT JOIN counts c ON g.region = c.region AND g.year = c.year AND g.quarter = c.quarter""",
)
def pivot_long(spark, sf_dir):
    return reshape.pivot_long(pivot_wide(spark, sf_dir), ["region"], ["year", "quarter", "metric"])


@query(
    "fill_down",
    """WITH o AS (SELECT o_orderstatus AS sheet_id, o_orderkey AS row_no,
                    CASE WHEN o_totalprice > 400000 THEN o_orderpriority END AS region,
                    CASE WHEN o_custkey % 9 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) END AS year FROM orders)
    SELECT sheet_id, row_no, last_value(region IGNORE NULLS) OVER w AS region,
           last_value(year IGNORE NULLS) OVER w AS year
    FROM o WINDOW w AS (PARTITION BY sheet_id ORDER BY row_no ROWS UNBOUNDED PRECEDING)""",
)
def fill_down(spark, sf_dir):
    """Three sheets of a third of the rows each, so the carried blocks matter."""
    rows = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("sheet_id"),
        F.col("o_orderkey").alias("row_no"),
        F.when(F.col("o_totalprice") > 400000, F.col("o_orderpriority")).alias("region"),
        F.when(F.col("o_custkey") % 9 == 0, F.year("o_orderdate").cast("string")).alias("year"),
    )
    return windows.fill_down(rows, ["region", "year"], ["sheet_id"], "row_no", block=1000)


# ---- sheets --------------------------------------------------------------------------

TIMELY_COLUMNS = ["c1", "c2", "c3", "c4", "c5"]


def timeliness_sheets(spark, sf_dir) -> DataFrame:
    """One sheet per region as exported: a title, a header, the region and each year printed
    once, '.' for the blanks, a total row, and every other number as a decimal."""
    counts = b.kept(spark, region_counts(spark, sf_dir), "counts")

    def printed(c: str, decimal):
        return F.when(decimal, F.col(c).cast("double").cast("string")).otherwise(F.col(c).cast("string"))

    in_sheet = Window.partitionBy("region").orderBy("year", "quarter")
    in_year = Window.partitionBy("region", "year").orderBy("quarter")
    body = counts.select(
        F.col("region").alias("sheet_id"),
        (F.row_number().over(in_sheet) + 2).cast("bigint").alias("row_no"),
        F.when(F.row_number().over(in_sheet) == 1, F.col("region")).alias("c1"),
        F.when(F.row_number().over(in_year) == 1, printed("year", F.col("year") % 2 == 0)).alias("c2"),
        printed("quarter", (F.col("year") + F.col("quarter")) % 2 == 0).alias("c3"),
        F.col("n_pass").cast("string").alias("c4"),
        F.col("n").cast("double").cast("string").alias("c5"),
    )
    sums = counts.groupBy(F.col("region").alias("sheet_id")).agg(
        F.sum("n_pass").cast("string").alias("c4"), F.sum("n").cast("string").alias("c5")
    )
    total = sums.select(
        "sheet_id", F.lit(10_000).cast("bigint").alias("row_no"), F.lit("Column Total").alias("c1"),
        F.lit("Column Total").alias("c2"), F.lit(None).cast("string").alias("c3"), "c4", "c5",
    )
    titles = [("Timeliness of reports", None, None, None, None), ("Region", "Year", "Quarter", "Pass", "N")]
    heads = [
        sums.select("sheet_id", F.lit(i + 1).cast("bigint").alias("row_no"),
                    *[F.lit(v).cast("string").alias(c) for c, v in zip(TIMELY_COLUMNS, cells)])
        for i, cells in enumerate(titles)
    ]
    stacked = body.unionByName(total)
    for head in heads:
        stacked = stacked.unionByName(head)
    return stacked


def exported(spark, sheets: DataFrame, columns: list[str]) -> DataFrame:
    """The sheets written as CSV export and read back, with '.' for missing cells."""
    path = b.scratch(spark, "sheets")
    sheets.write.csv(path, nullValue=".")
    return readers.read_sheet_csv(spark, path, columns)


@query("header_repair", f"WITH {COUNTS} SELECT region AS sheet_id, region, year, quarter, n_pass, n FROM counts")
def header_repair(spark, sf_dir):
    """Exported sheets repaired back to the counts they were printed from."""
    sheets = exported(spark, timeliness_sheets(spark, sf_dir), TIMELY_COLUMNS)
    return ind.timeliness_from_sheets(
        sheets, ["region", "year", "quarter", "n_pass", "n"], 2, ["region", "year", "quarter"]
    )


def _rates_sql(keys: str, counts: str) -> str:
    on = " AND ".join(f"g.{k} = c.{k}" for k in keys.split(", "))
    return f"""SELECT *, {label_sql('n', YEAR_SUFFIX)} AS label, round(100.0 * n_pass / nullif(n, 0), 6) AS var8,
      CAST(row_number() OVER (ORDER BY {keys}) AS INTEGER) AS rownum
    FROM (SELECT {', '.join('g.' + k for k in keys.split(', '))}, coalesce(n, 0) AS n, n_pass
          FROM (SELECT DISTINCT {keys} FROM grid) g LEFT JOIN {counts} c ON {on})"""


@query("timeliness_grid", f"WITH {COUNTS}, {GRID} " + _rates_sql("region, year, quarter", "counts"))
def timeliness_grid(spark, sf_dir):
    """Timely cases from exported sheets: repaired, on the full grid, with label, percent and row number."""
    counts = b.kept(spark, header_repair(spark, sf_dir), "repaired")
    return ind.timeliness_grid(counts, region_grid(spark), CURRENT, "var8").withColumn("var8", F.round("var8", 6))


STATE_COUNTS = """s AS (SELECT year, quarter, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n_pass) AS BIGINT) AS n_pass
                         FROM counts GROUP BY ALL)"""


@query("timeliness_grid_state", f"WITH {COUNTS}, {GRID}, {STATE_COUNTS} " + _rates_sql("year, quarter", "s"))
def timeliness_grid_state(spark, sf_dir):
    """The same for the state, from one sheet without regions."""
    counts = b.kept(spark, ind.quarter_counts(facts(spark, sf_dir), "event_date", F.col("disease_status") == "Confirmed"), "counts")
    first = F.row_number().over(Window.partitionBy("year").orderBy("quarter")) == 1
    body = counts.select(
        F.lit("state").alias("sheet_id"), (F.col("year") * 10 + F.col("quarter")).cast("bigint").alias("row_no"),
        F.when(first, F.col("year").cast("double").cast("string")).alias("c1"), F.col("quarter").cast("double").cast("string").alias("c2"),
        F.col("n_pass").cast("string").alias("c3"), F.col("n").cast("string").alias("c4"),
    )
    rows = [("state", 1, "Year", "Quarter", "Pass", "N"), ("state", 99_999, "Column Total", None, "1", "1")]
    edges = spark.createDataFrame(rows, "sheet_id string, row_no bigint, c1 string, c2 string, c3 string, c4 string")
    sheets = exported(spark, body.unionByName(edges), ["c1", "c2", "c3", "c4"])
    read = ind.timeliness_from_sheets(sheets, ["year", "quarter", "n_pass", "n"], 1, ["year", "quarter"])
    full = joins.grid(spark, year=YEARS, quarter=QUARTERS)
    return ind.timeliness_grid(b.kept(spark, read, "repaired"), full, CURRENT, "var8").withColumn("var8", F.round("var8", 6))


@query(
    "header_fallback",
    f"""WITH {COUNTS}, f AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY year, quarter) = 1 AS top FROM counts)
    SELECT region AS sheet_id, region, year, quarter, n_pass, n FROM f""",
)
def header_fallback(spark, sf_dir):
    """Sheets whose first data row has its numbers one row up, in the header."""
    sheets = timeliness_sheets(spark, sf_dir)
    first = Window.partitionBy("sheet_id").orderBy("row_no").rowsBetween(1, 1)
    moved = sheets.withColumns(
        {
            c: F.when(F.col("row_no") == 2, F.max(c).over(first)).when(F.col("row_no") != 3, F.col(c))
            for c in ("c4", "c5")
        }
    )
    return ind.timeliness_from_sheets(
        moved, ["region", "year", "quarter", "n_pass", "n"], 2, ["region", "year", "quarter"], header_row=2
    )


def tabulation_sheets(spark, sf_dir, counts: DataFrame | None = None) -> DataFrame:
    """One sheet per region and quarter: four header rows, then rowmiss, pass and Total."""
    counts = (region_counts(spark, sf_dir) if counts is None else counts).withColumn("sheet_id", ind.quarter_key("region", "year", "quarter"))
    cells = [
        ("title", F.col("region"), None),
        (None, F.lit("Year"), None),
        (None, F.col("year"), None),
        (None, F.col("quarter"), None),
        ("rowmiss", F.col("n") - F.col("n_pass"), F.round((F.col("n") - F.col("n_pass")) / F.col("n") * 100, 4)),
        ("pass", F.col("n_pass"), F.round(F.col("n_pass") / F.col("n") * 100, 4)),
        ("Total", F.col("n"), F.lit(100.0)),
    ]
    rows = [
        F.struct(
            F.lit(i + 1).cast("bigint").alias("row_no"),
            F.lit(label).cast("string").alias("c1"),
            value.cast("string").alias("c2"),
            (F.lit(None) if pct is None else pct).cast("string").alias("c3"),
        )
        for i, (label, value, pct) in enumerate(cells)
    ]
    return counts.select("sheet_id", F.inline(F.array(*rows)))


@query(
    "pass_rate_sheets",
    f"""WITH {COUNTS} SELECT region, year, quarter, n, round(round(100.0 * n_pass / n, 4) / 100, 6) AS var6 FROM counts""",
)
def pass_rate_sheets(spark, sf_dir):
    """Pass rates read back from tabulations with merged header cells."""
    sheets = exported(spark, tabulation_sheets(spark, sf_dir), ["c1", "c2", "c3"])
    rates = ind.pass_rates_from_sheets(sheets, 4, region=(1, "c2"), year=(3, "c2"), quarter=(4, "c2"))
    return rates.select("region", "year", "quarter", "n", F.round("var6", 6).alias("var6"))


@query(
    "pass_rate_grid",
    f"""WITH {DENSE} SELECT region, year, quarter, n, round(round(100.0 * n_pass / nullif(n, 0), 4) / 100, 6) AS var6,
      {label_sql('n')} AS label FROM dense""",
)
def pass_rate_grid(spark, sf_dir):
    """Pass rates of the tabulations on the full grid: absent quarters have n 0 and no rate."""
    sheets = exported(spark, tabulation_sheets(spark, sf_dir), ["c1", "c2", "c3"])
    header = {"region": (1, "c2"), "year": (3, "c2"), "quarter": (4, "c2")}
    return ind.pass_rate_grid(sheets, 4, region_grid(spark), CURRENT, **header).withColumn("var6", F.round("var6", 6))


@query(
    "pass_rate_grid_state",
    f"""WITH {COUNTS}, {GRID}, {STATE_COUNTS}, dense AS (
      SELECT g.year, g.quarter, coalesce(n, 0) AS n, n_pass FROM (SELECT DISTINCT year, quarter FROM grid) g
      LEFT JOIN s ON g.year = s.year AND g.quarter = s.quarter)
    SELECT year, quarter, n, round(round(100.0 * n_pass / nullif(n, 0), 4) / 100, 6) AS var6, {label_sql('n')} AS label FROM dense""",
)
def pass_rate_grid_state(spark, sf_dir):
    """The same for the state, whose sheets have no region."""
    counts = ind.quarter_counts(facts(spark, sf_dir), "event_date", F.col("disease_status") == "Confirmed")
    sheets = exported(spark, tabulation_sheets(spark, sf_dir, counts.withColumn("region", F.lit("State"))), ["c1", "c2", "c3"])
    full = joins.grid(spark, year=YEARS, quarter=QUARTERS)
    out = ind.pass_rate_grid(sheets, 4, full, CURRENT, year=(3, "c2"), quarter=(4, "c2"))
    return out.withColumn("var6", F.round("var6", 6))


@query(
    "completeness_sheets",
    f"""WITH {COMPLETE}, dense AS (
      SELECT g.region, g.year, g.quarter, coalesce(n, 0) AS n, var1, var2
      FROM grid g LEFT JOIN filled f ON g.region = f.region AND g.year = f.year AND g.quarter = f.quarter)
    SELECT region, year, quarter, n, round(var1, 6) AS var1, round(var2, 6) AS var2, {label_sql('n')} AS label FROM dense""",
)
def completeness_sheets(spark, sf_dir):
    """Printed completeness sheets read back and put on the grid."""
    shares = ind.quarter_completeness(facts(spark, sf_dir), "event_date", FIELDS, by=["region"])
    in_sheet = Window.partitionBy("region").orderBy("year", "quarter")
    body = shares.select(
        F.col("region").alias("sheet_id"),
        (F.row_number().over(in_sheet) + 1).cast("bigint").alias("row_no"),
        F.col("region").alias("c1"),
        ind.quarter_key("year", "quarter").alias("c2"),
        *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(("n", "var1", "var2"), 3)],
    )
    heads = shares.select(F.col("region").alias("sheet_id")).distinct().select(
        "sheet_id", F.lit(1).cast("bigint").alias("row_no"),
        *[F.lit(h).alias(f"c{i}") for i, h in enumerate(("Region", "Year_Qrtr", "N", "var1", "var2"), 1)],
    )
    sheets = exported(spark, body.unionByName(heads), TIMELY_COLUMNS)
    read = ind.completeness_from_sheets(sheets, ["region", "year_qrtr", "n", "var1", "var2"], 1)
    cells = ind.labelled_grid(read, region_grid(spark), CURRENT)
    return cells.withColumns({c: F.round(c, 6) for c in ("var1", "var2")})


# ---- sources and sinks ---------------------------------------------------------------

@query("period_extract", f"WITH {b.SQL_CASES} SELECT case_id, event_date, state FROM cases")
def period_extract(spark, sf_dir):
    """Two history extracts written, and that of the report month read back whole."""
    base = b.scratch(spark, "history")
    cases = b.cases(spark, sf_dir)
    writers.write_period_extract(cases, base, b.PERIOD)
    writers.write_period_extract(cases.filter(F.year("event_date") < 1998), base, ReportPeriod(date(2001, 5, 31)))
    return readers.read_period_extract(spark, base, b.PERIOD).select("case_id", "event_date", "state")


@query(
    "report_roundtrip",
    f"""WITH {b.SQL_FLU_LABS} SELECT case_id, specimen_date, result_value,
      CASE case_id % 5 WHEN 0 THEN '\\N' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN '\\\\N'
        ELSE 'said "' || coalesce(comments, 'none') || '", then' || chr(10) || 'left' END AS comments FROM flu_labs""",
)
def report_roundtrip(spark, sf_dir):
    """Free text with quotes, line breaks, the null token, empty and missing text written to CSV and read back."""
    said = F.concat(F.lit('said "'), F.coalesce("comments", F.lit("none")), F.lit('", then\nleft'))
    kind = F.col("case_id") % 5
    awkward = F.when(kind == 0, F.lit("\\N")).when(kind == 1, F.lit("")).when(kind == 3, F.lit("\\\\N")).when(kind == 4, said)
    report = b.flu_labs(spark, sf_dir).select("case_id", "specimen_date", "result_value", awkward.alias("comments"))
    path = b.scratch(spark, "report")
    writers.write_report(report, path, b.PERIOD.as_of, "csv")
    return writers.read_csv(
        spark,
        f"{path}/as_of={b.PERIOD.as_of.isoformat()}",
        "case_id bigint, specimen_date date, result_value string, comments string",
    )


@query(
    "convert_types",
    """SELECT CAST(o_orderkey AS DOUBLE) AS case_id, TRY_CAST(o_orderpriority AS DOUBLE) AS priority,
       strftime(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS event_time, nullif(o_orderstatus, 'P') AS status FROM orders""",
)
def convert_types(spark, sf_dir):
    rows = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("case_id"),
        F.col("o_orderpriority").alias("priority"),
        F.to_date("o_orderdate").alias("event_time"),
        nulls.sentinel_to_null("o_orderstatus", "P").alias("status"),
    )
    converted = reshape.convert_types(rows, numbers=["case_id", "priority"], times=["event_time"])
    return converted.withColumn("event_time", F.date_format("event_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    "reshape_columns",
    """SELECT o_orderstatus AS status, o_orderkey AS case_id, o_totalprice FROM orders""",
)
def reshape_columns(spark, sf_dir):
    return reshape.reshape_columns(
        b.table(spark, sf_dir, "orders"),
        drop=["o_custkey"],
        rename={"o_orderkey": "case_id", "o_orderstatus": "status"},
        first=["status"],
        last=["o_totalprice"],
        drop_from="o_orderdate",
    )


"""Outputs published together, feeds of differing types, exact quantiles and periods from a table, on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveil import publish
from surveil.operators import aggregates, intervals, joins, quantiles, reconcile
from workload import bindings as b
from workload.registry import query

# ---- outputs published together ------------------------------------------------------


class Died(Exception):
    """Stands for a driver that dies between two outputs."""


@query(
    "published_outputs",
    f"""WITH {b.SQL_CASES} SELECT state, n, count(*) AS n_listed, count(*) FILTER (disease_status = 'Confirmed') AS n_confirmed
    FROM cases JOIN (SELECT state, count(*) AS n FROM cases GROUP BY state) USING (state) GROUP BY state, n""",
)
def published_outputs(spark, sf_dir):
    """Two outputs of one release, read after a later release of the same date has died half way."""
    base, as_of = b.scratch(spark, "published"), b.PERIOD.as_of
    cases = b.cases(spark, sf_dir).select("case_id", "state", "disease_status")
    with publish.release(spark, base, as_of) as job:
        job.save(aggregates.count_rows(cases, ["state"]), "by_state", "csv")
        job.save(cases, "cases", "lines")
    try:
        with publish.release(spark, base, as_of) as job:
            job.save(aggregates.count_rows(cases.unionByName(cases), ["state"]), "by_state", "csv")
            raise Died
    except Died:
        pass
    rows = publish.current(spark, base, as_of)
    listed = publish.read_output(spark, rows, "cases").groupBy("state").agg(
        aggregates.rows().alias("n_listed"), F.count(F.when(F.col("disease_status") == "Confirmed", 1)).alias("n_confirmed")
    )
    return joins.skew_join(publish.read_output(spark, rows, "by_state"), listed, ["state"])


# ---- feeds of differing types --------------------------------------------------------

SQL_TYPED_FEEDS = """lines AS (SELECT *, CAST(l_shipdate AS DATE) AS day, l_linenumber % 3 AS kind FROM lineitem),
  typed AS (
    SELECT 'printed' AS feed, l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE CAST(day AS TIMESTAMP) END AS received,
      CASE WHEN l_suppkey % 4 = 0 THEN NULL ELSE l_quantity END AS quantity, CAST(l_partkey AS BIGINT) AS code, CAST(NULL AS VARCHAR) AS note,
      concat_ws('; ', CASE WHEN l_partkey % 5 = 0 THEN 'received=not sent' END, CASE WHEN l_suppkey % 4 = 0 THEN 'quantity=' || CAST(l_quantity AS INT) || ' ml' END) AS kept
    FROM lines WHERE kind = 0
    UNION ALL
    SELECT 'sheet', l_orderkey, l_linenumber, CAST(day AS TIMESTAMP) + INTERVAL 6 HOUR, l_quantity, CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_suppkey AS BIGINT) END, NULL,
      CASE WHEN l_partkey % 7 = 0 THEN 'code=' || l_suppkey || '.5' ELSE '' END
    FROM lines WHERE kind = 1
    UNION ALL
    SELECT 'message', l_orderkey, l_linenumber, CAST(day AS TIMESTAMP) + INTERVAL 90 MINUTE, l_quantity / 4, NULL, l_returnflag, '' FROM lines WHERE kind = 2)"""


def typed_feeds(spark, sf_dir) -> dict[str, DataFrame]:
    """Three feeds: all text as printed, a spreadsheet with dates as day numbers, and typed messages without a code."""
    lines = b.table(spark, sf_dir, "lineitem").withColumns({"day": F.to_date("l_shipdate"), "kind": F.col("l_linenumber") % 3})
    keys, quantity = ["l_orderkey", "l_linenumber"], F.col("l_quantity").cast("int")
    printed = lines.filter("kind = 0").select(
        *keys,
        F.when(F.col("l_partkey") % 5 == 0, "not sent").otherwise(F.col("day").cast("string")).alias("received"),
        F.when(F.col("l_suppkey") % 4 == 0, F.concat(quantity.cast("string"), F.lit(" ml"))).otherwise(F.concat(F.lit(" "), quantity.cast("string"), F.lit(".0"))).alias("quantity"),
        F.col("l_partkey").cast("string").alias("code"),
    )
    sheet = lines.filter("kind = 1").select(
        *keys,
        (F.datediff("day", F.lit("1899-12-30").cast("date")) + F.lit(0.25)).alias("received"),
        quantity.alias("quantity"),
        F.concat(F.col("l_suppkey").cast("string"), F.when(F.col("l_partkey") % 7 == 0, ".5").otherwise("")).alias("code"),
    )
    message = lines.filter("kind = 2").select(
        *keys, (F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 90 MINUTE")).alias("received"), (F.col("l_quantity") / 4).alias("quantity"),
        F.col("l_returnflag").alias("note"), F.lit(None).cast("bigint").alias("code"),
    )
    return {"printed": printed, "sheet": sheet, "message": message}


@query(
    "reconciled_feeds",
    f"WITH {SQL_TYPED_FEEDS} SELECT feed, l_orderkey, l_linenumber, strftime(received, '%Y-%m-%d %H:%M:%S') AS received, quantity, code, note, kept FROM typed",
)
def reconciled_feeds(spark, sf_dir):
    """A column that is text, number and date-time in three feeds, under one type; what cannot be converted is kept."""
    stacked = reconcile.stack_feeds(typed_feeds(spark, sf_dir))
    kept = F.array_join(F.transform(F.map_entries(reconcile.UNCONVERTED), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "; ")
    return stacked.select(
        "feed", "l_orderkey", "l_linenumber", F.date_format("received", "yyyy-MM-dd HH:mm:ss").alias("received"), "quantity", "code", "note", kept.alias("kept")
    )


@query(
    "unconverted_cells",
    f"""WITH {SQL_TYPED_FEEDS}, cells AS (SELECT feed, unnest(string_split(kept, '; ')) AS cell FROM typed WHERE kept <> '')
    SELECT feed, split_part(cell, '=', 1) AS "column", split_part(cell, '=', 2) AS text, count(*) AS n FROM cells GROUP BY ALL""",
)
def unconverted_cells(spark, sf_dir):
    return reconcile.unconverted_cells(reconcile.stack_feeds(typed_feeds(spark, sf_dir)))


# ---- exact quantiles -----------------------------------------------------------------

PAID = "l_extendedprice * (1 - l_discount) / l_quantity"


def paid(spark, sf_dir) -> DataFrame:
    price = F.when(F.col("l_linenumber") != 5, F.expr(PAID))
    return b.table(spark, sf_dir, "lineitem").select(price.alias("paid"), "l_quantity")


@query("lag_median_double", f"SELECT round(avg(x), 6) AS mean_lag, round(median(x), 6) AS median_lag FROM (SELECT CASE WHEN l_linenumber <> 5 THEN {PAID} END AS x FROM lineitem)")
def lag_median_double(spark, sf_dir):
    """Mean and exact median of a fractional lag, by narrowing and not by a sort."""
    out = quantiles.mean_and_median(paid(spark, sf_dir), "paid")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


PROBABILITIES = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)


@query(
    "exact_quantiles",
    f"""WITH p AS (SELECT unnest([{", ".join(f"{p}::DOUBLE" for p in PROBABILITIES)}]) AS probability, generate_subscripts([{", ".join(map(str, PROBABILITIES))}], 1) AS i),
    q AS (SELECT quantile_cont({PAID}, [{", ".join(map(str, PROBABILITIES))}]) FILTER (l_linenumber <> 5) AS paid, quantile_cont(l_quantity, [{", ".join(map(str, PROBABILITIES))}]) AS quantity FROM lineitem)
    SELECT probability, round(q.paid[i], 6) AS paid, round(q.quantity[i], 6) AS quantity FROM p, q""",
)
def exact_quantiles(spark, sf_dir):
    """Quantiles of a column with few repeats and of one with many."""
    lines = paid(spark, sf_dir)
    found = zip(PROBABILITIES, *[quantiles.quantiles(lines, c, PROBABILITIES) for c in ("paid", "l_quantity")])
    rows = F.array(*[F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("probability", "paid", "quantity"), row)]) for row in found])
    out = lines.agg(F.count("*")).select(F.inline(rows))
    return out.select("probability", F.round("paid", 6).alias("paid"), F.round("quantity", 6).alias("quantity"))


# ---- periods from a table ------------------------------------------------------------

HOT = "CASE WHEN c_nationkey < 9 THEN 'hot' ELSE 'n' || c_nationkey END"
SQL_PERIODS = f"""periods AS (
    SELECT c_custkey AS period_id, {HOT} AS region, DATE '1995-01-01' + CAST(c_custkey * 37 % 2400 AS INT) AS "start",
      DATE '1995-01-01' + CAST(c_custkey * 37 % 2400 + CASE WHEN c_custkey % 50 = 0 THEN 700 ELSE c_custkey % 40 - 1 END AS INT) AS "end" FROM customer),
  dated AS (SELECT o_orderkey AS case_id, {HOT} AS region, CASE WHEN o_orderkey % 19 <> 0 THEN CAST(o_orderdate AS DATE) END AS day FROM orders JOIN customer ON o_custkey = c_custkey)"""
HIT = 'd.region = p.region AND d.day BETWEEN p."start" AND p."end"'


def region_periods(spark, sf_dir) -> DataFrame:
    """Overlapping periods of a day to two years by region, a third of them in one; some end before they start."""
    shift, key = F.col("c_custkey") * 37 % 2400, F.col("c_custkey")
    length = F.when(key % 50 == 0, 700).otherwise(key % 40 - 1)
    day = F.lit("1995-01-01").cast("date")
    return b.table(spark, sf_dir, "customer").select(
        key.alias("period_id"), F.expr(HOT).alias("region"), F.date_add(day, shift.cast("int")).alias("start"), F.date_add(day, (shift + length).cast("int")).alias("end")
    )


def dated_cases(spark, sf_dir) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").join(b.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    day = F.when(F.col("o_orderkey") % 19 != 0, F.to_date("o_orderdate"))
    return orders.select(F.col("o_orderkey").alias("case_id"), F.expr(HOT).alias("region"), day.alias("day"))


@query("period_cases", f"WITH {SQL_PERIODS} SELECT period_id, p.region, count(*) AS n, min(day) AS first_day, max(day) AS last_day FROM dated d JOIN periods p ON {HIT} GROUP BY ALL")
def period_cases(spark, sf_dir):
    """Cases within each of many overlapping periods of their region.

    Cases are counted per region and day first, so a period meets its days, which the calendar bounds, and not its cases.
    """
    days = aggregates.count_rows(dated_cases(spark, sf_dir), ["region", "day"], "n_day")
    met = intervals.period_join(intervals.spread(days), region_periods(spark, sf_dir), "day", by=["region"])
    return met.groupBy("period_id", "region").agg(F.sum("n_day").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"))


@query("cases_outside_periods", f"WITH {SQL_PERIODS} SELECT case_id, region, day FROM dated d WHERE NOT EXISTS (SELECT 1 FROM periods p WHERE {HIT})")
def cases_outside_periods(spark, sf_dir):
    return intervals.period_join(dated_cases(spark, sf_dir), region_periods(spark, sf_dir), "day", by=["region"], how="left_anti")


@query(
    "periods_running",
    f"""WITH {SQL_PERIODS}, c AS (SELECT region, "start" AS day, 1 AS change FROM periods WHERE "start" <= "end" UNION ALL SELECT region, "end" + 1, -1 FROM periods WHERE "start" <= "end"),
    s AS (SELECT region, day, sum(change) AS change FROM c GROUP BY ALL HAVING sum(change) <> 0)
    SELECT region, CAST(day AS DATE) AS day, CAST(sum(change) OVER (PARTITION BY region ORDER BY day) AS BIGINT) AS n_running FROM s""",
)
def periods_running(spark, sf_dir):
    """How many periods of a region run at the same time."""
    return intervals.overlapping_days(region_periods(spark, sf_dir), by=["region"])


SEASONS = "SELECT y AS season, make_date(y, 10, 1) AS \"start\", make_date(y + 1, 5, 20) AS \"end\" FROM (SELECT unnest(range(1994, 2003)) AS y)"


@query(
    "seasons_from_table",
    f"""WITH {b.SQL_CASES}, seasons AS ({SEASONS}) SELECT CAST(season AS INTEGER) AS season, state, count(*) AS n
    FROM cases JOIN seasons ON event_date BETWEEN "start" AND "end" GROUP BY ALL""",
)
def seasons_from_table(spark, sf_dir):
    """Cases per season where the seasons are rows of a table and not an expression."""
    seasons = spark.range(1994, 2003).select(
        F.col("id").cast("int").alias("season"), F.make_date(F.col("id").cast("int"), F.lit(10), F.lit(1)).alias("start"),
        F.make_date((F.col("id") + 1).cast("int"), F.lit(5), F.lit(20)).alias("end"),
    )
    return aggregates.count_rows(intervals.period_join(b.cases(spark, sf_dir), seasons, "event_date"), ["season", "state"])

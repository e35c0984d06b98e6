"""Inputs. Schemas are always explicit, so no read infers types from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from surveil.functions.periods import ReportPeriod
from surveil.sources.writers import extract_path


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet", **options
) -> DataFrame:
    """A case or lab table. Parquet carries its own schema; text formats need one."""
    if schema is None and fmt != "parquet":
        raise ValueError(f"format {fmt!r} needs a schema")
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema is not None else reader).load(path)


def read_warehouse(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[str, str],
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A warehouse table over JDBC, read in parallel ranges of the partition column.

    Filters and column selection are pushed into the warehouse by Spark.
    """
    return spark.read.jdbc(
        url,
        table,
        column=partition_column,
        lowerBound=bounds[0],
        upperBound=bounds[1],
        numPartitions=partitions,
        properties=properties or {},
    )


def _sql_literal(v) -> str:
    return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"


def range_predicates(column: str, cuts: Sequence) -> list[str]:
    """WHERE clauses that part a table between the ``cuts``: every row, also one without a value, satisfies exactly one.

    Cuts at quantiles make parts of about equal size where equal strides would not.
    """
    points = sorted(set(cuts))
    if not points:
        return ["1 = 1"]
    inner = [f"{column} >= {_sql_literal(a)} AND {column} < {_sql_literal(b)}" for a, b in zip(points, points[1:])]
    return [f"{column} < {_sql_literal(points[0])} OR {column} IS NULL", *inner, f"{column} >= {_sql_literal(points[-1])}"]


def hash_predicates(expression: str, partitions: int) -> list[str]:
    """WHERE clauses by the remainder of a whole-number expression of the warehouse, such as a hash of the key.

    For keys of which one owns so many rows that no cut of their values parts them: the expression should then
    take in a further column. Negative values and rows without a value are in exactly one part, too.
    """
    rest = f"ABS(({expression}) % {partitions})"
    return [f"{rest} = {i}" + (f" OR ({expression}) IS NULL" if i == 0 else "") for i in range(partitions)]


def quantile_cuts(sample: DataFrame, column: str, partitions: int) -> list:
    """Cuts for ``range_predicates`` from a sample or an earlier extract of the table, by approximate quantiles of its values."""
    if partitions < 2:
        return []
    at = F.array(*[F.lit(i / partitions) for i in range(1, partitions)])
    cuts = sample.agg(F.percentile_approx(column, at, F.lit(max(10_000, 20 * partitions))).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def read_warehouse_parts(spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str] | None = None) -> DataFrame:
    """A warehouse table over JDBC, one task for each predicate (``range_predicates``, ``hash_predicates``)."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def read_period_extract(spark: SparkSession, base: str, period: ReportPeriod) -> DataFrame:
    """The history extract of the report date (``write_period_extract``), whole.

    Only the files of that one extract are listed and read. An extract that is not there is an error.
    """
    return spark.read.option("basePath", base).parquet(extract_path(base, period))


def read_sheet_csv(spark: SparkSession, path: str, columns: list[str], null_token: str = ".") -> DataFrame:
    """Exported sheets. Cells stay text and the null token becomes null.

    Spark does not keep the line order of a file, so the export carries ``sheet_id`` and
    ``row_no`` in front of the cells.
    """
    cells = ", ".join(f"`{c}` string" for c in columns)
    return spark.read.csv(path, schema=f"sheet_id string, row_no bigint, {cells}", nullValue=null_token)

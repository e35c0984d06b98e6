"""Outputs. A report is a folder partitioned by its period, never one big file."""

from __future__ import annotations

import os
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from surveil.functions.periods import ReportPeriod


def write_report(df: DataFrame, path: str, as_of: date, fmt: str = "parquet") -> None:
    """Write the report of one date; other dates in the same folder are kept.

    The partition folder is addressed directly, so a re-run replaces just its own date.
    """
    target = f"{path}/as_of={as_of.isoformat()}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        write_csv(df, target)
    elif fmt == "lines":
        write_lines(df, target)
    else:
        writer.format(fmt).save(target)


def write_period_extract(df: DataFrame, base: str, period: ReportPeriod) -> None:
    """The history extract of the report date: all of ``df`` under the year and month of the extract.

    The month is that of the report, not of the rows: one extract holds every earlier season.
    Other extracts in ``base`` are kept.
    """
    if {"year", "month"} & set(df.columns):
        raise ValueError("year and month name the extract; rename these columns")
    df.hint("rebalance").write.mode("overwrite").parquet(extract_path(base, period))


def extract_path(base: str, period: ReportPeriod) -> str:
    year, month = period.extract_month()
    return f"{base}/year={year}/month={month}"


# One set of options for both directions: every value quoted, quotes doubled, white space
# kept, and null told from empty text.
CSV_OPTIONS = {
    "header": True, "quote": '"', "escape": '"', "nullValue": "\\N", "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


# A text that reads like the null token, with any number of backslashes, gets one more.
LIKE_NULL, LIKE_ESCAPED = r"^\\+N$", r"^\\{2,}N$"
MAX_RECORDS = 1_000_000  # rows per file: a multi-line file is read by one task


def write_csv(df: DataFrame, path: str, max_records: int = MAX_RECORDS) -> None:
    """CSV that survives quotes, separators, line breaks and the null token itself in free text."""
    texts = [f.name for f in df.schema if f.dataType == StringType()]
    escaped = {c: F.when(F.col(f"`{c}`").rlike(LIKE_NULL), F.concat(F.lit("\\"), f"`{c}`")).otherwise(F.col(f"`{c}`")) for c in texts}
    writer = df.withColumns(escaped).write.mode("overwrite").option("maxRecordsPerFile", max_records)
    writer.options(quoteAll=True, **CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Counterpart of ``write_csv``."""
    df = spark.read.schema(schema).options(multiLine=True, **CSV_OPTIONS).csv(path)
    texts = [f.name for f in df.schema if f.dataType == StringType()]
    return df.withColumns(
        {c: F.when(F.col(f"`{c}`").rlike(LIKE_ESCAPED), F.substring(f"`{c}`", 2, 2**30)).otherwise(F.col(f"`{c}`")) for c in texts}
    )


# Escapes that keep a record on one line and whole. The backslash comes first, and the null token is no text's encoding.
LINE_ESCAPES = {"\\": "\\\\", "\n": "\\n", "\r": "\\r", "\0": "\\0"}


def one_line(c: str | Column) -> Column:
    """The text without line breaks: backslash, line feed, carriage return and NUL become two characters each."""
    out = F.col(c) if isinstance(c, str) else c
    for char, escape in LINE_ESCAPES.items():
        out = F.replace(out, F.lit(char), F.lit(escape))
    return out


def many_lines(c: str | Column) -> Column:
    """Undoes ``one_line``: between doubled backslashes, a backslash begins one of the other escapes."""
    encoded = F.col(c) if isinstance(c, str) else c

    def breaks(part: Column) -> Column:
        for char, escape in list(LINE_ESCAPES.items())[1:]:
            part = F.replace(part, F.lit(escape), F.lit(char))
        return part

    decoded = F.array_join(F.transform(F.split(encoded, r"\\\\", -1), breaks), "\\")
    return F.when(F.contains(encoded, F.lit("\\")), decoded).otherwise(encoded)


def write_lines(df: DataFrame, path: str) -> None:
    """CSV with one line per record, whatever its texts hold, so that a file of any size can be split between readers.

    Texts are written by ``one_line``; quotes and separators inside them are quoted as usual. A missing
    text is the bare token, which no written text equals. ``read_lines`` gives the same rows.
    """
    texts = {f.name: one_line(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, StringType)}
    df.withColumns(texts).write.mode("overwrite").options(quoteAll=True, **CSV_OPTIONS).csv(path)


def read_lines(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """Counterpart of ``write_lines``. Files are cut at line ends into parts of ``spark.sql.files.maxPartitionBytes``."""
    df = spark.read.schema(schema).options(multiLine=False, **CSV_OPTIONS).csv(path)
    return df.withColumns({f.name: many_lines(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, StringType)})


def report_name(prefix: str, as_of: date, year_week: tuple[int, int] | None = None) -> str:
    """Folder name with the date, or with the epidemiological year and week."""
    return f"{prefix}{year_week[0]}{year_week[1]}" if year_week else f"{prefix} {as_of.isoformat()}"


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder for an intermediate table, in the shared folder that the session names
    in ``spark.checkpoint.dir``. Without that setting there is no folder that all executors see."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")

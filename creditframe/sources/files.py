"""Readers for the delimited loan files and for small facts files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from creditframe.functions.scalars import as_double, as_int
from creditframe.sources import layouts


def detect_layout(spark: SparkSession, path: str) -> str:
    """Which naming convention the files of a folder follow; the first one in ``LAYOUT_MARKS`` that occurs.

    Lists the folder once and reads no file content.
    """
    names = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).select("path")
    seen = names.agg(*[F.max(F.col("path").rlike(mark)).alias(name) for name, mark in layouts.LAYOUT_MARKS.items()])
    found = seen.first().asDict()
    return next((name for name in layouts.LAYOUT_MARKS if found[name]), "quarterly")


#: The raw line of a row whose number of fields is not that of the layout.
REJECTED = "_rejected_line"


def _parsed_lines(spark: SparkSession, path: str, pattern: str, fields: list[str]) -> DataFrame:
    """Header-less pipe-delimited files, all text, with ``REJECTED`` set on rows of a wrong field count.

    Column pruning is off in the parser: with it on, rows are judged by the columns a query happens
    to use, so the same file would count differently from query to query.
    """
    schema = T.StructType([*layouts.text_schema(fields).fields, T.StructField(REJECTED, T.StringType())])
    return (
        spark.read.schema(schema)
        .option("sep", "|")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", REJECTED)
        .option("columnPruning", "false")
        .option("pathGlobFilter", pattern)
        .csv(path)
    )


def _read_text_columns(spark: SparkSession, path: str, pattern: str, fields: list[str]) -> DataFrame:
    """The well-formed rows; ``rejected_lines`` gives the others and ``counted`` counts both.

    Spark refuses a plain count over the raw-line column alone, so this reader drops malformed rows
    in the parser; both give the same rows.
    """
    return (
        spark.read.schema(layouts.text_schema(fields))
        .option("sep", "|")
        .option("header", "false")
        .option("mode", "DROPMALFORMED")
        .option("columnPruning", "false")
        .option("pathGlobFilter", pattern)
        .csv(path)
    )


def rejected_lines(spark: SparkSession, path: str, pattern: str, fields: list[str]) -> DataFrame:
    """File and raw text of every line with a wrong number of fields."""
    parsed = _parsed_lines(spark, path, pattern, fields)
    # A query of the raw-line column alone is refused by Spark's reader; the first field comes along.
    return parsed.where(F.col(REJECTED).isNotNull()).select(F.input_file_name().alias("file"), F.col(fields[0]).alias("first_field"), F.col(REJECTED).alias("line"))


def counted(spark: SparkSession, path: str, pattern: str, fields: list[str], name: str) -> tuple[DataFrame, Observation]:
    """Well-formed rows, with lines read and rejected counted by whatever action writes them."""
    watch = Observation(name)
    parsed = _parsed_lines(spark, path, pattern, fields).observe(
        watch, F.count(F.lit(1)).alias("read"), F.count(F.col(REJECTED)).alias("rejected")
    )
    return parsed.where(F.col(REJECTED).isNull()).drop(REJECTED), watch


def read_raw_loans(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    pattern = layouts.FILE_PATTERNS[layout or detect_layout(spark, path)][0]
    return _read_text_columns(spark, path, pattern, layouts.ORIGINATION_FIELDS)


def read_raw_performance(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    pattern = layouts.FILE_PATTERNS[layout or detect_layout(spark, path)][1]
    return _read_text_columns(spark, path, pattern, layouts.PERFORMANCE_FIELDS)


def _typed(name: str):
    column = F.col(name)
    if name in layouts.INT_FIELDS:
        return as_int(column).alias(name)
    if name in layouts.DOUBLE_FIELDS:
        return as_double(column).alias(name)
    return column


def type_loans(raw: DataFrame) -> DataFrame:
    """Typed origination columns; the vintage year here is that of the first payment."""
    names = [name for name in layouts.ORIGINATION_COLUMNS if name in raw.columns]
    year = as_int(F.substring("first_payment_date", 1, 4))
    return raw.select(*[_typed(name) for name in names], year.alias("vintage_year"))


def type_performance(raw: DataFrame) -> DataFrame:
    """The ten performance columns the analytics use; the delinquency status stays text."""
    return raw.select(*[_typed(name) for name in layouts.PERFORMANCE_COLUMNS])


def read_loans(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    return type_loans(read_raw_loans(spark, path, layout))


def read_performance(spark: SparkSession, path: str, layout: str | None = None) -> DataFrame:
    return type_performance(read_raw_performance(spark, path, layout))


def read_facts(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV file with a header, such as macro series or a finished projection."""
    return spark.read.schema(schema).option("header", "true").csv(path)

"""CSV readers: headed files with a schema built from the header, and
headless files read by position."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from quarry.functions.text import split_literal


def first_string_rest_double(names: Sequence[str], nullable: bool = False) -> StructType:
    """Schema from header names: the first column text, all others double."""
    fields = [StructField(names[0], StringType(), nullable)]
    fields += [StructField(n, DoubleType(), nullable) for n in names[1:]]
    return StructType(fields)


def header_columns(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names from the header line (reads one line, no inference)."""
    return spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path).columns


def require_not_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Fail the job on a null in any of ``cols`` (declared non-null fields;
    the CSV reader relaxes them to nullable).

    Each column is wrapped on its own, so the check travels with the
    column: a query that reads the column checks it, and a column the
    query prunes is neither read nor checked.
    """
    check = set(cols if cols is not None else df.columns)
    out = []
    for c in df.columns:
        x = F.col(f"`{c}`")
        if c in check:
            x = F.when(x.isNull(), F.raise_error(F.lit(f"null in non-null column {c}"))).otherwise(x)
        out.append(x.alias(c))
    return df.select(*out)


def read_headed_csv(
    spark: SparkSession,
    path: str,
    keep_quotes: bool = False,
    strict: bool = True,
    sep: str = ",",
    where: Column | None = None,
    where_cols: Sequence[str] = (),
    check_dropped: bool = False,
) -> tuple[list[str], DataFrame]:
    """Read a headed CSV whose first column is text and the rest numbers.

    Returns ``(columns, df)``.  The schema comes from the header (first
    column string, the others double); the header line is skipped.
    ``strict`` fails on a file with another header, on a malformed line or a
    bad number, and on an empty field in a column the query reads; otherwise
    bad lines land in ``_corrupt_record`` (PERMISSIVE).
    ``keep_quotes`` keeps quote characters in the text, as a plain split
    on the delimiter would.  ``where`` is a predicate on the raw columns
    ``where_cols``.  By default it is pushed into the CSV parser: a row with
    an empty field in ``where_cols`` still fails, and the other fields of
    rows that the predicate drops are not looked at.  With ``check_dropped``
    the predicate comes after the checks: the columns that a query reads are
    converted in every row, so a bad number fails in a dropped row as well.
    The checks wrap each column, so only the columns a query uses are checked.
    """
    names = header_columns(spark, path, sep)
    schema = first_string_rest_double(names, nullable=True)
    reader = spark.read.option("header", True).option("sep", sep)
    if keep_quotes:
        reader = reader.option("quote", "")
    if strict:
        df = reader.option("mode", "FAILFAST").option("enforceSchema", False).schema(schema).csv(path)
        if where is not None and not check_dropped:
            empty = [F.col(f"`{c}`").isNull() for c in where_cols]
            df = df.where(reduce(operator.or_, empty, where))
        df = require_not_null(df)
        if where is not None:
            df = df.where(where)
    else:
        schema = StructType(schema.fields + [StructField("_corrupt_record", StringType(), True)])
        df = (
            reader.option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .schema(schema)
            .csv(path)
        )
        if where is not None:
            df = df.where(where)
    return names, df


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines (column ``value``); the reader drops a byte-order mark at a file start."""
    return spark.read.text(path)


def positional_fields(line: Column | str, n: int, sep: str = ",") -> list[Column]:
    """The first ``n`` fields of a delimited line, by position.  A missing
    field fails the job (ANSI array index)."""
    parts = split_literal(line, sep)
    return [parts[i] for i in range(n)]

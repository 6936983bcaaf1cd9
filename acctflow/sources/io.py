"""Reading, writing, inline rows, views and parameterised SQL.

Errors propagate: a failed read or write raises instead of returning a stale
frame or logging success.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    schema: StructType | str | None = None,
    sep: str = ",",
    header: bool = True,
    **options: Any,
) -> DataFrame:
    """Read any format; explicit schema when given, inferred otherwise.

    With a schema the header line is skipped and the names come from the
    schema (S2); without one CSV columns are inferred, which costs an extra
    pass over the file (S1). Values keep surrounding spaces, as CSV does by
    default.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", header).option("sep", sep)
        if schema is None:
            reader = reader.option("inferSchema", True)
    if schema is not None:
        reader = reader.schema(schema)
    if options:
        reader = reader.options(**options)
    return reader.load(path)


def read_with_rejects(
    spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ",", header: bool = True, line: str = "line", **options: Any
) -> tuple[DataFrame, DataFrame]:
    """A CSV file as its good rows (the schema's columns) and its rejects: lines
    with a value that does not fit its type, or with too few or too many values, as
    the column ``line`` beside the values that could be read.

    Both parts come from one read that parses every column, so which lines are
    rejects does not depend on the columns used later.
    """
    whole = StructType([*schema.fields, StructField(line, StringType())])
    rows = read_table(spark, path, "csv", whole, sep, header, mode="PERMISSIVE", columnNameOfCorruptRecord=line, columnPruning=False, **options)
    # Spark refuses to read the raw line alone, so it carries no part of every other column.
    nothing = F.substring(F.concat_ws("", *[F.col(f.name).cast("string") for f in schema.fields]), 1, 0)
    raw = F.concat(F.col(line), nothing)
    return rows.where(raw.isNull()).drop(line), rows.where(raw.isNotNull()).withColumn(line, raw)


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "csv",
    mode: str = "overwrite",
    header: bool = True,
    partition_by: Iterable[str] | None = None,
    **options: Any,
) -> None:
    """Write in any format and save mode (S4, S5); CSV gets a header line."""
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", header)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if options:
        writer = writer.options(**options)
    writer.save(path)


def from_rows(
    spark: SparkSession, rows: Iterable[Any], schema: StructType | str | list[str]
) -> DataFrame:
    """Literal rows with a schema (S6). Meant for small inline data only."""
    return spark.createDataFrame(list(rows), schema)


def register_views(views: Mapping[str, DataFrame]) -> None:
    """Register or replace temp views by name."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_sql(
    spark: SparkSession, text: str, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """SQL over registered views with bound named parameters.

    Values are bound (``:name`` markers), never pasted into the text, so a
    date is a date and a string cannot change the query.
    """
    return spark.sql(text, args=dict(params or {}))

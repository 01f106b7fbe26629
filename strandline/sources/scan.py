"""Typed file scans and load stamps."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strandline.sources.schemas import TELEMETRY


def read_typed_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = TELEMETRY,
    malformed_col: str | None = None,
) -> DataFrame:
    """CSV with one header line, read under a declared schema.

    Columns bind by position: the header is skipped and its names are ignored.
    Cells that do not parse become NULL, short rows are padded with NULL and
    extra cells are dropped. Nothing is inferred, so no job runs here, and
    uncompressed files are split across tasks.

    ``malformed_col`` keeps the text of each row that has a cell that does not parse, or
    too few or too many cells; it is NULL for the others, empty cells included. Spark
    looks only at the columns that a query reads, so store the rows, or select all
    columns, before asking for it.
    """
    reader = spark.read.option("header", True)
    if malformed_col is not None:
        schema = StructType([*schema.fields, StructField(malformed_col, StringType())])
        reader = reader.option("columnNameOfCorruptRecord", malformed_col)
    return reader.schema(schema).csv(path)


def stamp(df: DataFrame, col: str, at: datetime | None = None) -> DataFrame:
    """Add the query's start time, or ``at`` to replay an earlier load."""
    return df.withColumn(col, F.current_timestamp() if at is None else F.lit(at))

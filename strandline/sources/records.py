"""Single rows, for the small tables that describe the large ones."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def one_row(spark: SparkSession, schema: str, values: Sequence[object]) -> DataFrame:
    """One row made of literals: unlike local data, it needs no Python worker."""
    fields = StructType.fromDDL(schema)
    return spark.range(1, numPartitions=1).select(
        *[_literal(v).cast(f.dataType).alias(f.name) for f, v in zip(fields, values, strict=True)]
    )


def _literal(value: object) -> Column:
    if isinstance(value, Mapping):
        return F.create_map(*[F.lit(part) for entry in value.items() for part in entry])
    return F.lit(value)


def add(spark: SparkSession, path: str, schema: str, values: Sequence[object]) -> None:
    """Append one row to a plain folder of small files.

    Files are only added, each under a name of its own, so several jobs may write.
    """
    one_row(spark, schema, values).write.mode("append").parquet(path)


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of such a folder, in no order; none where it is not there yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)

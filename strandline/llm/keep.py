"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.sources import shared


def keep(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: work done once, and its
    lineage ends here, so that a lost executor costs no recomputation of it."""
    path = shared.work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_ROWS = 1_000_000


def without(rows: DataFrame, dropped: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` is not among ``dropped``; null stays. The values are
    broadcast where they are at most BROADCAST_ROWS, by count; else they are joined."""
    few = dropped.count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(dropped) if few else dropped, column, "left_anti")


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for columns to add: those wanted, or longer where the frame has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def numbered(docs: DataFrame, id_col: str, name: str) -> DataFrame:
    """The rows with a number of their own as ``name``: the id where no other row has it,
    else, and for a null id, one beyond all ids. Without such rows no row travels."""
    again = keep(
        docs.groupBy(F.col(id_col).alias("again"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1 OR again IS NULL")
        .select("again"),
        "repeated",
    )
    own = F.col(id_col).cast("long")
    if again.isEmpty():
        return docs.withColumn(name, own)
    top = docs.agg(F.max(own)).first()[0] or 0
    beyond = F.lit(top + 1) + F.monotonically_increasing_id()
    (other,) = fresh(docs, "_again")
    marked = docs.join(
        again.select(F.col("again").alias(other)),
        F.col(id_col).eqNullSafe(F.col(other)),
        "left_semi",
    )
    rest = docs.join(
        again.select(F.col("again").alias(other)),
        F.col(id_col).eqNullSafe(F.col(other)),
        "left_anti",
    )
    # Written down, so that a row keeps its number.
    several = keep(marked.withColumn(name, beyond), "numbered")
    return rest.withColumn(name, own).unionByName(several)

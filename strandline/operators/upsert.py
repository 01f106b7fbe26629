"""Keyed upsert as plain DataFrame work.

A NULL in a key never matches, so such rows are kept on both sides. They take
no part in the join or the grouping: they would all hash to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an upsert did with a row.
INSERTED, UPDATED, KEPT = "inserted", "updated", "kept"


def has_key(keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def unmatched(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    bounds: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Target rows that no source row replaces.

    Only the key columns of the source are read. Spark broadcasts them if their
    size is under its threshold, and the target is then not shuffled at all;
    beyond it the join is sort-merge, and AQE splits skewed target partitions.

    ``bounds`` are literals, the source's least and greatest first key. Target rows
    outside them stay out of the join: for a load of recent instants that is nearly
    all of the table, copied without a shuffle. As literals they reach the scans,
    so where files are laid out by that key each of the two scans skips the other's
    row groups, and together they read the target about once. (Spark pushes no filter
    on timestamps without a zone to Parquet: those files are read twice.)
    """
    joined, aside = has_key(keys), ~has_key(keys)
    if bounds is not None:
        first, (low, high) = F.col(keys[0]), bounds
        joined = joined & (first >= low) & (first <= high)
        aside = aside | (first < low) | (first > high)
    incoming = source.select(*keys).filter(has_key(keys))
    kept = target.filter(joined).join(incoming, list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(target.filter(aside))


def repeated(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that several source rows share; NULL keys never match, so do not count."""
    return (
        source.select(*keys)
        .filter(has_key(keys))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .filter("n_rows > 1")
    )


def matches_by_file(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    bounds: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Files of the stored target that hold rows which a source row replaces, and how many.

    Reads the key columns only, and with ``bounds`` (see :func:`unmatched`) skips files
    and row groups outside the source's range. NULL keys match nothing.
    """
    rows = target.select(*keys, F.input_file_name().alias("_file")).filter(has_key(keys))
    if bounds is not None:
        rows = rows.filter((F.col(keys[0]) >= bounds[0]) & (F.col(keys[0]) <= bounds[1]))
    incoming = source.select(*keys).filter(has_key(keys))
    found = rows.join(incoming, list(keys), "left_semi")
    return found.groupBy("_file").agg(F.count(F.lit(1)).alias("n_rows"))


def matched(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the target rows that a source row replaces; reads key columns only."""
    return target.select(*keys).join(source.select(*keys), list(keys), "left_semi")


def upsert_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key; the rest of both stays.

    The source must hold one row per key (see ``dedupe.one_per_key``).
    """
    return unmatched(target, source, keys).unionByName(source)


def outcomes(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key columns and ``outcome`` of every row of the upserted result.

    Both sides hold one row per key. One grouping over the union of their keys
    replaces a full outer join: rows combine before the shuffle and nothing is
    sorted.
    """
    target_keys = target.select(*keys, F.lit(True).alias("_old"))
    source_keys = source.select(*keys, F.lit(False).alias("_old"))
    both = target_keys.unionByName(source_keys)
    outcome = (
        F.when(F.bool_and("_old"), KEPT)
        .when(F.bool_or("_old"), UPDATED)
        .otherwise(INSERTED)
        .alias("outcome")
    )
    matched = both.filter(has_key(keys)).groupBy(*keys).agg(outcome)
    loose = both.filter(~has_key(keys)).select(
        *keys, F.when(F.col("_old"), KEPT).otherwise(INSERTED).alias("outcome")
    )
    return matched.unionByName(loose)


def upsert_stats(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per outcome."""
    return outcomes(target, source, keys).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("n_rows")
    )

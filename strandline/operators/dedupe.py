"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (), keep: str = "first"
) -> DataFrame:
    """Keep one row of each key: the first (or last) by ``order_by``.

    Ties, and the whole choice where ``order_by`` is empty, are settled by the
    remaining columns in schema order (NULL lowest, NaN highest). So the result
    does not depend on partitioning and a recomputed task picks the same row.

    Columns that are or hold maps are refused: they have no order.

    This is a sort-based aggregate and not a ``row_number`` window: each map task first
    reduces its own rows to one per key, so a key holding a third of the table
    sends one row per task through the shuffle instead of all of them.
    """
    if keep not in ("first", "last"):
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(list(keys))
    maps = [c for c in rest if "map<" in df.schema[c].dataType.simpleString()]
    if maps:
        raise ValueError(f"maps have no order to settle ties by: {maps}")
    ranked = F.struct(*_ordered_first(rest, order_by))
    pick = F.min(ranked) if keep == "first" else F.max(ranked)
    return df.groupBy(*keys).agg(pick.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def _ordered_first(rest: Sequence[str], order_by: Sequence[str]) -> list[str]:
    unknown = [c for c in order_by if c not in rest]
    if unknown:
        raise ValueError(f"not a non-key column: {unknown}")
    return [*order_by, *[c for c in rest if c not in order_by]]

"""Versioned Parquet tables under a path.

    <path>/v=<N>-<id>/  files written by version N, never changed afterwards
    <path>/commits/     one row per finished version

    <path>/claims/<N>   made by the one writer that may commit version N

A commit row is written after its data, and reads go through the commits, so a
write that dies half-way stays invisible. Every write has a folder of its own and
overwrites nothing. Each table takes one writer at a time: of two that make the same
version the second stops with an error, and the table stays as the first left it. An
append writes its own rows only: a version is made of its ``base`` version's entries and
those of the appends since, and after MOST_APPENDS of them a new base is written. An
entry is a folder of files or, where a later version took over only some of them, a file.
A table may be split into parts by calendar period, with a folder for each part.
"""

from __future__ import annotations

import json
import math
import re
import time
import uuid
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    MapType,
    NumericType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from strandline.operators.upsert import has_key, matches_by_file, repeated, unmatched
from strandline.sources.records import one_row

COMMITS = (
    "table_name string, version int, ts timestamp, operation string, n_rows long, "
    "base int, folders array<string>, schema string"
)
ROWS_PER_FILE = 5_000_000
ROWS_PER_SORT = 2_000_000  # that one task of a layout in a given number of files sorts
MOST_APPENDS = 100
TIMESTAMPS = "spark.sql.parquet.outputTimestampType"
UNIONS = "spark.sql.unionOutputPartitioning"
MICROS_PER_DAY = 86_400_000_000
CLAIM_SECONDS = 3600  # an older claim without a commit is that of a writer that died
BITS = 6  # of a value's rank, in a layout along several columns
PERIODS = ("week", "month", "quarter", "year")


@dataclass(frozen=True)
class Split:
    """Parts by the calendar period of a timestamp or date, in UTC or else (``local``) in
    the session's time zone. Unless rows of a part are together already, ``gather`` brings
    them together before the write, large parts over several tasks."""

    col: str
    period: str = "month"
    local: bool = False
    gather: bool = True

    def __post_init__(self) -> None:
        if self.period not in PERIODS:
            raise ValueError(f"no such period: {self.period!r}")

    @property
    def name(self) -> str:
        return f"_{'local_' if self.local else ''}{self.period}_of_{self.col}"

    def part(self, value: object) -> str:
        """The folder of the part that begins on a date."""
        return f"{self.name}={value}"


# ---------------------------------------------------------------- reading


def exists(spark: SparkSession, path: str) -> bool:
    return _commits(spark, path) is not None


def latest_version(spark: SparkSession, path: str) -> int:
    return _commit_row(spark, path, None)["version"]


def fingerprint(spark: SparkSession, path: str, version: int | None = None) -> str:
    """Names a version; a table removed and made again has another."""
    commit = _commit_row(spark, path, version)
    return f"version {commit['version']} in {max(commit['folders']).split('/')[0]}"


def changed_parts(
    spark: SparkSession, path: str, since: int, split: Split
) -> list[str] | None:
    """First days of the parts whose rows may differ between a version and the newest:
    those that do not consist of the same entries. None where either is not split so."""
    sides = []
    for version in (since, None):
        parts: dict[str, set[str]] = {}
        for entry in _folders(spark, path, _commit_row(spark, path, version)):
            parts.setdefault(_part(entry), set()).add(entry)
        sides.append(parts)
    if not all(part.startswith(split.part("")) for parts in sides for part in parts):
        return None
    old, new = sides
    found = [part for part in {*old, *new} if old.get(part) != new.get(part)]
    return sorted(part.rsplit("=", 1)[1] for part in found)


def read_parts(
    spark: SparkSession, path: str, split: Split, parts: Sequence[str]
) -> DataFrame:
    """The newest version's rows of some parts; no file of the others is opened."""
    commit = _commit_row(spark, path, None)
    wanted = {split.part(p) for p in parts}
    entries = [f for f in _folders(spark, path, commit) if _part(f) in wanted]
    return _files(spark, path, entries, _schema_of(commit))


def row_count(spark: SparkSession, path: str, version: int | None = None) -> int:
    """Rows of a version, as counted when it was written."""
    return _commit_row(spark, path, version)["n_rows"]


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or an older one."""
    return _scan(spark, path, _commit_row(spark, path, version))


def view(spark: SparkSession, path: str, name: str, version: int | None = None) -> None:
    """Register a version as a temporary view for SQL users."""
    read(spark, path, version).createOrReplaceTempView(name)


def history(spark: SparkSession, path: str) -> DataFrame:
    """Versions, newest first."""
    commits = _commits(spark, path)
    if commits is None:
        raise LookupError(f"no table at {path}")
    return commits.select("table_name", "version", "ts", "operation", "n_rows").orderBy(
        F.desc("version")
    )


def audit(
    spark: SparkSession,
    path: str,
    skip_operations: Sequence[str] = (),
    contents: bool = False,
) -> DataFrame:
    """Stored rows of the newest version and of the one before it, in one row.

    The rows are counted in the files (their footers), not taken from the
    commits. ``skip_operations=("cluster",)`` compares with the last version
    that changed data. The previous side is NULL where there is none.

    ``contents`` adds ``same_contents``: whether both hold the same rows, each as often,
    in any order and any files. Sums of two row hashes are compared, and only files that
    one version has and the other has not are read; NULL where there is no previous one.
    """
    commits = _commits(spark, path)
    if commits is None:
        raise LookupError(f"no table at {path}")
    newest = _commit_row(spark, path, None)
    older = commits.filter(F.col("version") < newest["version"])
    if skip_operations and newest["operation"] in skip_operations:
        # The version before a layout holds the same data: look past that too.
        changed = commits.filter(~F.col("operation").isin(*skip_operations))
        data_version = changed.agg(F.max("version")).first()[0]
        older = changed.filter(F.col("version") < data_version)
    previous = older.orderBy(F.desc("version")).first()

    counted = _scan(spark, path, newest).select(F.lit(True).alias("newest"))
    if previous is not None:
        counted = counted.unionByName(
            _scan(spark, path, previous).select(F.lit(False).alias("newest"))
        )
    sides = counted.agg(
        F.count_if("newest").alias("n_rows"), F.count_if(~F.col("newest")).alias("before")
    )
    previous_version = None if previous is None else previous["version"]
    previous_rows = F.col("before") if previous is not None else F.lit(None).cast("long")
    row = sides.select(
        F.lit(newest["version"]).alias("version"),
        "n_rows",
        F.lit(previous_version).cast("int").alias("previous_version"),
        previous_rows.alias("previous_rows"),
        (F.col("n_rows") - previous_rows).alias("difference"),
    )
    if not contents:
        return row
    same = None if previous is None else _same_contents(spark, path, previous, newest)
    return row.withColumn("same_contents", F.lit(same).cast("boolean"))


def checksum(df: DataFrame) -> str:
    """A sum over all rows that does not depend on their order or place: the number of
    rows and, of two 64-bit hashes of each whole row, the sums. NULL differs from every
    value and has its place; a map's entries have no order."""
    row = df.agg(*_sums(df)).first()
    return f"{row['n']}-{row['a'] or 0}-{row['b'] or 0}"


def _sums(df: DataFrame) -> list[Column]:
    columns = []
    for field in df.schema:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, MapType):
            entries = F.array_sort(F.map_entries(col))
            col = F.to_json(F.struct(entries), {"ignoreNullFields": "false"})
        elif isinstance(field.dataType, (ArrayType, StructType)):
            # A hash passes over a NULL inside.
            col = F.to_json(F.struct(col), {"ignoreNullFields": "false"})
        columns += [F.col(f"`{field.name}`").isNull(), col]
    sums = [
        F.sum(F.xxhash64(F.lit(seed), *columns).cast("decimal(20,0)")).alias(name)
        for seed, name in ((1, "a"), (2, "b"))
    ]
    return [F.count(F.lit(1)).alias("n"), *sums]


def _same_contents(spark: SparkSession, path: str, previous: Row, newest: Row) -> bool:
    if previous["schema"] != newest["schema"]:
        return False
    old, new = (set(_folders(spark, path, c)) for c in (previous, newest))
    old, new = _single(spark, path, old - new), _single(spark, path, new - old)
    schema = _schema_of(newest)
    sides = [_files(spark, path, sorted(f), schema) for f in (old - new, new - old)]
    return checksum(sides[0]) == checksum(sides[1])


# ---------------------------------------------------------------- writing


def replace(
    df: DataFrame,
    path: str,
    operation: str = "replace",
    allow_schema_change: bool = False,
    split: Split | None = None,
) -> int:
    """Make ``df`` the table's content; returns its rows.

    ``df`` may read this very table: the older files stay. With a ``split`` there is a
    folder for each part.
    """
    spark = df.sparkSession
    current = _newest(spark, path)
    if current is not None and not allow_schema_change:
        df = _conform(df, current, path)
    version = _next_version(spark, path, current)
    folder = f"{_own_folder(version)}/rows"
    n_rows = _write(df, f"{path}/{folder}", split)["n_rows"]
    folders = _written(spark, path, folder, split)
    _commit(spark, path, version, operation, n_rows, version, folders, df.schema)
    return n_rows


def replace_parts(
    df: DataFrame, path: str, split: Split, parts: Sequence[str], operation: str = "replace"
) -> int:
    """Make ``df`` the content of some parts, given by their first days; returns its rows.

    The table must be split so. Its other parts are taken over as they are, and no file
    of theirs is opened. A row of ``df`` outside of the parts is an error, and the table
    is then as before.
    """
    spark = df.sparkSession
    current = _commit_row(spark, path, None)
    df = _conform(df, current, path)
    entries = _folders(spark, path, current)
    if not all(_part(f).startswith(split.part("")) for f in entries):
        raise ValueError(f"{path} is not split by {split.name}")
    version = _next_version(spark, path, current)
    own = _own_folder(version)
    n_written = _write(df, f"{path}/{own}/rows", split)["n_rows"]
    folders = _written(spark, path, f"{own}/rows", split)
    wanted = {split.part(p) for p in parts}
    strange = {_part(f) for f in folders} - wanted
    if strange:
        _discard(spark, f"{path}/{own}")
        raise ValueError(f"rows outside of the parts to replace: {sorted(strange)}")
    gone = [f for f in entries if _part(f) in wanted]
    n_gone = _files(spark, path, gone, df.schema).count()
    n_rows = current["n_rows"] - n_gone + n_written
    folders += [f for f in entries if _part(f) not in wanted]
    _commit(spark, path, version, operation, n_rows, version, folders, df.schema)
    return n_written


def append(df: DataFrame, path: str, operation: str = "append") -> int:
    """Add rows; returns how many. An empty ``df`` makes no version and no files.

    The rows are counted by the write itself, so an empty input needs no scan
    of its own. Every MOST_APPENDS-th append also takes the older rows into its
    folder, so that a read lists few of them.
    """
    spark = df.sparkSession
    current = _newest(spark, path)
    if current is not None:
        df = _conform(df, current, path)
    version, base, before = _after(spark, path, current)
    older = None
    if version - base >= MOST_APPENDS:
        older, base = _scan(spark, path, current), version
    folder = f"{_own_folder(version)}/rows"
    added = _write(df, f"{path}/{folder}", beside=older)["n_rows"]
    if added > 0:
        _commit(spark, path, version, operation, before + added, base, [folder], df.schema)
    else:
        _discard(spark, f"{path}/{folder.split('/')[0]}")
    return added


def append_new(
    df: DataFrame, path: str, ignore: Sequence[str] = (), operation: str = "append"
) -> int:
    """Add the rows that the table does not hold yet, each once; returns how many.

    Rows are equal if all columns but those to ``ignore`` (load stamps) are, NULL being
    equal to NULL. Both sides meet by a 256-bit digest of those columns, so one column of
    64 characters is shuffled for a stored row, not the row, or nothing where the new
    rows' digests are small enough to be broadcast.
    """
    spark = df.sparkSession
    named = [c for c in df.columns if c not in ignore]
    fresh = df.withColumn("_digest", _digest(named)).dropDuplicates(["_digest"])
    if exists(spark, path):
        stored = read(spark, path)
        held = stored.select(_digest(named).alias("_digest"))
        # The new rows' digests on the small side: only those stored that occur there.
        wanted = df.select(_digest(named).alias("_digest"))
        held = held.join(wanted, "_digest", "left_semi")
        fresh = fresh.join(held, "_digest", "left_anti")
    return append(fresh.select(*df.columns), path, operation)


def _digest(names: Sequence[str]) -> Column:
    whole = F.struct(*[F.col(f"`{c}`") for c in names])
    return F.sha2(F.to_json(whole, {"ignoreNullFields": "false"}), 256)


@contextmanager
def appending(
    df: DataFrame, path: str, where: Column, operation: str = "append"
) -> Iterator[tuple[int, DataFrame]]:
    """Append the rows where a condition holds, and hand on the others, in one pass.

    ``with appending(...) as (n_added, others):``. ``df`` is computed once and written
    once, split by the condition (NULL counts as false): one folder becomes the append,
    the other is read as ``others`` and is gone after the block. Without rows to add
    there is no version, as with :func:`append`.
    """
    spark = df.sparkSession
    current = _newest(spark, path)
    if current is not None:
        df = _conform(df, current, path)
    version, base, before = _after(spark, path, current)
    own = _own_folder(version)
    chosen = F.coalesce(where, F.lit(False))
    seen = Observation()
    flagged = df.withColumn("_added", chosen)
    observed = flagged.observe(seen, F.count_if("_added").alias("n_added"))
    with _exact_timestamps(spark):
        observed.write.partitionBy("_added").parquet(f"{path}/{own}/split")
    n_added = seen.get["n_added"]
    sides = _written(spark, path, f"{own}/split", Split("", "week"))  # any split lists folders
    added = [f for f in sides if f.endswith("=true")]
    others = [f for f in sides if f.endswith("=false")]
    try:
        if n_added:
            folders = added
            if version - base >= MOST_APPENDS:
                compact = f"{own}/rows"
                both = _files(spark, path, added, df.schema)
                _write(both, f"{path}/{compact}", beside=_scan(spark, path, current))
                folders, base = [compact], version
            _commit(spark, path, version, operation, before + n_added, base, folders, df.schema)
        yield n_added, _files(spark, path, others, df.schema)
    finally:
        for folder in others if n_added else [own]:
            _discard(spark, f"{path}/{folder}")


def upsert(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    period: str | None = None,
    unique_source: bool = False,
) -> int:
    """Create the table, or replace rows by key and add the others; returns source rows.

    The source must hold one row per key, NULL keys aside; else this stops with an
    error and the table is as before. The check groups the written keys;
    ``unique_source`` leaves it out for a source that was deduplicated just before.

    The source is computed and written once, and those files are part of the new
    version. Then the target's key columns are compared with the written keys, whose size
    Spark knows exactly and whose least and greatest first key come from the write, to
    find the files that hold rows to be replaced. Only those files are rewritten, without
    the replaced rows; the new version takes over all others. Where every row is
    replaced, as when the whole history is loaded again, no other column is read.

    With a ``period`` ("week", "month", "quarter" or "year") the files are split
    by that period of the first key, a timestamp or date, in UTC. Equal keys
    share a period, so only the keys of periods found in the source are compared.
    This costs one shuffle of the written rows.
    """
    split = None if period is None else Split(keys[0], period)
    spark = source.sparkSession
    current = _newest(spark, path)
    if current is not None:
        source = _conform(source, current, path)
    version = _next_version(spark, path, current)

    own = _own_folder(version)
    incoming = f"{own}/incoming"
    seen = _write(source, f"{path}/{incoming}", split, keys=keys)
    n_rows = n_incoming = seen["n_rows"]
    folders = _written(spark, path, incoming, split)
    stored = _files(spark, path, folders, source.schema)
    if not unique_source and not repeated(stored, keys).isEmpty():
        raise ValueError(f"the source has several rows of one key ({', '.join(keys)})")

    if current is not None:
        if not n_incoming:
            folders = []
        entries = _folders(spark, path, current)
        if split is not None:
            # Only a folder split in the same way holds none of the other keys.
            found, same = {_part(f) for f in folders}, split.part("")
            aside = [f for f in entries if _part(f).startswith(same) and _part(f) not in found]
            entries = [f for f in entries if f not in set(aside)]
            folders += aside
        hits: dict[str, int] = {}
        bounds = None
        if entries and seen["n_keys"]:
            bounds = _bounds(source, keys[0], seen)
            target = _files(spark, path, entries, source.schema)
            # A row per file of the table.
            hits = dict(matches_by_file(target, stored, keys, bounds).collect())
        untouched, touched = _apart(spark, path, entries, hits)
        folders += untouched
        n_rows += current["n_rows"] - sum(hits.values())
        if touched and (untouched or n_rows > n_incoming):
            kept = f"{own}/kept"
            remaining = unmatched(
                _files(spark, path, touched, source.schema), stored, keys, bounds
            )
            n_kept = _write(remaining, f"{path}/{kept}", split)["n_rows"]
            folders += _written(spark, path, kept, split) if n_kept else []

    operation = "create" if current is None else "upsert"
    _commit(spark, path, version, operation, n_rows, version, folders, source.schema)
    return n_incoming


def cluster_by(
    spark: SparkSession,
    path: str,
    col: str | Sequence[str],
    files: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
    rows_per_sort: int = ROWS_PER_SORT,
) -> int:
    """Rewrite the newest version in files of disjoint ranges of ``col``.

    A filter on ``col`` then skips files and row groups by their min/max. The
    row's place in the stored files is a second range key, so one value holding
    much of the table fills several files instead of one task.

    A file is written by one task. Where a given number of ``files`` leaves it more than
    ``rows_per_sort`` rows, it is cut into ranges of so many, each sorted by a task of its
    own and stored; the file is then written from its ranges in their order, unsorted.

    Several columns are laid out together: each value's rank among the column's quantiles
    is taken bit by bit, the columns in turn, and files are ranges of the number made of
    these bits. A filter on any one of the columns then skips most files. Finding the
    quantiles is one pass more over these columns.
    """
    current = _commit_row(spark, path, None)
    whole = files is None
    if whole:
        files = max(1, math.ceil(current["n_rows"] / rows_per_file))
    rows = _scan(spark, path, current)
    names = [col] if isinstance(col, str) else list(col)
    order = F.col(f"`{names[0]}`") if len(names) == 1 else interleaved(rows, names)
    placed = rows.withColumns({"_order": order, "_place": F.monotonically_increasing_id()})
    if whole or current["n_rows"] <= files * rows_per_sort:
        laid_out = (
            placed.repartitionByRange(files, "_order", "_place")
            .sortWithinPartitions("_order")
            .drop("_order", "_place")
        )
        return replace(laid_out, path, "cluster")
    ranges = f"{path}/{_own_folder(current['version'] + 1)}/ranges"
    per_file = math.ceil(current["n_rows"] / (files * rows_per_sort))
    try:
        laid_out = _from_ranges(placed, rows.schema, ranges, files, per_file)
        with _setting(spark, UNIONS, "false"):  # else a union of single tasks is one task
            return replace(laid_out, path, "cluster")
    finally:
        _discard(spark, ranges.removesuffix("/ranges"))


def _from_ranges(
    placed: DataFrame, schema: StructType, folder: str, files: int, per_file: int
) -> DataFrame:
    """The rows stored in sorted ranges, and for each of the files a partition that reads
    its ``per_file`` ranges, one after the other."""
    spark = placed.sparkSession
    in_ranges = (
        placed.repartitionByRange(files * per_file, "_order", "_place")
        .withColumn("_range", F.spark_partition_id())
        .sortWithinPartitions("_range", "_order")
        .drop("_order", "_place")
    )
    with _exact_timestamps(spark):
        in_ranges.write.partitionBy("_range").parquet(folder)
    stored = sorted(
        int(name.removeprefix("_range="))
        for name, is_folder in _listed(spark, folder)
        if is_folder and name.startswith("_range=")
    )
    of_file: dict[int, list[DataFrame]] = {}
    for number in stored:
        one = spark.read.schema(schema).parquet(f"{folder}/_range={number}")
        of_file.setdefault(number // per_file, []).append(one)
    return _union([_union(parts).coalesce(1) for parts in of_file.values()])


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    """The frames one after the other, by halves, so that no plan is deep."""
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return _union(frames[:half]).unionAll(_union(frames[half:]))


def interleaved(df: DataFrame, cols: Sequence[str], bits: int = BITS) -> Column:
    """The ranks of the columns' values, their bits interleaved, the highest first.

    A rank is the number of the column's quantiles that a value reaches; NULL and NaN
    come last. Numbers, dates, timestamps, and the first bytes of texts have ranks.
    """
    bits = min(bits, 62 // len(cols))
    values = [_as_number(df, c) for c in cols]
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(
        *[
            F.percentile_approx(F.when(~F.isnan(v), v), shares, 10_000).alias(f"q{i}")
            for i, v in enumerate(values)
        ]
    ).first()
    order = F.lit(0).cast("long")
    for i, value in enumerate(values):
        bounds = sorted(set(found[i] or ()))
        # Half the distance at each step, as many steps as the rank has bits.
        rank = F.when(value.isNull() | F.isnan(value), F.lit(2**bits - 1)).otherwise(
            _rank(value, bounds, 0, len(bounds))
        )
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(1).cast("long")
            order = order + F.shiftleft(one, bit * len(cols) + len(cols) - 1 - i)
    return order


def _rank(value: Column, bounds: Sequence[float], low: int, high: int) -> Column:
    """How many of the sorted bounds[low:high] a value reaches, and ``low`` more."""
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    above = _rank(value, bounds, middle + 1, high)
    return F.when(value >= F.lit(bounds[middle]), above).otherwise(
        _rank(value, bounds, low, middle)
    )


def _as_number(df: DataFrame, name: str) -> Column:
    col, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (NumericType, BooleanType)):
        return col.cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(col).cast("double")
    if isinstance(kind, TimestampType):
        return F.unix_micros(col).cast("double")
    if isinstance(kind, TimestampNTZType):
        seconds = F.hour(col) * 3600 + F.minute(col) * 60 + F.second(col)
        return F.unix_date(col.cast("date")).cast("double") * 86400 + seconds
    if isinstance(kind, StringType):
        first = F.rpad(F.substring(F.hex(F.encode(col, "UTF-8")), 1, 12), 12, "0")
        return F.conv(first, 16, 10).cast("double")
    raise ValueError(f"no layout by {name} of type {kind.simpleString()}")


# ---------------------------------------------------------------- commits


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/commits")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.schema(COMMITS).parquet(f"{path}/commits")


def _newest(spark: SparkSession, path: str) -> Row | None:
    commits = _commits(spark, path)
    return None if commits is None else _only(commits.orderBy(F.desc("version")), path)


def _only(commits: DataFrame, path: str) -> Row | None:
    """The first of the sorted commits; no other may have its version."""
    first = commits.limit(2).collect()
    if len({row["version"] for row in first}) < len(first):
        raise RuntimeError(f"{path} was written by two at once: version {first[0]['version']}")
    return first[0] if first else None


def _commit_row(spark: SparkSession, path: str, version: int | None) -> Row:
    if version is None:
        row = _newest(spark, path)
    else:
        commits = _commits(spark, path)
        row = (
            None if commits is None else _only(commits.filter(F.col("version") == version), path)
        )
    if row is None:
        wanted = "table" if version is None else f"version {version}"
        raise LookupError(f"no {wanted} at {path}")
    return row


def _after(spark: SparkSession, path: str, current: Row | None) -> tuple[int, int, int]:
    """Version, base and rows so far of an append to ``current``."""
    version = _next_version(spark, path, current)
    return (version, version, 0) if current is None else (version, current["base"], current["n_rows"])


def _next_version(spark: SparkSession, path: str, current: Row | None) -> int:
    """The version to write: the next that no other writer has claimed.

    A claim without a commit is that of a writer about to commit, which is an error, or
    of one that died; after a time the number is passed over.
    """
    version = 0 if current is None else current["version"] + 1
    while True:
        claim = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/claims/{version}")
        files = claim.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(claim):
            return version
        made = files.getFileStatus(claim).getModificationTime() / 1000
        if time.time() - made < CLAIM_SECONDS:
            raise RuntimeError(f"{path}: version {version} is written by another")
        version += 1


@contextmanager
def _claimed(spark: SparkSession, path: str, version: int) -> Iterator[None]:
    """Creating the file fails for the second of two writers. A commit that fails gives
    its version back."""
    claim = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/claims/{version}")
    files = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        files.create(claim, False).close()
    except Py4JJavaError as error:
        if not files.exists(claim):
            raise
        raise RuntimeError(f"{path}: version {version} is written by another") from error
    try:
        yield
    except BaseException:
        files.delete(claim, False)
        raise


def _commit(
    spark: SparkSession,
    path: str,
    version: int,
    operation: str,
    n_rows: int,
    base: int,
    folders: Sequence[str],
    schema: StructType,
) -> None:
    row = (
        path.rstrip("/").rsplit("/", 1)[-1],
        version,
        datetime.now(timezone.utc),
        operation,
        n_rows,
        base,
        list(folders),
        schema.json(),
    )
    with _claimed(spark, path, version):
        one_row(spark, COMMITS, row).write.mode("append").parquet(f"{path}/commits")


def _schema_of(commit: Row) -> StructType:
    return StructType.fromJson(json.loads(commit["schema"]))


def _scan(spark: SparkSession, path: str, commit: Row) -> DataFrame:
    return _files(spark, path, _folders(spark, path, commit), _schema_of(commit))


def _folders(spark: SparkSession, path: str, commit: Row) -> list[str]:
    """Entries of a version: those of its base and of the appends up to it."""
    if commit["base"] == commit["version"]:
        return list(commit["folders"])
    parts = _commits(spark, path).filter(
        F.col("version").between(commit["base"], commit["version"])
    )
    rows = parts.select("version", "folders").collect()  # MOST_APPENDS rows or so
    if len({r["version"] for r in rows}) < len(rows):
        raise RuntimeError(f"{path} was written by two at once")
    return [folder for r in rows for folder in r["folders"]]


def _files(
    spark: SparkSession, path: str, folders: Sequence[str], schema: StructType
) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in sorted(folders)])


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """Names in a folder, and whether each is a folder; hidden ones left out."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(root)
    names = [(status.getPath().getName(), status.isDirectory()) for status in found]
    return [(name, is_folder) for name, is_folder in names if name[0] != "." and name != "_SUCCESS"]


def _single(spark: SparkSession, path: str, entries: set[str]) -> set[str]:
    """The files of entries, each by itself."""
    out = set()
    for entry in entries:
        if entry.endswith(".parquet"):
            out.add(entry)
        else:
            out |= {f"{entry}/{name}" for name, _ in _listed(spark, f"{path}/{entry}")}
    return out


def _apart(
    spark: SparkSession, path: str, entries: Sequence[str], hits: Mapping[str, int]
) -> tuple[list[str], list[str]]:
    """Entries without the files that were hit, and these files. A folder of which only
    some files were hit is taken apart; the hits are paths as Spark reports them."""
    names = {}
    for reported in hits:
        # From the writer's own folder on, as entries begin.
        inside = re.search(r".*/(v=\d+-[0-9a-f]{12}/.*)$", reported)
        names[unquote(inside[1]) if inside else reported] = reported
    folders = {name.rsplit("/", 1)[0] for name in names}
    untouched, touched = [], []
    for entry in entries:
        if entry in names:
            touched.append(entry)
        elif entry in folders:
            for file in sorted(_single(spark, path, {entry})):
                (touched if file in names else untouched).append(file)
        else:
            untouched.append(entry)
    if len(touched) < len(names):  # a path that is not among ours: rewrite all
        return [], list(entries)
    return untouched, touched


def _own_folder(version: int) -> str:
    """A folder that no other write has."""
    return f"v={version}-{uuid.uuid4().hex[:12]}"


def _discard(spark: SparkSession, folder: str) -> None:
    """Remove a folder just written that no commit will name."""
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _write(
    df: DataFrame,
    folder: str,
    split: Split | None = None,
    keys: Sequence[str] = (),
    beside: DataFrame | None = None,
) -> Row:
    """Write and count in one pass: n_rows, and of ``keys`` n_keys, low and high.

    The figures sit in the writing stage, where Spark counts a task once however
    often it runs. With a ``split`` that gathers, rows are first brought together by
    part, with large parts spread over several tasks and small ones combined by AQE. The
    range is that of the first key, as micros of a timestamp and else as text, over
    the rows that have all keys. Rows ``beside`` are written but not counted.
    """
    figures = [F.count(F.lit(1)).alias("n_rows")]
    if keys:
        value = F.when(has_key(keys), F.col(keys[0]))
        zoned = isinstance(df.schema[keys[0]].dataType, TimestampType)
        figures.append(F.count(value).alias("n_keys"))
        for name, least in (("low", F.min(value)), ("high", F.max(value))):
            figures.append((F.unix_micros(least) if zoned else least.cast("string")).alias(name))
    if split is not None:
        df = df.withColumn(split.name, _period_start(df, split))
        if split.gather:
            df = df.hint("rebalance", F.col(f"`{split.name}`"))
    seen = Observation()
    rows = df.observe(seen, *figures)
    if beside is not None:
        rows = rows.unionByName(beside)
    writer = rows.write if split is None else rows.write.partitionBy(split.name)
    with _exact_timestamps(df.sparkSession):
        writer.parquet(folder)
    return Row(**seen.get)


@contextmanager
def _exact_timestamps(spark: SparkSession) -> Iterator[None]:
    """The default format has no min and max in the files, so no filter could skip any."""
    with _setting(spark, TIMESTAMPS, "TIMESTAMP_MICROS"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _bounds(df: DataFrame, col: str, seen: Row) -> tuple[Column, Column] | None:
    """The written range as literals; none for types whose text is not the value."""
    kind = df.schema[col].dataType
    if isinstance(kind, TimestampType):
        return F.timestamp_micros(F.lit(seen["low"])), F.timestamp_micros(F.lit(seen["high"]))
    if isinstance(kind, (NumericType, StringType, DateType, TimestampNTZType)):
        return F.lit(seen["low"]).cast(kind), F.lit(seen["high"]).cast(kind)
    return None


def _period_start(df: DataFrame, split: Split) -> Column:
    """First day of the period; in UTC whatever the session's zone, unless local.

    Two loads in different zones must agree on the folder of a key.
    """
    col = F.col(f"`{split.col}`")
    day = col.cast("date")
    if not split.local and isinstance(df.schema[split.col].dataType, TimestampType):
        day = F.date_from_unix_date(F.floor(F.unix_micros(col) / MICROS_PER_DAY).cast("int"))
    return F.trunc(day, split.period)


def _written(
    spark: SparkSession, path: str, folder: str, split: Split | None
) -> list[str]:
    """The folder just written, or its folders per part (no more than the calendar has)."""
    if split is None:
        return [folder]
    listed = _listed(spark, f"{path}/{folder}")
    return [f"{folder}/{name}" for name, is_folder in listed if is_folder and "=" in name]


def _part(entry: str) -> str:
    """The part that a folder or file holds; none has no name."""
    _, *inner = entry.split("/")
    return next((name for name in inner if "=" in name), "")


def _conform(df: DataFrame, current: Row, path: str) -> DataFrame:
    """The table's columns in its order; other columns or types are refused.

    Whether a value may be NULL is not compared: in files every value may.
    """
    table = StructType.fromJson(json.loads(current["schema"]))
    wanted = {f.name: f.dataType.simpleString() for f in table}
    given = {f.name: f.dataType.simpleString() for f in df.schema}
    if wanted != given:
        raise ValueError(f"columns of {path} are {wanted}, got {given}")
    return df.select(*table.names)

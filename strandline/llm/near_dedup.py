"""Near-duplicate documents: banded MinHash candidates, odd sketches, exact links."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import tokens
from strandline.llm.components import components
from strandline.llm.keep import keep

U64 = np.uint64
SAMPLES = 128
ROWS = 4  # samples per band
BANDS = SAMPLES // ROWS
SKETCH_BITS = 512
_FACTORS = (tokens.mix(np.arange(SAMPLES, dtype=U64) + U64(77)) | U64(1)).astype(np.uint32)
_SHIFTS = tokens.mix(np.arange(SAMPLES, dtype=U64) + U64(7777)).astype(np.uint32)
PIECE = 4096
BLOCK = 1024  # members compared with one another at once
DENSE = 4  # candidate pairs per member from which a unit is not written out as pairs
BROADCAST_IDS = 1_000_000


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of SAMPLES hash functions over a set."""
    low = shingles.astype(np.uint32)
    least = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(low), PIECE):
        values = low[at : at + PIECE, None] * _FACTORS + _SHIFTS
        np.minimum(least, values.min(axis=0), out=least)
    return least


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """A bitmap per row of samples: each (function, sample) flips the bit it hashes to,
    so that equal samples cancel in the XOR of two bitmaps."""
    which = np.arange(SAMPLES, dtype=U64) << U64(32)
    bits = tokens.mix(samples.astype(U64) + which) & U64(SKETCH_BITS - 1)
    at = bits.astype(np.int64) + np.arange(len(samples))[:, None] * SKETCH_BITS
    flips = np.bincount(at.ravel(), minlength=len(samples) * SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(len(samples), -1), axis=1)


def signatures(
    docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: id, n (distinct shingles), key (a 128-bit hash of their set),
    samples and sketch. With fewer words than ``words`` all of them are one shingle;
    without any, n is 0 and key null."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch, 1):
                sets = shingle_sets(block.column(1), words)
                samples = np.stack([minhash(s) for s in sets])
                keys = [
                    (tokens.mix(s).sum().tobytes() + tokens.mix(~s).sum().tobytes())
                    if len(s)
                    else None
                    for s in sets
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(keys, pa.binary()),
                        pa.array([s.tobytes() for s in samples], pa.binary()),
                        pa.array([s.tobytes() for s in odd_sketches(samples)], pa.binary()),
                    ],
                    names=["id", "n", "key", "samples", "sketch"],
                )

    return docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    ).mapInArrow(task, "id long, n long, key binary, samples binary, sketch binary")


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    hashes, rows = tokens.words(column)
    bounds = tokens.row_bounds(rows, len(column))
    shingled, of = tokens.shingles(hashes, rows, words)
    edges = tokens.row_bounds(of, len(column))
    sets = []
    for i in range(len(column)):
        if bounds[i + 1] - bounds[i] >= words or bounds[i + 1] == bounds[i]:
            sets.append(np.unique(shingled[edges[i] : edges[i + 1]]))
        else:
            own = hashes[bounds[i] : bounds[i + 1]]
            whole, _ = tokens.shingles(own, np.zeros(len(own), np.int32), len(own))
            sets.append(whole + U64(len(own)))  # apart from shingles of full length
    return sets


# ------------------------------------------------------------------ candidates


def similarity_estimate(differing: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the number of differing bits of two odd sketches."""
    share = np.minimum(2 * differing / SKETCH_BITS, 1 - 1e-9)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log1p(-share)


def most_differing(similarity: float, margin: float) -> int:
    """The most bits by which sketches differ whose estimate is ``similarity`` less
    ``margin`` or more."""
    counts = np.arange(SKETCH_BITS + 1)
    return int(counts[similarity_estimate(counts) >= similarity - margin].max())


def alike(
    one: np.ndarray, two: np.ndarray, n_one: np.ndarray, n_two: np.ndarray, limits: Limits
) -> tuple[np.ndarray, np.ndarray]:
    """Whether two rows can be linked by size and sketch, and their differing bits."""
    differing = np.bitwise_count(one ^ two).sum(axis=1)
    fits = np.minimum(n_one, n_two) * 100 >= limits.percent * np.maximum(n_one, n_two)
    return fits & (differing <= limits.most_differing), differing


@dataclass(frozen=True)
class Limits:
    """The least similarity in percent, and the most differing sketch bits."""

    percent: int
    most_differing: int


def bucket_members(classes: DataFrame) -> DataFrame:
    """(bucket, rep, leader, size) of every bucket with two classes or more. A bucket
    is a band's number and samples; its leader is its least member."""
    bands = classes.select(
        "rep",
        F.explode(
            F.expr(
                f"transform(sequence(0, {BANDS - 1}), b -> "
                f"xxhash64(b, substring(samples, {4 * ROWS} * b + 1, {4 * ROWS})))"
            )
        ).alias("bucket"),
    )
    shared_by_many = (
        bands.groupBy("bucket")
        .agg(F.min("rep").alias("leader"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
    )
    return bands.join(shared_by_many, "bucket")


def sketched(pairs: DataFrame, classes: DataFrame, limits: Limits) -> DataFrame:
    """Those pairs (a, b) whose sketches and sizes allow a link."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (bits(batch.column(c)) for c in ("sketch_a", "sketch_b"))
            sizes = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            fits, _ = alike(one, two, *sizes, limits)
            yield batch.select(["a", "b"]).filter(pa.array(fits))

    side = classes.select("rep", "n", "sketch")
    both = pairs
    for c in ("a", "b"):
        both = both.join(
            side.select(
                F.col("rep").alias(c),
                F.col("n").alias(f"n_{c}"),
                F.col("sketch").alias(f"sketch_{c}"),
            ),
            c,
        )
    return both.mapInArrow(task, "a long, b long")


def bits(column: pa.Array) -> np.ndarray:
    """Sketches as rows of 64-bit numbers."""
    whole = b"".join(column.to_pylist())
    return np.frombuffer(whole, U64).reshape(len(column), SKETCH_BITS // 64)


def units(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """The members of each bucket, with component, size and sketch, in units to be
    compared, those of different components only.

    Buckets of one component are left out. A larger bucket is compared in blocks of about
    BLOCK members, each component's in blocks of its own where it has that many; each pair
    of blocks with two components or more is a unit, with the block as ``side`` (0: both
    are one). So no bucket is one task, and a large component joined already costs only
    its meetings with the others.
    """
    named = members.select("bucket", "rep").join(
        labels.select(F.col("node").alias("rep"), "component"), "rep", "left"
    )
    named = named.select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    sizes = named.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("own_size"))
    mixed = (
        sizes.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("components"), F.sum("own_size").alias("size"))
        .filter("components > 1")
        .select("bucket", F.expr(f"ceil(size / {BLOCK})").alias("blocks"))
    )
    rows = named.join(mixed, "bucket").join(classes.select("rep", "n", "sketch"), "rep")
    known = ["rep", "component", "n", "sketch"]
    one = rows.filter("blocks = 1").select(
        F.xxhash64("bucket").alias("unit"), F.lit(0).alias("side"), *known
    )
    # A component's members are dealt over as many blocks as they fill.
    chunk = f"pmod(xxhash64(rep, bucket), ceil(own_size / {BLOCK}))"
    more = (
        rows.filter("blocks > 1")
        .join(sizes, ["bucket", "component"])
        .withColumn("own", F.expr(f"pmod(xxhash64(component, {chunk}, bucket), blocks)"))
    )
    blocks = more.groupBy("bucket", "own").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    )
    facing = blocks.select(
        "bucket", F.col("own").alias("other"), F.col("low").alias("low_2"),
        F.col("high").alias("high_2"),
    )
    met = (
        blocks.join(facing, "bucket")
        .filter("least(low, low_2) < greatest(high, high_2)")
        .groupBy("bucket", "own")
        .agg(F.collect_list("other").alias("others"))  # a bucket's size / BLOCK at most
    )
    many = more.join(met, ["bucket", "own"]).withColumn("other", F.explode("others")).select(
        F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("unit"),
        F.when(F.col("own") == F.col("other"), 0)
        .when(F.col("own") < F.col("other"), 1)
        .otherwise(2)
        .alias("side"),
        *known,
    )
    return one.unionByName(many)


def whole_units(
    batches: Iterator[pa.RecordBatch],
    work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
) -> Iterator[pa.RecordBatch]:
    """``work`` on batches that end where a unit ends; rows come sorted by unit."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if held is not None:
            batch = pa.concat_batches([held, batch])
        unit = batch.column("unit").to_numpy()
        last = int(np.searchsorted(unit, unit[-1]))  # the last unit may go on
        held = batch.slice(last)
        if last:
            yield from work(batch.slice(0, last))
    if held is not None:
        yield from work(held)


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit")


def closest(rows: DataFrame, limits: Limits) -> DataFrame:
    """Pairs (a, b): for each member of a unit its closest one in another component, if
    sketch and size allow a link."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rep = batch.column("rep").to_numpy()
        best = np.full(len(rep), SKETCH_BITS + 1)
        partner = np.full(len(rep), -1)
        for one, two, differing in candidates(batch, limits):
            for x, y in ((one, two), (two, one)):
                closer = differing < best[x]
                best[x[closer]], partner[x[closer]] = differing[closer], y[closer]
        has = np.flatnonzero(partner >= 0)
        if len(has):
            yield pair_rows(rep[has], rep[partner[has]])

    task = partial(whole_units, work=work)
    return dealt(rows).mapInArrow(task, "a long, b long").distinct()


def remaining(rows: DataFrame, limits: Limits) -> DataFrame:
    """All pairs of a unit that are in different components and that sketch and size
    allow to be linked, as rows (a, b). Where a unit has more than DENSE of them per
    member they are not written out: its members come as rows instead, with unit, side
    and component, to be compared on their sets at one place."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        unit, side, rep, component = (batch.column(i).to_numpy() for i in range(4))
        number = np.cumsum(np.diff(unit, prepend=unit[0]) != 0)
        found = [(one, two) for one, two, _ in candidates(batch, limits)]
        if not found:
            return
        one, two = (np.concatenate(x) for x in zip(*found, strict=True))
        pairs = np.bincount(number[one], minlength=number[-1] + 1)
        dense = pairs > DENSE * np.bincount(number)
        written = ~dense[number[one]]
        a, b = rep[one[written]], rep[two[written]]
        some = np.unique(np.concatenate([one[~written], two[~written]]))
        none = np.zeros(len(a), np.int64)
        yield pa.RecordBatch.from_pydict(
            {
                "a": np.concatenate([np.minimum(a, b), rep[some]]),
                "b": np.concatenate([np.maximum(a, b), component[some]]),
                "unit": np.concatenate([none, unit[some]]),
                "side": np.concatenate([none - 1, side[some].astype(np.int64)]),
            }
        )

    task = partial(whole_units, work=work)
    return dealt(rows).mapInArrow(task, "a long, b long, unit long, side long")


def candidates(
    batch: pa.RecordBatch, limits: Limits
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of two rows of one unit but different components that may be linked, and
    the differing bits of their sketches."""
    unit, side, _, component, n = (batch.column(i).to_numpy() for i in range(5))
    sketch = bits(batch.column(5))
    ends = np.searchsorted(unit, unit, side="right")
    at = np.arange(len(unit))
    step = 0
    while True:
        step += 1
        at = at[at + step < ends[at]]
        if not len(at):
            return
        two = at + step
        some = (component[at] != component[two]) & ((side[at] == 0) | (side[at] != side[two]))
        one, two = at[some], two[some]
        fits, differing = alike(sketch[one], sketch[two], n[one], n[two], limits)
        if fits.any():
            yield one[fits], two[fits], differing[fits]


def pair_rows(one: np.ndarray, two: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": np.minimum(one, two), "b": np.maximum(one, two)})


# ------------------------------------------------------------------ exact links


def shingles_of(
    docs: DataFrame, ids: DataFrame, words: int, id_col: str, text_col: str
) -> DataFrame:
    """(rep, n, shingles) of the documents whose id is in ``ids``. They are broadcast
    where they are at most BROADCAST_IDS, by count; else the texts are joined."""
    few = ids.count() <= BROADCAST_IDS
    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    wanted = texts.join(F.broadcast(ids) if few else ids, "rep", "left_semi")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch, 1):
                sets = shingle_sets(block.column(1), words)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["rep", "shingles"],
                )

    return wanted.mapInArrow(task, "rep long, shingles array<long>")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs whose full sets reach the similarity."""
    first = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("of_a"))
    second = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(first, "a").join(second, "b")
    common = F.size(F.array_intersect("of_a", "of_b"))
    union = F.size("of_a") + F.size("of_b") - common
    return both.filter(100 * common >= percent * union).select("a", "b")


def linked_in_units(crowd: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that join components within a unit, found on the full sets of its
    members; as many as join them, not all there are."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        unit = batch.column("unit").to_numpy()
        edges = np.flatnonzero(np.diff(unit, prepend=unit[0] - 1, append=unit[-1] + 1))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            found = joining(batch.slice(low, high - low), percent)
            if len(found):
                yield pair_rows(found[:, 0], found[:, 1])

    rows = crowd.join(sets, crowd["a"] == sets["rep"]).select("unit", "side", "a", "b", "shingles")
    task = partial(whole_units, work=work)
    return dealt(rows).mapInArrow(task, "a long, b long")


def joining(batch: pa.RecordBatch, percent: int) -> np.ndarray:
    """Links of one unit, those that join parts not joined before."""
    side, rep, component = (batch.column(i).to_numpy() for i in (1, 2, 3))
    lists = batch.column(4)
    flat = lists.flatten().to_numpy()
    starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    sizes = np.diff(starts)
    _, codes = np.unique(flat, return_inverse=True)
    here = np.zeros(len(flat), bool)
    part = component.copy()
    found = []
    for i in range(len(rep)):
        own = codes[starts[i] : starts[i + 1]]
        here[own] = True
        common = np.add.reduceat(here[codes].astype(np.int64), starts[:-1])
        here[own] = False
        for j in np.flatnonzero(100 * common >= percent * (sizes + sizes[i] - common)):
            if part[j] != part[i] and (side[i] == 0 or side[i] != side[j]):
                found.append((rep[i], rep[j]))
                part[part == part[j]] = part[i]
    return np.array(found, np.int64).reshape(-1, 2)


def link(
    docs: DataFrame,
    percent: int = 75,
    words: int = 5,
    margin: float = 0.19,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept.

    Documents whose sets of distinct ``words``-word shingles (ASCII lower case) have a
    Jaccard similarity of ``percent`` or more are linked; component_id is the least
    id reachable, kept says whether that is the document's own.

    1. Documents with equal sets are one class, named by its least id: copies, however
       many, go no further.
    2. 32 bands of 4 MinHash samples make candidate buckets: a pair at 0.75 shares none
       with probability 5e-6, at 0.8 with 5e-8.
    3. Every class is compared with its least leader, then with the closest member of
       each bucket in another component, then with all that are still in another
       component. Odd sketches drop pairs that estimate below the similarity less
       ``margin`` (4.5 deviations); the rest is confirmed on full sets, and links join
       components. Comparing only across components leaves out no link that matters
       to the result, and a large group is never written out as all its pairs: where
       candidates are many, members meet with their sets, block by block.

    Texts without a word have n_shingles 0 and are linked with nothing. Ids are
    integers; rows that share an id are one document to the links and give as many
    rows. A null id joins the component of documents equal to it; without one its
    component_id is null and it is kept. Other columns are not read.
    """
    limits = Limits(percent, most_differing(percent / 100, margin))
    signed = keep(signatures(docs, words, id_col, text_col), "signatures")
    classes = keep(
        signed.filter("key IS NOT NULL AND id IS NOT NULL")
        .groupBy("key")
        .agg(
            F.min("id").alias("rep"),
            F.first("n").alias("n"),
            F.first("samples").alias("samples"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    members = keep(bucket_members(classes), "members")
    sets = keep(
        shingles_of(docs, members.select("rep").distinct(), words, id_col, text_col), "sets"
    )
    star = (
        members.filter("rep <> leader")
        .groupBy(F.col("rep").alias("b"))
        .agg(F.min("leader").alias("a"))
        .select("a", "b")
    )
    links = keep(linked(sketched(star, classes, limits), sets, percent), "links")
    labels = components(links)
    near = keep(closest(units(members, labels, classes), limits), "pairs")
    links = keep(links.union(linked(near, sets, percent)), "links")
    labels = components(links)
    rest = keep(remaining(units(members, labels, classes), limits), "pairs")
    pairs = rest.filter("side < 0").select("a", "b").distinct()
    crowd = rest.filter("side >= 0")
    links = links.union(linked(pairs, sets, percent)).union(
        linked_in_units(crowd, sets, percent)
    )
    labels = components(keep(links, "links"))

    found = (
        classes.select("key", "rep")
        .join(labels, F.col("rep") == F.col("node"), "left")
        .select("key", F.coalesce("component", "rep").alias("component"))
    )
    return (
        signed.select("id", "n", "key")
        .join(found, "key", "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.coalesce("component", "id").alias("component_id"),
        )
        .withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
    )

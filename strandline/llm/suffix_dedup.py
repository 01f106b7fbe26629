"""Repeated byte strings across documents, by sampled anchors and suffix arrays."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.llm import suffix_array, tokens
from strandline.llm.keep import keep

U64 = np.uint64
GRAM = 20  # bytes of an anchor
GROUP = 1024  # pieces of one gram that are compared in one shard
HOT = 1 << 20  # rows of one gram held at once
HOT_PARTS = 4096
SHARD = 1 << 20  # bytes of a suffix array, or one group more
BROADCAST_IDS = 1_000_000
_BYTES = tokens.mix(np.arange(256, dtype=U64) + U64(0xABCDEF12345))


@dataclass(frozen=True)
class Sizes:
    """The length of a repeat and what follows from it."""

    length: int

    @property
    def reach(self) -> int:
        """How far a window that holds an anchor goes beyond it, on either side."""
        return self.length - GRAM

    @property
    def half(self) -> int:
        """Each such window goes this far beyond it on one side at least."""
        return self.reach // 2


class Sums:
    """Hashes of any substring of a text of moderate size, from running sums."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = tokens.powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return tokens.mix(raw + (end - start).astype(U64))


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the place of its least, the first of equals
    (in the leading bits; places are below 2**20)."""
    if len(values) < width:
        return np.zeros(0, np.int64)
    packed = (values & U64(0xFFFFFFFFFFF00000)) | np.arange(len(values), dtype=U64)
    span = 1
    while span * 2 <= width:
        packed = np.minimum(packed[:-span], packed[span:])
        span *= 2
    rest = width - span
    if rest:
        packed = np.minimum(packed[:-rest], packed[rest:])
    return (packed & U64(0xFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, ...]:
    """The anchors of one text: hash of the gram, hash of the piece, hash of both sides,
    first window, last window.

    Every window of ``length`` bytes has one anchor: the gram of least hash in it, the
    first of equals. Equal windows have the same one in the same place. Windows with one
    anchor follow one another; the bytes they cover are its piece. Two anchors' pieces
    can share a window only if their grams are equal, and the ``half`` bytes on the
    left or on the right of them too; a side on which no window goes so far is 0.
    """
    whole: tuple[list, ...] = [], [], [], [], []
    step = 1 << 19
    n = len(data)
    for at in range(0, max(n - sizes.length + 1, 0), step):
        part = data[at : at + step + sizes.length - 1]
        sums = Sums(part)
        starts = np.arange(len(part) - GRAM + 1)
        grams = sums.of(starts, starts + GRAM)
        place = least_places(grams, sizes.length - GRAM + 1)
        first = np.flatnonzero(np.diff(place, prepend=-1))
        last = np.append(first[1:], len(place)) - 1
        place = place[first]
        piece = sums.of(first, last + sizes.length) + tokens.mix((place - first).astype(U64))
        left = np.maximum(place - sizes.half, 0)
        one = np.where(first <= place - sizes.half, sums.of(left, place), U64(0))
        end = place + GRAM + sizes.half
        inside = last + sizes.length >= end
        two = np.where(inside, sums.of(place + GRAM, np.where(inside, end, place + GRAM)), U64(0))
        sides = (one & U64(0xFFFFFFFF)) << U64(32) | (two & U64(0xFFFFFFFF))
        found = (grams[place], piece, sides, first + at, last + at)
        for parts, values in zip(whole, found, strict=True):
            parts.append(values)
    kinds = (U64, U64, U64, np.int64, np.int64)
    return tuple(
        np.concatenate(parts) if parts else np.zeros(0, kind)
        for parts, kind in zip(whole, kinds, strict=True)
    )


# ------------------------------------------------------------------ rows in flight
#
# All stages send rows of five numbers: gram, piece, sides, doc, windows (the first and
# how many more). Ranges to remove have a gram of 0 and lie in doc, piece and sides.

ROW = "gram long, piece long, sides long, doc long, windows long"
MARK = 0
RUN_BITS = 20  # windows of one anchor: fewer than a window has bytes
MOST_LENGTH = 1 << 19


def packed_windows(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return first << RUN_BITS | last - first


def unpacked_windows(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = windows >> RUN_BITS
    return first, first + (windows & ((1 << RUN_BITS) - 1))


def row_batch(*columns: np.ndarray) -> pa.RecordBatch:
    names = ["gram", "piece", "sides", "doc", "windows"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c.view(np.int64) if c.dtype == U64 else c) for c in columns], names=names
    )


def merged(
    doc: np.ndarray, start: np.ndarray, end: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges per document, those that overlap or touch as one."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], end[order]
    # Ends so far, restarted per document by a step larger than any place.
    number = np.cumsum(np.diff(doc, prepend=doc[0]) != 0)
    lift = number * (int(end.max()) + 1)
    so_far = np.maximum.accumulate(end + lift) - lift
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > so_far[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], so_far[last]


def marks(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    doc, start, end = merged(doc, start, end)
    none = np.full(len(doc), MARK, np.int64)
    return row_batch(none, start, end, doc, none)


def found_rows(docs: DataFrame, sizes: Sizes) -> DataFrame:
    """The anchors of all texts. Of equal pieces in one block of rows only the earliest
    travels on, as a row; the others' bytes are ranges to remove at once. So a text or
    passage that a third of all documents hold travels as one row per block."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch, 1, 8 << 20):
                data, offsets = tokens.utf8(block.column(1))
                ids = block.column(0).to_numpy()
                parts, docs_ = [], []
                for i in range(len(ids)):
                    parts.append(anchors(data[offsets[i] : offsets[i + 1]], sizes))
                    docs_.append(np.full(len(parts[-1][0]), ids[i]))
                gram, piece, sides, first, last = map(np.concatenate, zip(*parts, strict=True))
                gram = gram | U64(1)  # never a mark
                doc = np.concatenate(docs_)
                early, same = firsts(gram, piece, doc, first)
                rest = ~early & ~same
                yield row_batch(
                    gram[early], piece[early], sides[early], doc[early],
                    packed_windows(first[early], last[early]),
                )
                yield marks(doc[rest], first[rest], last[rest] + sizes.length)

    return docs.select("doc", "text").mapInArrow(task, ROW)


def firsts(
    gram: np.ndarray, piece: np.ndarray, doc: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are the earliest of their piece, and which others lie in the very same
    place (a document that is there twice)."""
    order = np.lexsort((first, doc, piece, gram))
    g, p, d, f = gram[order], piece[order], doc[order], first[order]
    new = np.ones(len(order), bool)
    new[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1])
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else np.zeros(0, np.int64)
    early, same = np.zeros(len(order), bool), np.zeros(len(order), bool)
    early[order] = new
    same[order] = ~new & (d == d[head]) & (f == f[head])
    return early, same


def sifted(batch: pa.RecordBatch, sizes: Sizes, ask_all: bool) -> Iterator[pa.RecordBatch]:
    """Whole groups of one gram each: ranges to remove for all but the earliest of equal
    pieces, and as rows those pieces that may share a window with a different one.
    In a row's place of ``piece`` stands a part of its group (see GROUP)."""
    gram, piece, sides, doc, windows = (
        batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)
    )
    first, last = unpacked_windows(windows)
    early, same = firsts(gram, piece, doc, first)
    rest = ~early & ~same
    if rest.any():
        yield marks(doc[rest], first[rest], last[rest] + sizes.length)
    kept = np.flatnonzero(early)
    ask = np.full(len(kept), ask_all)
    for shift in (0, 32):
        side = (sides[kept] >> shift) & 0xFFFFFFFF
        order = np.lexsort((side, gram[kept]))
        g, x = gram[kept][order], side[order]
        equal = (g[1:] == g[:-1]) & (x[1:] == x[:-1]) & (x[1:] != 0)
        both = np.zeros(len(kept), bool)
        both[1:] |= equal
        both[:-1] |= equal
        ask[order] |= both
    kept = kept[ask]
    if not len(kept):
        return
    order = np.lexsort((first[kept], doc[kept], gram[kept]))
    kept = kept[order]
    new = np.flatnonzero(np.diff(gram[kept], prepend=0) != 0)
    size = np.diff(np.append(new, len(kept)))
    rank = np.arange(len(kept)) - np.repeat(new, size)
    parts = np.repeat(-(-size // GROUP) if not ask_all else np.full(len(size), HOT_PARTS), size)
    part = np.where(parts > 1, 1 + (doc[kept] if ask_all else rank) % parts, 0)
    yield row_batch(gram[kept], part, sides[kept], doc[kept], windows[kept])


def sift(rows: DataFrame, sizes: Sizes) -> DataFrame:
    """``sifted`` over all rows, dealt by gram; a group of more than HOT rows goes on
    in slices, all asking, so that a task's memory has a bound."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        hot = None
        for batch in batches:
            gram = batch.column("gram").to_numpy()
            passing = gram == MARK
            if passing.any():
                yield batch.filter(pa.array(passing))
                batch = batch.filter(pa.array(~passing))
                gram = gram[~passing]
            if not batch.num_rows:
                continue
            whole = pa.concat_batches([*held, batch])
            gram = whole.column("gram").to_numpy()
            cut = int(np.searchsorted(gram, gram[-1]))
            if hot is not None:
                end = int(np.searchsorted(gram, hot, side="right"))
                yield from sifted(whole.slice(0, end), sizes, True)
                whole, gram = whole.slice(end), gram[end:]
                cut = max(0, cut - end)
                if len(gram):
                    hot = None
            if cut:
                yield from sifted(whole.slice(0, cut), sizes, False)
            held = [whole.slice(cut)] if whole.num_rows > cut else []
            if held and held[0].num_rows > HOT:
                hot = gram[-1]
                yield from sifted(held[0], sizes, True)
                held = []
        if held:
            yield from sifted(held[0], sizes, False)

    # Ranges are dealt evenly too.
    key = F.when(F.col("gram") == MARK, F.xxhash64("doc", "piece")).otherwise(F.col("gram"))
    return (
        rows.repartition(key.alias("key"))
        .sortWithinPartitions("gram", "piece", "doc", "windows")
        .mapInArrow(task, ROW)
    )


# ------------------------------------------------------------------ shards


def pieces_of(docs: DataFrame, asking: DataFrame, sizes: Sizes) -> DataFrame:
    """(gram, part, doc, first, bytes) of the asking rows. Texts meet their rows by
    document; only documents that ask travel, where their ids are few enough (by
    count) to be broadcast."""
    per = asking.groupBy("doc").agg(
        F.collect_list(F.struct("gram", "piece", "windows")).alias("asked")
    )
    ids = asking.select("doc").distinct()
    texts = docs.select("doc", "text")
    if ids.count() <= BROADCAST_IDS:
        texts = texts.join(F.broadcast(ids), "doc", "left_semi")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch, 1, 4 << 20):
                data, offsets = tokens.utf8(block.column(1))
                asked = block.column(2)
                flat = asked.flatten()
                gram, part, windows = (
                    flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)
                )
                lists = asked.offsets.to_numpy()
                row = np.repeat(np.arange(len(block)), np.diff(lists))
                first, last = unpacked_windows(windows)
                low = first + offsets[row]
                high = last + sizes.length + offsets[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(gram),
                        pa.array(part),
                        block.column(0).take(pa.array(row)),
                        pa.array(first),
                        pa.array([data[a:b].tobytes() for a, b in zip(low, high, strict=True)], pa.binary()),
                    ],
                    names=["gram", "part", "doc", "first", "bytes"],
                )

    return texts.join(per, "doc").mapInArrow(
        task, "gram long, part long, doc long, first long, bytes binary"
    )


def compared(batch: pa.RecordBatch, sizes: Sizes) -> Iterator[pa.RecordBatch]:
    """One shard, of whole groups: ranges to remove for every window that is not the
    earliest of its kind; from divided groups the earliest of each kind go on as rows,
    with the hash of their bytes in the place of ``piece`` and ``sides``."""
    strings = batch.column("bytes").to_pylist()
    gram, part, doc, first = (batch.column(i).to_numpy() for i in range(4))
    length = np.array([len(x) for x in strings])
    # Bytes from 2 up, a 1 behind each piece, and a last 0.
    text = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 2
    ends = np.cumsum(length)
    text = np.append(np.insert(text, ends, 1), 0).astype(np.int16)
    start = np.concatenate(([0], (ends + np.arange(1, len(ends) + 1))[:-1]))
    order = suffix_array.suffix_array(text, 258)
    near = suffix_array.reaching(text, order, sizes.length)
    owner = np.repeat(np.arange(len(strings)), length + 1)
    owner = np.append(owner, len(strings) - 1)
    offset = np.arange(len(text)) - start[owner]
    valid = offset + sizes.length <= length[owner]
    order = order[valid[order]]
    # A run of the suffix array with long common prefixes holds equal windows.
    run = np.cumsum(~near[order]) - 1
    who = owner[order]
    at = first[who] + offset[order]
    by = np.lexsort((at, doc[who], run))
    run, who, at = run[by], who[by], at[by]
    new = np.ones(len(run), bool)
    new[1:] = run[1:] != run[:-1]
    if not len(run):
        return
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = ~new & ((doc[who] != doc[who][head]) | (at != at[head]))
    if later.any():
        yield marks(doc[who][later], at[later], at[later] + sizes.length)
    rest = np.flatnonzero(new & (part[who] > 0))
    if len(rest):
        sums = suffix_array.running_sums(text)
        places = order[by][rest]
        one = suffix_array.between(sums, places, places + sizes.length)
        two = suffix_array.between(sums, places + 1, places + sizes.length - 1)
        yield row_batch(gram[who[rest]], one, two, doc[who[rest]], at[rest] << RUN_BITS)


def compare(pieces: DataFrame, sizes: Sizes) -> DataFrame:
    """``compared`` over shards of about SHARD bytes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.concat_batches([held, batch])
            # Groups end where gram or part changes; a shard is some groups.
            gram, part = (whole.column(c).to_numpy() for c in ("gram", "part"))
            new = np.flatnonzero((np.diff(gram) != 0) | (np.diff(part) != 0)) + 1
            sums = np.concatenate(([0], np.cumsum(pc.binary_length(whole.column("bytes")).to_numpy())))
            at = 0
            while True:
                some = new[(new > at) & (sums[new] - sums[at] >= SHARD)]
                if not len(some):
                    break
                yield from compared(whole.slice(at, int(some[0]) - at), sizes)
                at = int(some[0])
            held = whole.slice(at)
        if held is not None and held.num_rows:
            yield from compared(held, sizes)

    return (
        pieces.repartition("gram", "part")
        .sortWithinPartitions("gram", "part", "doc", "first")
        .mapInArrow(task, ROW)
    )


def united(rows: DataFrame, sizes: Sizes) -> DataFrame:
    """Ranges to remove for windows of divided groups that are not the earliest of all
    parts. A window of one part is one row, so no kind has more rows than parts."""
    least = Window.partitionBy("gram", "piece", "sides")
    place = F.struct("doc", "windows")
    return (
        rows.withColumn("least", F.min(place).over(least))
        .filter(place > F.col("least"))
        .select(
            "doc",
            F.shiftright("windows", RUN_BITS).alias("start"),
            (F.shiftright("windows", RUN_BITS) + sizes.length).alias("end"),
        )
    )


# ------------------------------------------------------------------ the operator


def ranges(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc, start, end): byte ranges, overlapping, whose union is every byte that a
    string of ``length`` bytes covers which also starts earlier. ``docs`` has doc (a
    number that orders the documents) and text."""
    sizes = Sizes(length)
    sifted_rows = keep(sift(found_rows(docs, sizes), sizes), "sifted")
    asking = sifted_rows.filter(F.col("gram") != MARK)
    done = keep(compare(pieces_of(docs, asking, sizes), sizes), "compared")
    at_once = [
        rows.filter(F.col("gram") == MARK).select(
            "doc", F.col("piece").alias("start"), F.col("sides").alias("end")
        )
        for rows in (sifted_rows, done)
    ]
    return at_once[0].unionByName(at_once[1]).unionByName(
        united(done.filter(F.col("gram") != MARK), sizes)
    )


def numbered(docs: DataFrame) -> DataFrame:
    """The documents with ``doc``, a number that orders them. That is the id, unless an
    id is null or no integer or belongs to different texts: then all are numbered in
    the order of id and text's hash, by the partitions of a range."""
    integer = docs.schema["id"].dataType.typeName() in ("byte", "short", "integer", "long")
    if integer:
        odd = docs.groupBy("id").agg(
            (F.min(F.xxhash64("text")) != F.max(F.xxhash64("text"))).alias("differ")
        )
        if odd.filter("differ OR id IS NULL").isEmpty():
            return docs.withColumn("doc", F.col("id").cast("long"))
    keys = docs.select("id", F.xxhash64("text").alias("of")).distinct()
    keys = keys.repartitionByRange("id", "of").sortWithinPartitions("id", "of")
    keys = keep(keys.withColumn("doc", F.monotonically_increasing_id()), "numbers")
    keys = keys.select(F.col("id").alias("id_"), F.col("of").alias("of_"), "doc")
    return keep(
        docs.withColumn("of", F.xxhash64("text"))
        .join(keys, F.expr("of = of_ AND id <=> id_"))
        .select("id", "text", "doc"),
        "numbered",
    )


def remove(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    A byte goes if a string of ``length`` bytes covers it that also starts earlier: in a
    document of smaller id, or further left in the same one. Matches never cross
    documents, and all are judged on the input. n_spans counts maximal removed runs.

    1. Each window's anchor is found (``anchors``), 2.5 % of the bytes. Equal pieces
       are settled by their hash; copies go no further.
    2. Pieces with equal grams and an equal side, but different as a whole, are read
       again; shards of them get a suffix array by induced sorting, and the places
       where its common prefixes reach ``length`` are equal windows. Groups of more
       than GROUP pieces are divided, and their parts' windows united by hash.
    3. Ranges are united per document and cut out.

    Hashes have 64 bits or more on top of the gram's. Null text counts as empty. Rows
    that repeat an id and a text are one document and give as many rows; for other ids
    that repeat, or are null, see ``numbered``. Other columns are not read.
    """
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    if length > MOST_LENGTH:
        raise ValueError(f"length must be {MOST_LENGTH} at most")
    source = numbered(
        docs.select(
            F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
        )
    )
    cut = keep(
        ranges(source, length)
        .groupBy("doc")
        .agg(F.collect_list(F.struct("start", "end")).alias("cut")),
        "cuts",
    )
    kind = source.schema["id"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch, 1, 4 << 20):
                data, offsets = tokens.utf8(block.column(1))
                cuts = block.column(2)
                flat, lists = cuts.flatten(), cuts.offsets.to_numpy()
                row = np.repeat(np.arange(len(block)), np.diff(lists))
                start, end = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                row, start, end = merged(row, start, end)
                spans = np.bincount(row, minlength=len(block))
                removed = np.bincount(row, end - start, minlength=len(block)).astype(np.int64)
                steps = np.zeros(len(data) + 1, np.int64)
                np.add.at(steps, start + offsets[row], 1)
                np.add.at(steps, end + offsets[row], -1)
                stays = np.cumsum(steps[:-1]) == 0
                kept = [
                    data[a:b][stays[a:b]].tobytes()
                    for a, b in zip(offsets[:-1], offsets[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0),
                        pa.array(np.diff(offsets)),
                        pa.array(removed),
                        pa.array(spans),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    ids = cut.select("doc")
    touched, whole = source, source
    few = ids.count() <= BROADCAST_IDS
    if few:
        touched = source.join(F.broadcast(ids), "doc", "left_semi")
    whole = source.join(F.broadcast(ids) if few else ids, "doc", "left_anti")
    changed = (
        touched.join(cut, "doc")
        .select("id", "text", "cut")
        .mapInArrow(
            task, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
        )
    )
    same = whole.select(
        "id",
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"),
        F.col("text").cast("binary").alias("kept"),
    )
    return changed.unionByName(same).withColumnRenamed("id", id_col)

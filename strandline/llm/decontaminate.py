"""Benchmark items in documents, whole and lightly edited, by embedded edit distance."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strandline.llm import tokens

U64 = np.uint64
# Walks and samples for a recall of 0.99 at the most edits. Seeds have chosen the windows,
# so that samples of few places do: an unlike window passes some five times in a hundred.
WALKS = 8  # random walks per window
SAMPLES = 24  # bit samples per walk
SAMPLED = 3  # places per sample
REACH = 1.6  # sampled steps of a walk per byte of the item; a walk moves every other one
CLASS = 32  # items are walked by their length in such units
LEAST_STEPS = 14  # of a walk
GRAM = 8  # bytes of a seed at most
LEAST_GRAM = 6  # bytes of a seed at least, where several must agree
SEEDS = 3  # seeds that must agree on a place, where the item has room for them
MAX_ITEMS = 20_000  # broadcast at once; more items are gone through in parts
MOST_HITS = 1 << 20  # places of seeds looked at together
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = tokens.SPACE


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts in ASCII lower case with one blank between words, and their offsets."""
    solid = ~_SPACE[data]
    keep = solid.copy()
    keep[1:] |= solid[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    keep[starts] = solid[starts]
    out = _LOWER[data]
    out[~solid] = 32
    places = np.concatenate(([0], np.cumsum(keep)))
    return out[keep], places[offsets]


class Walk:
    """A random walk over strings (the embedding of edit into Hamming distance): at
    each step it writes the byte it stands on, then stays or moves on as a random
    function of the step and that byte says. Strings that differ by few edits soon
    walk in step again and write mostly the same."""

    def __init__(self, seed: int, steps: int) -> None:
        at = np.arange(steps * 256, dtype=U64) + U64(seed << 40)
        self.moves = (tokens.mix(at) & U64(1)).astype(np.int8).reshape(steps, 256)
        chosen = tokens.mix(np.arange(SAMPLES * SAMPLED, dtype=U64) + U64(seed << 20))
        self.sampled = (chosen % U64(steps)).astype(np.int64).reshape(SAMPLES, SAMPLED)

    def samples(self, strings: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """What the walk from each start writes at the sampled steps."""
        wanted, where = np.unique(self.sampled, return_inverse=True)
        at = starts.astype(np.int64)
        out = np.empty((len(wanted), len(starts)), np.uint8)
        row = 0
        for step in range(int(wanted[-1]) + 1):
            byte = strings[at]
            if wanted[row] == step:
                out[row] = byte
                row += 1
            at += self.moves[step][byte]
        return out[where.ravel()].reshape(SAMPLES, SAMPLED, len(starts))


@lru_cache(maxsize=1024)
def walk_of(seed: int, steps: int) -> Walk:
    return Walk(seed, steps)


def met(
    strings: np.ndarray, starts: np.ndarray, item: np.ndarray, items: Items
) -> np.ndarray:
    """Whether a window and its item agree in all places of some sample of some walk."""
    out = np.zeros(len(starts), bool)
    classes = items.sizes // CLASS
    for size in np.unique(classes[item]):
        own = np.flatnonzero(classes[item] == size)
        steps = max(LEAST_STEPS, int(REACH * CLASS * size))
        some = np.flatnonzero(classes == size)
        for number in range(WALKS):
            walk = walk_of(1000 * int(size) + number + 1, steps)
            theirs = walk.samples(items.data, items.starts[some])
            own = own[~out[own]]  # one meeting is enough
            at_item = np.searchsorted(some, item[own])
            for first in range(0, len(own), 1 << 15):
                part = slice(first, first + (1 << 15))
                mine = walk.samples(strings, starts[own[part]])
                equal = (mine == theirs[:, :, at_item[part]]).all(axis=1).any(axis=0)
                out[own[part]] |= equal
    return out


def edit_distance(item: bytes, text: bytes, most: int) -> int:
    """The least edit distance of ``item`` to any substring of ``text``, with the
    columns of the table as bits of one number; more than ``most`` may be any such."""
    if item in text:
        return 0
    size = len(item)
    full = (1 << size) - 1
    top = 1 << (size - 1)
    masks: dict[int, int] = {}
    for place, byte in enumerate(item):
        masks[byte] = masks.get(byte, 0) | 1 << place
    up, down, distance = full, 0, size
    best = distance
    for byte in text:
        equal = masks.get(byte, 0)
        cross = ((((equal & up) + up) ^ up) | equal) & full
        plus = (down | ~(cross | up)) & full
        minus = up & cross
        if plus & top:
            distance += 1
        elif minus & top:
            distance -= 1
        vertical = equal | down
        plus = plus << 1 & full
        minus = minus << 1 & full
        up = (minus | ~(vertical | plus)) & full
        down = plus & vertical
        best = min(best, distance)
    return best


@dataclass(frozen=True)
class Seeds:
    """Pieces of ``size`` bytes as sorted numbers, with their items and places."""

    size: int
    flags: np.ndarray
    keys: np.ndarray
    items: np.ndarray
    places: np.ndarray

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places of grams that are seeds, the first such seed and how many there are."""
        wanted = grams >> U64(8 * (GRAM - self.size))
        some = np.flatnonzero(self.flags[slot(wanted, len(self.flags))])
        low = np.searchsorted(self.keys, wanted[some])
        times = np.searchsorted(self.keys, wanted[some], side="right") - low
        hit = times > 0
        return some[hit], low[hit], times[hit]


def slot(keys: np.ndarray, slots: int) -> np.ndarray:
    return (keys * U64(0x9E3779B97F4A7C15)) >> U64(65 - slots.bit_length())


def grams(strings: np.ndarray, size: int) -> np.ndarray:
    """The GRAM bytes from each of ``size`` places as a number, the first byte highest."""
    return np.ndarray(size, ">u8", np.ascontiguousarray(strings), strides=(1,)).astype(U64)


@dataclass(frozen=True)
class Items:
    """Benchmark items: ids, normalised bytes behind one another, seeds by size."""

    ids: list
    data: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    seeds: list[Seeds]
    needed: np.ndarray
    share: float

    def edits(self, item: np.ndarray) -> np.ndarray:
        """The most edits of a match."""
        return (self.sizes[item] * self.share).astype(np.int64)


def items_of(ids: list, texts: list[str], share: float) -> Items:
    """Each item of e edits at most is cut into e + k pieces, so that k of them are whole
    in any match; k is SEEDS, or less where the pieces would be shorter than LEAST_GRAM."""
    data, offsets = normal(*tokens.utf8(pa.array(texts, pa.string())))
    sizes = np.diff(offsets)
    pad = np.zeros(int(REACH * sizes.max(initial=0)) + GRAM, np.uint8)
    strings = np.concatenate([data, pad])
    edits = (sizes * share).astype(np.int64)
    needed = np.ones(len(ids), np.int64)
    for k in range(2, SEEDS + 1):
        needed[sizes // (edits + k) >= LEAST_GRAM] = k
    pieces = np.where(sizes > 0, edits + needed, 0)
    of = np.repeat(np.arange(len(ids)), pieces)
    place = ragged(pieces) * sizes[of] // np.maximum(pieces[of], 1)
    length = np.clip(sizes // np.maximum(pieces, 1), 1, GRAM)[of]
    keys = grams(strings, len(data))[offsets[:-1][of] + place]
    seeds = []
    for size in np.unique(length):
        own = np.flatnonzero(length == size)
        short = keys[own] >> U64(8 * (GRAM - int(size)))
        order = np.argsort(short, kind="stable")
        own, short = own[order], short[order]
        flags = np.zeros(max(1 << 16, 1 << (16 * len(own)).bit_length()), bool)
        flags[slot(short, len(flags))] = True
        seeds.append(Seeds(int(size), flags, short, of[own], place[own]))
    return Items(ids, strings, offsets[:-1], sizes, seeds, needed, share)


def seeds_in(
    strings: np.ndarray, offsets: np.ndarray, items: Items, done: set[tuple[int, int]]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Where a document shares as many seeds with an item as a match has whole: its
    row, the item, and where the item would begin in the row; each only once.

    Texts in which very many places meet seeds, such as one sign over and over, are gone
    through in stretches of MOST_HITS, that overlap by the longest window. Rows and items
    that are ``done`` by then are passed over.
    """
    size = int(offsets[-1])
    found = grams(strings, size)
    hits = [seeds.hits(found) for seeds in items.seeds]
    if not hits:
        return
    per_place = np.zeros(size + 1, np.int64)
    for places, _, times in hits:
        per_place[places + 1] += times
    so_far = np.cumsum(per_place)
    reach = int(items.sizes.max() + items.edits(items.sizes.argmax()[None]).max()) + GRAM
    at = 0
    while at < size:
        stop = int(np.searchsorted(so_far, so_far[at] + MOST_HITS, side="right")) - 1
        stop = min(size, max(stop, at + reach))
        parts = []
        for seeds, (places, low, times) in zip(items.seeds, hits, strict=True):
            here = slice(*np.searchsorted(places, [at, stop + reach]))
            place = np.repeat(places[here], times[here])
            seed = np.repeat(low[here], times[here]) + ragged(times[here])
            row = np.searchsorted(offsets, place, side="right") - 1
            inside = place + seeds.size <= offsets[row + 1]
            place, seed, row = place[inside], seed[inside], row[inside]
            parts.append((row, seeds.items[seed], place - offsets[row] - seeds.places[seed]))
        row, item, start = (np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True))
        if done:
            number = row * len(items.ids) + item
            known = np.array([r * len(items.ids) + i for r, i in done], np.int64)
            open_ = ~np.isin(number, known)
            row, item, start = row[open_], item[open_], start[open_]
        yield agreeing(row, item, start, items)
        at = stop


def agreeing(
    row: np.ndarray, item: np.ndarray, at: np.ndarray, items: Items
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The places on which as many seeds as needed agree, within an item's edits."""
    order = np.lexsort((at, item, row))
    row, item, at = row[order], item[order], at[order]
    enough = items.needed[item] < 2
    for n in range(2, SEEDS + 1):
        near = np.zeros(len(row), bool)
        if len(row) >= n:
            near[: len(row) - n + 1] = (
                (row[n - 1 :] == row[: len(row) - n + 1])
                & (item[n - 1 :] == item[: len(row) - n + 1])
                & (at[n - 1 :] - at[: len(row) - n + 1] <= items.edits(item[n - 1 :]))
            )
        near &= items.needed[item] == n
        for k in range(n):
            enough[k:] |= near[: len(row) - k]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(at) != 0)
    kept = np.flatnonzero(enough & new)
    return row[kept], item[kept], at[kept]


def ragged(sizes: np.ndarray) -> np.ndarray:
    """0..size-1 for each size, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)


def batch_matches(column: pa.Array, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item and distance of the items found in a block of texts."""
    data, offsets = normal(*tokens.utf8(column))
    longest = int(REACH * items.sizes.max(initial=0)) + GRAM
    strings = np.concatenate([data, np.zeros(longest, np.uint8)])
    best: dict[tuple[int, int], int] = {}
    whole: set[tuple[int, int]] = set()  # found without an edit: nothing can be closer
    for row, item, at in seeds_in(strings, offsets, items, whole):
        begin = np.clip(at, 0, np.diff(offsets)[row]) + offsets[row]
        close = met(strings, begin, item, items)
        confirmed(data, offsets, items, row[close], item[close], begin[close], best, whole)
    found = np.array([(*key, distance) for key, distance in best.items()], np.int64).reshape(-1, 3)
    return found[:, 0], found[:, 1], found[:, 2]


def confirmed(
    data: np.ndarray,
    offsets: np.ndarray,
    items: Items,
    row: np.ndarray,
    item: np.ndarray,
    begin: np.ndarray,
    best: dict[tuple[int, int], int],
    whole: set[tuple[int, int]],
) -> None:
    """Add to ``best`` the distances of the windows that met, where they are within the
    item's edits. Windows as near as that to one another are gone over together."""
    most = items.edits(item)
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (np.diff(item) != 0) | (np.diff(begin) > most[1:])
    bounds = np.append(np.flatnonzero(new), len(row))
    for first, last in zip(bounds[:-1], bounds[1:], strict=True):
        key = (int(row[first]), int(item[first]))
        if key in whole:
            continue
        edits, start, size = int(most[first]), int(items.starts[key[1]]), int(items.sizes[key[1]])
        low = max(int(begin[first]) - edits, int(offsets[key[0]]))
        high = min(int(begin[last - 1]) + size + edits, int(offsets[key[0] + 1]))
        distance = edit_distance(
            items.data[start : start + size].tobytes(), data[low:high].tobytes(), edits
        )
        if distance <= edits:
            best[key] = min(distance, best.get(key, distance))
            if not distance:
                whole.add(key)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    max_edit_share: float = 0.1,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per document and benchmark item found in it: id, item, distance,
    similarity (1 - distance / the item's bytes).

    Both are compared in ASCII lower case with one blank between words, as bytes. An
    item is found where some substring is within ``max_edit_share`` of its length in
    edits (e). Windows of an item's size are set where as many of its e + k pieces agree
    on its place as any such substring has whole, k; no match is without a window,
    whatever its length or script. Random walks embed window and item so that few edits
    become few differing places; windows meet if any of WALKS * SAMPLES samples of
    SAMPLED places is equal, and only those that met are compared with their item. A
    match of the most edits meets with a probability of 0.99 or more at any length
    (measured in the tests), one of fewer edits surely. ``distance`` is exact over the
    windows that met: an upper bound of the text's least.

    The items are broadcast, MAX_ITEMS at a time: more are gone through in parts, one
    scan of the documents each. Texts travel nowhere. Null and empty texts and items
    match nothing; repeated items count once, repeated documents give as many rows;
    other columns are not read.
    """
    spark = docs.sparkSession
    listed = (
        benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
        .filter("text IS NOT NULL AND item IS NOT NULL")
        .distinct()
    )
    parts = -(-listed.count() // MAX_ITEMS) or 1
    doc_kind = docs.schema[id_col].dataType.simpleString()
    item_kind = benchmark.schema[item_col].dataType.simpleString()
    schema = f"id {doc_kind}, item {item_kind}, distance int, size int"
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def scan(rows: list) -> DataFrame:
        own = spark.sparkContext.broadcast(
            items_of([r["item"] for r in rows], [r["text"] for r in rows], max_edit_share)
        )
        kind = benchmark.schema[item_col].dataType

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = own.value
            names = pa.array(items.ids, to_arrow_type(kind))
            for batch in batches:
                for block in tokens.blocks(batch, 1, 2 << 20):
                    row, item, distance = batch_matches(block.column(1), items)
                    yield pa.RecordBatch.from_arrays(
                        [
                            block.column(0).take(pa.array(row)),
                            names.take(pa.array(item)),
                            pa.array(distance.astype(np.int32)),
                            pa.array(items.sizes[item].astype(np.int32)),
                        ],
                        names=["id", "item", "distance", "size"],
                    )

        return texts.mapInArrow(task, schema)

    found = None
    for part in range(parts):
        chosen = listed.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part)
        one = scan(chosen.orderBy("item", "text").collect())
        found = one if found is None else found.unionByName(one)
    return found.select(
        F.col("id").alias(id_col),
        F.col("item").alias(item_col),
        "distance",
        (1 - F.col("distance") / F.col("size")).alias("similarity"),
    )

"""Token sequences of at most a fixed length, with as little padding as possible."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strandline.llm import tokens
from strandline.llm.keep import fresh
from strandline.llm.ngrams import lower_utf8
from strandline.sources import shared

U64 = np.uint64
KNOWN_WORDS = 600_000  # remembered per Python worker, some 25 MB
BREAK = "\x01"  # set between words that are encoded together
ROWS_PER_BUCKET = 2000
NODES = 20_000  # branches of one completion; in all, of the search for a plan
FEW = 400  # pieces that are planned bin by bin
MOST_SEEN = 100_000  # states that the search remembers

# ------------------------------------------------------------------ token ids


def _kinds() -> np.ndarray:
    """The tokenizer's kinds of signs, by byte, for ASCII and the Latin
    letters up to U+024F: white space, letters, digits, and others."""
    kinds = np.full(256, 3, np.uint8)
    kinds[[0x20, *range(0x09, 0x0E)]] = 0
    kinds[97:123] = kinds[128:] = 1
    kinds[48:58] = 2
    return kinds


KINDS = _kinds()
# Bytes that no such text has; BREAK is kept for ourselves.
FOREIGN = np.zeros(256, bool)
FOREIGN[[1, *range(0xC0, 0xC3), *range(0xCA, 0x100)]] = True
END = U64(0x656E64)


def simple(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Whether each text has only ASCII and Latin letters up to U+024F, but for the one
    whose lower case is two signs (U+0130)."""
    bad = FOREIGN[data]
    for lead, low, high in ((0xC3, 0x97, 0x97), (0xC3, 0xB7, 0xB7), (0xC4, 0xB0, 0xB0), (0xC9, 0x90, 0xFF)):
        at = np.flatnonzero(data[:-1] == lead)
        bad[at[(data[at + 1] >= low) & (data[at + 1] <= high)]] = True
    rows = np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1
    out = np.ones(len(offsets) - 1, bool)
    out[rows] = False
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of lower-case simple texts begin and end: runs of letters, single
    digits, runs of other signs. A part between white space that has an apostrophe is
    one, as the tokenizer cuts it by a list of endings."""
    kinds = KINDS[data]
    rows = np.zeros(len(data) + 1, bool)
    rows[offsets] = True
    solid = kinds > 0
    part = solid.copy()
    part[1:] &= ~solid[:-1] | rows[1:-1]
    begin = solid.copy()
    begin[1:] &= (kinds[1:] != kinds[:-1]) | (kinds[1:] == 2) | rows[1:-1]
    quotes = np.flatnonzero(data == 0x27)
    if len(quotes):
        number = np.cumsum(part)
        whole = np.zeros(int(number[-1]) + 1, bool)
        whole[number[quotes]] = True
        begin &= part | ~whole[number]
    starts = np.flatnonzero(begin)
    # A word ends where the next one begins, less the white space between.
    stops = np.append(starts[1:], len(data))
    gaps = np.concatenate(([0], np.cumsum(~solid)))
    return starts, stops - (gaps[stops] - gaps[starts])


class Encoder:
    """Token ids by a tokenizer that lower-cases, drops white space and ends each word.

    A text's ids are its words' ids in order. Words are cut and looked up by hash, for a
    block of texts at once; words not met before are encoded together, set apart by a
    sign of their own. Texts with other signs than ``simple`` allows go to the tokenizer
    whole.
    """

    def __init__(self, path: str, end_id: int) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.end_id = end_id
        (self.apart,) = self.ids(BREAK)
        self.forget()

    def forget(self) -> None:
        """Only the end of a text is known."""
        self.hashes, self.pool = np.array([END]), np.array([self.end_id], "<u4")
        self.first, self.size = np.zeros(1, np.int64), np.ones(1, np.int64)

    def ids(self, text: str) -> np.ndarray:
        (found,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(found.ids, dtype="<u4")

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all texts of a block, each with the end id, behind one another; the
        rows they belong to, and the n + 1 places where they begin."""
        plain = simple(*tokens.utf8(column))
        rows = [np.flatnonzero(plain), np.flatnonzero(~plain)]
        ids, sizes = self.encode_simple(column.filter(pa.array(plain)))
        other = [
            np.append(self.ids(text), np.array([self.end_id], "<u4"))
            for text in column.filter(pa.array(~plain)).to_pylist()
        ]
        sizes = np.concatenate([sizes, [len(x) for x in other]]).astype(np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        return np.concatenate([ids, *other]), np.concatenate(rows), edges

    def encode_simple(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = lower_utf8(column)
        starts, stops = words(data, offsets)
        up, down = tokens.powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(tokens.BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        hashes = tokens.mix((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(U64))
        # Each text ends with END.
        behind = np.searchsorted(starts, offsets[1:])
        distinct, some, at = np.unique(hashes, return_index=True, return_inverse=True)
        self.learn(distinct, starts[some], stops[some], data)
        place = np.searchsorted(self.hashes, distinct)[at]
        place = np.insert(place, behind, np.searchsorted(self.hashes, END))
        size = self.size[place]
        edges = np.concatenate(([0], np.cumsum(size)))
        index = np.arange(edges[-1]) + np.repeat(self.first[place] - edges[:-1], size)
        ends = edges[behind + np.arange(1, len(column) + 1)]
        return self.pool[index], np.diff(ends, prepend=0)

    def learn(
        self, distinct: np.ndarray, starts: np.ndarray, stops: np.ndarray, data: np.ndarray
    ) -> None:
        """Make all of these (sorted) hashes known."""
        if len(self.hashes) + len(distinct) > KNOWN_WORDS:
            self.forget()
        at = np.minimum(np.searchsorted(self.hashes, distinct), len(self.hashes) - 1)
        new = np.flatnonzero(self.hashes[at] != distinct)
        if not len(new):
            return
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist(), strict=True)]
        between = f" {BREAK} ".encode()
        found = []
        for first in range(0, len(texts), 4096):
            found.append(self.ids(between.join(texts[first : first + 4096]).decode()))
            found.append(np.array([self.apart], "<u4"))
        ids = np.concatenate(found)
        apart = np.flatnonzero(ids == self.apart)
        if len(apart) != len(new):
            raise ValueError("the tokenizer does not keep words apart")
        begin = np.concatenate(([0], apart[:-1] + 1))
        to = np.searchsorted(self.hashes, distinct[new])
        self.first = np.insert(self.first, to, begin + len(self.pool))
        self.size = np.insert(self.size, to, apart - begin)
        self.hashes = np.insert(self.hashes, to, distinct[new])
        self.pool = np.concatenate([self.pool, ids])


@cache
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 4096,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document one row per piece: id, piece, start, length, ids.

    A document is its token ids and then ``end_id``; null text counts as empty.
    Documents longer than ``capacity`` are cut into pieces of that length, the last
    one shorter. ``ids`` holds little-endian unsigned 32-bit numbers. ``tokenizer``
    is a file of a public tokenizer, found under the same path by every worker; see
    ``Encoder`` for what it must do. Repeated rows give as many rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = encoder(tokenizer, end_id)
        for batch in batches:
            for block in tokens.blocks(batch, 1, 1 << 20):
                ids, rows, edges = known.encode(block.column(1).fill_null(""))
                times = -(-np.diff(edges) // capacity)
                first = np.concatenate(([0], np.cumsum(times)[:-1]))
                piece = np.arange(int(times.sum())) - np.repeat(first, times)
                start = piece * capacity
                length = np.minimum(np.repeat(np.diff(edges), times) - start, capacity)
                # Pieces lie behind one another as the ids do.
                cuts = np.concatenate(([0], np.cumsum(length))).astype(np.int32) * 4
                binary = pa.Array.from_buffers(
                    pa.binary(), len(piece), [None, pa.py_buffer(cuts), pa.py_buffer(ids)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column(0).take(pa.array(np.repeat(rows, times))),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        binary,
                    ],
                    names=["id", "piece", "start", "length", "ids"],
                )

    return (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .mapInArrow(task, f"id {kind}, piece int, start long, length long, ids binary")
        .withColumnRenamed("id", id_col)
    )


# ------------------------------------------------------------------ the plan

#: How often a filling is used, and the filling: (length, times) pairs.
Filling = tuple[int, tuple[tuple[int, int], ...]]


def best_fit(counts: dict[int, int], capacity: int) -> list[Filling]:
    """Best-fit decreasing over a histogram: bins that are alike are one entry."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, items: tuple[int, ...], n: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((items, n))

    done: list[tuple[tuple[int, ...], int]] = []
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                per = capacity // length
                full, rest = divmod(left, per)
                if full:
                    put(capacity - per * length, (length,) * per, full)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                break
            room = rooms[at]
            items, n = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            per = min(room // length, left)
            used = min(n, left // per)
            if used < n:
                put(room, items, n - used)
            put(room - per * length, items + (length,) * per, used)
            left -= used * per
    done = [entry for group in open_.values() for entry in group]
    return [(n, tuple(Counter(items).items())) for items, n in done]


def completion(
    lengths: list[int], counts: dict[int, int], room: int, nodes: int = NODES
) -> list[tuple[int, int]]:
    """The filling of ``room`` that wastes least; of equal ones the first with the
    longest pieces, so that short ones stay for later bins.

    Branches take a length as often as possible first: a filling to which another
    piece could be added is dominated and never kept, as the fuller one is met
    before. A branch ends where even all shorter pieces cannot beat the incumbent,
    whose first value is the best-fit filling (the first branch). ``nodes`` bounds
    the branches per bin.
    """
    below = [0] * (len(lengths) + 1)
    for k in range(len(lengths) - 1, -1, -1):
        below[k] = below[k + 1] + lengths[k] * counts[lengths[k]]
    best: list[tuple[int, int]] = []
    best_sum = 0
    left_nodes = nodes
    taken: list[tuple[int, int]] = []
    # Each frame: the next index, the room, and how often the length was taken.
    stack: list[tuple[int, int, int]] = [(0, room, -1)]
    while stack:
        at, free, times = stack.pop()
        if times >= 0:  # come back: one piece less of this length, then on
            del taken[next(i for i, (k, _) in enumerate(taken) if k == at) :]
            if times == 0:
                at, times = at + 1, -1
            else:
                length = lengths[at]
                if times - 1:
                    taken.append((at, times - 1))
                    stack.append((at, free + length, times - 1))
                free, at = free + length, at + 1
        while at < len(lengths):
            total = room - free
            if total > best_sum:
                best_sum, best = total, list(taken)
            if best_sum == room or total + min(free, below[at]) <= best_sum:
                break
            length = lengths[at]
            if length > free:
                # Skip to the first length that fits.
                lo, hi = at, len(lengths)
                while lo < hi:
                    mid = (lo + hi) // 2
                    if lengths[mid] > free:
                        lo = mid + 1
                    else:
                        hi = mid
                at = lo
                continue
            n = min(counts[length], free // length)
            left_nodes -= 1
            if left_nodes < 0:
                stack.clear()
                break
            if n:
                taken.append((at, n))
                free -= n * length
                stack.append((at, free, n))
            at += 1
        total = room - free
        if total > best_sum:
            best_sum, best = total, list(taken)
        if best_sum == room:
            break
    return [(lengths[k], n) for k, n in best]


def greedy(counts: dict[int, int], capacity: int, most_waste: int) -> list[Filling] | None:
    """Around the longest piece left, the filling with least waste, as often as its pieces
    last; None once the waste exceeds ``most_waste``. Each step uses up a length or
    nearly so, so the work depends on the number of different lengths, ``capacity`` at
    most, and not on the number of pieces."""
    left = dict(counts)
    lengths = sorted(left, reverse=True)
    found: list[Filling] = []
    waste = 0
    while lengths:
        longest = lengths[0]
        left[longest] -= 1
        inner = lengths if left[longest] else lengths[1:]
        filling = Counter(dict(completion(inner, left, capacity - longest)))
        left[longest] += 1
        filling[longest] += 1
        times = min(left[length] // n for length, n in filling.items())
        for length, n in filling.items():
            left[length] -= n * times
            if not left[length]:
                lengths.remove(length)
        found.append((times, tuple(filling.items())))
        waste += times * (capacity - sum(length * n for length, n in filling.items()))
        if waste > most_waste:
            return None
    return found


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """A number of bins that no plan goes below. For each ``low``: pieces that leave less
    than ``low`` have a bin to themselves, no two others over half share one, and what of
    the rest (``low`` and longer) does not fit beside these needs bins by its sum. With
    ``low`` 0 this is the sum of all over the capacity."""
    lengths = np.array(sorted(counts), np.int64)
    if not len(lengths):
        return 0
    times = np.array([counts[int(x)] for x in lengths], np.int64)
    number = np.concatenate(([0], np.cumsum(times)))
    sums = np.concatenate(([0], np.cumsum(times * lengths)))
    half = int(np.searchsorted(lengths, capacity // 2, side="right"))
    lows = np.concatenate(([0], lengths[:half]))
    alone = np.searchsorted(lengths, capacity - lows, side="right")
    first = np.searchsorted(lengths, lows)
    beside = (number[alone] - number[half]) * capacity - (sums[alone] - sums[half])
    over = np.maximum(0, sums[half] - sums[first] - beside)
    by_sum = (number[-1] - number[half] + -(-over // capacity)).max()
    # And no bin has more pieces of a length or longer than of that length alone.
    by_number = -(-(number[-1] - number[:-1]) // (capacity // lengths))
    return int(max(by_sum, by_number.max()))


@dataclass(frozen=True)
class Plan:
    """Fillings, their number of bins, and the least that any plan could have. ``whole``:
    the search came to its end, so there is no better plan even if the two differ."""

    fillings: list[Filling]
    bins: int
    least: int
    whole: bool


class Search:
    """Bin completion by branch and bound.

    A bin is completed around the longest piece left; branches are its undominated
    fillings, least waste first. What the bins so far waste may not exceed what a plan
    with one bin less than the incumbent can waste, nor may the bins that the rest needs
    at least make up as many as the incumbent's. While many pieces are left, a filling is
    used as often as they last; the last FEW pieces are tried bin by bin.
    """

    def __init__(self, capacity: int, total: int, incumbent: list[Filling], nodes: int) -> None:
        self.capacity, self.total, self.nodes = capacity, total, nodes
        self.best = incumbent
        self.bins = n_bins(incumbent)
        self.seen: dict[tuple, int] = {}
        self.complete = True

    def run(self, counts: dict[int, int], least: int) -> None:
        # A stack of open bins: what was left, bins and waste so far, fillings to try.
        chosen: list[Filling] = []
        stack = [(dict(counts), 0, 0, iter(self.fillings(counts, 0)))]
        while stack and self.bins > least:
            left, used, waste, untried = stack[-1]
            filling = next(untried, None)
            if filling is None or self.nodes < 0:
                stack.pop()
                if chosen:
                    chosen.pop()
                continue
            few = sum(left.values()) <= FEW
            times = 1 if few else min(left[length] // n for length, n in filling.items())
            self.complete &= few or times == 1
            rest = {k: v - filling.get(k, 0) * times for k, v in left.items()}
            rest = {k: v for k, v in rest.items() if v}
            lost = waste + times * (self.capacity - sum(k * n for k, n in filling.items()))
            if lost > (self.bins - 1) * self.capacity - self.total:
                continue
            now = used + times
            plan_ = [*chosen, (times, tuple(filling.items()))]
            if not rest:
                if now < self.bins:
                    self.best, self.bins = plan_, now
                continue
            state = tuple(sorted(rest.items()))
            if now + least_bins(rest, self.capacity) >= self.bins or self.seen.get(state, now + 1) <= now:
                continue
            if len(self.seen) < MOST_SEEN:
                self.seen[state] = now
            chosen.append(plan_[-1])
            stack.append((rest, now, lost, iter(self.fillings(rest, lost))))

    def fillings(self, left: dict[int, int], waste: int) -> list[dict[int, int]]:
        """Undominated fillings around the longest piece, those of least waste first."""
        spare = (self.bins - 1) * self.capacity - self.total - waste
        lengths = sorted(left, reverse=True)
        longest, room = lengths[0], self.capacity - lengths[0]
        counts = dict(left)
        counts[longest] -= 1
        below = [0] * (len(lengths) + 1)
        for k in range(len(lengths) - 1, -1, -1):
            below[k] = below[k + 1] + lengths[k] * counts[lengths[k]]
        found: list[dict[int, int]] = []
        stack: list[tuple[int, int, tuple[tuple[int, int], ...]]] = [(0, room, ())]
        while stack:
            at, free, taken = stack.pop()
            self.nodes -= 1
            if self.nodes < 0:
                self.complete = False
                break
            if free - min(free, below[at]) > spare:
                continue  # not even all shorter pieces fill it enough
            while at < len(lengths) and lengths[at] > free:
                at += 1
            if at == len(lengths):
                filling = dict(taken)
                filling[longest] = filling.get(longest, 0) + 1
                if not self.dominated(filling, left, free):
                    found.append(filling)
                continue
            length = lengths[at]
            for n in range(min(counts[length], free // length) + 1):
                more = taken + ((length, n),) if n else taken
                stack.append((at + 1, free - n * length, more))
        found.sort(key=lambda f: (-sum(k * n for k, n in f.items()), [-k for k in f]))
        return found

    def dominated(self, filling: dict[int, int], left: dict[int, int], free: int) -> bool:
        """Whether a piece left out could go in, alone or in place of shorter ones: of one
        piece, or of two that it is as long as. Wherever that piece would go, they can."""
        longest = max(filling)
        pieces = [k for k, n in filling.items() for _ in range(min(n, 2)) if k != longest]
        if filling[longest] > 1:
            pieces.append(longest)
        places = {0} | set(pieces)
        places |= {a + b for i, a in enumerate(pieces) for b in pieces[i + 1 :]}
        for other, n in left.items():
            if n > filling.get(other, 0):
                for out in places:
                    if out <= other <= free + out and not (out == other and out in pieces):
                        return True
        return False


def n_bins(fillings: list[Filling]) -> int:
    return sum(n for n, _ in fillings)


def planned(counts: dict[int, int], capacity: int, nodes: int = NODES) -> Plan:
    """Fillings for a histogram of lengths, each with how often it is used.

    The better of best-fit decreasing and the greedy completion is the incumbent; where it
    has more bins than any plan needs at least, the branch and bound looks for a better
    one, for ``nodes`` branches at most. The plan says how far it may be from the best.
    """
    incumbent = best_fit(counts, capacity)
    least = least_bins(counts, capacity)
    if n_bins(incumbent) == least:
        return Plan(incumbent, least, least, True)
    total = sum(length * n for length, n in counts.items())
    first = greedy(counts, capacity, n_bins(incumbent) * capacity - total)
    incumbent = min([incumbent, first or incumbent], key=n_bins)
    search = Search(capacity, total, incumbent, nodes)
    if search.bins > least:
        search.run(counts, least)
    return Plan(search.best, search.bins, least, search.bins == least or search.complete)


def plan(counts: dict[int, int], capacity: int) -> list[Filling]:
    return planned(counts, capacity).fillings


# ------------------------------------------------------------------ placing


def pack(
    rows: DataFrame,
    capacity: int = 4096,
    id_col: str = "doc_id",
    length_col: str = "length",
    with_bound: bool = False,
) -> DataFrame:
    """The rows with sequence_id and offset added: each row's place in a sequence of
    at most ``capacity``, gapless from 0.

    The driver sees the histogram of lengths only (``capacity`` entries at most). It
    plans fillings; a row finds its place by its rank among the rows of its length.
    Ranks are counted per bucket of a few thousand rows and added up over buckets,
    so that no length, however common, is ranked in one task. Lengths must lie in
    1..capacity, else an error. ``with_bound`` adds n_sequences and least_sequences, how
    many there are and how many any packing needs. All other columns are kept; the rows are written to
    the shared folder once. Ties are broken by all the columns, equal rows by chance. Where
    the rows have a sequence_id or offset, these take its place.
    """
    spark = rows.sparkSession
    folder = shared.work_folder(spark, "pieces")
    rows.write.parquet(folder)
    held = spark.read.schema(rows.schema).parquet(folder)
    histogram = {
        int(length): int(n)
        for length, n in held.groupBy(length_col).agg(F.count(F.lit(1))).limit(capacity + 2).collect()
    }
    if any(not 0 < length <= capacity for length in histogram):
        raise ValueError(f"lengths must lie in 1..{capacity}")
    n_rows = sum(histogram.values())
    buckets = n_rows // ROWS_PER_BUCKET + 1

    # Per (filling, length): the first rank and the ranks it takes, times a bin, the
    # first sequence, and the offset.
    slots, first_rank, first_sequence = [], Counter(), 0
    found = planned(histogram, capacity)
    for times, filling in found.fillings:
        offset = 0
        for length, per in sorted(filling, reverse=True):
            slots.append((length, first_rank[length], per, first_sequence, offset))
            first_rank[length] += times * per
            offset += per * length
        first_sequence += times
    table = np.array(sorted(slots), dtype=np.int64).reshape(-1, 5)
    given = spark.sparkContext.broadcast(table)

    names = [c for c in held.columns if c not in ("sequence_id", "offset")]
    rank, bucket, base, n = fresh(held, "_rank", "_bucket", "_base", "_n")
    dealt = held.select(*names).withColumn(
        bucket, F.pmod(F.xxhash64(*names), F.lit(buckets))
    )
    by_length = Window.partitionBy(length_col).orderBy(bucket)
    bases = (
        dealt.groupBy(length_col, bucket)
        .agg(F.count(F.lit(1)).alias(n))
        .withColumn(base, F.sum(n).over(by_length) - F.col(n))
        .drop(n)
    )
    in_bucket = Window.partitionBy(length_col, bucket).orderBy(*names)
    ranked = (
        dealt.withColumn(rank, F.row_number().over(in_bucket) - 1)
        .join(bases, [length_col, bucket])
        .withColumn(rank, F.col(rank) + F.col(base))
        .drop(bucket, base)
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, firsts, per, sequence, offset = given.value.T
        key = lengths << 40 | firsts
        for batch in batches:
            length = batch.column(length_col).to_numpy().astype(np.int64)
            ranks = batch.column(rank).to_numpy().astype(np.int64)
            at = np.searchsorted(key, length << 40 | ranks, side="right") - 1
            inside = ranks - firsts[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in names),
                    pa.array(sequence[at] + inside // per[at]),
                    pa.array(offset[at] + inside % per[at] * length),
                ],
                names=[*names, "sequence_id", "offset"],
            )

    schema = ranked.select(
        *names, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    ).schema
    placed = ranked.select(*names, rank).mapInArrow(task, schema)
    if not with_bound:
        return placed
    return placed.withColumns(
        {
            "n_sequences": F.lit(found.bins).cast("long"),
            "least_sequences": F.lit(found.least).cast("long"),
        }
    )

"""Language-model scores from a Bloom filter of quantised n-gram counts.

The model is a bigram model smoothed towards exact unigram counts. It keeps every
bigram, in one bit array cut into parts by hash: an n-gram with count c is stored as the
pairs (n-gram, 1), ..., (n-gram, level(c)), so that repeated membership probes,
level by level until one fails, give its level back. Every count of a bigram comes from
such probes.

Texts and parts meet in blocks. A block of texts sends each part one row, the arrays of
its bigrams that the part holds, and gets one row of sums back. The counts of the most
frequent words are broadcast; those of the others lie beside the part that their
bigrams are in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import tokens
from strandline.sources import shared

U64 = np.uint64
END = np.uint64(0x656E64)  # the end token, and the history of a text's first token
#: Counts between 2**((k - 1) / STEPS) and 2**(k / STEPS) share level k + 1.
STEPS = 2
PROBES = 6
BITS_EACH = 16  # of an n-gram's level: a filter a third full, wrong for one probe in 1000
LEAST_PARTS = 32
# An n-gram's name within its part. Two of one part share it once in 2**40: rarely beside
# the filter, which takes an unseen n-gram for a seen one far more often.
NAME = U64((1 << 40) - 1)
COUNTED = 8 << 20  # bytes of text counted or sent at once
MOST_HELD = 1 << 22  # distinct n-grams a task gathers before it sends them on


def level(counts: np.ndarray) -> np.ndarray:
    """The quantised logarithm of counts of at least 1: 1, 2, 3, ..."""
    return np.floor(np.log2(counts) * STEPS).astype(np.int64) + 1


def value(levels: np.ndarray) -> np.ndarray:
    """The least count of a level; 0 for level 0."""
    return np.where(levels > 0, np.ceil(2.0 ** ((levels - 1) / STEPS)), 0.0)


def value_of(counts: np.ndarray) -> np.ndarray:
    """``value(level(n))``, 0 for 0."""
    return np.where(counts > 0, value(level(np.maximum(counts, 1))), 0.0)


def signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return tokens.mix(first * U64(0x9E3779B97F4A7C15) + tokens.mix(second))


def seeds_of(items: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """What the bit places of each (item, level) follow from."""
    return tokens.mix(items + levels.astype(U64) * U64(0xD1B54A32D192ED03))


def place(seeds: np.ndarray, turn: int, bits: int) -> np.ndarray:
    """One of the PROBES bit places per seed in an array of ``bits`` (below 2**32)."""
    step = (seeds >> U64(32)) | U64(1)
    turned = (seeds + U64(turn) * step) & U64(0xFFFFFFFF)
    return ((turned * U64(bits)) >> U64(32)).view(np.int64)


def places(items: np.ndarray, levels: np.ndarray, bits: int) -> np.ndarray:
    """PROBES bit places per (item, level)."""
    seeds = seeds_of(items, levels)
    return np.stack([place(seeds, turn, bits) for turn in range(PROBES)], axis=1).view(U64)


def probe(array: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The level of each item: probes go on while all bits of a level are set."""
    bits = len(array) * 8
    levels = np.zeros(len(items), np.int64)
    open_ = np.arange(len(items))
    at = 0
    while len(open_) and at < 64 * STEPS:
        at += 1
        seeds = seeds_of(items[open_], np.array([at]))
        for turn in range(PROBES):
            found = place(seeds, turn, bits)
            hit = np.flatnonzero((array[found >> 3] >> (found & 7).astype(np.uint8)) & 1)
            if len(hit) < len(open_):
                open_, seeds = open_[hit], seeds[hit]
        levels[open_] = at
    return levels


def filled(items: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bit array of distinct items with their counts."""
    levels = level(counts)
    bits = max(64, -(-BITS_EACH * int(levels.sum()) // 64) * 64)
    flags = np.zeros(bits, bool)
    for at in range(1, int(levels.max(initial=0)) + 1):
        some = items[levels >= at]
        for start in range(0, len(some), 1 << 18):
            seeds = seeds_of(some[start : start + (1 << 18)], np.array([at]))
            for turn in range(PROBES):
                flags[place(seeds, turn, bits)] = True
    return np.packbits(flags, bitorder="little")


def stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes and rows: each text's words, lower-cased, then one end."""
    hashes, rows = tokens.words(column)
    n = len(column)
    last = tokens.row_bounds(rows, n)[1:]
    return np.insert(hashes, last, END), np.insert(rows, last, np.arange(n))


def histories(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The token before each one; END before a text's first."""
    before = np.concatenate(([END], hashes[:-1]))
    before[np.flatnonzero(np.diff(rows, prepend=-1))] = END
    return before


def ordered(numbers: np.ndarray) -> np.ndarray:
    """The places of numbers in their order, those of equal ones in theirs. Numbers are
    sorted several times as quickly as places by them, so each takes its place along in its
    low bits, where there is room for it."""
    size = len(numbers).bit_length()
    if int(numbers.max(initial=0)) >> (64 - size):
        return np.argsort(numbers, kind="stable")
    return together(numbers.astype(U64) << U64(size))


def together(hashes: np.ndarray) -> np.ndarray:
    """The places of hashes in their order but for the low bits, where their places lie.
    Equal hashes lie together, unless others share all other bits (40 at least) with them."""
    low = U64((1 << len(hashes).bit_length()) - 1)
    mixed = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=U64))
    return (mixed & low).view(np.int64)


def runs(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return np.flatnonzero(new)


def distinct_words(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct hashes, and the number of each one among them."""
    order = together(hashes)
    found = hashes[order]
    firsts = runs(found)
    names = found[firsts]
    if not (names[1:] > names[:-1]).all():  # hashes that differ in their low bits only
        return np.unique(hashes, return_inverse=True)
    at = np.empty(len(hashes), np.int64)
    at[order] = np.repeat(np.arange(len(firsts)), np.diff(firsts, append=len(hashes)))
    return names, at


def tally(hashes: np.ndarray, column: str) -> pa.RecordBatch:
    found, counts = np.unique(hashes, return_counts=True)
    return pa.RecordBatch.from_arrays([signed(found), pa.array(counts)], names=[column, "n"])


# ---------------------------------------------------------------- arrays in rows


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers, in as many bytes each as the largest needs."""
    most = int(numbers.max(initial=0))
    size = next(n for n in (1, 2, 4, 8) if most < 1 << (8 * n))
    return bytes([size]) + numbers.astype(f"<u{size}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def short_names(items: np.ndarray) -> list[bytes]:
    """40-bit names, as their low and high bytes."""
    return [
        (items & U64(0xFFFFFFFF)).astype("<u4").tobytes(),
        (items >> U64(32)).astype(np.uint8).tobytes(),
    ]


def long_names(low: bytes, high: bytes) -> np.ndarray:
    return np.frombuffer(low, "<u4").astype(U64) | np.frombuffer(high, np.uint8).astype(U64) << U64(32)


# Kinds of rows between texts and parts, in the order in which a task meets them.
FILTER, LOCAL, ASKED, ANSWER, PAIRS, RARE = range(6)


def row(kind: int, part: int, block: int, data: list[bytes], ids: pa.Array) -> pa.RecordBatch:
    """One row; ``ids`` of the block's texts, or none of their type."""
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([kind], pa.int8()),
            pa.array([block], pa.int64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([data], pa.list_(pa.binary())),
        ],
        names=["part", "kind", "block", "ids", "data"],
    )


def row_type(kind: str) -> str:
    return f"part int, kind tinyint, block long, ids array<{kind}>, data array<binary>"


def met(rows: DataFrame, by: str, tasks: int | None = None) -> DataFrame:
    """The rows, those of one part or block behind one another and in the order of kinds."""
    dealt = rows.repartition(tasks, by) if tasks else rows.repartition(by)
    return dealt.sortWithinPartitions(by, "kind")


def small_batches(spark: SparkSession) -> None:
    """Rows hold arrays: few of them at a time go to a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


# ---------------------------------------------------------------- the model


@dataclass(frozen=True)
class Model:
    """Head words (sorted hashes) with exact counts, the totals, and the folder with the
    parts: of each its bits and its other words with their counts."""

    head: np.ndarray
    head_counts: np.ndarray
    train_tokens: int
    train_words: int
    strength: float
    filter: str
    parts: int

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a hash is a head word, and its count."""
        return looked_up(self.head, self.head_counts, hashes)

    @property
    def scale(self) -> float:
        """log10 of what counts of words are divided by."""
        return float(np.log10(self.train_tokens + self.train_words + 1.0))

    def share(self, counts: np.ndarray) -> np.ndarray:
        """The unigram probability of words with these counts."""
        return 10.0 ** (np.log10(counts + 1.0) - self.scale)

    def gain(self, joint: np.ndarray, share: np.ndarray) -> np.ndarray:
        """What a bigram's count adds to the log of its smoothed probability, by the
        unigram probability of its second word."""
        return np.log10(joint / (self.strength * share) + 1.0)

    def of_word(self, counts: np.ndarray) -> np.ndarray:
        """What a word's count adds, as word and as history, to that of an unseen one."""
        lost = np.log10(value_of(counts) / self.strength + 1.0)
        return np.log10(counts + 1.0) - lost


def looked_up(
    names: np.ndarray, counts: np.ndarray, hashes: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    if not len(names):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
    hit = names[at] == hashes
    return hit, np.where(hit, counts[at], 0)


def parts_of(
    pairs: np.ndarray, words: np.ndarray, is_head: np.ndarray, parts: int
) -> np.ndarray:
    """The part of each bigram: by its own hash, so that a frequent word's are spread; by
    that of its second word, if that is not a head word, whose count is there as well."""
    shift = U64(64 - (parts.bit_length() - 1))
    return (np.where(is_head, pairs, words) >> shift).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): the exact count of every token, by hash. Each batch is counted
    before the shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tokens.blocks(batch, 0, COUNTED):
                yield tally(stream(block.column(0))[0], "word")

    return texts.mapInArrow(task, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def least_count(counted: DataFrame, most: int) -> int:
    """The least power of two that counts of at most ``most`` items reach."""
    sizes = (
        counted.groupBy(F.floor(F.log2("n")).cast("int").alias("power"))
        .agg(F.count(F.lit(1)).alias("items"))
        .collect()
    )  # 64 rows at most
    limit, total = 1, 0
    for power, items in sorted(sizes, reverse=True):
        total += items
        if total > most:
            limit = 1 << (power + 1)
            break
    return limit


def summed(items: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each item once, sorted, with the sum of its counts."""
    order = ordered(items)
    items, counts = items[order], counts[order]
    firsts = np.flatnonzero(np.diff(items, prepend=~items[:1]) != 0)
    return items[firsts], np.add.reduceat(counts, firsts) if len(firsts) else counts


NO_IDS = pa.array([], pa.int64())


def pair_rows(texts: DataFrame, head: np.ndarray, parts: int) -> DataFrame:
    """Rows of kind PAIRS: a part's bigrams in some texts, and their counts there."""
    shared_head = texts.sparkSession.sparkContext.broadcast(head)

    def send(keys: np.ndarray, of: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = ordered(of)
        keys, of, counts = keys[order], of[order], counts[order]
        firsts = runs(of)
        for a, b in zip(firsts, [*firsts[1:], len(of)], strict=True):
            data = [*short_names(keys[a:b] & NAME), packed(counts[a:b])]
            yield row(PAIRS, int(of[a]), 0, data, NO_IDS)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for block in tokens.blocks(batch, 0, COUNTED):
                hashes, rows = stream(block.column(0))
                distinct, at = distinct_words(hashes)
                is_head, _ = looked_up(shared_head.value, shared_head.value, distinct)
                pairs = pair_hash(histories(hashes, rows), hashes)
                order = together(pairs)
                firsts = runs(pairs[order])
                n = np.diff(firsts, append=len(order))
                found, word = pairs[order[firsts]], at[order[firsts]]
                of = parts_of(found, distinct[word], is_head[word], parts)
                held.append((found, of, n))
                if sum(len(x) for x, _, _ in held) > MOST_HELD:
                    yield from send(*united(held))
                    held = []
        if held:
            yield from send(*united(held))

    return texts.mapInArrow(task, row_type("bigint"))


def united(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Items, their parts, and counts, of several blocks: each item once, but for those
    that ``together`` leaves apart, whose counts are summed in their part."""
    if len(held) == 1:
        return held[0]
    items, of, counts = (np.concatenate(x) for x in zip(*held, strict=True))
    order = together(items)
    items, of, counts = items[order], of[order], counts[order]
    firsts = runs(items)
    return items[firsts], of[firsts], np.add.reduceat(counts, firsts)


def rare_rows(words: DataFrame, parts: int) -> DataFrame:
    """Rows of kind RARE: words of a part and their counts."""
    shift = 64 - (parts.bit_length() - 1)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_numpy().view(U64)
            of, counts = names >> U64(shift), batch.column(1).to_numpy()
            for part in np.unique(of):
                own = of == part
                data = [names[own].tobytes(), packed(counts[own])]
                yield row(RARE, int(part), 0, data, NO_IDS)

    return words.select("word", "n").mapInArrow(task, row_type("bigint"))


def filter_rows(rows: DataFrame, parts: int) -> DataFrame:
    """A row of kind FILTER per part: its bits, its other words sorted, their counts."""

    def made(part: int, pairs: list, rare: list) -> pa.RecordBatch:
        nothing = (np.zeros(0, U64), np.zeros(0, np.int64))
        items, counts = gathered(pairs) if pairs else nothing
        words, word_counts = gathered(rare) if rare else nothing
        data = [filled(items, counts).tobytes(), words.tobytes(), packed(word_counts)]
        return row(FILTER, part, 0, data, NO_IDS)

    def gathered(held: list) -> tuple[np.ndarray, np.ndarray]:
        names, counts = (np.concatenate(x) for x in zip(*held, strict=True))
        return summed(names, counts)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, pairs, rare, size = None, [], [], 0
        for batch in batches:
            for part, kind, data in zip(
                *(batch.column(c).to_pylist() for c in ("part", "kind", "data")), strict=True
            ):
                if part != at:
                    if at is not None:
                        yield made(at, pairs, rare)
                    at, pairs, rare, size = part, [], [], 0
                if kind == PAIRS:
                    pairs.append((long_names(data[0], data[1]), unpacked(data[2])))
                    size += len(pairs[-1][0])
                    if size > 2 * MOST_HELD:  # what repeats among blocks counts once
                        pairs = [gathered(pairs)]
                        size = 0
                else:
                    rare.append((np.frombuffer(data[0], U64), unpacked(data[1])))
        if at is not None:
            yield made(at, pairs, rare)

    return met(rows, "part", parts).mapInArrow(task, row_type("bigint"))


def stored(df: DataFrame, name: str) -> str:
    """The folder in the shared one that now holds ``df``."""
    path = shared.work_folder(df.sparkSession, name)
    df.write.parquet(path)
    return path


def fit(
    texts: DataFrame,
    head_words: int = 1 << 20,
    max_filter_bits: int = 1 << 26,
    strength: float = 64.0,
    text_col: str = "text",
) -> Model:
    """Learn from all ``texts``.

    ``head_words`` bounds what is broadcast (16 bytes a word), and ``max_filter_bits``
    roughly the bits of a part, not what is counted: all words are counted exactly and
    all bigrams are in the filter, which has as many parts as it takes.
    ``strength`` is the weight of the unigram model in a bigram's probability, in
    counts of the history. Null texts count as empty: one end token.
    """
    spark = texts.sparkSession
    small_batches(spark)
    only = texts.select(F.col(text_col))
    counted = spark.read.parquet(stored(word_counts(only), "words"))
    train_tokens, train_words = counted.agg(F.sum("n"), F.count(F.lit(1))).first()
    train_tokens = int(train_tokens or 0)
    head_least = least_count(counted, head_words)
    top = counted.filter(F.col("n") >= head_least).toArrow()
    names = top.column("word").to_numpy().view(U64)
    order = np.argsort(names)
    head, head_counts = names[order], top.column("n").to_numpy()[order].astype(np.int64)
    parts = LEAST_PARTS
    while parts * max_filter_bits < BITS_EACH * train_tokens:
        parts *= 2
    rare = rare_rows(counted.filter(F.col("n") < head_least), parts)
    rows = pair_rows(only, head, parts).unionByName(rare)
    return Model(
        head=head,
        head_counts=head_counts,
        train_tokens=train_tokens,
        train_words=int(train_words),
        strength=strength,
        filter=stored(filter_rows(rows, parts), "filter"),
        parts=parts,
    )


# ---------------------------------------------------------------- scoring


def sent(block: int, ids: pa.Array, column: pa.Array, model: Model) -> Iterator[pa.RecordBatch]:
    """A row of kind LOCAL, with the texts' ids and what needs no part, and for each part
    one of kind ASKED: of each second word the bigrams that follow and its count if it is
    a head word, else its hash; of each bigram of a text its name, the text, how often."""
    n = len(column)
    hashes, rows = stream(column)
    distinct, at = distinct_words(hashes)
    is_head, counts = model.known(distinct)
    before = np.concatenate((at[-1:], at[:-1]))
    before[np.flatnonzero(np.diff(rows, prepend=-1))] = np.searchsorted(distinct, END)
    # A text's histories are its tokens, so a word counts as often as either.
    n_tokens = np.bincount(rows, minlength=n)
    n_known = np.bincount(rows, (counts > 0)[at], n)
    base = np.bincount(rows, np.log10(counts + 1.0)[at], n) - n_tokens * model.scale
    gain = np.bincount(rows, model.of_word(counts)[at], n) - n_tokens * model.scale

    pairs = pair_hash(distinct[before], hashes)
    # Those of one text; a pair that ``together`` leaves apart is sent twice, once each.
    own = tokens.mix(pairs + rows.astype(U64) * U64(0x9E3779B97F4A7C15))
    order = together(own)
    firsts = runs(own[order])
    first, times = order[firsts], np.diff(firsts, append=len(order))
    word, pairs, rows = at[first], pairs[first], rows[first]
    of = parts_of(pairs, distinct[word], is_head[word], model.parts)
    # By part, then head words, then word.
    group = (of * 2 + ~is_head[word]) * len(distinct) + word
    order = ordered(group)
    group, of, word = group[order], of[order], word[order]
    pairs, rows, times = pairs[order], rows[order], times[order]
    groups, starts = runs(group), runs(of)
    data = [packed(np.array([len(starts)])), packed(n_tokens), packed(n_known)]
    data += [base.tobytes(), gain.tobytes()]
    yield row(LOCAL, block % model.parts, block, data, ids)
    for a, b in zip(starts, [*starts[1:], len(of)], strict=True):
        own = groups[np.searchsorted(groups, a) : np.searchsorted(groups, b)]
        sizes, whose = np.diff(own, append=b), word[own]
        head = is_head[whose]
        data = [
            packed(np.array([n])),
            packed(sizes),
            packed(counts[whose[head]]),
            distinct[whose[~head]].tobytes(),
            *short_names(pairs[a:b] & NAME),
            packed(rows[a:b]),
            packed(times[a:b]),
        ]
        yield row(ASKED, int(of[a]), block, data, ids.slice(0, 0))


def answered(asked: list[bytes], held: list[bytes] | None, model: Model) -> list[bytes]:
    """The sums of a block's texts over what a part holds: the texts that have words of
    the part, how many of these words are known and what they add to the base score; what
    words and bigrams add to the score."""
    n, sizes = int(unpacked(asked[0])[0]), unpacked(asked[1])
    head, rare = unpacked(asked[2]), np.frombuffer(asked[3], U64)
    rows, times = unpacked(asked[6]), unpacked(asked[7])
    if held is None:
        return [packed(rows[:0]), packed(rows[:0]), b"", np.zeros(n).tobytes()]
    array = np.frombuffer(held[0], np.uint8)
    _, found = looked_up(np.frombuffer(held[1], U64), unpacked(held[2]), rare)
    of_words = np.concatenate([head, found])
    share = model.share(of_words)
    counts, of = np.repeat(of_words, sizes), np.repeat(np.arange(len(sizes)), sizes)
    here = (of >= len(head)) & (counts > 0)
    # No bigram has a second word that was never seen; one that was not seen adds nothing.
    seen = np.flatnonzero(counts > 0)
    levels = probe(array, long_names(asked[4], asked[5])[seen])
    met_, levels = seen[levels > 0], levels[levels > 0]
    gain = np.zeros(len(counts))
    gain[met_] = model.gain(value(np.arange(64 * STEPS + 1))[levels], share[of[met_]])
    gain[here] += model.of_word(counts[here])
    whose, place = np.unique(rows[here], return_inverse=True)
    base = np.bincount(place, np.log10(counts[here] + 1.0) * times[here], len(whose))
    known = np.bincount(place, times[here], len(whose)).astype(np.int64)
    sums = np.bincount(rows, gain * times, n)
    return [packed(whose), packed(known), base.tobytes(), sums.tobytes()]


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, n_tokens, n_known, train_tokens, base_score, score.

    base_score sums log10((c + 1) / (N + V + 1)) over a text's tokens, with exact
    counts. score sums log10((c(h, w) + s * p(w)) / (c(h) + s)): p the same unigram
    probability, s the model's strength, c(h) quantised, c(h, w) by probes of the filter.
    A filter errs upwards only, and never for a word that was not seen.

    A block of texts sends each part one row of arrays and gets one back; a bigram
    travels once for each text that has it, so none is hot, and a frequent word's
    bigrams are spread over all parts. A task holds one part at a time. A text of null is
    one end token. Repeated rows give as many rows; other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    shared_model = spark.sparkContext.broadcast(model)
    kind = docs.schema[id_col].dataType.simpleString()

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts in tokens.blocks(batch, 1, COUNTED):
                yield from sent(block, texts.column(0), texts.column(1), shared_model.value)
                block += 1

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                what = one.column("kind")[0].as_py()
                if what == LOCAL:
                    yield one
                    continue
                data = one.column("data")[0].as_py()
                if what == FILTER or one.column("part")[0].as_py() != part:
                    part = one.column("part")[0].as_py()
                    held = data if what == FILTER else None
                if what == ASKED:
                    block = one.column("block")[0].as_py()
                    found = answered(data, held, shared_model.value)
                    yield row(ANSWER, part, block, found, one.column("ids").flatten())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_col, "n_tokens", "n_known", "base_score", "score"]
        ids, sums, missing = None, [], 0

        def whole() -> pa.RecordBatch:
            if missing:
                raise RuntimeError("a block of texts differs from that of an earlier attempt")
            return pa.RecordBatch.from_arrays([ids, *map(pa.array, sums)], names=names)

        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                data = one.column("data")[0].as_py()
                if one.column("kind")[0].as_py() == LOCAL:
                    if ids is not None:
                        yield whole()
                    ids = one.column("ids").flatten()
                    missing = int(unpacked(data[0])[0])
                    sums = [unpacked(data[1]), unpacked(data[2])]
                    sums += [np.frombuffer(x, np.float64).copy() for x in data[3:]]
                    continue
                whose = unpacked(data[0])
                sums[1][whose] += unpacked(data[1])
                sums[2][whose] += np.frombuffer(data[2], np.float64)
                sums[3] += np.frombuffer(data[3], np.float64)
                missing -= 1
        if ids is not None:
            yield whole()

    asked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        send, row_type(kind)
    )
    held = spark.read.parquet(model.filter).withColumn(
        "ids", F.array().cast(f"array<{kind}>")
    )
    answers = met(asked.unionByName(held), "part", model.parts).mapInArrow(answer, row_type(kind))
    found = met(answers, "block").mapInArrow(
        add, f"`{id_col}` {kind}, n_tokens long, n_known long, base_score double, score double"
    )
    return found.select(
        id_col,
        "n_tokens",
        "n_known",
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )

"""Exact token counts of texts and of all their prefixes.

The count at every prefix comes from one pass of dynamic programming over each distinct
word (``bpe_prefix``); words are set apart by white space, so the count at a place in a
text is the sum of the words before and the count at that place of its word. Questions
of budget and truncation read these counts; no prefix is encoded again.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from strandline.llm import tokens
from strandline.llm.bpe_prefix import Merges, flat

BLOCK_BYTES = 8 << 20
JOINED = 1 << 18  # code points normalised at a time
# How the tokenizer cuts normalised text into pieces, and the pieces that
# its list of endings makes.
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
ENDINGS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


class Words:
    """Token counts of words and of their prefixes, by one tokenizer file's text."""

    def __init__(self, text: str) -> None:
        held = json.loads(text)
        steps = held["pre_tokenizer"]
        cuts = [s.get("pattern", {}).get("Regex") for s in steps.get("pretokenizers", [steps])]
        if PATTERN not in cuts or not held["model"].get("end_of_word_suffix"):
            raise ValueError("this needs a tokenizer that drops white space and ends each word")
        # These are found in a text before anything else.
        self.special = sorted((t["content"] for t in held["added_tokens"]), key=len, reverse=True)
        if any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
            for t in held["added_tokens"]
        ) or any(c.isspace() for s in self.special for c in s):
            raise ValueError("special tokens that take in their neighbours are not supported")
        tokenizer = Tokenizer.from_str(text)
        self.normal, self.cut = tokenizer.normalizer, tokenizer.pre_tokenizer
        self.merges = Merges(text)

    def parts(self, word: str) -> tuple[list[tuple[int, int]], int]:
        """The parts of a word between special tokens, and how many of these it has."""
        parts, at, n = [], 0, 0
        while self.special:
            found = [(word.find(s, at), -len(s)) for s in self.special if s in word[at:]]
            if not found:
                break
            start, size = min(found)
            parts.append((at, start))
            at, n = start - size, n + 1
        return [*parts, (at, len(word))], n

    def totals(self, words: pa.Array) -> np.ndarray:
        """Tokens of each word; these hold no ASCII white space."""
        total = np.zeros(len(words), np.int64)
        listed = words.to_pylist()
        # Words with special tokens, or white space beyond ASCII, are not joined to others.
        alone = np.fromiter((w.split() != [w] for w in listed), bool, len(listed))
        for s in self.special:
            alone |= pc.match_substring(words, s).to_numpy(zero_copy_only=False)
        pieces: list[str] = []
        owners: list[np.ndarray] = []
        plain = np.flatnonzero(~alone)
        at = 0
        while at < len(plain):
            stop, size = at, 0
            while stop < len(plain) and (stop == at or size < JOINED):
                size += len(listed[plain[stop]]) + 1
                stop += 1
            names, of = self._pieces([listed[w] for w in plain[at:stop].tolist()])
            pieces += names
            owners.append(plain[at + of])
            at = stop
        for w in np.flatnonzero(alone).tolist():
            parts, total[w] = self.parts(listed[w])
            for a, b in parts:
                text = self.normal.normalize_str(listed[w][a:b])
                names = [p for p, _ in self.cut.pre_tokenize_str(text)]
                pieces += names
                owners.append(np.full(len(names), w))
        if pieces:
            distinct = pa.array(pieces, pa.large_string()).dictionary_encode()
            data, offsets = flat(distinct.dictionary.to_pylist())
            ends = self.merges.count(data, offsets)[offsets[1:] - 1]
            found = ends[distinct.indices.to_numpy()]
            total += np.bincount(np.concatenate(owners), found, len(words)).astype(np.int64)
        return total

    def _pieces(self, words: list[str]) -> tuple[list[str], np.ndarray]:
        """All pieces of words without white space, and the word each is of."""
        text = self.normal.normalize_str(" ".join(words))
        signs = np.frombuffer(text.encode("utf-32-le"), "<u4")
        spaces = np.flatnonzero(signs == 0x20)
        if len(spaces) != len(words) - 1:
            raise ValueError("the tokenizer's white space is not that of Unicode")
        found = self.cut.pre_tokenize_str(text)
        starts = np.fromiter((place[0] for _, place in found), np.int64, len(found))
        return [p for p, _ in found], np.searchsorted(spaces, starts)

    def prefixes(self, word: str) -> tuple[np.ndarray, np.ndarray]:
        """Places in a word, in code points, and the tokens of its prefix up to each.

        All places count but those inside a special token and those between a letter and
        a sign that the normal form joins to it; the last place is the word's end.
        """
        places, counts, before = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], 0
        parts, _ = self.parts(word)
        for k, (a, b) in enumerate(parts):
            if k:  # behind a special token
                before += 1
                places.append(np.array([a]))
                counts.append(np.array([before]))
            if a == b:
                continue
            at, n = self._prefixes(word[a:b])
            places.append(a + at)
            counts.append(before + n)
            before += int(n[-1])
        return np.concatenate(places), np.concatenate(counts)

    def _prefixes(self, part: str) -> tuple[np.ndarray, np.ndarray]:
        clusters = joined(part)
        ends = np.cumsum([len(c) for c in clusters])
        normal = [self.normal.normalize_str(c) for c in clusters]
        text = "".join(normal)
        found = self.cut.pre_tokenize_str(text)
        # The count behind each code point of the normal form: white space adds none.
        counts = np.zeros(len(text) + 1, np.int64)
        filled, before = 0, 0
        for name, (start, stop) in found:
            counts[filled : start + 1] = before
            piece = text[start:stop]
            data, offsets = flat([name])
            by_byte = self.merges.count(data, offsets)
            width = np.cumsum([len(c.encode()) for c in piece])
            counts[start + 1 : stop + 1] = before + by_byte[width - 1]
            if piece in ENDINGS:  # shorter, it would have been cut after its first sign
                for size in range(2, len(piece)):
                    counts[start + size] = before + sum(
                        int(self.merges.count(*flat([p]))[-1])
                        for p, _ in self.cut.pre_tokenize_str(piece[:size])
                    )
            before = int(counts[stop])
            filled = stop
        counts[filled:] = np.maximum(counts[filled:], before)
        return ends, counts[np.cumsum([len(n) for n in normal])]

    def tokens_of(self, word: str, size: int) -> int:
        """Tokens of the first ``size`` code points of a word."""
        places, counts = self.prefixes(word)
        at = np.flatnonzero(places == size)
        if len(at):
            return int(counts[at[-1]])
        return int(self.totals(pa.array([word[:size]], pa.large_string()))[0])


@cache
def _behind() -> frozenset[str]:
    """Signs that a normal form may join to the sign before them."""
    found = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            found.add(chr(int(parts[1], 16)))
    found.update(map(chr, range(0x1161, 0x1176)), map(chr, range(0x11A8, 0x11C3)))
    return frozenset(found)


def joined(text: str) -> list[str]:
    """The text in runs that normalise each for itself: a sign and what joins it."""
    if unicodedata.is_normalized("NFC", text):
        return list(text)  # so is every prefix
    starts = [0] + [
        i
        for i, c in enumerate(text)
        if i and not unicodedata.combining(c) and c not in _behind()
    ]
    return [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)], strict=True)]


_WORDS: dict[int, Words] = {}


def held(file: Broadcast[str]) -> Words:
    """The tables of a tokenizer file, made once per Python worker."""
    key = hash(file.value)
    if key not in _WORDS:
        _WORDS.clear()
        _WORDS[key] = Words(file.value)
    return _WORDS[key]


class Block:
    """The words of some texts, each distinct one counted once."""

    def __init__(self, words: Words, texts: pa.Array) -> None:
        texts = texts.cast(pa.large_string()).fill_null("")
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        self.words, self.distinct = words, coded.dictionary
        self.codes = coded.indices.to_numpy()
        self.edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        self.totals = words.totals(coded.dictionary)[self.codes]
        self.sums = np.concatenate(([0], np.cumsum(self.totals)))
        self.texts = texts

    def counts(self) -> np.ndarray:
        return self.sums[self.edges[1:]] - self.sums[self.edges[:-1]]

    def places(self, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the words of a text: where they start and end, in code points, their
        numbers in ``distinct`` and the tokens up to their ends."""
        data, offsets = tokens.utf8(self.texts.slice(row, 1))
        solid = np.concatenate(([False], ~tokens.SPACE[data], [False]))
        firsts = np.flatnonzero(solid[1:] & ~solid[:-1])
        ends = np.flatnonzero(solid[:-1] & ~solid[1:])
        signs = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
        inside = slice(int(self.edges[row]), int(self.edges[row + 1]))
        codes, totals = self.codes[inside], self.totals[inside]
        empty = pc.equal(self.distinct, "").to_numpy(zero_copy_only=False)
        solid_words = ~empty[codes]
        totals = np.cumsum(totals[solid_words])
        return signs[firsts], signs[ends], codes[solid_words], totals

    def cut(self, row: int, budget: int) -> tuple[int, int]:
        """The longest prefix of a text within the budget: code points and tokens."""
        starts, ends, codes, totals = self.places(row)
        n = int(np.searchsorted(totals, budget, side="right"))
        before = int(totals[n - 1]) if n else 0
        if n == len(codes):
            return len(self.texts[row].as_py()), before
        at, counts = self.words.prefixes(self.distinct[int(codes[n])].as_py())
        fits = np.flatnonzero(before + counts <= budget)[-1]
        return int(starts[n] + at[fits]), before + int(counts[fits])

    def at(self, row: int, place: int) -> int:
        """Tokens of the first ``place`` code points of a text."""
        starts, ends, codes, totals = self.places(row)
        n = int(np.searchsorted(ends, place, side="right"))
        before = int(totals[n - 1]) if n else 0
        if n == len(codes) or place <= starts[n]:
            return before
        return before + self.words.tokens_of(self.distinct[int(codes[n])].as_py(), place - int(starts[n]))


def _per_block(
    docs: DataFrame,
    tokenizer: str,
    columns: list[Column],
    schema: str | StructType,
    work: Callable[[Block, pa.RecordBatch], list[pa.Array]],
) -> DataFrame:
    """``work`` over blocks of texts (the first column); it gives the schema's columns."""
    with open(tokenizer, encoding="utf-8") as file:
        text = file.read()
    Words(text)  # refuses other kinds here and not in a task
    shared = docs.sparkSession.sparkContext.broadcast(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tokens.blocks(batch, 0, BLOCK_BYTES):
                out = work(Block(held(shared), part.column(0)), part)
                yield pa.RecordBatch.from_arrays(out, names=names)

    out = docs.select(*columns)
    frame = out.sparkSession.createDataFrame([], schema)
    names = frame.columns
    return out.mapInArrow(task, frame.schema)


def _id_type(docs: DataFrame, id_col: str) -> str:
    return docs.schema[id_col].dataType.simpleString()


def count(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row of ``docs``: its id, n_bytes (UTF-8), n_tokens, over_limit.

    Counts are those of the ``tokenizers`` library for the file, without special tokens
    added; a special token's string in a text counts as that one token. A null text is
    empty and has 0 tokens. Ids may be of any type, null or repeated; each row is
    counted. Other columns of ``docs`` play no part. Nothing is shuffled, and a task
    holds one block of about 8 MB of text, or one longer text.
    """

    def work(block: Block, part: pa.RecordBatch) -> list[pa.Array]:
        sizes = pc.coalesce(pc.binary_length(part.column(0)), pa.scalar(0)).cast(pa.int64())
        counts = block.counts()
        return [part.column(1), sizes, pa.array(counts), pa.array(counts > limit)]

    schema = f"id {_id_type(docs, id_col)}, n_bytes long, n_tokens long, over_limit boolean"
    columns = [F.col(text_col).alias("text"), F.col(id_col).alias("id")]
    return _per_block(docs, tokenizer, columns, schema, work).withColumnRenamed("id", id_col)


def truncate(
    docs: DataFrame,
    tokenizer: str,
    budget: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: its id, kept_chars, kept_tokens and kept, the longest prefix of the text
    with at most ``budget`` tokens.

    Counts of prefixes may fall as a word grows ("hel" has more tokens than "hello"), so
    the longest is taken, not the first to reach the budget. A cut parts no special token
    and no letter from its marks. A text within the budget is kept whole; a null text
    gives an empty one.
    """

    def work(block: Block, part: pa.RecordBatch) -> list[pa.Array]:
        counts = block.counts()
        sizes = pc.utf8_length(block.texts).to_numpy().astype(np.int64)
        kept = block.texts.to_pylist()
        for row in np.flatnonzero(counts > budget).tolist():
            sizes[row], counts[row] = block.cut(row, budget)
            kept[row] = kept[row][: sizes[row]]
        return [part.column(1), pa.array(sizes), pa.array(counts), pa.array(kept, pa.string())]

    schema = f"id {_id_type(docs, id_col)}, kept_chars long, kept_tokens long, kept string"
    columns = [F.col(text_col).alias("text"), F.col(id_col).alias("id")]
    return _per_block(docs, tokenizer, columns, schema, work).withColumnRenamed("id", id_col)


def tokens_before(
    docs: DataFrame,
    tokenizer: str,
    place_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: its id, the place (a number of code points) and n_tokens, the tokens of
    the text up to there. Any place may be asked for; beyond the text's end it is the
    whole text, a negative or null place is 0."""

    def work(block: Block, part: pa.RecordBatch) -> list[pa.Array]:
        places = part.column(2)
        found = [
            block.at(row, max(0, place or 0)) for row, place in enumerate(places.to_pylist())
        ]
        return [part.column(1), places, pa.array(found, pa.int64())]

    schema = f"id {_id_type(docs, id_col)}, place long, n_tokens long"
    columns = [
        F.col(text_col).alias("text"),
        F.col(id_col).alias("id"),
        F.col(place_col).cast("long").alias("place"),
    ]
    return _per_block(docs, tokenizer, columns, schema, work).withColumnRenamed("id", id_col)


def word_table(
    docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: its id, ``places`` where its words end, in code points, and ``totals``,
    the tokens up to each. Stored, it answers budgets with ``fitting`` alone."""

    def work(block: Block, part: pa.RecordBatch) -> list[pa.Array]:
        found = [block.places(row) for row in range(part.num_rows)]
        kind = pa.list_(pa.int64())
        return [
            part.column(1),
            pa.array([ends for _, ends, _, _ in found], kind),
            pa.array([totals for *_, totals in found], kind),
        ]

    schema = f"id {_id_type(docs, id_col)}, places array<long>, totals array<long>"
    columns = [F.col(text_col).alias("text"), F.col(id_col).alias("id")]
    return _per_block(docs, tokenizer, columns, schema, work).withColumnRenamed("id", id_col)


def fitting(table: DataFrame, budget: int) -> DataFrame:
    """A ``word_table`` with ``kept_chars`` and ``kept_tokens``: the most whole words
    within the budget."""
    words = F.size(F.filter("totals", lambda t: t <= budget))
    last = lambda name: F.when(words > 0, F.get(name, words - 1)).otherwise(0).cast("long")
    return table.withColumns({"kept_chars": last("places"), "kept_tokens": last("totals")})

"""Token counts of texts and prefixes against the tokenizer's library."""

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strandline.llm import token_counts
from strandline.llm.bpe_prefix import Merges, flat

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as file:
    WORDS = token_counts.Words(file.read())

# Combining marks, jamo, signs with two lower-case signs, white space beyond ASCII,
# endings, special tokens and parts of them.
SIGNS = st.sampled_from(
    [*"aetohrnsldAZ'19 \t\n\x0b\x1c\x85\xa0.#$", "é", "é", "́", "̧", "İ", "Σ", "ß"]
    + ["가", "ᆨ", "가", "日", "本", "😀", " ", "'re", "'S", "'ll", "the", "and"]
    + ["<|endoftext|>", "<|startoftext|>", "<|end", "|>", "\x00", "क़", "½", "٣"]
)
TEXT = st.lists(SIGNS, max_size=25).map("".join)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.none() | TEXT, min_size=1, max_size=5))
def test_whole_texts(texts):
    block = token_counts.Block(WORDS, pa.array(texts, pa.string()))
    assert block.counts().tolist() == [library(t or "") for t in texts]


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_every_prefix(text):
    block = token_counts.Block(WORDS, pa.array([text], pa.string()))
    found = [block.at(0, n) for n in range(len(text) + 2)]
    assert found == [library(text[:n]) for n in range(len(text) + 2)]


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(0, 12))
def test_longest_prefix_within_a_budget(text, budget):
    block = token_counts.Block(WORDS, pa.array([text], pa.string()))
    size, n = block.cut(0, budget)
    assert n == library(text[:size]) <= budget
    # Longer prefixes are over the budget, or end inside a letter or a special token.
    for longer in range(size + 1, len(text) + 1):
        if library(text[:longer]) <= budget:
            head = text[: longer + 16].rsplit(" ", 1)[-1]
            rest = text[longer : longer + 16]
            inside = any(
                text.find(s, max(0, longer - len(s) + 1), longer + len(s) - 1) >= 0
                for s in ("<|endoftext|>", "<|startoftext|>")
            )
            assert inside or rest[:1] in token_counts._behind() or rest[:1] in "̧́", head


@pytest.mark.parametrize("unit", ["a", "ha", "the", "日本", "#", "ab1", "é"])
def test_long_words(unit):
    """Beyond the vectorised width, one word of one sign repeated."""
    text = unit * 400
    block = token_counts.Block(WORDS, pa.array([text], pa.string()))
    assert block.counts().tolist() == [library(text)]
    for n in (1, 127, 128, 129, 255, len(text) - 1):
        assert block.at(0, n) == library(text[:n])
    size, n = block.cut(0, 30)
    assert n == library(text[:size]) <= 30


def test_both_ways_of_counting_agree():
    rng = np.random.default_rng(1)
    pieces = ["".join(rng.choice(list("aehrt"), n)) for n in rng.integers(1, 120, 200)]
    data, offsets = flat(pieces)
    together = WORDS.merges.count(data, offsets)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        assert WORDS.merges._one(data[a:b].tobytes()).tolist() == together[a:b].tolist()


def test_other_vocabularies_are_refused(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="ends each word"):
        token_counts.count(docs, public_tokenizers.path("byte_bpe_50k.json"))
    with pytest.raises(ValueError, match="byte-pair"):
        Merges('{"model": {"type": "WordPiece", "vocab": {}, "merges": []}}')


def test_rows_of_any_kind(spark):
    rows = [("a", "Hello <|endoftext|> there", 1), ("a", None, 2), (None, "", 3)]
    rows += [("a", "Hello <|endoftext|> there", 1), ("b", "x" * 5000 + " y", 4)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, n_tokens int")
    found = token_counts.count(docs, PATH, limit=3).collect()
    assert len(found) == 5
    for r in found:
        text = next(t or "" for i, t, _ in rows if i == r.doc_id and len(t or "") == r.n_bytes)
        assert r.n_tokens == library(text)
        assert r.over_limit == (r.n_tokens > 3)
    assert token_counts.count(docs.limit(0), PATH).count() == 0
    cut = {(r.doc_id, r.kept_chars): r for r in token_counts.truncate(docs, PATH, budget=2).collect()}
    assert cut["a", 20].kept == "Hello <|endoftext|> " or cut["a", 19].kept == "Hello <|endoftext|>"
    assert cut["a", 0].kept == "" and cut[None, 0].kept_tokens == 0
    table = token_counts.word_table(docs, PATH)
    for r in token_counts.fitting(table, 2).filter("doc_id = 'a' AND size(totals) > 0").collect():
        assert (r.places, r.totals) == ([5, 19, 25], [1, 2, 3])
        assert (r.kept_chars, r.kept_tokens) == (19, 2)
    asked = token_counts.tokens_before(docs.withColumn("at", docs.n_tokens * 8), PATH, "at")
    assert {r.n_tokens for r in asked.filter("place = 8").collect()} == {library("Hello <|")}


def test_white_space_is_that_of_python():
    """Words are joined where Python sees no white space in them; the tokenizer must
    then see none either."""
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and " " in WORDS.normal.normalize_str(f"a{chr(code)}b"):
            assert chr(code).isspace(), hex(code)

"""Word hashes, shingles and suffix arrays against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import suffix_array, tokens

TEXT = st.text(alphabet="aAbB \t\n\x0b\x1cé日", max_size=40)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", lowered(text or ""))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6), st.sampled_from([4, 7, 1 << 20]))
def test_words_are_those_of_the_pattern(texts, chunk):
    tokens.CHUNK, before = chunk, tokens.CHUNK
    try:
        hashes, rows, firsts, ends = tokens.words(pa.array(texts, pa.string()), places=True)
    finally:
        tokens.CHUNK = before
    expected = [(i, w) for i, t in enumerate(texts) for w in plain_words(t)]
    assert rows.tolist() == [i for i, _ in expected]
    found = [
        lowered((texts[r] or "").encode()[a:b].decode())
        for r, a, b in zip(rows, firsts, ends, strict=True)
    ]
    assert found == [w for _, w in expected]
    assert len(set(hashes.tolist())) == len({w for _, w in expected})


def test_shingles_stay_in_their_row():
    hashes, rows = tokens.words(pa.array(["a b c", "b c", None, "a b c d"]))
    found, of = tokens.shingles(hashes, rows, 3)
    assert of.tolist() == [0, 3, 3]
    assert found[0] == found[1] != found[2]


def test_blocks_cover_all_rows():
    batch = pa.record_batch({"t": ["a" * n for n in (3, 0, 9, 1, 1)]})
    assert [b.num_rows for b in tokens.blocks(batch, 0, 4)] == [2, 1, 2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=30), st.integers(1, 6))
def test_suffix_array_and_common_prefixes(symbols, length):
    s = [*symbols, 0]
    order = sorted(range(len(s)), key=lambda i: s[i:])
    found = suffix_array.suffix_array(np.array(s), 4)
    assert found.tolist() == order
    near = suffix_array.reaching(np.array(s), found, length)
    for one, two in zip(order, order[1:], strict=False):
        both = s[one : one + length], s[two : two + length]
        assert near[two] == (both[0] == both[1] and len(both[0]) == length)


def test_tiny_suffix_arrays():
    assert suffix_array.suffix_array(np.array([0]), 1).tolist() == [0]
    assert suffix_array.suffix_array(np.array([1, 0]), 2).tolist() == [1, 0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=200), st.sampled_from([np.int16, np.int64]), st.integers(1, 60))
def test_recursion_and_permuted_prefixes(symbols, kind, most):
    """Long repeats make equal names at several levels."""
    for s in ([*symbols, 0], [*(symbols * 3), 0], [*[1, 2] * len(symbols), 0]):
        want = sorted(range(len(s)), key=lambda i: s[i:])
        text = np.array(s, kind)
        found = suffix_array.suffix_array(text, 4)
        assert found.tolist() == want
        before, suffix_array.BUCKETS = suffix_array.BUCKETS, 0
        try:
            assert suffix_array.suffix_array(text, 4).tolist() == want
        finally:
            suffix_array.BUCKETS = before
        prefixes = suffix_array.permuted_prefixes(text, found, most)
        expected = {want[0]: 0}
        for before, i in zip(want, want[1:], strict=False):
            n = 0
            while n < most and max(before, i) + n < len(s) and s[before + n] == s[i + n]:
                n += 1
            expected[i] = n
        assert prefixes.tolist() == [expected[i] for i in range(len(s))]

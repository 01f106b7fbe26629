"""Benchmark items in texts: whole, edited, and not there."""

import random
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strandline.llm import decontaminate

SF = "/root/testdata/sf0.001"


def plain_distance(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=80), st.text(alphabet="abc", max_size=90))
def test_edit_distance(item, text):
    item = bytes(97 + b % 3 for b in item)
    assert decontaminate.edit_distance(item, text.encode(), 99) == plain_distance(item, text.encode())


@pytest.fixture(scope="module")
def items(spark):
    rows = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    return {r.item_id: r.text for r in rows}


def shout(text):
    return "".join(c.upper() if c.isascii() else c for c in text)


def edited(text, share, r):
    out = list(text)
    for _ in range(int(len(text) * share)):
        at = r.randrange(len(out))
        what = r.random()
        if what < 0.4:
            out[at] = r.choice("abcdefgh")
        elif what < 0.7:
            out.insert(at, r.choice("abcdefgh"))
        else:
            del out[at]
    return "".join(out)


@pytest.mark.parametrize(("share", "recall"), [(0.0, 1.0), (0.04, 0.97), (0.08, 0.9)])
def test_recall_and_precision(spark, items, share, recall):
    r = random.Random(8)
    docs, hidden = [], {}
    filler = "plain filler words that no item holds and go on for a while "
    for n in range(200):
        item = r.choice(list(items))
        hidden[n] = item
        docs.append((n, f"{filler}{shout(edited(items[item], share, r))}\n {filler}", "x"))
        docs.append((1000 + n, filler * r.randint(1, 5), "x"))
    frame = spark.createDataFrame(docs, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    rows = decontaminate.matches(frame, bench).collect()
    found = {(x.doc_id, x.item_id) for x in rows}
    assert len(found) == len(rows)
    assert sum((n, i) in found for n, i in hidden.items()) >= recall * len(hidden)
    assert {d for d, _ in found} <= set(hidden)
    for x in rows:
        assert x.distance <= 0.1 * len(items[x.item_id].encode())


def cut_items(items, words):
    """The items' first words; for no number, texts without blanks."""
    if words:
        return [" ".join(t.split()[:words]) for t in items.values()]
    r = random.Random(5)
    return ["".join(chr(0x4E00 + r.randrange(3000)) for _ in range(40)) for _ in range(40)]


@pytest.mark.parametrize("words", [3, 4, 5, 6, 8, 12, 24, 99, None])
def test_every_match_at_the_limit_is_found(spark, items, words):
    """All items within 10 % of edits, by length, also short ones and without blanks."""
    r = random.Random(8)
    some = cut_items(items, words)
    bench = spark.createDataFrame(list(enumerate(some)), "item_id long, text string")
    docs, expected = [], {}
    for n in range(150):
        at = r.randrange(len(some))
        text = f"before it {edited(some[at], 0.1, r)} behind it"
        docs.append((n, text))
        item = " ".join(some[at].split()).encode().lower()
        place = " ".join(text.split()).encode().lower()
        distance = decontaminate.edit_distance(item, place, 99)
        if distance <= int(len(item) * 0.1):
            expected[n, at] = distance
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(x.doc_id, x.item_id): x.distance for x in decontaminate.matches(frame, bench).collect()}
    assert len(expected) > 100
    assert expected.items() <= found.items()


@pytest.mark.parametrize("words", [3, 4, 6, 8, 12, 24, 99, None])
def test_windows_of_matches_meet(items, words, monkeypatch):
    """Recall of walks and samples at the most edits; without them nothing is found."""
    r = random.Random(21)
    some = cut_items(items, words)
    known = decontaminate.items_of(list(range(len(some))), some, 0.1)
    texts, expected = [], []
    for _ in range(300):
        at = r.randrange(len(some))
        text = f"before it {edited(some[at], 0.1, r)} behind it"
        item = " ".join(some[at].split()).encode().lower()
        place = " ".join(text.split()).encode().lower()
        if decontaminate.edit_distance(item, place, 99) <= int(len(item) * 0.1):
            expected.append((len(texts), at))
            texts.append(text)
    row, item, _ = decontaminate.batch_matches(pa.array(texts), known)
    found = set(zip(row.tolist(), item.tolist(), strict=True))
    assert sum(x in found for x in expected) >= 0.98 * len(expected) > 200
    monkeypatch.setattr(decontaminate, "WALKS", 0)
    row, _, _ = decontaminate.batch_matches(pa.array(texts), known)
    assert len(row) == 0


@pytest.mark.parametrize(("unit", "size"), [("a", 2_000_000), ("ab ", 20_000), ("日", 9_000)])
def test_very_repetitive_texts(items, unit, size, monkeypatch):
    """Every place of the text meets every seed of an item: memory stays bounded."""
    some = [unit * 200, "unlike it in every way", *list(items.values())[:5]]
    if size < 10**6:
        some.append((unit * 200)[:-3] + "zz")  # never found whole, so never settled
        monkeypatch.setattr(decontaminate, "MOST_HITS", 1 << 14)
    known = decontaminate.items_of(list(range(len(some))), some, 0.1)
    texts = pa.array([(unit * size)[:size], unit * 150, None])
    tracemalloc.start()
    row, item, distance = decontaminate.batch_matches(texts, known)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 500 << 20
    found = {(a, b): c for a, b, c in zip(row.tolist(), item.tolist(), distance.tolist(), strict=True)}
    assert found.pop((0, 0)) == 0
    assert all(row == 0 and 0 < c <= 3 for (row, _), c in found.items())
    assert len(found) == (size < 10**6)


def test_stretches_change_nothing(items, monkeypatch):
    r = random.Random(4)
    some = [*cut_items(items, None)[:20], *list(items.values())[:20], "aaaaaaaaaaaaaaaaaaaa"]
    known = decontaminate.items_of(list(range(len(some))), some, 0.1)
    texts = ["".join(f"{edited(r.choice(some), 0.05, r)} x " for _ in range(20)) for _ in range(20)]
    texts += ["a" * 3000, "", None]

    def found():
        return sorted(zip(*(x.tolist() for x in decontaminate.batch_matches(pa.array(texts), known)), strict=True))

    whole = found()
    monkeypatch.setattr(decontaminate, "MOST_HITS", 50)
    assert [x[:2] for x in found()] == [x[:2] for x in whole] and len(whole) > 200


def test_against_all_documents_and_items(spark, items):
    """Every pair of the whole table, by the exact distance of text and item."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60).collect()
    some = dict(list(items.items())[:12])
    frame = spark.createDataFrame([(d.doc_id, d.text) for d in docs], "doc_id long, text string")
    bench = spark.createDataFrame(list(some.items()), "item_id long, text string")
    found = {(x.doc_id, x.item_id) for x in decontaminate.matches(frame, bench).collect()}
    want = set()
    for d in docs:
        place = " ".join((d.text or "").split()).encode().lower()
        for i, t in some.items():
            item = " ".join(t.split()).encode().lower()
            if decontaminate.edit_distance(item, place, 99) <= int(len(item) * 0.1):
                want.add((d.doc_id, i))
    assert found == want


def test_items_in_parts_and_odd_rows(spark, items, monkeypatch):
    some = list(items.items())[:7]
    bench = spark.createDataFrame(
        [*some, some[0], (None, "a b c"), (99, None), (98, ""), (97, "one")],
        "item_id long, text string",
    )
    docs = spark.createDataFrame(
        [(i, t) for i, t in some] + [(1, some[0][1])] * 2 + [(50, None), (51, ""), (52, "One")],
        "doc_id long, text string",
    )
    whole = sorted(decontaminate.matches(docs, bench).collect())
    assert {(r.doc_id, r.item_id) for r in whole} >= {(52, 97), *((i, i) for i, _ in some)}
    assert not {50, 51} & {r.doc_id for r in whole}
    monkeypatch.setattr(decontaminate, "MAX_ITEMS", 3)
    assert sorted(decontaminate.matches(docs, bench).collect()) == whole


def test_empty_tables(spark, items):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    assert decontaminate.matches(docs.limit(0), bench).count() == 0
    assert decontaminate.matches(docs, bench.limit(0)).count() == 0

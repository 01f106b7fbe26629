"""Links and groups against all pairs."""

import random

import pytest

from strandline.llm import components, near_dedup

SCHEMA = "doc_id long, text string, component_id long, n string"


def shingles(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")
    w = [x for x in w if x]
    if not w:
        return frozenset()
    if len(w) < 5:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def expected(docs):
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            common = len(x & y)
            if x and y and 100 * common >= 75 * (len(x) + len(y) - common):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def group(seed, n):
    """Near copies of one text, more and less changed, some cut short."""
    r = random.Random(seed)
    text = [f"w{r.randrange(9999)}" for _ in range(100)]
    out = []
    for _ in range(n):
        w = list(text)
        for _ in range(r.randint(0, 8)):
            w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w[: r.randint(50, 100)] if r.random() < 0.3 else w))
    return out


@pytest.fixture(scope="module")
def docs():
    texts = group(1, 120) + group(2, 30) + ["", None, "a b", "A  B", "a b c", "a b c d e", "a b c d"]
    texts += [texts[3]] * 40
    order = random.Random(3).sample(range(1000), len(texts))
    return list(zip(order, texts, strict=True))


@pytest.mark.parametrize(("block", "dense"), [(256, 4), (32, 0)])
def test_against_all_pairs(spark, docs, monkeypatch, block, dense):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    monkeypatch.setattr(near_dedup, "DENSE", dense)
    frame = spark.createDataFrame([(i, t, -1, "x") for i, t in docs], SCHEMA).repartition(5)
    rows = near_dedup.link(frame).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == expected(docs)


def test_repeated_and_missing_ids(spark):
    text = "one two three four five six"
    rows = [(7, text), (7, text), (None, text), (9, text.upper()), (None, "x"), (3, None)]
    found = near_dedup.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in found) == [
        (0, 0, True),
        (0, 7, False),
        (3, 3, True),
        (7, 7, True),
        (7, 7, True),
        (9, 7, False),
    ]


def test_an_empty_table(spark):
    assert near_dedup.link(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_a_long_path(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, 101), (101, 102), (5, 5)]
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    want = {i: 1 for i in range(1, 21)} | {100: 100, 101: 100, 102: 100}
    assert {r.node: r.component for r in found.collect()} == want


def test_sketches_estimate_similarity():
    import numpy as np

    r = np.random.default_rng(1)
    for similarity in (0.5, 0.75, 0.95):
        n = 2000
        shared = int(2 * n * similarity / (1 + similarity))
        values = r.integers(0, 2**63, 2 * n - shared, dtype=np.uint64)
        sets = values[:n], values[n - shared :]
        samples = np.stack([near_dedup.minhash(s) for s in sets])
        one, two = near_dedup.odd_sketches(samples).view(np.uint64)
        differing = int(np.bitwise_count(one ^ two).sum())
        assert abs(near_dedup.similarity_estimate(np.array(differing)) - similarity) < 0.13


def test_a_joined_group_is_not_compared_again(spark):
    """Units grow with what is still apart, not with the square of a group."""
    for n in (1000, 4000):
        classes = spark.range(n).selectExpr("id AS rep", "10L AS n", "CAST('' AS BINARY) AS sketch")
        members = classes.selectExpr("7L AS bucket", "rep", "0L AS leader", f"{n}L AS size")
        one = classes.selectExpr("rep AS node", "0L AS component")
        assert near_dedup.units(members, one, classes).count() == 0
        # Five of them apart, each by itself.
        some = one.selectExpr("node", "CASE WHEN node % 200 = 99 AND node < 1000 THEN node "
                              "ELSE component END AS component")
        rows = near_dedup.units(members, some, classes)
        assert rows.count() < 6 * n + 6 * near_dedup.BLOCK
        # Every pair of different components meets in a unit, once or on its two sides.
        found = rows.select("unit", "side", "rep", "component").collect()
        by_unit = {}
        for r in found:
            by_unit.setdefault(r.unit, []).append(r)
        for a in (99, 299, 899):
            for b in (0, 5, 299, 500, n - 1):
                if a != b:
                    assert any(
                        x.rep == a and y.rep == b and (x.side == 0 or x.side != y.side)
                        for unit in by_unit.values()
                        for x in unit if x.rep == a
                        for y in unit if y.rep == b
                    ), (a, b)

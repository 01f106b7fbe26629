"""The pipeline's stages against their operators; queries against their SQL."""

import glob
import os

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry_point
import corpus_pipeline
from strandline.llm import decontaminate, near_dedup, queries, quality_classifier

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_is_its_sql(spark, duck, name):
    rows = queries.ALL[name](spark, SF)
    result = duck.execute(queries.SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(rows.columns)
    want = sorted(repr([r[names.index(c)] for c in sorted(names)]) for r in result.fetchall())
    assert sorted(repr([r[c] for c in sorted(names)]) for r in rows.collect()) == want


def test_all_are_registered():
    names = entry_point.queries()
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in names if q.startswith("op")}
    assert names["pipeline"] is corpus_pipeline.run
    assert set(entry_point.oracle_sql()) <= set(names)


def test_stages(spark, tmp_path):
    docs = queries.table(spark, SF, "documents")
    names = docs.columns
    seen = [docs]
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], SF).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
        if at < 4:
            assert seen[-1].columns == names
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in seen]
    model = quality_classifier.fit(seen[0], queries.table(spark, SF, "labels"))
    good = {r.doc_id for r in quality_classifier.score(seen[0], model).collect() if r.predicted}
    assert ids[1] == good and len(good) < len(ids[0])
    kept = {r.doc_id for r in near_dedup.link(seen[1]).collect() if r.kept}
    assert ids[2] == kept and len(kept) < len(good)
    found = decontaminate.matches(seen[2], queries.table(spark, SF, "benchmark")).collect()
    assert ids[3] == kept - {r.doc_id for r in found}
    assert ids[4] == ids[3] == ids[5]
    before = {r.doc_id: r.text for r in seen[3].collect()}
    for r in seen[4].collect():
        assert r.n_chars == len(r.text)
        assert "@mail" not in r.text
        assert r.text == before[r.doc_id] or "<" in r.text


def test_stages_send_small_batches(spark, monkeypatch):
    """Stages share their processes, so each holds little; batches change no result."""
    docs = queries.table(spark, SF, "documents").limit(60)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    python = [s for s in corpus_pipeline.STAGES if s[0] != "personal_data"]
    found = {}
    for batch in ("2m", "1k"):
        monkeypatch.setattr(corpus_pipeline, "BATCH", batch)
        for name, stage in python:
            queries.table(spark, SF, "documents")  # a query before it, with its own settings
            rows = stage(spark, docs, SF)
            assert spark.conf.get(setting) == batch
            assert spark.sparkContext.environment["MALLOC_MMAP_THRESHOLD_"] == "1048576"
            kept = sorted((r.doc_id, r["piece"] if name == "packing" else 0) for r in rows.collect())
            assert found.setdefault(name, kept) == kept
    queries.table(spark, SF, "documents")
    assert spark.conf.get(setting) == "8m"


def test_packed_sequences_hold_their_tokens(spark):
    """The last stage's rows, side by side, are the sequences; by document, its ids."""
    docs = queries.table(spark, SF, "documents").limit(40)
    rows = corpus_pipeline.packed(spark, docs, SF).collect()
    encoder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    sequences, texts = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, len(ids)))
        texts.setdefault(r.doc_id, []).append((r.start, ids))
    for places in sequences.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= 4096
    for d in docs.collect():
        found = np.concatenate([ids for _, ids in sorted(texts[d.doc_id], key=lambda x: x[0])])
        assert found.tolist() == [*encoder.encode(d.text, add_special_tokens=False).ids, 1]


def test_stages_on_an_empty_table(spark):
    docs = queries.table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name


def test_stages_on_odd_rows(spark):
    """Null ids and texts, rows and ids that repeat, ties, columns whose names clash."""
    from pyspark.sql import functions as F

    given = queries.table(spark, SF, "documents")
    some = [r.text for r in given.orderBy("doc_id").limit(40).collect()]
    words = " ".join(f"word{i}" for i in range(80))
    near = words.replace("word79", "other")
    secret = f"{words} mail someone@example.org here"
    item = queries.table(spark, SF, "benchmark").first()["text"]
    rows = [(1, words), (2, near), (3, words), (None, words), (None, words), (None, None)]
    rows += [(4, secret + " a"), (4, f"{secret} {some[0]}"), (None, f"{item} {some[1]}")]
    rows += [(5, ""), (5, ""), (6, None), (7, some[2]), (7, some[2]), (None, some[3])]
    names = ["_key", "_id", "_of", "_spans", "_row", "_again", "component_id", "kept", "_rank",
             "sequence_id", "offset", "score", "spans", "id"]
    docs = spark.createDataFrame(
        [(i, t, 0) for i, t in rows], "doc_id long, text string, n_chars int"
    ).withColumns({c: F.lit(c) for c in names})
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, SF)
        if name != "packing":
            assert found.columns == docs.columns, name
        out[name] = found.collect()
    texts = [r.text for r in out["near_duplicates"]]
    assert texts.count(words) == 1 and near not in texts
    assert [r.doc_id for r in out["near_duplicates"] if r.text == words] == [1]
    assert texts.count(some[2]) == 1 and texts.count(some[3]) == 1
    assert texts.count(None) == 2 and texts.count("") == 2
    left = sorted((r.doc_id or 0, r.text or "") for r in out["decontamination"])
    assert left == sorted((i or 0, t or "") for i, t in rows if not (t or "").startswith(item))
    clean = out["personal_data"]
    assert len(clean) == len(rows)
    assert sum("someone@" in (r.text or "") for r in clean) == 0
    assert sum("<email>" in (r.text or "") for r in clean) == 2
    assert all(r.n_chars == len(r.text) for r in clean if r.text is not None)
    assert sum(r.piece == 0 for r in out["packing"]) == len(rows)
    kept = {r.text for r in out["quality_classifier"]}
    assert len([1 for r in out["quality_classifier"] if r.text in kept]) == sum(
        t in kept for _, t in rows
    )


def test_pieces_whose_columns_clash(spark):
    from strandline.llm import packing

    rows = spark.createDataFrame(
        [(i, 3 + i % 4, -1, -1, "x", "y") for i in range(50)],
        "doc_id long, length long, sequence_id int, offset int, _rank string, _bucket string",
    )
    found = packing.pack(rows, capacity=10)
    assert sorted(found.columns) == sorted(rows.columns)
    places = {}
    for r in found.collect():
        assert (r._rank, r._bucket) == ("x", "y")
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 10

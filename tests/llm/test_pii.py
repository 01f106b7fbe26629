"""Personal data: patterns against their plain forms, trees, redaction."""

import re
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from strandline.llm import pii

# The plain forms; numbers of digits and values are checked behind them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(value):
    total = 0
    for k, c in enumerate(reversed([int(c) for c in value if c in "0123456789"])):
        total += c if k % 2 == 0 else 2 * c - 9 * (c > 4)
    return total % 10 == 0


def base(text):
    out = []
    for at, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            value, n = m[0], sum(c in "0123456789" for c in m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(x) <= 255 for x in value.split(".")),
                "card": 12 <= n <= 19 and luhn(value),
                "phone": 9 <= n <= 15,
            }[kind]
            if good:
                out.append((m.start(), at, m.end(), value))
    return sorted(out)


def proposed(spark, texts):
    docs = spark.createDataFrame(
        [(i, t, 0, "x") for i, t in enumerate(texts)], "doc_id long, text string, kind int, of string"
    )
    return docs, pii.proposals(docs)


CASES = [
    None,
    "",
    "é a.b@c.d, x%y@z-1.com.. q@@r.s a@b@c.d a@b a@b.c%d@e.f.g- 😀 u@v.w",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0001.002.0255.0 1.2.3 99999999999999999999.1.1.1",
    "4845168114407329 4845 1681 1440 7329 4845-1681-1440-7329 4845168114407328 48451681144073291",
    "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9 0 " * 500,
    "+1 (017) 555-7713 +1 (826) 555-4081 190.137.223.204 +49.(30)-1234567 ++1234567890",
    "a" * 50_000 + "@" + "b.c" * 20_000,
    "0" * 100_000,
    "x1@y2.z3 " * 1500,
]


def test_base_patterns(spark):
    _, found = proposed(spark, CASES)
    for row in found.collect():
        assert [tuple(s) for s in row["base"]] == base(CASES[row["id"]]), row["id"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="a.@+-() 0123459é%", max_size=60), min_size=20, max_size=40))
def test_base_patterns_on_random_texts(spark, texts):
    _, found = proposed(spark, texts)
    for row in found.collect():
        assert [tuple(s) for s in row["base"]] == base(texts[row["id"]])


@pytest.fixture(scope="module")
def texts():
    out = []
    for i in range(120):
        out.append(f'see token = "{i * 7919:040x}" and word{i}abcdefghijklmnop here')
        out.append(f"call +1 ({i:03d}) 555-{i * 37:04d} or mail n{i}@mail{i}.example.com now")
        out.append(f"version {i}.0 of part{i} costs {i}00 and 12345678901234{i:03d} units")
    return [*out, None, "", f'token = "{5:x}{"ab12" * 9}"', "+1 (826) 555-4081 190.137.223.204 of"]


def test_trees_add_secrets_and_keep_base_spans(spark, texts):
    docs, found = proposed(spark, texts)
    found = found.cache()
    model = pii.fit(found)
    rows = {r["id"]: r for r in pii.detect(found, model).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        own = {tuple(s) for s in rows[i]["base"]}
        assert sorted(own) == base(text)
        spans = [tuple(s) for s in rows[i]["spans"]]
        assert own <= set(spans) and spans == sorted(spans)
        ends = [0, *(e for _, _, e, _ in spans)]
        assert all(a <= s[0] for a, s in zip(ends, spans, strict=False))
    secrets = {i for i, r in rows.items() if any(s["kind"] == 4 for s in r["spans"])}
    assert secrets >= set(range(0, 360, 3))
    assert not secrets & set(range(2, 360, 3))
    clean = pii.redact(docs, pii.detect(found, model), "doc_id", "text")
    assert clean.columns == docs.columns
    out = {r.doc_id: r.text for r in clean.collect()}
    assert out[0] == "see token = \"<secret>\" and word0abcdefghijklmnop here"
    assert out[4] == "call <phone> or mail <email> now"
    assert out[360] is None and out[361] == ""
    assert out[5] == texts[5]


def test_all_candidates_are_learned_from(spark):
    """Secrets whose hashes come after those of 20,000 other candidates are learned too."""
    mails = [" ".join(f"n{i}.{k}@mail{i}.example.com" for k in range(60)) for i in range(450)]
    named = [f'see token = "{i * 7919:040x}" and then' for i in range(3000)]
    other = [f"see word{i}abcdefghijklmnop and then" for i in range(3000)]
    docs, found = proposed(spark, [*mails, *named, *other])
    found = found.cache()
    order = F.xxhash64("of", "start", "kind").alias("order")
    hashes = pii.candidate_rows(found).select("id", "kind", order).collect()
    of_mails = sorted(r["order"] for r in hashes if r["kind"] == 0)
    early = {r["id"] for r in hashes if r["kind"] == 4 and r["order"] <= of_mails[19_999]}
    late = found.filter(~F.col("id").isin(sorted(early - set(range(len(mails))))))
    mails_only = late.withColumn(
        "candidates",
        F.filter("candidates", lambda c: (F.col("id") >= len(mails)) | (c["kind"] == 0)),
    )
    model = pii.fit(mails_only)
    assert "secret" in model.thresholds
    seen = pii.detect(late.filter(F.col("id") >= len(mails)), model).collect()
    got = {r["id"] for r in seen if any(s["kind"] == 4 for s in r["spans"])}
    assert got == {r["id"] for r in seen if r["id"] < len(mails) + len(named)} != set()


def test_pipeline_learns_from_all_candidates(spark):
    """Secrets after 20,000 other candidates by hash are redacted by the pipeline's stage."""
    mails = [" ".join(f"n{i}.{k}@mail{i}.example.com" for k in range(60)) for i in range(450)]
    named = [f'see token = "{i * 7919:040x}" and then' for i in range(2000)]
    other = [f"see word{i}abcdefghijklmnop and then" for i in range(2000)]
    docs, found = proposed(spark, [*mails, *named, *other])
    order = F.xxhash64("of", "start", "kind").alias("order")
    hashes = pii.candidate_rows(found.cache()).select("id", "kind", order).collect()
    least = sorted(r["order"] for r in hashes if r["kind"] == 0)[19_999]
    early = sorted({r["id"] for r in hashes if r["kind"] == 4 and r["order"] <= least})
    late = docs.filter(~F.col("doc_id").isin(early))
    clean = corpus_pipeline.personal_data(spark, late, "").filter(F.col("doc_id") >= len(mails))
    out = {r.doc_id: r.text for r in clean.collect()}
    for i, text in out.items():
        secret = i < len(mails) + len(named)
        assert ("<secret>" in text) == secret and secret == ("token" in text)
    assert {i < len(mails) + len(named) for i in out} == {True, False}


def test_equal_candidates_are_counted_together(spark, texts):
    """The counts by label and features are those of the candidates one by one."""
    _, found = proposed(spark, texts[:60] * 3)
    found = found.cache()
    rows = pii.candidate_rows(found).collect()
    want = Counter((r["kind"], r["label"], *(r[f] for f in pii.features())) for r in rows)
    got = Counter()
    for r in pii.counted(found).collect():
        got[(r["kind"], r["label"], *(r[f] for f in pii.features()))] += r["n"]
    assert got == want and got.total() == len(rows)


def test_long_secrets_are_whole(spark):
    """Tokens of any length, with their digits anywhere or nowhere, are one candidate."""
    long = [("ab12" * 300), "abcdefghij" * 6 + "7", "k" * 50 + "9" * 300, "Q" * 64, "x1" * 200_000]
    _, found = proposed(spark, [f'token = "{x}" end' for x in long])
    for row in found.collect():
        spans = {(c["start"], c["value"]) for c in row["candidates"] if c["kind"] == 4}
        assert spans == {(9, long[row["id"]])}


def test_long_secrets_leave_no_tail(spark, texts):
    key = "ab12" * 100
    docs, found = proposed(spark, [*texts, f'see token = "{key}" here', f"see token = '{key}x'"])
    found = found.cache()
    clean = pii.redact(docs, pii.detect(found, pii.fit(found)), "doc_id", "text")
    left = [r.text for r in clean.orderBy("doc_id").collect()][-2:]
    assert not any("ab12" in text for text in left), left


def test_nothing_to_learn_from(spark):
    docs, found = proposed(spark, [None, "", "clean"])
    model = pii.fit(found)
    assert model.trees is None
    assert [list(r["spans"]) for r in pii.detect(found, model).collect()] == [[], [], []]
    _, empty = proposed(spark, [])
    assert pii.detect(empty, pii.fit(empty)).count() == 0


def test_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a@b.c")] * 2 + [(None, "d@e.f")], "doc_id long, text string")
    found = pii.proposals(docs)
    spans = pii.detect(found, pii.Model(None, {}))
    assert spans.count() == 3
    out = pii.redact(docs, spans, "doc_id", "text").collect()
    assert [r.text for r in out] == ["<email>"] * 3

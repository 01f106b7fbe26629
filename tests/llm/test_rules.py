"""Quality rules and url filters against plain Python."""

import re
from collections import Counter

import duckdb
import pytest

from strandline.llm import queries, quality_rules, url_filters

LONG = " ".join(f"w{i}" for i in range(60))
TEXTS = [
    None,
    "",
    " \n\t\n",
    LONG,
    LONG + "\nsame line\nsame line\n# $ <b>|",
    "a b c a b c a b c a b c " * 20,
    "a a a a a",
    "a\x1cb é日 ü\x0bc",
    "x y z",
    "x y z x y z",
    "word " * 5000,
]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def expected_figures(text):
    w = words(text)
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    times = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if times[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    figures = (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )
    return (*figures, len(w) < 50 or 100 * len(covered) > 50 * len(w))


def test_figures(spark):
    docs = spark.createDataFrame(
        [(i, t, "s", i) for i, t in enumerate(TEXTS)],
        "doc_id long, text string, source string, n_words long",
    )
    rows = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for i, text in enumerate(TEXTS):
        assert tuple(rows[i][n] for n in names) == expected_figures(text), text


def test_common_lines_per_host(spark):
    line = "Home | About | Contact us today"
    docs = [(i, f"{line}\n{LONG} {'q' * i}", "big") for i in range(30)]
    docs += [(100 + i, f"HOME |  About | Contact us today\n{i}", "big") for i in range(4)]
    docs += [(200, f"{line}\nx", "small"), (201, f"{line}\n{LONG}", None)]
    docs += [(300, f"{line}\nrepeated", "big")] * 2
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = quality_rules.judge(frame, min_docs=10, max_share=0.5).collect()
    assert len(rows) == len(docs)
    depleted = {r.doc_id for r in rows if r.depleted}
    assert depleted == {100, 101, 102, 103, 300}
    assert {r.doc_id for r in rows if r.kept} == {*range(30), 201}
    share = next(r.removed_share for r in rows if r.doc_id == 0)
    assert share == len(line) / (len(line) + len(LONG))


def test_common_lines_of_a_very_large_host(spark):
    line = "Home | About | Contact us today"
    docs = spark.range(40_000).selectExpr(
        "id AS doc_id", f"IF(id < 3000, '{line}', translate(id, '0123456789', 'abcdefghij')) AS text", "'hot' AS source"
    )
    only_share = quality_rules.judge(docs, max_docs=None)
    assert only_share.filter("depleted").count() == 0  # 7.5 % of the host
    rows = quality_rules.judge(docs).filter("depleted").collect()
    assert {r.doc_id for r in rows} == set(range(3000))
    few = quality_rules.judge(docs, max_docs=3000)
    assert few.filter("depleted").count() == 0


def test_rows_that_repeat_are_one_document(spark, tmp_path):
    """The registered query and its SQL, on a table with rows and ids that repeat."""
    line = "Home | About | Contact us today"
    docs = [(i, f"{line}\nq{'q' * i}", "one") for i in range(8)] * 4  # 8 documents, not 32
    docs += [(100 + i, f"{line}\nr{'r' * i}", "two") for i in range(15)]
    docs += [(100, f"{line}\nr", "two"), (100, f"{line}\nother", "two"), (7, line, "two")]
    docs += [(200 + i, f"unlike {'u' * i}", h) for i in range(40) for h in ("one", "two")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op2_quality_rules(spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id for r in rows if r.depleted} == {7, *range(100, 115)}
    con = duckdb.connect()
    con.execute(
        f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')"
    )
    result = con.execute(queries.SQL["op2_quality_rules"])
    names = [d[0] for d in result.description]
    want = sorted(repr(x) for x in result.fetchall())
    assert sorted(repr(tuple(r[n] for n in names)) for r in rows) == want


RULES = [*queries.URL_RULES, ("x.net", "", "block"), ("x.net", "", "allow"), ("x.net", "/a", "allow")]
URLS = [
    None,
    "",
    "no scheme example.org/es/",
    "http://A.Example.ORG/es/1?q#f",
    "https://example.org/en/148.html",
    "https://badexample.org/en/1",
    "http://x.com/fr",
    "http://x.com/fr/",
    "x://y://com/de/",
    "http://com/de/#",
    "http://org",
    "http://org?x/",
    "http:///org/",
    "http://a.x.net/a",
    "http://x.net:80/a",
    "http://x.net",
    "http://.org/",
    "http://" + "a." * 3000 + "org/" + "p" * 5000,
]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), re.match("[^/?#]*", rest)[0])
        path = re.match("[^?#]*", rest[len(re.match("[^/?#]*", rest)[0]) :])[0]
    fits = [
        (len(h + p), len(h), a == "block", h + p)
        for h, p, a in RULES
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, "allow"
    *_, blocks, rule = max(fits)
    return host, path, rule, "block" if blocks else "allow"


def test_urls(spark):
    pages = spark.createDataFrame(
        [(i, u, "h") for i, u in enumerate(URLS)] + [(3, URLS[3], "again")],
        "page_id long, url string, rule string",
    )
    rules = spark.createDataFrame(
        [*RULES, *RULES, (None, "/", "block"), ("", "", "block")],
        "host string, path string, action string",
    )
    rows = url_filters.judge(pages, rules).collect()
    assert len(rows) == len(URLS) + 1
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert found == {i: judged(u) for i, u in enumerate(URLS)}


@pytest.mark.parametrize("some", [[], [(1, "http://x.org/", "h")]])
def test_no_rules_and_no_pages(spark, some):
    pages = spark.createDataFrame(some, "page_id long, url string, html string")
    rules = spark.createDataFrame([], "host string, path string, action string")
    assert [r.verdict for r in url_filters.judge(pages, rules).collect()] == ["allow"] * len(some)
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert quality_rules.judge(docs).count() == 0

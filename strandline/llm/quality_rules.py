"""Quality rules: text figures, and lines that too many documents of a host share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.keep import keep

# Fixed values of the rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_DOCS = 1000  # of a host: a line in more of them is common whatever the host's size

WORD_GAP = r"[\\x20\\x09-\\x0D]+"
HAS_WORD = r"[^\\x20\\x09-\\x0D]"

# Places in three-word windows that occur twice or more. The windows' hashes are
# sorted with their places; each place whose neighbour is equal starts a repeat,
# and covers three words less the overlap with the place before it. array(x) with
# [0] binds a value to a name, so that it is computed once and not per element.
REPEATED = """
transform(array(words), w -> if(size(w) < 4, 0L,
 transform(array(sort_array(transform(sequence(0, size(w) - 3),
   i -> struct(xxhash64(w[i], w[i + 1], w[i + 2]) AS h, i AS at)))), s ->
  transform(array(sort_array(transform(filter(s, (x, j) ->
    coalesce(get(s, j - 1).h = x.h, false) OR coalesce(get(s, j + 1).h = x.h, false)),
    x -> x.at))), p ->
   aggregate(transform(p, (x, j) -> if(j = 0, 3L, CAST(least(3, x - p[j - 1]) AS BIGINT))),
     0L, (a, x) -> a + x))[0])[0]))[0]
"""


def figures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document, in the scan: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed. Null text counts as empty. Equal texts share the
    column ``same``."""
    text = docs.select(
        F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    per = text.selectExpr(
        f"`{id_col}`",
        "xxhash64(text) AS same",
        f"array_remove(split(text, '{WORD_GAP}'), '') AS words",
        f"filter(split(text, '\\n'), l -> l RLIKE '{HAS_WORD}') AS lines",
        "CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '')) AS BIGINT) AS n_symbols",
    )
    counted = per.selectExpr(
        f"`{id_col}`",
        "same",
        "CAST(size(words) AS BIGINT) AS n_words",
        "CAST(length(array_join(words, '')) AS BIGINT) AS word_chars",
        "n_symbols",
        "CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines",
        f"{REPEATED} AS n_repeat_words",
    )
    return counted.withColumn(
        "base_failed",
        F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    )


# A line in lower case, digits as 0, white space as one blank, ends trimmed.
NORMAL_LINES = f"""
filter(transform(split(text, '\\n'), l ->
 trim(regexp_replace(regexp_replace(lower(l), '[0-9]', '0'), '{WORD_GAP}', ' '))), l -> l <> '')
"""


def common_lines(
    docs: DataFrame,
    min_docs: int = 10,
    max_share: float = 0.1,
    host_col: str = "source",
    max_docs: int | None = MAX_DOCS,
    id_col: str = "doc_id",
) -> DataFrame:
    """(host, line): lines, by hash, in more than ``min_docs`` distinct documents of a host
    and in more than ``max_share`` of them, or in more than ``max_docs`` of them, however
    large the host (None: no such limit).

    Rows of one id are one document. Each task first combines equal pairs, so a line or
    host that a third of all rows hold travels as one row per task; only rows whose id
    occurs again travel with it.
    """
    texts = docs.select(
        F.col(host_col).alias("host"), F.col(id_col).alias("id"), F.col("text")
    )
    again = keep(
        texts.groupBy("id")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter("rows > 1")
        .select(F.col("id").alias("again")),
        "repeated",
    )
    single, several = texts, texts.limit(0)
    if not again.isEmpty():
        single = texts.join(again, F.expr("id <=> again"), "left_anti")
        several = texts.join(again, F.expr("id <=> again"), "left_semi")
    per_host = single.select("host").unionByName(several.select("host", "id").distinct().drop("id"))
    sizes = per_host.groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    each = f"explode(array_distinct(transform({NORMAL_LINES}, l -> xxhash64(l)))) AS line"
    counts = (
        single.selectExpr("host", each)
        .unionByName(several.selectExpr("host", "id", each).distinct().drop("id"))
        .groupBy("host", "line")
        .agg(F.count(F.lit(1)).alias("n_docs"))
        .filter(F.col("n_docs") > min_docs)
    )
    common = F.col("n_docs") > max_share * F.col("host_docs")
    if max_docs is not None:
        common |= F.col("n_docs") > max_docs
    return (
        counts.alias("c")
        .join(sizes.alias("s"), F.expr("c.host <=> s.host"))
        .filter(common)
        .select("c.host", "c.line")
    )


def judge(
    docs: DataFrame,
    min_docs: int = 10,
    max_share: float = 0.1,
    min_left: float = 0.5,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    salts: int = 64,
    max_docs: int | None = MAX_DOCS,
) -> DataFrame:
    """One row per document: the figures, removed_share, depleted, kept.

    Common lines (see ``common_lines``) are removed; removed_share is their share of
    the document's line characters (0 without lines). A document left with less
    than ``min_left`` of them is depleted; kept: neither base_failed nor depleted.

    Common lines meet the documents' lines by a join dealt over ``salts`` parts per
    line; Spark broadcasts them where they are few. Null text: no line, base_failed.
    A null host is a host of its own. Rows that repeat an id count as one document of
    their host and give as many rows; other columns are not read.
    """
    source = docs.select(
        F.col(id_col), F.col(text_col).alias("text"), F.col(host_col).alias("host")
    )
    common = common_lines(source, min_docs, max_share, "host", max_docs, id_col).selectExpr(
        "host AS at_host",
        "line AS at_line",
        f"explode(sequence(0, {salts - 1})) AS at_salt",
    )
    lines = source.selectExpr(
        f"`{id_col}` AS id",
        "host",
        "xxhash64(text) AS of",
        f"explode(transform({NORMAL_LINES}, l -> struct(xxhash64(l) AS line, length(l) AS chars)))"
        " AS l",
    ).selectExpr("*", f"CAST(pmod(xxhash64(id, of), {salts}) AS INT) AS salt")
    # Shares, so that rows repeated as a whole change nothing.
    removed = (
        lines.join(
            common, F.expr("l.line = at_line AND salt = at_salt AND host <=> at_host"), "left"
        )
        .groupBy("id", "of")
        .agg(
            (
                F.sum(F.when(F.col("at_line").isNotNull(), F.col("l.chars")).otherwise(0))
                / F.sum("l.chars")
            ).alias("share")
        )
        .filter("share > 0")
    )
    return (
        figures(source, id_col, "text")
        .join(removed, F.expr(f"same = of AND `{id_col}` <=> id"), "left")
        .withColumn("removed_share", F.coalesce("share", F.lit(0.0)))
        .withColumn("depleted", F.expr(f"1 - removed_share < {min_left}"))
        .withColumn("kept", F.expr("NOT base_failed AND NOT depleted"))
        .drop("same", "of", "id", "share")
    )

"""URL rules by expansion: host suffixes times path prefixes, found by hash."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

URL_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The lower-cased host and the path; both empty for null or no ``://``."""
    text = F.coalesce(url, F.lit(""))
    host = F.translate(
        F.regexp_extract(text, URL_PARTS, 1), string.ascii_uppercase, string.ascii_lowercase
    )
    return host, F.regexp_extract(text, URL_PARTS, 2)


def judge(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    id_col: str = "page_id",
    url_col: str = "url",
    prefix_hex: int = 8,
) -> DataFrame:
    """One row per page: id, host, path, rule, verdict.

    ``rules`` has host, path and action (``allow`` or ``block``). A rule fits its
    host and all subdomains where the url's path starts with the rule's path. The
    longest (host and path together) wins; among equals the longer host, then
    ``block``. Where none fits, the verdict is ``default`` and the rule null.

    Each url becomes the expressions host suffix + path prefix, only with as many
    labels and with such path lengths as some rule has. Rules are met by an
    equi-join on the first ``prefix_hex`` digits of the expression's SHA-256; the
    full digest then confirms. Spark picks a broadcast by the rules' size. Rules
    with null host, path or action are ignored, and so are repeated ones.

    Null and malformed urls have an empty host and path, which no rule fits.
    Repeated pages give as many rows. Other columns of the inputs are not read.
    """
    rules = (
        rules.select("host", "path", "action")
        .filter("host IS NOT NULL AND path IS NOT NULL AND action IN ('allow', 'block')")
        .filter("host <> ''")
        .distinct()
    )
    # The lengths are at most those of an url and the row is one: no list of rules.
    seen = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.collect_set(F.length("path")).alias("lengths"),
    ).first()
    labels = seen["labels"] or 0
    lengths = F.array(*map(F.lit, sorted(seen["lengths"]))).cast("array<int>")

    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    suffixes = F.expr(
        "transform(transform(array(split(host, '[.]')), p -> transform("
        f"sequence(1, least(size(p), {max(1, labels)})), i -> array_join(slice(p, -i, i), '.')))"
        "[0], s -> s)"
    )
    prefixes = F.transform(
        F.filter(lengths, lambda n: n <= F.length("path")),
        lambda n: F.col("path").substr(F.lit(1), n),
    )
    expressions = F.flatten(
        F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))
    )
    expanded = parts.filter(F.col("host") != "").select(
        "*", F.explode(expressions).alias("expression")
    ).withColumn("digest", F.sha2("expression", 256))
    expanded = expanded.withColumn("short", F.substring("digest", 1, prefix_hex))

    named = F.concat("host", "path")
    listed = rules.select(
        F.sha2(named, 256).alias("rule_digest"),
        named.alias("rule"),
        F.struct(
            F.length(named).alias("size"),
            F.length("host").alias("host_size"),
            (F.col("action") == "block").alias("blocks"),
        ).alias("rank"),
    ).withColumn("rule_short", F.substring("rule_digest", 1, prefix_hex))
    met = expanded.join(
        listed,
        (F.col("short") == F.col("rule_short")) & (F.col("digest") == F.col("rule_digest")),
    )
    # The pages themselves stay out of the join: one that no rule fits has no key there.
    found = F.struct("rank", "rule").alias("found")
    fits = met.select("id", "host", "path", found, F.lit(0).alias("pages"))
    none = F.lit(None).cast(fits.schema["found"].dataType).alias("found")
    alone = parts.select("id", "host", "path", none, F.lit(1).alias("pages"))
    best = (
        alone.unionByName(fits)
        .groupBy("id", "host", "path")
        .agg(F.max("found").alias("best"), F.sum("pages").alias("copies"))
    )
    return best.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.when(F.col("best").isNull(), F.lit(default))
        .when(F.col("best.rank.blocks"), "block")
        .otherwise("allow")
        .alias("verdict"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")

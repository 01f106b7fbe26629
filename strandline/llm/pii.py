"""Personal data: fixed patterns, and candidates chosen by boosted trees."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.keep import fresh, keep

# The kinds in their order, and the patterns of the first four. Each
# matches what its plain form matches from the left (see the tests), but starts only
# where a match can start and repeats single characters only, so that long runs cost
# linear time and no deep stack.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = {
    "email": (
        r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++\.[A-Za-z0-9-]"
        r"[A-Za-z0-9.-]*?(?=\.(?![A-Za-z0-9-])|[^A-Za-z0-9.-]|\z)"
    ),
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # Longer and shorter runs of digits fail anyway.
    "card": (
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])"
    ),
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What may be personal data, by the kind it would be. High recall, overlapping.
CANDIDATES = {
    "email": r"(?<![^\s@\x22<>|])[^\s@\x22<>|]++@[^\s@\x22<>|]++",
    "ip": r"(?<![0-9.])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3,7}+",
    "card": r"(?<![0-9A-Za-z.])(?:[0-9]{12,19}|[0-9]{4}(?:[\x20-][0-9]{4}){3})(?![0-9A-Za-z])",
    "phone": (
        r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,3}\)?[\x20.-]?\(?[0-9]{2,4}\)?[\x20.-]?[0-9]{3,4}"
        r"[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z])"
    ),
    "secret": r"(?<![A-Za-z0-9_/+=-])[A-Za-z0-9_/+=-]{16,}+",
}
SECRET_NAMED = r"(?i)(?:token|key|secret|password|passwd|auth)[\x22']?\s{0,3}[=:]\s{0,3}[\x22']?\z"
AROUND = 24
STEP = 200
BROADCAST_TEXTS = 100_000
SPAN = "struct<start:int,end:int,value:string>"


def found(text: Column, pattern: str) -> Column:
    """All matches of a pattern in a text, with places in code points, end exclusive.

    The text between matches gives the places. They are summed in two levels, so that
    a text with very many matches stays near linear.
    """
    parts = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
    )
    none = F.array().cast(f"array<{SPAN}>")

    def runs(x: Column) -> Column:
        pair = F.zip_with(
            F.slice(x["gaps"], F.lit(1), F.size(x["hits"])),
            x["hits"],
            lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit")),
        )
        steps = F.sequence(F.lit(0), F.floor((F.size(x["hits"]) - 1) / STEP).cast("int"))
        blocks = F.transform(
            F.array(pair),
            lambda p: F.transform(steps, lambda k: F.slice(p, k * STEP + 1, F.lit(STEP))),
        )[0]

        def size(block: Column) -> Column:
            return F.aggregate(
                block, F.lit(0), lambda a, y: a + y["gap"] + F.length(y["hit"])
            )

        def next_block(a: Column, block: Column) -> Column:
            return F.struct(
                (a["at"] + size(block)).alias("at"),
                F.concat(
                    a["out"], F.array(F.struct(a["at"].alias("at"), block.alias("block")))
                ).alias("out"),
            )

        empty = F.array().cast("array<struct<at:int,block:array<struct<gap:int,hit:string>>>>")
        placed = F.aggregate(
            blocks,
            F.struct(F.lit(0).alias("at"), empty.alias("out")),
            next_block,
            lambda a: a["out"],
        )

        def next_hit(a: Column, y: Column) -> Column:
            start = a["at"] + y["gap"]
            end = start + F.length(y["hit"])
            span = F.struct(start.alias("start"), end.alias("end"), y["hit"].alias("value"))
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

        return F.flatten(
            F.transform(
                placed,
                lambda b: F.aggregate(
                    b["block"],
                    F.struct(b["at"].alias("at"), none.alias("out")),
                    next_hit,
                    lambda a: a["out"],
                ),
            )
        )

    return F.transform(
        F.array(parts), lambda x: F.when(F.size(x["hits"]) > 0, runs(x)).otherwise(none)
    )[0]


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether a value's digits pass the Luhn check."""
    back = F.reverse(digits(value))
    total = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.length(back), F.lit(1))),
        F.lit(0),
        lambda a, k: a + luhn_part(F.coalesce(back.substr(k, F.lit(1)).try_cast("int"), F.lit(0)), k),
    )
    return (F.length(back) > 0) & (total % 10 == 0)


def luhn_part(digit: Column, place: Column) -> Column:
    doubled = digit * 2
    return F.when(place % 2 == 1, digit).otherwise(
        F.when(doubled > 9, doubled - 9).otherwise(doubled)
    )


def octets(value: Column) -> Column:
    """Whether every part between dots is at most 255."""
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return value.rlike(rf"\A{part}(?:\.{part})*\z")


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": octets,
    "card": luhn,
    "phone": lambda v: F.length(digits(v)).between(9, 15),
}


def tagged(spans: Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(KINDS.index(kind)).alias("kind"),
            s["end"].alias("end"),
            s["value"].alias("value"),
        ),
    )


def proposals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document, in one scan: id, of (a hash of id and text), base (the spans of
    the fixed patterns) and candidates (with the signs around them). A null text
    counts as empty."""
    text = F.col("text")
    # Texts without a digit or an @ have none of these; a secret may be without either.
    possible = {
        kind: text.contains("@") if kind == "email" else text.rlike("[0-9]") for kind in BASE
    }
    possible["secret"] = F.lit(True)
    none = F.array().cast(f"array<{SPAN}>")

    def spans(pattern: str, kind: str) -> Column:
        return F.when(possible[kind], found(text, pattern)).otherwise(none)

    def checked(kind: str) -> Column:
        return F.filter(spans(BASE[kind], kind), lambda s: CHECKS[kind](s["value"]))

    base = F.concat(*(tagged(checked(kind), kind) for kind in BASE))
    candidates = F.concat(*(tagged(spans(CANDIDATES[kind], kind), kind) for kind in KINDS))
    source = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(id_col, text_col).alias("of"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )

    def around(c: Column) -> Column:
        first = F.greatest(c["start"] - AROUND, F.lit(0))
        return F.struct(
            c["start"].alias("start"),
            c["kind"].alias("kind"),
            c["end"].alias("end"),
            c["value"].alias("value"),
            text.substr(first + 1, c["start"] - first).alias("left"),
            text.substr(c["end"] + 1, F.lit(AROUND)).alias("right"),
        )

    return source.select("id", "of", "text", base.alias("base"), candidates.alias("raw")).select(
        "id",
        "of",
        F.sort_array("base").alias("base"),
        F.transform("raw", around).alias("candidates"),
    )


# ------------------------------------------------------------------ the trees

def features() -> dict[str, Column]:
    """Form and surroundings of a candidate."""
    return {
        **{f"is_{kind}": (F.col("kind") == at).cast("double") for at, kind in enumerate(KINDS)},
        "size": F.length("value").cast("double"),
        "digits": F.length(digits(F.col("value"))).cast("double"),
        "letters": F.length(F.regexp_replace("value", "[^A-Za-z]", "")).cast("double"),
        "hex": F.length(F.regexp_replace("value", "[^0-9A-Fa-f]", "")) / F.length("value"),
        "signs": F.length(F.regexp_replace("value", "[A-Za-z0-9]", "")).cast("double"),
        "dots": F.length(F.regexp_replace("value", "[^.]", "")).cast("double"),
        "plus": F.col("value").startswith("+").cast("double"),
        "domain": F.col("value").rlike(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+\z").cast("double"),
        "luhn": luhn(F.col("value")).cast("double"),
        "octets": octets(F.col("value")).cast("double"),
        "left_space": F.col("left").rlike(r"(?:\A|[\s|])\z").cast("double"),
        "left_quote": F.col("left").rlike(r"[\x22'`]\z").cast("double"),
        "left_equals": F.col("left").rlike(r"[=:]\s?[\x22'`]?\z").cast("double"),
        "left_letter": F.col("left").rlike(r"[\p{L}0-9]\z").cast("double"),
        "right_letter": F.col("right").rlike(r"\A[\p{L}0-9]").cast("double"),
        "right_quote": F.col("right").rlike(r"\A[\x22'`]").cast("double"),
        "digits_left": F.col("left").rlike(r"[0-9]").cast("double"),
        "digits_right": F.col("right").rlike(r"[0-9]").cast("double"),
    }


@dataclass(frozen=True)
class Model:
    """The trees, and per kind the least score that is taken."""

    trees: GBTClassificationModel | None
    thresholds: dict[str, float]


def candidate_rows(proposed: DataFrame) -> DataFrame:
    """One row per candidate with its features; label says whether a fixed pattern
    matches the same span, for secrets whether a name stands before it."""
    rows = proposed.select("id", "of", "base", F.explode("candidates").alias("c")).select(
        "id", "of", "base", "c.*"
    )
    same = F.exists(
        "base",
        lambda b: (b["start"] == F.col("start"))
        & (b["end"] == F.col("end"))
        & (b["kind"] == F.col("kind")),
    )
    named = F.col("left").rlike(SECRET_NAMED) & (F.col("kind") == KINDS.index("secret"))
    return rows.select(
        "id",
        "of",
        "start",
        "kind",
        "end",
        "value",
        (same | named).cast("double").alias("label"),
        *(column.alias(name) for name, column in features().items()),
    )


def scored(rows: DataFrame, trees: GBTClassificationModel) -> DataFrame:
    vectors = VectorAssembler(inputCols=list(features()), outputCol="features").transform(rows)
    return trees.transform(vectors).withColumn(
        "score", vector_to_array("probability")[1]
    )


def counted(proposed: DataFrame) -> DataFrame:
    """All candidates, as one row per label and features with their number as ``n``:
    trees cannot tell those apart. ``held`` marks the third that is not learned from."""
    held = F.pmod(F.xxhash64("of", "start", "kind"), F.lit(3)) == 0
    return (
        candidate_rows(proposed)
        .groupBy(held.alias("held"), "kind", "label", *features())
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )


def fit(
    proposed: DataFrame,
    least_precision: float = 0.95,
    rounds: int = 12,
    depth: int = 4,
) -> Model:
    """Boosted trees over all candidates; two thirds are learned from, equal ones as one
    row of their number's weight.

    The labels are what the fixed patterns and the names before secrets say; the
    trees do not see those names, so they learn the form and the surroundings. A
    kind's threshold is the least score from which the other third's precision is
    ``least_precision``; a kind for which no score reaches it adds nothing. Without
    candidates of both labels there are no trees.
    """
    rows = keep(counted(proposed), "candidates")
    learn, hold = rows.filter("NOT held"), rows.filter("held")
    sizes = dict(learn.groupBy("label").count().collect())
    if len(sizes) < 2:
        return Model(None, {})
    vectors = VectorAssembler(inputCols=list(features()), outputCol="features").transform(learn)
    # The trees look for splits in a sample of maxBins squared rows: here, in all of them.
    trees = GBTClassifier(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=0.3,
        seed=7,
        weightCol="n",
        maxBins=max(32, math.isqrt(sum(sizes.values())) + 1),
    ).fit(vectors)
    bins = (
        scored(hold, trees)
        .groupBy("kind", F.floor(F.col("score") * 100).alias("bin"))
        .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("label")).alias("right"))
        .collect()
    )  # a hundred rows per kind at most
    thresholds = {}
    for at, kind in enumerate(KINDS):
        n = right = 0.0
        for row in sorted((r for r in bins if r["kind"] == at), key=lambda r: -r["bin"]):
            n, right = n + row["n"], right + row["right"]
            if right >= least_precision * n:
                thresholds[kind] = row["bin"] / 100
    return Model(trees, thresholds)


def detect(proposed: DataFrame, model: Model) -> DataFrame:
    """One row per proposal: id, of, base and spans, both sorted arrays of (start,
    kind, end, value). spans holds the base spans and, per document, the candidates
    at or above their kind's threshold that overlap no base span and no better
    candidate (by score, then length, then place)."""
    if model.trees is None or not model.thresholds:
        return proposed.select("id", "of", "base", F.col("base").alias("spans"))
    least = F.lit(2.0)
    for kind, threshold in model.thresholds.items():
        least = F.when(F.col("kind") == KINDS.index(kind), threshold).otherwise(least)
    apart = proposed.withColumn(
        "candidates",
        F.filter(
            "candidates",
            lambda c: ~F.exists(
                "base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])
            ),
        ),
    ).filter(F.size("candidates") > 0)
    taken = (
        scored(candidate_rows(apart), model.trees)
        .filter(F.col("score") >= least)
        .groupBy("id", "of")
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        (-F.col("score")).alias("rank"),
                        (F.col("start") - F.col("end")).alias("short"),
                        "start",
                        "kind",
                        "end",
                        "value",
                    )
                )
            ).alias("more")
        )
        .select(F.col("id").alias("id2"), F.col("of").alias("of2"), "more")
    )
    span = "array<struct<start:int,kind:int,end:int,value:string>>"
    chosen = F.aggregate(
        "more",
        F.array().cast(span),
        lambda kept, c: F.when(
            F.exists(kept, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"])), kept
        ).otherwise(
            F.concat(kept, F.array(F.struct(c["start"], c["kind"], c["end"], c["value"])))
        ),
    )
    return (
        proposed.join(taken, F.expr("of = of2 AND id <=> id2"), "left")
        .withColumn("added", F.when(F.col("more").isNotNull(), chosen))
        .select(
            "id",
            "of",
            "base",
            F.when(F.col("added").isNull(), F.col("base"))
            .otherwise(F.sort_array(F.concat("base", "added")))
            .alias("spans"),
        )
    )


def count(spans: str, kind: str) -> Column:
    """How many spans of a kind an array column holds."""
    at = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == at)).cast("long")


def written(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    kinds = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def redact(docs: DataFrame, spans: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents with each span replaced by ``<kind>``; spans that overlap one
    before them are cut to what follows it. ``spans`` is a result of ``detect`` over
    the same documents; those with spans are broadcast where there are at most
    BROADCAST_TEXTS of them, by count, so that texts need not be shuffled. All columns
    are kept, whatever their names; null and empty texts have no spans and stay."""
    key, id_, of, own = fresh(docs, "_key", "_id", "_of", "_spans")
    marked = (
        spans.filter(F.size("spans") > 0)
        .select(
            F.col("id").alias(id_),
            F.col("of").alias(of),
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")
                ),
            ).alias(own),
        )
        .dropDuplicates([id_, of])
    )
    if marked.count() <= BROADCAST_TEXTS:
        marked = F.broadcast(marked)
    text = F.col(text_col)
    kinds = F.array(*map(F.lit, KINDS))

    def step(a: Column, s: Column) -> Column:
        start = F.greatest(s["start"], a["at"])
        before = text.substr(a["at"] + 1, start - a["at"])
        mark = F.when(
            s["end"] > a["at"], F.concat(F.lit("<"), F.get(kinds, s["kind"]), F.lit(">"))
        ).otherwise("")
        return F.struct(
            F.greatest(s["end"], a["at"]).alias("at"),
            F.concat(a["out"], F.array(before, mark)).alias("out"),
        )

    clean = F.aggregate(
        F.col(own),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")),
        step,
        lambda a: F.concat(F.array_join(a["out"], ""), text.substr(a["at"] + 1, F.length(text))),
    )
    redacted = F.when(F.col(own).isNotNull(), clean).otherwise(text).alias(text_col)
    names = [redacted if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return (
        docs.withColumn(key, F.xxhash64(id_col, text_col))
        .join(marked, F.expr(f"`{key}` = `{of}` AND `{id_col}` <=> `{id_}`"), "left")
        .select(*names)
    )

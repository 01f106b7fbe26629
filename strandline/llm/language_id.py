"""Language by the nearest of several centroids per language, by cosine."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm import ngrams

SIZE = 4096
TRIGRAMS = ngrams.tables_for(3, 3, SIZE)
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """ASCII letters and all bytes of other characters stay; the rest is a blank."""
    kept = np.full(256, 32, np.uint8)
    kept[97:123] = np.arange(97, 123)
    kept[128:] = np.arange(128, 256)
    return kept


LETTERS = _letters()


def counts_of(column: pa.Array) -> np.ndarray:
    """Counts of letter trigrams per lower-cased text; words are set off by one blank."""
    data, offsets = ngrams.lower_utf8(column)
    out = np.zeros((len(column), SIZE), np.float32)
    letters = LETTERS[data]
    for i in range(len(column)):
        part = letters[offsets[i] : offsets[i + 1]]
        part = np.concatenate(([32], part, [32])).astype(np.uint8)
        blank = part == 32
        keep = np.ones(len(part), dtype=bool)
        keep[1:] = ~(blank[1:] & blank[:-1])
        out[i] = ngrams.byte_counts(part[keep], TRIGRAMS, SIZE)
    return out


@dataclass(frozen=True)
class Model:
    """Bin weights; unit centroids with their language and least similarity."""

    weights: np.ndarray
    centroids: np.ndarray
    of: np.ndarray
    languages: list[str]
    least: np.ndarray

    def place(self, counts: np.ndarray) -> np.ndarray:
        return ngrams.unit(np.log1p(counts) * self.weights)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, cosine, and whether the text is too far from its centroid."""
        if not self.languages:
            n = len(counts)
            return np.zeros(n, int), np.zeros(n), np.ones(n, bool)
        near = self.place(counts) @ self.centroids.T
        best = near.argmax(axis=1)
        cosine = np.clip(near[np.arange(len(near)), best], 0, 1).astype(np.float64)
        return self.of[best], cosine, cosine < self.least[best]


def clustered(rows: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Unit centroids of at most k clusters by cosine; farthest-first starts."""
    centroids = ngrams.unit(rows.mean(axis=0, keepdims=True))
    for _ in range(1, min(k, len(rows))):
        farthest = (rows @ centroids.T).max(axis=1).argmin()
        centroids = np.concatenate([centroids, rows[farthest : farthest + 1]])
    for _ in range(rounds):
        of = (rows @ centroids.T).argmax(axis=1)
        sums = np.stack([rows[of == c].sum(axis=0) for c in np.unique(of)])
        centroids = ngrams.unit(sums)
    return centroids


def fit(
    docs: DataFrame,
    max_texts: int = 600,
    centroids: int = 4,
    least_quantile: float = 0.01,
    slack: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Bin weights from all ``docs`` with a language; centroids from a bounded sample.

    ``max_texts`` bounds the texts per language (those with the least id hashes) that
    reach the driver, as rows of term counts. A centroid's least similarity is
    ``slack`` times the ``least_quantile`` of the cosines of its own sample texts.
    Null texts and languages are left out; without any text there are no centroids.
    """
    known = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    found, n_docs = ngrams.document_frequencies(known, counts_of, SIZE, "text")
    weights = ngrams.idf(found, n_docs)

    # A share of each language by id hash, so that no language goes to one task.
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    wanted = F.lit(False)
    for lang, n in sizes:
        share = int(min(1.0, max_texts / n) * (1 << 30))
        near = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) < share
        wanted = wanted | ((F.col("lang") == lang) & near)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ngrams.BLOCK):
                part = batch.slice(at, ngrams.BLOCK)
                yield pa.RecordBatch.from_pydict(
                    {
                        "counts": [r.astype(np.float32).tobytes() for r in counts_of(part[0])],
                        "lang": part[1],
                    }
                )

    rows = (
        known.filter(wanted)
        .select("text", "lang")
        .mapInArrow(task, "counts binary, lang string")
        .toArrow()
    )
    langs = np.array(rows.column("lang").to_pylist(), dtype=object)
    terms = np.frombuffer(
        b"".join(rows.column("counts").to_pylist()), np.float32
    ).reshape(-1, SIZE)
    terms = ngrams.unit(np.log1p(terms) * weights)
    names = sorted(set(langs))
    parts, of, least = [], [], []
    for number, lang in enumerate(names):
        own = terms[langs == lang]
        own = own[np.lexsort(own[:, :32].T)]  # the fit does not depend on row order
        own = own[(own != 0).any(axis=1)]
        if not len(own):
            continue
        found_centroids = clustered(own, centroids)
        near = own @ found_centroids.T
        nearest = near.argmax(axis=1)
        for c in range(len(found_centroids)):
            cosines = near[nearest == c, c]
            least.append(slack * np.quantile(cosines, least_quantile) if len(cosines) else 0.0)
        parts.append(found_centroids)
        of += [number] * len(found_centroids)
    if not parts:
        return Model(weights, np.zeros((0, SIZE)), np.zeros(0, int), [], np.zeros(0))
    return Model(weights, np.concatenate(parts), np.array(of), names, np.array(least))


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id, lang_pred, score (the cosine, 0..1), rejected.

    ``rejected`` marks texts farther from their centroid than its least similarity;
    lang_pred still names the nearest. Texts that are null or without a letter are
    ``und`` with score 0, rejected; a text whose n-grams were never seen goes to the
    first centroid with score 0; without any learned language all are ``und``. Repeated rows give as many rows; other columns are
    not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ngrams.BLOCK):
                part = batch.slice(at, ngrams.BLOCK)
                own = shared.value
                number, cosine, far = own.nearest(counts_of(part.column(1)))
                names = own.languages or [UNKNOWN]
                lang = np.array([names[n] for n in number], dtype=object)
                none = ~part.column(2).to_numpy(zero_copy_only=False)
                lang[none], cosine[none], far[none] = UNKNOWN, 0.0, True
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(lang, pa.string()), pa.array(cosine), pa.array(far)],
                    names=["id", "lang_pred", "score", "rejected"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return (
        docs.select(
            F.col(id_col).alias("id"),
            F.col(text_col).alias("text"),
            F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("has_letter"),
        )
        .mapInArrow(task, f"id {kind}, lang_pred string, score double, rejected boolean")
        .withColumnRenamed("id", id_col)
    )

"""Language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector of hashed character n-grams (1 to 3), scaled to length
one. Per language a spherical k-means over a bounded sample gives a few centroids; a
text gets the language of the centroid with the largest cosine. Each language has a
radius, a quantile of its sample's distances: a text beyond it is marked as not
accepted.

The fit uses at most ``SAMPLE`` texts per language, those with the smallest hash of
``doc_id``; only their n-gram counts come to the driver. Prediction is one pass over
the whole texts with one small broadcast, without a shuffle.

Defined results: a text that is null or has no letter is ``und`` with score 0 and is
accepted; with nothing to learn from, every text is ``und``; repeated rows repeat their
result; ties between centroids go to the language first in code-point order.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.ship import ship
from faregrid.session import staged

UNKNOWN = "und"
BUCKET_BITS = 14
SAMPLE = 300
CLUSTERS = 4
ROUNDS = 12
RADIUS_QUANTILE = 0.995
FOLDS = 5

_NO_LETTERS = regex.compile(r"\P{L}+")
_FACTORS = tuple(
    np.uint32(f) for f in (2_654_435_761, 2_246_822_519, 3_266_489_917, 668_265_263)
)


def letters_only(text: str | None) -> str:
    """Lower-case letters, with one blank around and between runs of them."""
    return f" {_NO_LETTERS.sub(' ', (text or '').lower()).strip()} "


def grams(clean: str) -> np.ndarray:
    """Hashed n-grams of a cleaned text; blanks mark word ends."""
    codes = np.frombuffer(clean.encode("utf-32-le"), dtype=np.uint32)
    shift = np.uint32(32 - BUCKET_BITS)
    mixed, out = np.zeros(len(codes), dtype=np.uint32), []
    for n, factor in enumerate(_FACTORS[:3]):
        if len(codes) <= n:
            break
        mixed = (mixed[: len(codes) - n] ^ codes[n:]) * factor
        mixed ^= mixed >> np.uint32(15)
        out.append((mixed * _FACTORS[3]) >> shift)
    return np.concatenate(out).astype(np.int64)


def _counts(texts: list[str]) -> np.ndarray:
    """One row of n-gram counts per cleaned text."""
    size = 1 << BUCKET_BITS
    keys = [grams(t) + i * size for i, t in enumerate(texts)]
    flat = np.bincount(np.concatenate(keys), minlength=size * len(texts))
    return flat.reshape(len(texts), size).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    norm = np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]
    return rows / np.maximum(norm, 1e-12)


@dataclass(frozen=True)
class Centroids:
    languages: tuple[str, ...]
    owner: np.ndarray  # place in ``languages`` of each centroid
    centres: np.ndarray
    idf: np.ndarray
    least_cosine: np.ndarray  # per language

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return _unit(np.log1p(counts) * self.idf)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language place, cosine and lead over the next language."""
        cosine = self.vectors(counts) @ self.centres.T
        best = np.full((len(counts), len(self.languages)), -1.0)
        for k, language in enumerate(self.owner):
            best[:, language] = np.maximum(best[:, language], cosine[:, k])
        place = best.argmax(axis=1)
        top = best.max(axis=1)
        others = best.copy()
        others[np.arange(len(best)), place] = -1.0
        return place, np.clip(top, 0.0, 1.0), top - others.max(axis=1)


def _spherical_means(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = rows[rng.permutation(len(rows))[:k]]
    for _ in range(ROUNDS):
        own = (rows @ centres.T).argmax(axis=1)
        sums = np.stack([rows[own == c].sum(axis=0) for c in range(len(centres))])
        filled = np.einsum("ij,ij->i", sums, sums) > 0
        centres = np.where(filled[:, None], _unit(sums), centres)
    return centres


def crc_fold(doc_id) -> F.Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def training_rows(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` texts with letters per language, by the smallest hash of ``doc_id``."""
    usable = docs.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    chosen = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 30))
    rows = usable.select("lang", "text", chosen.alias("_draw"))
    # twice the share that is needed passes by itself, so few texts are sorted
    share = staged(
        rows.groupBy(F.col("lang").alias("_lang")).agg(
            (2.0 * sample / F.count("*") * (1 << 30)).alias("_most")
        ),
        "languages",
    )
    first = Window.partitionBy("lang").orderBy("_draw", F.xxhash64("text"))
    return (
        rows.join(share, F.col("lang") == F.col("_lang"))
        .filter(F.col("_draw") <= F.col("_most"))
        .withColumn("_place", F.row_number().over(first))
        .filter(F.col("_place") <= sample)
        .select("lang", "text", "_place")
    )


def fit(docs: DataFrame, sample: int = SAMPLE, clusters: int = CLUSTERS) -> Centroids:
    """Centroids of the languages in ``docs`` (columns ``doc_id``, ``text``, ``lang``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = _counts([letters_only(row["text"])])[0]
                (used,) = counts.nonzero()
                yield pa.RecordBatch.from_pydict(
                    {
                        "lang": [row["lang"]],
                        "_place": pa.array([row["_place"]], pa.int32()),
                        "bucket": pa.array([used.tolist()], pa.list_(pa.int32())),
                        "n": pa.array([counts[used].tolist()], pa.list_(pa.float32())),
                    }
                )

    ship(docs.sparkSession)
    drawn = training_rows(docs, sample).mapInArrow(
        run, "lang string, _place int, bucket array<int>, n array<float>"
    )
    rows = sorted(drawn.collect(), key=lambda r: (r["lang"], r["_place"]))
    size = 1 << BUCKET_BITS
    languages = tuple(sorted({r["lang"] for r in rows}))
    seen = np.ones(size)
    for r in rows:
        seen[r["bucket"]] += 1
    idf = (np.log((1 + len(rows)) / seen) + 1).astype(np.float32)
    centres, owner, least = [], [], []
    for place, language in enumerate(languages):
        own = [r for r in rows if r["lang"] == language]
        counts = np.zeros((len(own), size), dtype=np.float32)
        for i, r in enumerate(own):
            counts[i, r["bucket"]] = r["n"]
        vectors = _unit(np.log1p(counts) * idf)
        found = _spherical_means(vectors, clusters, np.random.default_rng(place))
        centres.append(found)
        owner += [place] * len(found)
        distance = 1 - (vectors @ found.T).max(axis=1)
        least.append(1 - np.quantile(distance, RADIUS_QUANTILE))
    joined = np.concatenate(centres) if centres else np.zeros((0, size), dtype=np.float32)
    return Centroids(languages, np.asarray(owner, dtype=int), joined, idf, np.asarray(least))


def predict(docs: DataFrame, model: Centroids) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` (cosine), ``lead`` and ``accepted`` per document.

    ``accepted`` is false where the text lies beyond the radius of its language.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # centroids of a few languages: languages * clusters * 2**14 numbers
    shared = ship(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centroids = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 32):
                part = batch.slice(start, 32)
                clean = [letters_only(t.as_py()) for t in part.column("text")]
                known = np.asarray([len(c) > 2 for c in clean]) & bool(centroids.languages)
                lang = np.full(len(clean), UNKNOWN, dtype=object)
                score, lead = np.zeros(len(clean)), np.zeros(len(clean))
                accepted = np.ones(len(clean), dtype=bool)
                if known.any():
                    counts = _counts([c for c, k in zip(clean, known, strict=True) if k])
                    place, cosine, ahead = centroids.nearest(counts)
                    lang[known] = np.asarray(centroids.languages, dtype=object)[place]
                    score[known], lead[known] = cosine, ahead
                    accepted[known] = cosine >= centroids.least_cosine[place]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "lang_pred": pa.array(lang, pa.string()),
                        "score": pa.array(score, pa.float64()),
                        "lead": pa.array(lead, pa.float64()),
                        "accepted": pa.array(accepted, pa.bool_()),
                    }
                )

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {id_type}, lang_pred string, score double, lead double, accepted boolean",
    )

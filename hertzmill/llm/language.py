"""Language identification by the nearest of several centroids per language.

A text is a TF-IDF vector of hashed byte bigrams and trigrams of its lower-cased whole
text, scaled to length one. Document frequencies come from all training rows. Each
language's vectors, from a bounded sample, are clustered by spherical k-means; a text
goes to the language of the centroid with the highest cosine, and is rejected when that
centroid is further away than its own training vectors are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIM_BITS = 12
DIM = 1 << DIM_BITS
#: Most training rows a language that centroids are fitted on. Rows are drawn by hash.
SAMPLE = 600
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PIECE = 1 << 18
_KEEP = np.ones(256, bool)
_KEEP[:65] = False
_KEEP[[91, 92, 93, 94, 95, 96, 123, 124, 125, 126, 127]] = False


def counts(text: str) -> np.ndarray:
    """Hashed counts of byte bigrams and trigrams; each run of bytes that aren't letters is one space."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    out = np.zeros(DIM, np.int64)
    for at in range(0, len(data), _PIECE):
        a = data[at : at + _PIECE]
        a = np.where(_KEEP[a], a, np.uint8(32))
        a = a[np.r_[True, (a[1:] != 32) | (a[:-1] != 32)]].astype(np.uint32)
        a = np.concatenate([[32], a, [32]]).astype(np.uint32)
        two = a[:-1] * np.uint32(257) + a[1:]
        three = two[:-1] * np.uint32(65537) + a[2:]
        for grams in (two * np.uint32(2654435761), three * np.uint32(2246822519)):
            out += np.bincount(grams >> np.uint32(32 - DIM_BITS), minlength=DIM)
    return out


def vectors(texts: list[str], idf: np.ndarray) -> np.ndarray:
    out = np.zeros((len(texts), DIM), np.float32)
    for i, text in enumerate(texts):
        c = counts(text)
        out[i] = np.where(c > 0, 1 + np.log(np.maximum(c, 1)), 0) * idf
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norm > 0, norm, 1)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    langs: list
    radius: np.ndarray

    def predict(self, texts: list[str]) -> tuple[list, np.ndarray, np.ndarray]:
        """Language, cosine (0 to 1) and whether the text lies within its centroid's radius."""
        names, cosines, near = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        some = [i for i, x in enumerate(texts) if _LETTER.search(x)]
        if some and len(self.langs):
            sims = vectors([texts[i] for i in some], self.idf) @ self.centroids.T
            best = sims.argmax(axis=1)
            for i, b, s in zip(some, best, sims[np.arange(len(some)), best], strict=True):
                names[i], cosines[i], near[i] = self.langs[b], min(1.0, max(0.0, float(s))), 1 - s <= self.radius[b]
        return names, cosines, near


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, n = np.zeros(DIM, np.int64), 0
    for batch in batches:
        for text in batch["text"].to_pylist():
            total += counts(text) > 0
            n += 1
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, DIM), pa.int32()), pa.array(np.r_[n, total])], ["gram", "n"])


def _clusters(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from spread-out first members: each is the furthest from those before."""
    centers = x[:1]
    while len(centers) < min(k, len(x)):
        centers = np.vstack([centers, x[(x @ centers.T).max(axis=1).argmin()]])
    for _ in range(rounds):
        own = (x @ centers.T).argmax(axis=1)
        centers = np.stack([x[own == j].sum(axis=0) if (own == j).any() else centers[j] for j in range(len(centers))])
        centers /= np.linalg.norm(centers, axis=1, keepdims=True)
    return centers


def fit(train: DataFrame, per_language: int = 4, sample: int = SAMPLE, quantile: float = 0.995) -> Model:
    """train: doc_id, text, lang, none of them null. Texts without letters and empty tables teach nothing.

    The driver gets one count per hash slot (4097 numbers) and at most about ``sample``
    texts' vectors a language, computed on executors; rows are drawn by a hash of doc_id.
    """
    rows = {r["gram"]: r["n"] for r in train.select("text").mapInArrow(_frequencies, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()}
    n = rows.get(-1, 0)
    idf = np.log((1 + n) / (1 + np.array([rows.get(i, 0) for i in range(DIM)], np.float64))) + 1
    idf = idf.astype(np.float32)
    sizes = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model(idf, np.zeros((0, DIM), np.float32), [], np.zeros(0))
    share = F.create_map(*[F.lit(x) for lang, m in sizes.items() for x in (lang, min(1.0, sample / m))])
    drawn = train.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 20)) < F.try_element_at(share, "lang") * (1 << 20))

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(d, lang, x) for d, lang, x in zip(batch["doc_id"].to_pylist(), batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True) if _LETTER.search(x)]
            x = vectors([k[2] for k in kept], idf).astype(np.float16)
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in kept], pa.int64()), pa.array([k[1] for k in kept], pa.string()), pa.array([r.tobytes() for r in x], pa.binary())], ["doc_id", "lang", "x"])

    held: dict = {}
    for r in drawn.mapInArrow(embed, "doc_id long, lang string, x binary").collect():
        held.setdefault(r["lang"], []).append((r["doc_id"], bytes(r["x"])))
    centroids, langs, radius = [], [], []
    for lang in sorted(held):
        x = np.stack([np.frombuffer(b, np.float16).astype(np.float32) for _, b in sorted(held[lang])])
        c = _clusters(x, per_language)
        sims = x @ c.T
        own = sims.argmax(axis=1)
        for j in range(len(c)):
            mine = 1 - sims[own == j, j]
            centroids.append(c[j])
            langs.append(lang)
            radius.append(float(np.quantile(mine, quantile)) * 1.1 if len(mine) else 0.0)
    return Model(idf, np.stack(centroids), langs, np.array(radius))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and accepted of every row; only doc_id and text are read.

    lang_pred is ``und`` where text is null or has no letter (score 0, not accepted), or
    the model has no language; else the language of the nearest centroid, also where it
    is rejected (accepted false). score: cosine to that centroid, 0 to 1. Ties go to the
    language that sorts first. Repeated rows give repeated rows; no rows give none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some centroids of 4096 numbers a language

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                names, cosines, near = shared.value.predict([x or "" for x in part["text"].to_pylist()])
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(names, pa.string()), pa.array(cosines), pa.array(near)], ["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, lang_pred string, score double, accepted boolean")

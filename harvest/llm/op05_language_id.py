"""Language ID by nearest centroids.

A text is lower-cased, its runs of letters are joined by one space, and its character 2- and 3-grams are
counted in ``dims`` hashed cells. The vector is (1 + log tf) * idf, normalised.

Fitting (``fit``) uses a sample of the labelled rows, bounded by ``per_language`` texts for each language on
average and ``most`` texts in all; it is drawn by a hash of the text, with copies of a text once. On it, the idf
is counted and each language's vectors are clustered into ``clusters`` centroids (spherical k-means, started
from the vectors that lie farthest apart). The model is a fixed ``dims`` x (languages * clusters) matrix.

Prediction takes each whole text to the centroid of highest cosine. A text whose distance to all centroids is
beyond the ``floors`` is rejected: the floor of a language and a band of text lengths is the cosine that all but ``outliers`` of
the sample's texts of that length reach with their own language; where under ``FEW`` texts are so long, that of passages
cut from longer ones, without those that repeat their words. They are scored by centroids of the half of
the sample that they are not in, as new texts lie farther from the centroids than learned ones.

Defined cases: null texts, texts without a letter, and all texts where nothing could be learned get ``und``, score
0 and are rejected; equal cosines go to the first language in alphabetical order; rows without a language
or id are not learned from, but predicted. Other columns are carried in ``rest``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import pieces, rest_of

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
C2, C3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


#: Least lengths, in letters and spaces between words, of the bands with floors of their own.
BANDS = np.array([1, 8, 24, 64, 160, 400, 1000])
FEW = 30


def band(length: np.ndarray) -> np.ndarray:
    return np.maximum(np.searchsorted(BANDS, length, "right") - 1, 0)


def vectors(texts: list[str | None], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """1 + log of the gram counts, a row for each text, and the texts' lengths; zero where there is no letter. ``dims`` is a power of two."""
    shift = np.uint32(32 - dims.bit_length() + 1)
    out, length = np.zeros((len(texts), dims), np.float32), np.zeros(len(texts), np.int64)
    for k, t in enumerate(texts):
        words = LETTERS.findall(t.lower()) if t else ()
        if not words:
            continue
        c = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le", "surrogatepass"), np.uint32)
        length[k] = len(c) - 2
        two = (c[:-1] * C2 + c[1:]) * C3
        three = (two[:-1] + c[2:]) * C2
        out[k] = np.bincount((two ^ two >> np.uint32(15)) * C2 >> shift, minlength=dims)
        out[k] += np.bincount((three ^ three >> np.uint32(13)) * C3 >> shift, minlength=dims)
    some = out > 0
    out[some] = 1 + np.log(out[some])
    return out, length


def passages(text: str) -> list[str | None]:
    """For each band, words from within the text that just reach its least length; null where the text is shorter or they repeat."""
    words = LETTERS.findall(text.lower())
    words = words[len(words) // 3:] + words[:len(words) // 3]
    reach = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0)
    ends = np.searchsorted(reach, BANDS).tolist()
    return [" ".join(words[:n + 1]) if n < len(words) and 2 * len(set(words[:n + 1])) > n + 1 else None for n in ends]


def normalised(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means: at most k normalised centroids."""
    chosen = [int(np.argmax(x @ normalised(x.sum(axis=0, keepdims=True))[0]))]
    near = x @ x[chosen[0]]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(near)))
        near = np.maximum(near, x @ x[chosen[-1]])
    c = x[chosen]
    for _ in range(rounds):
        own = np.argmax(x @ c.T, axis=1)
        c = normalised(np.array([x[own == i].sum(axis=0) if (own == i).any() else c[i] for i in range(len(c))]))
    return c


@dataclass
class Model:
    dims: int
    idf: np.ndarray
    languages: list[str]        # of each centroid
    centroids: np.ndarray
    floors: np.ndarray          # of each centroid and band

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """language, score and whether it is rejected."""
        x, length = vectors(texts, self.dims)
        empty = ~x.any(axis=1)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        cosine = normalised(x * self.idf) @ self.centroids.T
        best = np.argmax(cosine, axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best].astype(np.float64), 0, 1)
        score[empty] = 0
        return [UNKNOWN if e else self.languages[i] for i, e in zip(best.tolist(), empty.tolist())], score, empty | (score < self.floors[best, band(length)])


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", dims: int = 4096, clusters: int = 4,
        per_language: int = 400, most: int = 2400, outliers: float = 0.002) -> Model:
    """Learn from the rows where ``learn`` holds and text and language are not null."""
    rows = docs.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    count = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()}
    if not count:
        return Model(dims, np.ones(dims, np.float32), [], np.zeros((0, dims), np.float32), np.zeros((0, len(BANDS))))
    # Each language gets its part of the bound; those with no more texts than that are learned whole, and never cut for the others.
    each = max(1, min(per_language, most // len(count)))
    share = F.create_map(*[F.lit(x) for l, n in count.items() for x in (l, min(1.0, each / n))])[F.col("lang")]
    key = F.xxhash64("text")
    sample = (rows.withColumn("key", key).withColumn("share", share).where(F.pmod("key", F.lit(1 << 30)) < F.col("share") * (1 << 30))
              .dropDuplicates(["lang", "key"]).orderBy(F.col("share") < 1, "key", "lang").limit(most).select("lang", "text").repartition(8, "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 200):
            texts = b.column("text").to_pylist()
            v, length = vectors(texts, dims)
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array([x.tobytes() for x in v.astype(np.float16)], pa.binary()), pa.array(length),
                                              pa.array([passages(t) for t in texts], pa.list_(pa.string()))], ["lang", "v", "length", "passages"])

    got = sorted(((r.lang, bytes(r.v), r.length, r.passages) for r in sample.mapInArrow(run, "lang string, v binary, length long, passages array<string>").collect()),
                 key=lambda r: r[:2])
    x = np.array([np.frombuffer(r[1], np.float16) for r in got], np.float32).reshape(-1, dims)
    kept = x.any(axis=1)
    got = [r for r, k in zip(got, kept) if k]
    x, langs, length = x[kept], np.array([r[0] for r in got], object), np.array([r[2] for r in got], np.int64)
    idf = (np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0))) + 1).astype(np.float32)
    x = normalised(x * idf)
    names, parts, floors = [], [], []
    for l in sorted(set(langs)):
        mine = x[langs == l]
        c = centroids(mine, clusters)
        parts.append(c)
        names += [l] * len(c)
        floors += [floors_of(mine, length[langs == l], [r[3] for r in got if r[0] == l], idf, clusters, outliers)] * len(c)
    return Model(dims, idf, names, np.concatenate(parts) if parts else np.zeros((0, dims), np.float32), np.array(floors).reshape(-1, len(BANDS)))


def floors_of(x: np.ndarray, length: np.ndarray, parted: list[list[str | None]], idf: np.ndarray, clusters: int, outliers: float) -> np.ndarray:
    """The floor of each band for the language with these texts. A band that none reaches has that of the one below."""
    half = np.arange(len(x)) % 2
    others = [centroids(x[half != h], clusters) if len(x) > 1 else x for h in (0, 1)]
    score = np.where(half == 0, *((x @ c.T).max(axis=1) for c in others))
    out = np.zeros(len(BANDS))
    for k in range(len(BANDS)):
        scores = [score[band(length) == k]]
        if len(scores[0]) < FEW:
            for h in (0, 1):
                texts = [p[k] for p in parted[h::2] if p[k]]
                scores += [(normalised(vectors(texts[i:i + 200], len(idf))[0] * idf) @ others[h].T).max(axis=1) for i in range(0, len(texts), 200)]
        scores = np.concatenate(scores)
        out[k] = np.quantile(scores, outliers) if len(scores) else out[k - 1] if k else 0.0
    return out


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """rest (all columns but the text), text, lang_pred, score, rejected: a row for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 500):
            lang, score, rejected = shared.value.predict(b.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang), pa.array(score), pa.array(rejected)],
                                             [*b.schema.names, "lang_pred", "score", "rejected"])

    frame = docs.select(rest_of(docs, text), F.col(text).cast("string").alias("text"))
    return frame.mapInArrow(run, f"rest {dict(frame.dtypes)['rest']}, text string, lang_pred string, score double, rejected boolean")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id mod 5 is 0 (null ids: neither held out nor learned from)."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def with_language(docs: DataFrame) -> DataFrame:
    return identify(docs, fit(docs, ~held_out()))


def digest(found: DataFrame) -> DataFrame:
    return found.select("rest.doc_id", F.coalesce(held_out("rest.doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")

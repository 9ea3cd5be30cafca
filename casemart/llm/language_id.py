"""Language ID (op 2): nearest clustered centroid over normalised TF-IDF n-gram vectors.

A text is the vector of its byte trigrams, counted within words of lower-cased letters and hashed to `DIMENSIONS`
features, as (1 + log tf) * idf, scaled to length 1. Each language has up to `CENTROIDS` centroids, found by spherical
k-means, so that a language of several registers is not averaged away. The language of the nearest centroid by cosine is
predicted. A text that is farther from its centroid than nearly all that made it (`REJECT_SHARE` of them) is rejected.

Document frequencies come from all training rows. The clustering sees at most `SAMPLE_PER_LANGUAGE` different training rows per
language (a documented bound), those with the smallest hash of id and text: all if there are no more, and as many as that
otherwise, however ids and rows repeat. Hashes are sampled without the texts, which are read for the chosen ones only and sent
on as vectors, so a language's group is bounded whatever the lengths of its texts. Languages are clustered side by side in
Spark. Only the centroids, one count per feature and the number of languages reach the driver.

Null texts and texts without a letter are `und` with score 0. Repeated rows are predicted alike and clustered once. Without
training rows every text is `und`. Rows with a null lang aren't learned from; those with a null id are, by their text. Other
columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casemart.llm.common import KEY_BITS, MOST_BITS, blocks, filter_bits, passes, raw_text, stored

DIMENSIONS = 4096
CENTROIDS = 4
SAMPLE_PER_LANGUAGE = 500
REJECT_SHARE = 0.005
#: Texts turned into dense vectors at one time.
ROWS = 128
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
_PLAIN = np.full(256, 32, np.uint8)  # letters, lower-cased; all else is a space
_PLAIN[97:123] = _PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)


def features(column: pa.Array, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """The feature of every trigram within a word, and the text it is in."""
    data, offsets = raw_text(pc.utf8_lower(column))
    plain = _PLAIN[data]
    padded = np.concatenate([np.full(1, 32, np.uint8), plain, np.full(1, 32, np.uint8)])
    x = padded.astype(np.uint32)
    codes = (x[:-2] << 16) | (x[1:-1] << 8) | x[2:]
    owner = np.repeat(np.arange(len(column)), np.diff(offsets))
    inside = plain != 32  # the middle is a letter; a neighbour of another text counts as a space
    first = np.zeros(len(plain), bool)
    first[offsets[:-1][offsets[:-1] < len(plain)]] = True
    codes = np.where(first, (codes & 0xFFFF) | (32 << 16), codes)
    last = np.zeros(len(plain), bool)
    last[offsets[1:][offsets[1:] > 0] - 1] = True
    codes = np.where(last, (codes & 0xFFFF00) | 32, codes)
    hashed = ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(dimensions)
    return hashed[inside].astype(np.int64), owner[inside]


def counts(column: pa.Array, dimensions: int) -> Iterator[tuple[int, np.ndarray]]:
    """Dense trigram counts of up to ROWS texts at a time, with the number of the first."""
    for start in range(0, len(column), ROWS):
        part = column.slice(start, ROWS)
        feature, owner = features(part, dimensions)
        yield start, np.bincount(owner * dimensions + feature, minlength=len(part) * dimensions).reshape(len(part), dimensions)


def vectors(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = tf.astype(np.float32)
    held = x > 0
    x[held] = 1 + np.log(x[held])
    x *= idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def spherical_k_means(x: np.ndarray, k: int, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of length 1 and each row's centroid. Starts from rows far from each other; the same rows give the same result."""
    chosen = [0]
    near = x @ x[0]
    while len(chosen) < min(k, len(x)):
        far = int(np.argmin(near))
        if near[far] > 0.999:
            break
        chosen.append(far)
        near = np.maximum(near, x @ x[far])
    centroids = x[chosen].copy()
    own = np.zeros(len(x), int)
    for turn in range(rounds):
        after = np.argmax(x @ centroids.T, axis=1)
        if turn and (after == own).all():
            break
        own = after
        for j in range(len(centroids)):
            if (own == j).any():
                mean = x[own == j].mean(axis=0)
                centroids[j] = mean / max(np.linalg.norm(mean), 1e-12)
    return centroids, own


@dataclass(frozen=True)
class Model:
    """Centroids of all languages, one row each; least: the cosine below which a text is rejected."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    least: np.ndarray


def _document_frequencies(train: DataFrame, dimensions: int) -> tuple[np.ndarray, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(dimensions, np.int64), 0
        for block in blocks(batches):
            for _, tf in counts(block.column("text"), dimensions):
                total += (tf > 0).sum(axis=0)
                rows += len(tf)
        if rows:  # the last place holds the number of rows
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimensions + 1)), pa.array(np.append(total, rows))], names=["feature", "n"])

    parts = train.select("text").mapInArrow(count, "feature long, n long")
    out = np.zeros(dimensions + 1, np.int64)
    for row in parts.groupBy("feature").agg(F.sum("n").alias("n")).collect():
        out[row["feature"]] = row["n"]
    return out[:-1], int(out[-1])


def sampled(train: DataFrame, sample: int) -> DataFrame:
    """lang, place, text: of each language the `sample` different rows (doc_id, text) with the smallest hashes, or all.

    Hashes with many leading zeros are few: a count of the different ones per number of zeros tells where the wanted ones
    begin, with a margin for its error, and only those beyond are ranked.
    """
    place = F.xxhash64("doc_id", "text", F.lit(17))
    placed = train.select("lang", place.alias("place"), "text")
    # The 63 upper bits as a number; its zeros at the front.
    narrow = placed.select("lang", "place").withColumn("zeros", 63 - F.length(F.bin(F.shiftrightunsigned("place", 1))))
    levels = narrow.groupBy("lang", "zeros").agg(F.approx_count_distinct("place").alias("n"))
    deeper = levels.withColumn("held", F.sum("n").over(Window.partitionBy("lang").orderBy(F.desc("zeros"))))
    least = deeper.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("held") >= 2 * sample, F.col("zeros"))), F.lit(0)).alias("least"))
    # One row per language, where the model that is sent to all tasks has several centroids per language.
    few = narrow.join(F.broadcast(least), "lang").filter("zeros >= least").select("lang", "place").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.shiftrightunsigned("place", 1), "place"))
    chosen = stored(few.withColumn("rank", rank).filter(F.col("rank") <= sample).select("lang", "place"), "sample")
    count = chosen.count()
    bits = min(MOST_BITS, 1 << max(10, (KEY_BITS * count - 1).bit_length())) if count else 1 << 10
    words = train.sparkSession.sparkContext.broadcast(filter_bits(chosen, "place", bits))

    @F.pandas_udf("boolean")
    def may_be_chosen(place: pd.Series) -> pd.Series:
        return pd.Series(passes(words.value, place.to_numpy()))

    # Rows that pass are few, so texts are shuffled for them only; one of equal rows stays.
    rows = placed.filter(may_be_chosen("place")).join(chosen, ["lang", "place"], "left_semi")
    return rows.groupBy("lang", "place").agg(F.first("text").alias("text"))


def fit(train: DataFrame, dimensions: int = DIMENSIONS, centroids: int = CENTROIDS, sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """A model from the rows of train (doc_id, text, lang)."""
    train = train.filter("text IS NOT NULL AND lang IS NOT NULL").select("doc_id", "text", "lang")
    frequency, rows = _document_frequencies(train, dimensions)
    idf = (np.log((1 + rows) / (1 + frequency)) + 1).astype(np.float32)
    if not rows:
        return Model([], idf, np.zeros((0, dimensions), np.float32), np.zeros(0, np.float32))

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches):
            for start, tf in counts(block.column("text"), dimensions):
                x = vectors(tf, idf)
                part = block.slice(start, len(x))
                yield pa.RecordBatch.from_arrays(
                    [part.column("lang"), part.column("place"), pa.array([v.astype("<f4").tobytes() for v in x], pa.binary())], names=["lang", "place", "vector"]
                )

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place", ignore_index=True)
        x = np.frombuffer(b"".join(pdf["vector"]), "<f4").reshape(-1, dimensions)
        x = x[np.linalg.norm(x, axis=1) > 0.5]  # the others have no letter
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "least": []})
        means, own = spherical_k_means(x, centroids)
        cosine = np.einsum("ij,ij->i", x, means[own])
        least = [float(np.quantile(cosine[own == j], REJECT_SHARE)) if (own == j).any() else 1.0 for j in range(len(means))]
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [m.astype("<f4").tobytes() for m in means], "least": least})

    embedded = sampled(train, sample).select("lang", "place", "text").mapInArrow(embed, "lang string, place long, vector binary")
    found = embedded.groupBy("lang").applyInPandas(cluster, "lang string, centroid binary, least double").collect()
    found.sort(key=lambda r: (r["lang"], bytes(r["centroid"])))
    stacked = np.array([np.frombuffer(r["centroid"], "<f4") for r in found], np.float32).reshape(-1, dimensions)
    return Model([r["lang"] for r in found], idf, stacked, np.array([r["least"] for r in found], np.float32))


def predict(docs: DataFrame, model: Model, held_out: Column | None = None) -> DataFrame:
    """doc_id, lang_pred, score, rejected of each row of docs (doc_id, text); with held_out, that column after doc_id.

    A rejected text keeps its nearest language in lang_pred; the caller decides what to do with it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a row per centroid, whatever the size of the input
    dimensions = model.centroids.shape[1]
    marked = held_out is not None

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for block in blocks(batches):
            text = block.column("text")
            best, score = np.zeros(len(text), int), np.zeros(len(text), np.float32)
            if m.languages:
                for start, tf in counts(text, dimensions):
                    cosine = vectors(tf, m.idf) @ m.centroids.T
                    best[start : start + len(tf)] = cosine.argmax(axis=1)
                    score[start : start + len(tf)] = cosine.max(axis=1)
            lettered = np.array([t is not None and bool(m.languages) and _LETTER.search(t) is not None for t in text.to_pylist()], bool)
            names = [m.languages[i] if ok else UNKNOWN for i, ok in zip(best.tolist(), lettered.tolist())]
            score = np.where(lettered, np.clip(score, 0, 1), 0).astype(float)
            far = ~lettered | (score < m.least[best]) if m.languages else ~lettered
            arrays = [block.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(far)]
            fields = ["doc_id", "lang_pred", "score", "rejected"]
            if marked:
                arrays.insert(1, block.column("held_out"))
                fields.insert(1, "held_out")
            yield pa.RecordBatch.from_arrays(arrays, names=fields)

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", "text", held_out.alias("held_out")) if marked else docs.select("doc_id", "text")
    return own.mapInArrow(find, f"doc_id {kind}, {'held_out boolean, ' * marked}lang_pred string, score double, rejected boolean")

"""Language ID by string kernels: blended-spectrum presence kernel, Nystroem landmarks, kernel ridge.

The kernel of two texts is the number of character-class n-grams, n from 1 to 3, that both hold,
over the root of what each holds: the normalised blended-spectrum presence kernel.  It is taken
over the n-grams that occur in the training sample.  ``PER_LANGUAGE`` different training documents a language, least hash
first, and fewer where a language has none or where all would be more than ``SAMPLE``, are the bounded, documented
sample of labelled rows; every language has at least one.  The first ``LANDMARKS`` of them a language are landmarks.  Texts are mapped by
their kernel values to the landmarks (Nystroem), and one-versus-rest ridge regression gives
a score for each language.  Prediction is two matrix products for a batch of texts.

Edge cases: a null text, or one without any letter, is ``und`` with score 0; null langs are never
learned from; a null doc_id is not held out and not learned from; with nothing to learn from all
are ``und``; repeated rows come back once each; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from fragloom.llm import arrays as A
from fragloom.llm.spans import picked, received, sent
from fragloom.storage import materialise

PER_LANGUAGE, LANDMARKS, SAMPLE, RIDGE, BINS = 200, 32, 8000, 1e-3, 1 << 10

#: Chunks are small: a chunk's presence matrix has a row for each document and a column for each n-gram.
CHUNK_BYTES, CHUNK_ROWS = 1 << 19, 128

#: Class n-grams of all sizes have codes below this.
CODES = 64 + 64**2 + 64**3


def _classes():
    """Byte to class: one for each letter, a few for the rest of ASCII, and the bytes of longer characters by value."""
    out = np.zeros(256, np.uint8)
    for c in range(26):
        out[[65 + c, 97 + c]] = 1 + c
    out[48:58] = 27
    out[[ord(c) for c in ".,;:!?"]] = 28
    out[[ord(c) for c in "'\"-()"]] = 29
    out[33:48] = np.where(out[33:48] == 0, 30, out[33:48])
    out[0x80:0xC0] = 31 + np.arange(64) % 26
    out[0xC0:] = 57 + np.arange(64) // 10
    return out


CLASS_OF = _classes()


def presence(data, bounds, column, n_columns):
    """A 0/1 matrix: which n-grams each document holds; column: code to column, or -1."""
    c = CLASS_OF[data].astype(np.int32)
    lengths = np.diff(bounds)
    out = np.zeros((len(lengths), n_columns), np.float32)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    left = np.repeat(bounds[1:], lengths) - np.arange(len(c))
    codes, base = c, 0
    for n in (1, 2, 3):
        if n > 1:
            codes = (codes[:-1] << 6) | c[n - 1 :] if len(codes) > 1 else codes[:0]
            base += 64 ** (n - 1)
        inside = left[: len(codes)] >= n
        at = column[codes[inside] + base]
        known = at >= 0
        out[owner[: len(codes)][inside][known], at[known]] = 1
    return out


def _codes(batches):
    """The n-grams of each training document."""
    every = np.arange(CODES)
    for rows, data, bounds in A.text_chunks(batches, limit=CHUNK_BYTES):
        found = []
        for i in range(rows.num_rows):
            own = presence(data[bounds[i] : bounds[i + 1]], np.array([0, bounds[i + 1] - bounds[i]]), every, CODES)
            found.append(np.flatnonzero(own[0]).astype(np.int32))
        yield pa.RecordBatch.from_arrays([rows.column("lang"), rows.column("rank"), rows.column("doc_id"), pa.array([x.tolist() for x in found], pa.list_(pa.int32()))], names=["lang", "rank", "doc_id", "codes"])


class Model:
    """languages; column: code to column; landmarks: columns by landmark; weights: landmark kernel values to language scores."""

    def __init__(self, sample, landmarks, ridge):
        """sample: (lang, rank, codes) of the training documents."""
        self.languages = sorted({lang for lang, _, _ in sample})
        known = np.unique(np.concatenate([codes for _, _, codes in sample])) if sample else np.zeros(0, np.int64)
        self.column = np.full(CODES, -1, np.int32)
        self.column[known] = np.arange(len(known))
        x = np.zeros((len(sample), len(known)), np.float32)
        for i, (_, _, codes) in enumerate(sample):
            x[i, self.column[codes]] = 1
        x = self._unit(x)
        chosen = [i for i, (_, rank, _) in enumerate(sample) if rank <= landmarks]
        self.landmarks = np.ascontiguousarray(x[chosen].T)
        if not sample:
            return
        values, vectors = np.linalg.eigh((x[chosen] @ self.landmarks).astype(np.float64))
        keep = values > 1e-6 * values.max()
        nystroem = vectors[:, keep] / np.sqrt(values[keep])
        z = (x @ self.landmarks) @ nystroem
        z = np.hstack([z, np.ones((len(z), 1))])
        target = np.array([[1.0 if lang == y else -1.0 for y in self.languages] for lang, _, _ in sample])
        weights = np.linalg.solve(z.T @ z + ridge * len(z) * np.eye(z.shape[1]), z.T @ target)
        self.weights, self.offset = (nystroem @ weights[:-1]).astype(np.float32), weights[-1].astype(np.float32)

    @staticmethod
    def _unit(x):
        return x / np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))

    def scores(self, data, bounds):
        """Language scores of each document, mapped from [-1, 1] to [0, 1]."""
        x = self._unit(presence(data, bounds, self.column, self.landmarks.shape[0]))
        return np.clip(((x @ self.landmarks) @ self.weights + self.offset + 1) / 2, 0, 1)


def _predict(model):
    def predict(batches):
        m = received(model)
        names = np.array([*m.languages, "und"], object)
        for rows, data, bounds in A.text_chunks(_small(batches), limit=CHUNK_BYTES):
            n = rows.num_rows
            best, score = np.full(n, len(m.languages)), np.zeros(n)
            if m.languages:
                scores = m.scores(data, bounds)
                letters = rows.column("letters").fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
                best = np.where(letters, scores.argmax(axis=1), len(m.languages))
                score = np.where(letters, scores.max(axis=1), 0)
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("held_out"), pa.array(names[best].tolist(), pa.string()), pa.array(score, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return predict


def _small(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, CHUNK_ROWS):
            yield batch.slice(i, CHUNK_ROWS)


def _rows(docs, id_col, text_col):
    """doc_id, held_out, text and whether it has a letter."""
    text, key = F.col("text").cast("string"), F.col("doc_id").cast("string")
    held_out = F.coalesce(F.crc32(key.cast("binary")) % 5 == 0, F.lit(False))
    return picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), held_out.alias("held_out"), text.alias("text"), text.rlike(r"\p{L}").alias("letters"))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, most: int = SAMPLE, ridge: float = RIDGE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from a bounded sample: of each language the per_language different documents of least hash, held-out ones left out, or as many as ``most`` in all allow."""
    docs = picked(docs, doc_id=id_col, text=text_col, lang=lang_col)
    learned = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    labelled = docs.where("lang is not null and doc_id is not null and text is not null").where(learned)
    text = F.col("text").cast("string")
    labelled = labelled.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    bin_ = F.pmod(F.xxhash64("doc_id", "tag"), F.lit(BINS))
    named = labelled.select("doc_id", "tag", "lang").distinct().withColumn("bin", bin_)
    languages = labelled.select("lang").distinct().count()
    each = max(1, min(per_language, most // max(1, languages)))
    # Only rows up to the bin that completes a language's sample are ranked, so a frequent language does not gather in one task.
    before = F.sum("count").over(Window.partitionBy("lang").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1))
    bins = named.groupBy("lang", "bin").count().withColumn("before", F.coalesce(before, F.lit(0)))
    last = materialise(bins.where(F.col("before") < each).groupBy("lang").agg(F.max("bin").alias("last_bin")))
    # A row for each language, fewer than the sample that the model is made of: joined without dealing all rows by language.
    near = named.join(F.broadcast(last), "lang").where(F.col("bin") <= F.col("last_bin"))
    first = Window.partitionBy("lang").orderBy("bin", "doc_id", "tag")
    chosen = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= each).select("doc_id", "tag", "lang", "rank")
    # Only rows that were labelled so are learned from, and of repeated ones one.
    training = labelled.join(F.broadcast(chosen), ["doc_id", "tag", "lang"]).dropDuplicates(["doc_id", "tag", "lang"]).select("doc_id", "lang", "rank", "text")
    sample = training.mapInArrow(_codes, "lang string, rank int, doc_id bigint, codes array<int>").collect()
    sample = sorted((x.lang, x.rank, x.doc_id, tuple(x.codes)) for x in sample)
    return Model([(lang, rank, np.array(codes, np.int64)) for lang, rank, _, codes in sample], landmarks, ridge)


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of each document."""
    model = model or train(docs, id_col=id_col, text_col=text_col, lang_col=lang_col)
    model = sent(docs.sparkSession, model)
    return _rows(docs, id_col, text_col).mapInArrow(_predict(model), "doc_id bigint, held_out boolean, lang_pred string, score double")


def query(spark, sf_dir):
    return identify(spark.read.parquet(f"{sf_dir}/documents.parquet"))

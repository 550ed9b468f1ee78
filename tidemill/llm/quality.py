"""Quality scores by nearest-neighbour voting among labelled documents.

A text is described by its words, hashed, and by its form: grams of character classes, word
lengths, and whether words repeat those shortly before. Both parts' roots of relative
frequency, weighted by rarity, are projected to the leading latent dimensions of a labelled
sample, so texts are near that use words of the same kind in the same form. The sample's vectors are broadcast; every document is
compared with all of them in blocks of exact cosine products, and the labels of the
nearest are averaged by similarity.

``SAMPLE`` bounds the sample, and so the broadcast, at every size of the corpus: 4,000
vectors of 48 numbers. It is drawn over all labels together, so their ratio, and with it
what a score means, does not change with the size. All else covers every document and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import Roller, append, mix64, schema_with, texts_of

SAMPLE = 4000
DIMENSIONS = 48
NEIGHBOURS = 25
BLOCK = 512
WORD_SHARE = 0.1  # of a text's squared length that its words make up, beside 1 of its form
_GRAMS, _LAGS, _WORDS = 2048, 6, 1024
_FORM = _GRAMS + 2 * _LAGS + 32
TERMS = _FORM + _WORDS
_EXTRA, _STEPS = 16, 6  # of the subspace iteration


def _classes() -> np.ndarray:
    """One class for a line end, other space, digits, capitals, and letters; each
    other ASCII character has its own. Bytes of longer characters count as letters."""
    table = np.full(256, 4, np.uint8)
    table[:128] = np.arange(128)
    table[[9, 11, 12, 13, 32]] = 1
    table[10] = 0
    table[48:58] = 2
    table[65:91] = 3
    table[97:123] = 4
    return table


class Describer:
    def __init__(self) -> None:
        self.classes, self.roller = _classes(), Roller()
        self.small = np.arange(256, dtype=np.uint8)
        self.small[65:91] = self.small[97:123]

    def __call__(self, text: str) -> np.ndarray:
        """Root frequencies of the terms; all 0 for a text without words."""
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        out = np.zeros(TERMS, np.float32)
        kinds = self.classes[data]
        word = kinds > 1
        edges = np.flatnonzero(np.diff(np.r_[False, word, False]))
        starts, ends = edges[::2], edges[1::2]
        if not len(starts):
            return out
        # Runs of one class count as one, or as two when longer.
        run = np.flatnonzero(np.r_[True, kinds[1:] != kinds[:-1]])
        long_ = (np.diff(np.r_[run, len(kinds)]) > 1).astype(np.uint64)
        shape = kinds[run].astype(np.uint64) * np.uint64(2) + long_
        for n in (1, 2, 3):
            code = np.full(max(len(shape) - n + 1, 0), n, np.uint64)
            for i in range(n):
                code = code * np.uint64(512) + shape[i : len(shape) - n + 1 + i]
            out[:_GRAMS] += np.bincount((mix64(code) % np.uint64(_GRAMS)).astype(np.int64), minlength=_GRAMS)
        # The same word so many words before.
        hashes = self._hashes(data, starts, ends)
        for lag in range(1, _LAGS + 1):
            same = int((hashes[lag:] == hashes[:-lag]).sum())
            out[_GRAMS + 2 * lag - 2] = 4 * same
            out[_GRAMS + 2 * lag - 1] = len(hashes) - same
        out[_GRAMS + 2 * _LAGS : _FORM] = np.bincount(np.minimum(ends - starts, 31), minlength=32)
        # Words by their letters and digits: the marks around them belong to the form.
        letters = self._letters(data)
        out[_FORM:] = np.bincount((mix64(letters) % np.uint64(_WORDS)).astype(np.int64), minlength=_WORDS)
        out[:_FORM] /= out[:_FORM].sum()
        out[_FORM:] *= WORD_SHARE / max(out[_FORM:].sum(), 1)
        return np.sqrt(out)

    def _letters(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the runs of letters and digits, capitals as small ones."""
        kinds = self.classes[data]
        edges = np.flatnonzero(np.diff(np.r_[False, (kinds > 1) & (kinds < 5), False]))
        return self._hashes(self.small[data], edges[::2], edges[1::2])

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        n = len(data)
        if n > len(self.roller.up):
            self.roller._grow(2 * n)
        sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.roller.up[:n])]
        return (sums[ends] - sums[starts]) * self.roller.down[starts]


@dataclass
class Model:
    """All it needs to score; its size is bounded by the sample's."""

    weight: np.ndarray
    mean: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, terms: np.ndarray) -> np.ndarray:
        latent = (terms * self.weight - self.mean) @ self.basis
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-12)

    def score(self, terms: np.ndarray) -> np.ndarray:
        if not len(self.vectors):
            return np.full(len(terms), self.prior)
        out = np.empty(len(terms))
        k = min(NEIGHBOURS, len(self.vectors))
        for at in range(0, len(terms), BLOCK):
            part = terms[at : at + BLOCK]
            cosine = self.project(part) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, near, 1), 0)
            total = vote.sum(1)
            mean = (vote * self.labels[near]).sum(1) / np.maximum(total, 1e-12)
            out[at : at + BLOCK] = np.where((total > 0) & part.any(1), mean, self.prior)
        return np.clip(out, 0.0, 1.0)


class Packed:
    """Compressed rows of terms, unpacked block by block: the driver never holds them whole."""

    def __init__(self, rows: list[bytes]) -> None:
        self.rows = rows

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, part: slice) -> np.ndarray:
        unzip = zstandard.ZstdDecompressor()
        return np.stack([np.frombuffer(unzip.decompress(r), "<f4") for r in self.rows[part]])

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return self[:].astype(dtype or np.float32)


def _leading(terms: np.ndarray | Packed, weight: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The leading directions of the weighted rows, by subspace iteration. In blocks, so that
    the driver holds no second copy of the sample."""
    basis = np.random.default_rng(TERMS).normal(size=(TERMS, min(DIMENSIONS + _EXTRA, TERMS)))
    for _ in range(_STEPS):
        basis, _ = np.linalg.qr(basis)
        image = np.zeros_like(basis)
        for at in range(0, len(terms), BLOCK):
            part = (terms[at : at + BLOCK] * weight - mean).astype(np.float64)
            image += part.T @ (part @ basis)
        small = basis.T @ image
        basis_before, basis = basis, image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    return np.ascontiguousarray((basis_before @ turn[:, ::-1])[:, :DIMENSIONS]).astype(np.float32)


def fit(terms: np.ndarray | Packed, labels: np.ndarray) -> Model:
    """Latent dimensions of the sample, the leading ones of its covariance."""
    empty = np.zeros(TERMS, np.float32)
    if not len(terms):
        return Model(empty, empty, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), labels, 0.5)
    seen, total = np.zeros(TERMS, np.int64), np.zeros(TERMS, np.float32)
    for at in range(0, len(terms), BLOCK):
        part = terms[at : at + BLOCK]
        seen += (part > 0).sum(0)
        total = np.add.reduce(np.vstack([total, part]), axis=0)
    weight = np.log((1 + len(terms)) / (1 + seen)).astype(np.float32) + 1
    mean = (total / np.float32(len(terms)) * weight).astype(np.float32)
    basis = _leading(terms, weight, mean)
    model = Model(weight, mean, basis, np.zeros((0, 1), np.float32), labels, float(labels.mean()))
    parts = [model.project(terms[at : at + BLOCK]) for at in range(0, len(terms), BLOCK)]
    model.vectors = np.concatenate(parts).astype(np.float32)
    return model


def held_out(key: str = "doc_id") -> Column:
    """Rows that no label is learnt from; a null key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def describe(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the compressed terms of each text: most are 0, so they take little room on
    their way to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer, zip_ = Describer(), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            terms = [zip_.compress(describer(t).astype("<f4").tobytes()) for t in texts_of(batch.column(text))]
            yield append(batch, **{out: pa.array(terms, pa.binary())})

    return df.mapInArrow(run, schema_with(df, (out, T.BinaryType())))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """A model from at most ``SAMPLE`` labelled keys, those with the smallest hashes whatever
    their label, none of them held out. Other labels than 0 and 1 are ignored; of several labels
    of a key the smaller counts, and of several texts that with the smallest hash."""
    open_ = labels.where(F.col(key).isNotNull() & ~held_out(key)).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_y"))
    chosen = open_.where(F.col("_y").isin(0, 1)).groupBy("_key").agg(F.min("_y").alias("_y"))
    chosen = chosen.orderBy(F.xxhash64("_key"), "_key").limit(SAMPLE)
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_key")
    described = describe(sample.withColumn("_hash", F.xxhash64("_text")), "_text", "_terms")
    one = described.groupBy("_key").agg(F.min(F.struct("_hash", "_y", "_terms")).alias("r"))
    rows = one.select(F.xxhash64("_key").alias("_place"), "_key", "r._y", "r._terms").collect()
    rows.sort(key=lambda r: (r["_place"], r["_key"]))
    return fit(Packed([bytes(r["_terms"]) for r in rows]), np.array([r["_y"] for r in rows], np.float32))


def score_quality(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1. Texts that are null, empty or without words get
    the sample's share of label 1. A column already named ``out`` is replaced."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        describer = Describer()
        for batch in batches:
            texts = texts_of(batch.column(text))
            scores = np.zeros(len(texts))
            for at in range(0, len(texts), BLOCK):
                part = np.stack([describer(t) for t in texts[at : at + BLOCK]])
                scores[at : at + BLOCK] = shared.value.score(part)
            yield append(batch, **{out: pa.array(scores, pa.float64())})

    return df.mapInArrow(run, schema_with(df, (out, T.DoubleType())))

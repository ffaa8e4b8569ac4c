"""Quality classifier: regularised quadratic discriminant.

Each text becomes a vector of transformed statistics (logs of lengths,
squared-root shares of symbols, capitals, digits, repeats and so on; never its
language, source or id). Per class, Spark sums the first and second moments
of the labelled training rows; the driver sees one fixed-size table of sums.
Class covariances are shrunk towards the pooled one and towards its diagonal,
factored once by Cholesky, and a text's score is the logistic of the
difference of the two Mahalanobis log densities plus the log prior odds.

Training uses every labelled row whose crc32(doc_id as text) mod 4 is not 2.

Defined results: null and empty texts have the zero statistics and a score;
a document labelled twice counts once, by its lower label; labels other than
0 and 1 are ignored; with a class missing the score is the smoothed class
share; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens.llm.quality_rules import SYMBOLS, ngram_cover
from sessionlens.llm.tables import id_text
from sessionlens.llm.textblock import Block, U64, blocks, code_points, mix, utf8
from sessionlens.session import cut_lineage

HELD_OUT = 2
FOLDS = 4
THRESHOLD = 0.7
FEATURES = ["log_chars", "log_words", "word_chars", "symbol", "digit", "upper", "punctuation", "bang",
            "newline", "non_ascii", "distinct", "top_word", "repeat_3", "no_letter", "log_line_words", "longest"]


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars.encode())] = 1
    return out


_DIGIT = _class("0123456789")
_UPPER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER + _class("abcdefghijklmnopqrstuvwxyz")
_LETTER[0x80:] = 1
_PUNCTUATION = _class(".,;:?'\"()-")
_BANG = _class("!")
_NEWLINE = _class("\n")
_HIGH = np.zeros(256, np.int64)
_HIGH[0xC0:] = 1  # lead bytes: one a code point


def statistics(b: Block) -> np.ndarray:
    """Feature matrix of a block, one row a text."""
    n = len(b)

    def total(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        run = np.zeros(len(values) + 1)
        np.cumsum(values, out=run[1:])
        return run[edges[1:]] - run[edges[:-1]]

    points = code_points(b.data)
    chars = (points[b.offsets[1:]] - points[b.offsets[:-1]]).astype(float)
    words = np.diff(b.first).astype(float)
    size = points[b.end] - points[b.start]
    c, w = np.maximum(chars, 1), np.maximum(words, 1)
    share = lambda table: np.sqrt(total(table[b.data], b.offsets) / c)
    h = b.hashes()
    own = mix(h ^ mix(b.doc.astype(U64)))  # a word's hash within its text
    _, at, count = np.unique(own, return_index=True, return_counts=True)
    distinct = np.bincount(b.doc[at], minlength=n)
    top, longest = np.zeros(n), np.zeros(n)
    np.maximum.at(top, b.doc[at], count)
    np.maximum.at(longest, b.doc, size)
    letters = np.zeros(len(b.data) + 1, np.int64)
    np.cumsum(_LETTER[b.data], out=letters[1:])
    bare = (letters[b.end] == letters[b.start]).astype(float)
    lines = total(_NEWLINE[b.data], b.offsets) + 1
    return np.column_stack([
        np.log1p(chars), np.log1p(words), np.log1p(total(size, b.first) / w), share(SYMBOLS), share(_DIGIT),
        share(_UPPER), share(_PUNCTUATION), share(_BANG), share(_NEWLINE), share(_HIGH), np.sqrt(distinct / w),
        np.sqrt(top / w), np.sqrt(total(ngram_cover(b, h, 3), b.first) / w), np.sqrt(total(bare, b.first) / w),
        np.log1p(words / lines), np.log1p(longest)])


def features(docs: DataFrame) -> DataFrame:
    """doc_id, held_out and the feature vector of every row, in one scan."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for b in blocks(utf8(batch.column(2))):
                x = statistics(b)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(b.rows, len(b)), batch.column(1).slice(b.rows, len(b)), flat],
                    ["doc_id", "held_out", "x"])

    fold = F.crc32(F.col("doc_id").cast("string")) % FOLDS
    rows = id_text(docs).select("doc_id", F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, x array<double>")


@dataclass(frozen=True)
class Model:
    """Standardised class means, inverse Cholesky factors and log constants."""

    centre: np.ndarray
    scale: np.ndarray
    mean: np.ndarray  # class x feature
    inverse: np.ndarray  # class x feature x feature, inverse of the Cholesky factor
    constant: np.ndarray  # class: log prior - log det

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        z = (x - self.centre) / self.scale
        log = np.empty((len(z), 2))
        for k in range(2):
            y = (z - self.mean[k]) @ self.inverse[k].T
            log[:, k] = self.constant[k] - 0.5 * np.einsum("ij,ij->i", y, y)
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -500, 500)))


def moments(train: DataFrame, d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums and sums of products of (label, x) rows, by class."""
    size = 1 + d + d * d

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, size))
        for batch in batches:
            label = batch.column(0).to_numpy(zero_copy_only=False)
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            for k in range(2):
                own = x[label == k]
                acc[k] += np.concatenate([[len(own)], own.sum(0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(2), size)), pa.array(np.tile(np.arange(size), 2)), pa.array(acc.ravel())],
            ["label", "at", "v"])

    sums = train.select("label", "x").mapInArrow(run, "label long, at long, v double")
    out = np.zeros((2, size))
    for r in sums.groupBy("label", "at").agg(F.sum("v").alias("v")).collect():  # fixed size
        out[r.label, r["at"]] = r.v
    return out[:, 0], out[:, 1:d + 1], out[:, d + 1:].reshape(2, d, d)


def fit(n: np.ndarray, s: np.ndarray, p: np.ndarray, to_pooled: float = 0.3, to_diagonal: float = 0.1) -> Model:
    """Shrunken class covariances from the moments."""
    d = s.shape[1]
    prior = (n + 1) / (n.sum() + 2)
    if (n < 2).any():
        return Model(np.zeros(d), np.ones(d), np.zeros((2, d)), np.zeros((2, d, d)), np.log(prior))
    mean = s / n[:, None]
    cov = p / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = np.tensordot(n / n.sum(), cov, 1)
    centre = s.sum(0) / n.sum()
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-6))
    cov, pooled = (c / np.outer(scale, scale) for c in (cov, pooled))
    inverse, constant = np.empty((2, d, d)), np.empty(2)
    for k in range(2):
        c = (1 - to_pooled) * cov[k] + to_pooled * pooled
        c = (1 - to_diagonal) * c + to_diagonal * np.diag(np.diag(c)) + 1e-4 * np.eye(d)
        factor = np.linalg.cholesky(c)
        inverse[k] = np.linalg.solve(factor, np.eye(d))
        constant[k] = np.log(prior[k]) - np.log(np.diag(factor)).sum()
    return Model(centre, scale, (mean - centre) / scale, inverse, constant)


def train(rows: DataFrame, labels: DataFrame) -> Model:
    """Model from the labelled rows outside the held-out fold."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("label"))
             .filter(F.col("label").isin(0, 1)).groupBy("doc_id").agg(F.min("label").alias("label")))
    return fit(*moments(rows.filter(~F.col("held_out")).join(known, "doc_id"), len(FEATURES)))


def score(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and prediction of every document."""
    rows = cut_lineage(features(docs))
    model = docs.sparkSession.sparkContext.broadcast(train(rows, labels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            s = model.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")

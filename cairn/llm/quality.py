"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has its own mean and a covariance shrunk towards a scaled identity (over standardised statistics); the score
is the logistic of the difference of the two Gaussian log densities, whose Mahalanobis distances use Cholesky factors
that are inverted once. Statistics come from the text alone, in one pass over Arrow batches.

The fit reads at most ``FIT_ROWS`` labels (those with the smallest hash of ``doc_id``) and as many rows of their documents; this bound
is what the driver holds. Documents are scored in place, whatever their number.

Defined results: null and empty texts are scored (their statistics are zero); a document labelled twice counts twice if
the labels agree row by row, null labels are not learned from; without rows of both classes every score is the share
of label 1 (1.0 without labels); extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.names import ddl, quoted
from cairn.llm.words import hashed_words, text_slices

FIT_ROWS = 20_000
SHRINKAGE = 0.1
THRESHOLD = 0.7
#: a text of so many words is drawn half way to the middle value of every statistic
SHORT_WORDS = 25
STATISTICS = ("log_words", "log_word_length", "upper", "digits", "marks", "symbols", "non_ascii", "lines_per_word",
              "log_distinct", "log_repeats", "log_symbols", "log_top_byte")


def crc_fold(doc_id: Column, folds: int = 4) -> Column:
    return F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(folds))


def byte_classes() -> np.ndarray:
    """0 other, 1 A-Z, 2 digit, 3 sentence mark, 4 symbol, 5 non-ASCII, 6 newline."""
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = 4
    kinds[[ord(c) for c in ".,;:'?-"]] = 3
    kinds[0x30:0x3A] = 2
    kinds[0x61:0x7B] = 0
    kinds[0x41:0x5B] = 1
    kinds[0x80:] = 5
    kinds[0x0A] = 6
    return kinds


def top_bytes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How often each text's most frequent byte other than white space occurs."""
    rows = len(offsets) - 1
    shown = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])[data]
    cells = np.repeat(np.arange(rows), np.diff(offsets))[shown] * 256 + data[shown]
    return np.bincount(cells, minlength=256 * rows).reshape(rows, 256).max(1)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of transformed statistics per text; nulls count as empty."""
    kinds, out = byte_classes(), np.zeros((len(texts), len(STATISTICS)))
    for row, end, data, offsets in text_slices(texts):
        words, first = hashed_words(data, offsets)
        cells = np.repeat(np.arange(end - row), np.diff(offsets)) * 7 + kinds[data]
        by_kind = np.bincount(cells, minlength=7 * (end - row)).reshape(-1, 7).astype(float)
        size = np.maximum(np.diff(offsets), 1)
        n = np.diff(first)
        owner = np.repeat(np.arange(end - row), n)
        same = np.zeros(len(words), bool)
        same[1:] = (words[1:] == words[:-1]) & (owner[1:] == owner[:-1])
        order = np.lexsort((words, owner))
        fresh = np.ones(len(words), bool)
        fresh[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        distinct = np.bincount(owner[order][fresh], minlength=end - row)
        repeats = np.bincount(owner[same], minlength=end - row)
        most = np.maximum(n, 1)
        share = by_kind[:, 1:] / size[:, None]
        visible = size - by_kind[:, 6]
        out[row:end] = np.column_stack([
            np.log1p(n), np.log1p(visible / most), np.sqrt(share[:, 0]), np.sqrt(share[:, 1]), np.sqrt(share[:, 2]), np.sqrt(share[:, 3]),
            np.sqrt(share[:, 4]), np.log1p(100 * by_kind[:, 6] / most), np.log1p(distinct) / np.log1p(most), np.log1p(100 * repeats / most),
            np.log1p(by_kind[:, 4]) / np.log1p(size), np.log1p(top_bytes(data, offsets)) / np.log1p(size)])
    return out


class QuadraticDiscriminant:
    """Two Gaussians in standardised space; ``factors`` are the inverted Cholesky factors."""

    def __init__(self, x: np.ndarray, good: np.ndarray, shrinkage: float = SHRINKAGE):
        self.share = float(good.mean()) if len(good) else 1.0
        self.fitted = 0 < good.sum() < len(good)
        if not self.fitted:
            return
        self.middle = np.median(x[:, 1:], axis=0)
        x = self.drawn(x)
        self.centre, self.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
        z = (x - self.centre) / self.scale
        self.means, self.factors, self.offsets = [], [], []
        for group in (z[~good], z[good]):
            mean = group.mean(0)
            spread = (group - mean).T @ (group - mean) / len(group)
            spread = (1 - shrinkage) * spread + shrinkage * max(np.trace(spread) / len(mean), 1e-3) * np.eye(len(mean))
            factor = np.linalg.cholesky(spread)
            self.means.append(mean)
            self.factors.append(np.linalg.inv(factor).T)
            self.offsets.append(np.log(len(group) / len(x)) - np.log(np.diag(factor)).sum())

    def drawn(self, x: np.ndarray) -> np.ndarray:
        """The shares and ratios, those of short texts drawn towards the middle value by their number of words."""
        words = np.expm1(x[:, :1])
        return self.middle + (x[:, 1:] - self.middle) * words / (words + SHORT_WORDS)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.share)
        z = (self.drawn(x) - self.centre) / self.scale
        bad, good = (o - 0.5 * (((z - m) @ f) ** 2).sum(1) for m, f, o in zip(self.means, self.factors, self.offsets))
        return 1 / (1 + np.exp(-np.clip(good - bad, -30, 30)))


def fit_quality(docs: DataFrame, labels: DataFrame, held_out_fold: int | None = 2, fit_rows: int = FIT_ROWS) -> QuadraticDiscriminant:
    """The model of at most ``fit_rows`` labelled documents outside the held-out fold."""
    learnt = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if held_out_fold is not None:
        learnt = learnt.where(crc_fold(F.col("doc_id")) != held_out_fold)
    picked = learnt.select(F.col("doc_id").cast("long").alias("_doc"), (F.col("quality") == 1).alias("_good")).orderBy(
        F.xxhash64("_doc"), "_doc", "_good").limit(fit_rows)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(list(x), pa.list_(pa.float64()))], ["_doc", "good", "x"])

    # a doc_id may repeat, so the bound holds for the joined rows too
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("_doc")).select("_doc", "_good", "text").mapInArrow(
        measured, "_doc bigint, good boolean, x array<double>").orderBy(F.xxhash64("_doc"), "_doc", "good", "x").limit(fit_rows).select("good", "x").collect()
    return QuadraticDiscriminant(np.array([r[1] for r in rows]).reshape(-1, len(STATISTICS)), np.array([r[0] for r in rows], bool))


def score_quality(docs: DataFrame, model: QuadraticDiscriminant, column: str = "quality_score") -> DataFrame:
    """``docs`` with the probability that label 1 applies, in place of a column of that name."""
    docs = docs.drop(column)
    text_at = docs.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(model.score(statistics(batch.column(text_at))))], [*batch.schema.names, column])

    return docs.mapInArrow(scored, f"{ddl(docs)}, {quoted(column)} double")

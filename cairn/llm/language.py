"""Language identification with error-correcting output codes.

Every language has a codeword of +1/-1 bits. For each bit a binary n-gram classifier (log odds of hashed byte trigrams
between the languages on either side) gives a margin, centred and scaled so that the closest languages of both sides
lie at -1 and +1. Decoding adds up the logistic loss of the margins against each codeword, bits weighted by how well they
separate, and takes the language with the least loss; the score is the softmax of the losses, and ``ambiguous`` tells
that the runner-up is close. Up to seven languages have the exhaustive code, more a spread-out random one.

All training documents count: tasks add up trigram frequencies per language, and the driver sees ``languages x BUCKETS``
sums.

Defined results: null text or text without a letter is ``und`` with score 0; without training documents everything is
``und``; a single language is always predicted; null languages are not learned from; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.names import ddl
from cairn.llm.words import byte_table, text_slices

BUCKETS = 8192
UNKNOWN = "und"
GAIN, AMBIGUOUS = 3.0, 0.2


def folded_bytes(data: np.ndarray) -> np.ndarray:
    """Letters lower-cased, everything else a space."""
    table = np.frombuffer(byte_table(), np.uint8).copy()
    table[0x30:0x3A] = 0x20
    return table[data]


def gram_cells(data: np.ndarray, offsets: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of each trigram that holds a letter and lies within one row."""
    low = folded_bytes(data).astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (row[2:] == row[:-2]) & (code != 0x202020)
    return row[:-2][keep], ((code[keep] * np.uint32(0x9E3779B1)) >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int64)


def has_letter(texts: pa.Array) -> np.ndarray:
    return np.array([any(map(str.isalpha, t.as_py() or "")) for t in texts], bool)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of +1/-1 per language."""
    if n <= 7:
        columns = [[1] + [1 if mask >> i & 1 else -1 for i in range(n - 1)] for mask in range(2 ** (n - 1) - 1)]
        return np.array(columns, float).reshape(-1, n).T
    random, width, best = np.random.default_rng(seed), 12 * int(np.ceil(np.log2(n))), None
    for _ in range(50):
        code = random.choice([-1.0, 1.0], (n, width))
        code = code[:, abs(code.sum(0)) < n]
        apart = min((code[i] != code[j]).sum() for i, j in combinations(range(n), 2))
        if best is None or apart > best[0]:
            best = apart, code
    return best[1]


class OutputCode:
    """Bit classifiers and codewords from trigram frequencies per language."""

    def __init__(self, languages: list[str], sums: np.ndarray):
        self.languages, self.buckets = languages, sums.shape[1]
        if len(languages) < 2:
            return
        shares = (sums + sums.sum(1, keepdims=True) * 1e-6 + 1e-12)
        shares /= shares.sum(1, keepdims=True)
        self.code = codewords(len(languages))
        sides = [np.log(np.stack([shares[bits > 0].mean(0), shares[bits < 0].mean(0)])) for bits in self.code.T]
        self.weights = np.array([a - b for a, b in sides]).T
        margins = shares @ self.weights
        low = np.array([m[bits > 0].min() for m, bits in zip(margins.T, self.code.T)])
        high = np.array([m[bits < 0].max() for m, bits in zip(margins.T, self.code.T)])
        self.centre, half = (low + high) / 2, np.maximum((low - high) / 2, 1e-9)
        self.scale, self.trust = 1 / half, half / half.sum() * len(half)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) per text."""
        n = len(texts)
        if not self.languages:
            return [UNKNOWN] * n, np.zeros(n), np.zeros(n, bool)
        known = np.zeros(n, bool)
        losses = np.zeros((n, len(self.languages)))
        for row, end, data, offsets in text_slices(texts):
            letters = np.zeros(len(data) + 1, np.int64)
            low = folded_bytes(data)
            np.cumsum((low >= 0x61) & (low <= 0x7A), out=letters[1:])
            known[row:end] = np.diff(letters[offsets]) > 0
            if len(self.languages) < 2:
                continue
            at, cell = gram_cells(data, offsets, self.buckets)
            count = np.maximum(np.bincount(at, minlength=end - row), 1)
            margins = np.stack([np.bincount(at, self.weights[cell, b], minlength=end - row) for b in range(self.weights.shape[1])], 1)
            margins = np.clip((margins / count[:, None] - self.centre) * self.scale, -4, 4)
            wrong = np.logaddexp(0, -GAIN * margins[:, None, :] * self.code[None])
            losses[row:end] = (wrong * self.trust).sum(2)
        rest = np.flatnonzero(~known)
        known[rest] = has_letter(texts.take(pa.array(rest)))
        odds = np.exp(losses.min(1, keepdims=True) - losses)
        odds /= odds.sum(1, keepdims=True)
        best = odds.argmax(1)
        ranked = np.sort(odds, 1)
        close = ranked[:, -1] - ranked[:, -2] < AMBIGUOUS if len(self.languages) > 1 else np.zeros(n, bool)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, np.where(known, odds.max(1), 0.0), close & known


def fit_languages(docs: DataFrame, buckets: int = BUCKETS) -> OutputCode:
    """The model of all documents of ``docs`` with a language."""
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for row, end, data, offsets in text_slices(batch.column(1)):
                at, cell = gram_cells(data, offsets, buckets)
                share = 1 / np.maximum(np.bincount(at, minlength=end - row), 1)
                for name in set(names[row:end]):
                    own = (names[row:end] == name)[at]
                    part = np.bincount(cell[own], share[at[own]], minlength=buckets)
                    sums[name] = sums[name] + part if name in sums else part
        for name, total in sums.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used.astype(np.int32)), pa.array(total[used])], ["lang", "bucket", "share"])

    rows = (docs.where(F.col("lang").isNotNull()).select("lang", "text").mapInArrow(summed, "lang string, bucket int, share double")
            .groupBy("lang", "bucket").agg(F.sum("share").alias("share")).collect())
    languages = sorted({r[0] for r in rows})
    sums = np.zeros((len(languages), buckets))
    at = {name: i for i, name in enumerate(languages)}
    for name, bucket, share in rows:
        sums[at[name], bucket] = share
    return OutputCode(languages, sums)


def predict_language(docs: DataFrame, model: OutputCode) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` and ``ambiguous``, in place of columns of those names."""
    docs = docs.drop("lang_pred", "lang_score", "ambiguous")
    text_at = docs.columns.index("text")

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, close = model.predict(batch.column(text_at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score), pa.array(close)],
                [*batch.schema.names, "lang_pred", "lang_score", "ambiguous"])

    return docs.mapInArrow(predicted, f"{ddl(docs)}, lang_pred string, lang_score double, ambiguous boolean")

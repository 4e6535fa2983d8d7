"""Importance resampling towards a target distribution, over buckets of hashed word runs.

Words come from an Aho-Corasick dictionary: each distinct word, bounded by a delimiter on both sides, carries its CRC-32 and its
length. A scan of the normalised bytes emits the payloads of all dictionary words in order; the CRC of a run of words is composed
of the payloads of its adjacent words (``joined_crc``), so no run is ever spelt out. A run's bucket is that CRC modulo ``buckets``.

Every task grows its own dictionary from the words it meets, by doubling, up to ``DICTIONARY_WORDS`` words of at most
``WORD_BYTES`` bytes; words outside it get the same payload from their bytes, so results do not depend on the dictionary.

A bucket's gain is ``floor(1000 * ln(((t + 1) * (S + buckets)) / ((s + 1) * (T + buckets))))`` for ``s`` of ``S`` features of all documents
and ``t`` of ``T`` of all target texts; a document's weight is the floored mean of its features' gains. Adding a Gumbel variable drawn
from a hash of seed and ``doc_id`` makes the highest scores a sample without replacement in proportion to the weights.

Defined results: null, empty and wordless texts have no features, weight 0 and are not drawn while ``min_words`` is above 0; a null
``doc_id`` has a weight but no score, is not drawn and does not count for the size of the sample; rows that repeat a ``doc_id`` are
separate rows with the same noise; ties go to the smaller ``doc_id``, then to the smaller weight; an empty table gives no rows,
an empty target gives gains that only depend on the documents; extra columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.store import shuffle_slots, stored
from cairn.llm.words import byte_table, text_slices

BUCKETS, MAX_RUN, SEED = 10_000, 1, 2024
MIN_WORDS, PERCENT = 20, 10
DICTIONARY_WORDS, WORD_BYTES, FIRST_WORDS = 200_000, 64, 256


def byte_operator() -> np.ndarray:
    """Images of the 32 bits under the CRC step over one zero byte."""
    bits = np.uint32(1) << np.arange(32, dtype=np.uint32)
    for _ in range(8):
        bits = np.where(bits & np.uint32(1), (bits >> np.uint32(1)) ^ np.uint32(0xEDB88320), bits >> np.uint32(1))
    return bits


def applied(operator: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.zeros_like(values)
    for bit in range(32):
        out ^= np.where(values >> np.uint32(bit) & np.uint32(1), operator[bit], np.uint32(0))
    return out


def joined_crc(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two byte strings one after the other, from their CRCs and the length of the right ones."""
    out, operator, left_over = left.astype(np.uint32), byte_operator(), np.asarray(length, np.int64).copy()
    while (left_over > 0).any():
        odd = (left_over & 1).astype(bool)
        out[odd] = applied(operator, out[odd])
        left_over >>= 1
        operator = applied(operator, operator)
    return out ^ right.astype(np.uint32)


class PayloadDictionary:
    """Words with their CRC-32 and length, and the automaton that finds them between delimiters."""

    def __init__(self, most: int = DICTIONARY_WORDS):
        self.most = most
        self.words: dict[bytes, int] = {}
        self.fresh: dict[bytes, int] = {}
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.automaton = None

    def grow(self) -> None:
        """Takes over the words met since the last time once they are half as many as those known."""
        if len(self.fresh) < max(FIRST_WORDS, len(self.words) // 2) or len(self.words) >= self.most:
            return
        for word, crc in self.fresh.items():
            if len(self.words) == self.most:
                break
            self.words[word] = crc
        self.fresh = {}
        self.crc = np.fromiter(self.words.values(), np.uint32, len(self.words))
        self.length = np.fromiter(map(len, self.words), np.int64, len(self.words))
        self.automaton = ahocorasick.Automaton()
        for k, word in enumerate(self.words):
            # one character per byte
            self.automaton.add_word(f" {word.decode('latin-1')} ", k)
        self.automaton.make_automaton()

    def payload(self, word: bytes) -> int:
        """The CRC of a word outside the automaton, remembered for its growth."""
        crc = self.fresh.get(word)
        if crc is None:
            crc = zlib.crc32(word)
            if len(word) <= WORD_BYTES and len(self.words) + len(self.fresh) < self.most:
                self.fresh[word] = crc
        return crc

    def scan(self, clean: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """CRC of every word of ``clean``, which begins and ends with a space."""
        out, known = np.zeros(len(starts), np.uint32), np.zeros(len(starts), bool)
        if self.automaton is not None:
            found = list(self.automaton.iter(clean.decode("latin-1")))
            if found:
                at, entry = (np.array(column, np.int64) for column in zip(*found))
                place = np.searchsorted(starts, at - self.length[entry])
                out[place], known[place] = self.crc[entry], True
        for k in np.flatnonzero(~known).tolist():
            out[k] = self.payload(clean[starts[k]: ends[k]])
        self.grow()
        return out


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes with single-byte delimiters around every text, starts and ends of words, each text's first word plus the total)."""
    apart = np.insert(np.frombuffer(data.tobytes().translate(byte_table()), np.uint8), offsets, 0x20)
    inside = apart != 0x20
    edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    return apart.tobytes(), starts, ends, np.searchsorted(starts, offsets + np.arange(len(offsets)))


def run_crcs(crc: np.ndarray, length: np.ndarray, first: np.ndarray, max_run: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, CRC) of all runs of 1 to ``max_run`` words joined by one space, texts together."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    texts, crcs, run = [text], [crc], crc
    spaced = joined_crc(np.full(len(crc), zlib.crc32(b" "), np.uint32), crc, length) if max_run > 1 else crc
    for words in range(2, max_run + 1):
        n = max(len(crc) - words + 1, 0)
        run = joined_crc(run[:n], spaced[words - 1:], length[words - 1:] + 1)
        whole = text[:n] == text[words - 1:]
        texts.append(text[:n][whole])
        crcs.append(run[whole])
    texts, crcs = np.concatenate(texts), np.concatenate(crcs)
    order = np.argsort(texts, kind="stable")
    return texts[order], crcs[order]


def features(docs: DataFrame, key: str, buckets: int = BUCKETS, max_run: int = MAX_RUN, dictionary_words: int = DICTIONARY_WORDS) -> DataFrame:
    """``key, n_words, n_features, buckets`` (32-bit numbers as bytes, 16-bit ones where they fit) per row."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = PayloadDictionary(dictionary_words)
        for batch in batches:
            n_words, n_features, held = [], [], []
            for row, end, data, offsets in text_slices(batch.column(1)):
                clean, starts, ends, first = normalised(data, offsets)
                text, crc = run_crcs(dictionary.scan(clean, starts, ends), ends - starts, first, max_run)
                bucket = (crc % np.uint32(buckets)).astype(kind)
                cuts = np.searchsorted(text, np.arange(end - row + 1))
                held += [bucket[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
                n_words.append(np.diff(first))
                n_features.append(np.diff(cuts))
            numbers = (pa.array(np.concatenate([np.zeros(0, np.int64), *n]).astype(np.int64)) for n in (n_words, n_features))
            yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(held, pa.large_binary())], ["key", "n_words", "n_features", "buckets"])

    return docs.select(F.col(key).cast("long").alias("key"), "text").mapInArrow(
        hashed, "key bigint, n_words bigint, n_features bigint, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """How many features each bucket holds; counted in tasks, one row per bucket reaches the driver."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for held in batch.column(0):
                total += np.bincount(np.frombuffer(held.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.select("buckets").mapInArrow(counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def bucket_gains(have: np.ndarray, want: np.ndarray) -> np.ndarray:
    buckets, S, T = len(have), int(have.sum()), int(want.sum())
    return np.array([math.floor(1000 * math.log((float(t) + 1) * float(S + buckets) / ((float(s) + 1) * float(T + buckets))))
                     for s, t in zip(have.tolist(), want.tolist())], np.int64)


def weights(rows: DataFrame, gains: np.ndarray) -> DataFrame:
    """``key, n_words, n_features, weight``."""
    kind = np.uint16 if len(gains) <= 1 << 16 else np.uint32

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for held in batch.column(3):
                bucket = np.frombuffer(held.as_buffer(), kind)
                out.append(int(gains[bucket].sum()) // len(bucket) if len(bucket) else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.int64())], ["key", "n_words", "n_features", "weight"])

    return rows.select("key", "n_words", "n_features", "buckets").mapInArrow(weighed, "key bigint, n_words bigint, n_features bigint, weight bigint")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, max_run: int = MAX_RUN, seed: int = SEED, min_words: int = MIN_WORDS,
             percent: int = PERCENT, target_key: str = "item_id") -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` per row: rank 1 and on for the ``percent`` of the documents with ``min_words`` words that are drawn."""
    rows = stored(features(docs, "doc_id", buckets, max_run), "features")
    gains = bucket_gains(bucket_counts(rows, buckets), bucket_counts(features(target, target_key, buckets, max_run), buckets))
    head = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("key").cast("string")).cast("binary"), 256), 1, 8)
    uniform = (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    scored = weights(rows, gains).select(
        "key", "n_features", "weight", (F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))).cast("long")).alias("score"),
        (F.col("key").isNotNull() & (F.col("n_words") >= min_words)).alias("_may"))
    # a rank is a place in range-partitioned order: rows of the ranges before, plus the place within the range
    order = [F.desc("_may"), F.desc_nulls_last("score"), F.asc_nulls_last("key"), F.asc("weight"), F.asc("n_features")]
    slots = shuffle_slots(rows)
    placed = stored(scored.repartitionByRange(slots, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "scores")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"), F.count_if("_may").alias("_able"))
    # one row per range, whatever the number of documents
    before = Window.orderBy("_part")
    offsets = sizes.select("_part", (F.sum("_n").over(before) - F.col("_n")).alias("_before"))
    able = placed.agg(F.count_if("_may")).first()[0]
    rank = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return placed.withColumn("_part", part).join(F.broadcast(offsets), "_part").select(
        F.col("key").alias("doc_id"), "n_features", "weight", "score", F.when(F.col("_may") & (rank <= percent * able // 100), rank).alias("rank"))

"""Repeated passages by sparse suffix arrays.

Suffixes are kept only where a position's run of ``GRAM`` words is the smallest of ``SPACING`` neighbouring runs (a minimiser):
equal passages keep suffixes at equal places, and every passage of ``MIN_WORDS`` words has one within its first ``SPACING``
words. A suffix is represented by hashes of its first 16 and next 16 words, as many as such a passage always leaves. All
suffixes are sorted (range partitions over hashes, document and place, so no key can fill one task) and compared with their
neighbours; the first and last row of a partition, whose neighbour lies elsewhere, stay candidates.

Candidates are then extended left and right in the texts: every window of ``MIN_WORDS`` words around a candidate that starts
within reach is hashed, sorted and compared in the same way. Overlapping repeated windows join to the maximal spans.

Defined results: null or short texts have no spans; a null ``doc_id`` is not read; a passage that repeats within one
document counts; rows that repeat a ``doc_id`` with equal text count as one document; ties do not matter, since all places
are given; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.store import shuffle_slots, stored
from cairn.llm.words import doubled_window_hashes, hashed_words, text_slices

MIN_WORDS = 50
GRAM, SPACING, HALF = 8, 16, 16


def minimisers(words: np.ndarray) -> np.ndarray:
    """Positions whose run of words is the smallest (the last of equals) of some ``SPACING`` neighbouring runs."""
    grams = doubled_window_hashes(words, GRAM, seed=3)
    if len(grams) < SPACING:
        return np.zeros(0, np.int64)
    views = sliding_window_view(grams[::-1], SPACING)
    return np.unique(len(grams) - 1 - (np.arange(len(views)) + views.argmin(1)))


def documents(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    for row, end, data, offsets in text_slices(column):
        words, first = hashed_words(data, offsets)
        for k in range(end - row):
            yield row + k, words[first[k]: first[k + 1]]


def sparse_suffixes(docs: DataFrame) -> DataFrame:
    """``h1, h2, doc_id, place``: the kept suffixes of at least ``2 * HALF`` words."""
    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, parts = batch.column(0).to_numpy(), ([], [], [], [])
            for row, words in documents(batch.column(1)):
                if len(words) < MIN_WORDS:
                    continue
                halves = doubled_window_hashes(words, HALF)
                at = minimisers(words)
                at = at[at < len(halves) - HALF]
                for part, values in zip(parts, (halves[at], halves[at + HALF], np.full(len(at), ids[row]), at)):
                    part.append(values)
            h1, h2, doc, place = (np.concatenate([np.zeros(0, kind), *p]) for p, kind in zip(parts, ("u8", "u8", "i8", "i8")))
            yield pa.RecordBatch.from_arrays([pa.array(h1.view("i8")), pa.array(h2.view("i8")), pa.array(doc.astype("i8")), pa.array(place.astype("i4"))],
                                             ["h1", "h2", "doc_id", "place"])

    return docs.where(f"doc_id is not null and length(text) >= {2 * MIN_WORDS - 1}").select(F.col("doc_id").cast("long"), "text").mapInArrow(
        suffixes, "h1 bigint, h2 bigint, doc_id bigint, place int")


def with_equal_neighbour(rows: DataFrame) -> DataFrame:
    """The rows whose neighbour in sorted order has equal hashes (``found``), and those at either end of a partition (``edge``)."""
    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        previous: pa.RecordBatch | None = None  # the last row, not given yet
        equal_before = started = False
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([previous, batch] if previous is not None else [batch]).combine_chunks()
            h1, h2, doc, place = (table.column(k).to_numpy() for k in ("h1", "h2", "doc_id", "place"))
            same = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1]) & ((doc[1:] != doc[:-1]) | (place[1:] != place[:-1]))
            found = np.concatenate(([equal_before], same)) | np.concatenate((same, [False]))
            edge = np.zeros(len(found), bool)
            edge[0] = not started
            give = found | edge
            give[-1] = False
            if len(found) > 1:
                started = True
                yield rows_of(table, give, found, edge)
            equal_before = bool(same[-1]) if len(same) else equal_before
            previous = table.slice(table.num_rows - 1).to_batches()[0]
        if previous is not None:
            yield rows_of(pa.Table.from_batches([previous]), np.array([True]), np.array([equal_before]), np.array([True]))

    def rows_of(table: pa.Table, give: np.ndarray, found: np.ndarray, edge: np.ndarray) -> pa.RecordBatch:
        picked = table.append_column("found", pa.array(found)).append_column("edge", pa.array(edge)).filter(pa.array(give)).combine_chunks()
        return picked.to_batches()[0] if picked.num_rows else pa.RecordBatch.from_pylist([], picked.schema)

    order = ("h1", "h2", "doc_id", "place")
    return (rows.repartitionByRange(shuffle_slots(rows), *order).sortWithinPartitions(*order)
             .mapInArrow(neighbours, "h1 bigint, h2 bigint, doc_id bigint, place int, found boolean, edge boolean"))

def windows_around(docs: DataFrame, candidates: DataFrame) -> DataFrame:
    """``h1, h2, doc_id, place`` of every ``MIN_WORDS`` window that reaches over a candidate from at most ``SPACING`` words before it."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, places, parts = batch.column(0).to_numpy(), batch.column(2), ([], [], [], [])
            for row, words in documents(batch.column(1)):
                n = len(words) - MIN_WORDS + 1
                if n <= 0:
                    continue
                wanted = np.zeros(n + SPACING, np.int64)
                at = np.unique(places[row].values.to_numpy())
                np.add.at(wanted, np.maximum(at - SPACING + 1, 0)[at - SPACING < n], 1)
                np.add.at(wanted, np.minimum(at + 1, n)[at - SPACING < n], -1)
                starts = np.flatnonzero(np.cumsum(wanted)[:n] > 0)
                for part, values in zip(parts, (doubled_window_hashes(words, MIN_WORDS, 5)[starts], doubled_window_hashes(words, MIN_WORDS, 7)[starts],
                                                np.full(len(starts), ids[row]), starts)):
                    part.append(values)
            h1, h2, doc, place = (np.concatenate([np.zeros(0, kind), *p]) for p, kind in zip(parts, ("u8", "u8", "i8", "i8")))
            yield pa.RecordBatch.from_arrays([pa.array(h1.view("i8")), pa.array(h2.view("i8")), pa.array(doc.astype("i8")), pa.array(place.astype("i4"))],
                                             ["h1", "h2", "doc_id", "place"])

    per_doc = candidates.groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("place").alias("_places"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(
        per_doc.hint("shuffle_hash"), F.col("doc_id") == F.col("_doc")).select("doc_id", "text", "_places")
    return texts.mapInArrow(windows, "h1 bigint, h2 bigint, doc_id bigint, place int")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, start, n_words``: every maximal span of words covered by windows of ``MIN_WORDS`` words that occur elsewhere too."""
    candidates = with_equal_neighbour(sparse_suffixes(docs)).select("doc_id", "place")
    found = with_equal_neighbour(windows_around(docs, candidates))
    hash_of = lambda c: F.when(F.col("edge"), F.col(c)).alias(c)  # only these few are compared again
    windows = stored(found.select(hash_of("h1"), hash_of("h2"), "doc_id", "place", "found", "edge"), "windows")
    ends = windows.where("edge").dropDuplicates(["h1", "h2", "doc_id", "place"])
    across = (ends.groupBy("h1", "h2").agg(F.count("*").alias("_n")).where("_n > 1"))
    lone = ends.where("not found").join(across, ["h1", "h2"]).select("doc_id", "place")
    starts = windows.where("found").select("doc_id", "place").unionByName(lone)
    return joined_spans(starts)


def joined_spans(starts: DataFrame) -> DataFrame:
    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_doc, begin, end = None, 0, 0
        for batch in batches:
            doc, place = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype("i8")
            if not len(doc):
                continue
            fresh = np.ones(len(doc), bool)
            fresh[1:] = (doc[1:] != doc[:-1]) | (place[1:] > place[:-1] + MIN_WORDS)
            fresh[0] = doc[0] != open_doc or place[0] > end
            heads = np.flatnonzero(fresh)
            lasts = np.append(heads[1:], len(doc)) - 1
            out = [(open_doc, begin, end - begin)] if open_doc is not None and fresh[0] else []
            if not len(heads) or heads[0] > 0:
                until = (heads[0] if len(heads) else len(doc)) - 1
                end = int(place[until]) + MIN_WORDS
                if len(heads):
                    out.append((open_doc, begin, end - begin))
            done = [(int(doc[h]), int(place[h]), int(place[t]) + MIN_WORDS - int(place[h])) for h, t in zip(heads, lasts)]
            if done:
                open_doc, begin, end = done[-1][0], done[-1][1], done[-1][1] + done[-1][2]
                out += done[:-1]
            yield span_batch(out)
        if open_doc is not None:
            yield span_batch([(open_doc, begin, end - begin)])

    def span_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_words"])

    return (starts.repartition(shuffle_slots(starts), "doc_id").sortWithinPartitions("doc_id", "place")
            .mapInArrow(spans, "doc_id bigint, start bigint, n_words bigint"))

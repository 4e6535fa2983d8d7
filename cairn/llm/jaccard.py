"""N-gram Jaccard join with Bayesian candidate pruning.

Documents are sets of hashed runs of ``SHINGLE`` words. Rows with equal sets form a class; classes are numbered in the order of
their first row by ``doc_id`` (then by hash of the text), and a class's first row stands for it. Representatives meet in the buckets
of ``BANDS`` bands of ``BAND_ROWS`` MinHash values. In a bucket two signatures are compared ``STEP`` values at a time; from
``FIRST_TEST`` values on the pair is dropped when the posterior probability that its similarity reaches the threshold, given
the matches so far and a uniform prior, is below ``TOLERANCE``. Pairs that survive connect candidate groups; inside those, all
similarities are computed exactly from the whole sets, and links counted, in pairs of blocks bounded by rows and by bytes.
Signatures hold 8 bits a value, which the posterior allows for.

A pair whose rows already hang together needs no comparison for the groups, so a bucket of copies costs one pass.

Defined results: rows are judged one by one, also those that share a ``doc_id``: the class is named by the smallest ``doc_id`` in it, one
row of it is kept, ``n_links`` counts other rows. Null, empty and wordless texts link with nothing and are kept; fewer than ``SHINGLE``
words are one run; a null ``doc_id`` cannot be named, links with nothing and is kept; an empty table gives no rows; extra columns
are not read (``drop_near`` keeps them; of rows with the same ``doc_id`` and text the one with the smallest hash stays).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.embeddings import edge_batch
from cairn.llm.graph import Forest, components, dealt_blocks, fixed_rows, whole_groups, with_groups
from cairn.llm.names import free_names, quoted
from cairn.llm.store import shuffle_slots, stored
from cairn.llm.words import hashed_words, mix, text_slices, window_hashes

SHINGLE, THRESHOLD = 5, 0.8
BANDS, BAND_ROWS, VALUES, STEP = 24, 5, 128, 16
TOLERANCE, FIRST_TEST = 1e-6, 32
#: rows of a bucket in one block; bytes of sets in a block of a group, at most (and one set), and at least 1 / GROUP_BLOCK of that a row
BUCKET_BLOCK = 16_384
GROUP_BYTES, GROUP_BLOCK = 16_000_000, 512
CHUNK = 4096


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct run hashes of every text."""
    for row, end, data, offsets in text_slices(texts):
        words, first = hashed_words(data, offsets)
        runs = window_hashes(words, size)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= size:
                yield np.unique(runs[a: b - size + 1])
            else:
                yield window_hashes(words[a:b], int(b - a), seed=2) if b > a else np.zeros(0, np.uint64)


def permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(23)
    return random.integers(1, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1), random.integers(0, 2**63, VALUES, dtype=np.uint64)


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> np.ndarray:
    """Per step, the fewest matches of 8-bit values with which a pair stays."""
    s = (np.arange(4000) + 0.5) / 4000
    match = s + (1 - s) / 256
    out = []
    for n in range(STEP, VALUES + 1, STEP):
        m = np.arange(n + 1)[:, None]
        log = m * np.log(match) + (n - m) * np.log1p(-match)
        weight = np.exp(log - log.max(1, keepdims=True))
        posterior = weight[:, s >= threshold].sum(1) / weight.sum(1)
        out.append(int(np.argmax(posterior >= tolerance)) if n >= FIRST_TEST else 0)
    return np.array(out)


def text_keys(text: str = "text") -> tuple[Column, Column]:
    """Two hashes that tell the texts of one ``doc_id`` apart."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, t1, t2`` (the text's keys), ``h1, h2`` (hash of the set), ``bytes`` of the set, ``buckets`` (one per band), ``signature``;
    wordless texts have null hashes."""
    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor, shift = permutations()
        for batch in batches:
            h1, h2, sizes, buckets, signatures = [], [], [], [], []
            for runs in shingle_sets(batch.column(1)):
                if not len(runs):
                    for column in (h1, h2, sizes, buckets, signatures):
                        column.append(None)
                    continue
                h1.append(int(np.add.reduce(mix(runs)).view(np.int64)))
                h2.append(int(np.bitwise_xor.reduce(mix(runs + np.uint64(0x51ED270B))).view(np.int64)))
                sizes.append(runs.nbytes)
                least = np.full(VALUES, 2**64 - 1, np.uint64)
                for at in range(0, len(runs), CHUNK):
                    part = runs[at: at + CHUNK, None] * factor + shift
                    np.minimum(least, part.min(0), out=least)
                least >>= np.uint64(16)
                bands = window_hashes(least[: BANDS * BAND_ROWS], BAND_ROWS)[::BAND_ROWS] + np.arange(BANDS, dtype=np.uint64)
                buckets.append(mix(bands).view(np.int64))
                signatures.append(mix(least).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), batch.column(3), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(buckets, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                ["doc_id", "t1", "t2", "h1", "h2", "bytes", "buckets", "signature"])

    t1, t2 = text_keys()
    return docs.select(F.col("doc_id").cast("long"), "text", t1.alias("t1"), t2.alias("t2")).mapInArrow(
        sketched, "doc_id bigint, t1 bigint, t2 bigint, h1 bigint, h2 bigint, bytes bigint, buckets array<bigint>, signature binary")


def candidate_links(members: DataFrame, payload: DataFrame, threshold: float) -> DataFrame:
    """A spanning forest ``a, b`` of the pairs of each bucket that outlive the incremental comparison."""
    need = least_matches(threshold)

    def forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def alive(signatures: np.ndarray, row: int, others: np.ndarray) -> np.ndarray:
            matches = np.zeros(len(others), np.int64)
            for step, least in enumerate(need):
                at = slice(step * STEP, (step + 1) * STEP)
                matches += (signatures[others, at] == signatures[row, at]).sum(1)
                stay = matches >= least
                if not stay.all():
                    others, matches = others[stay], matches[stay]
                    if not len(others):
                        break
            return others

        for table, bounds in whole_groups(batches):
            ids, own, i, j = (table.column(c).to_numpy() for c in ("id", "own", "i", "j"))
            signatures = fixed_rows(table.column("signature"), "u1")
            out: list[tuple[int, int]] = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                forest, part, crossing = Forest(b - a), signatures[a:b], i[a] != j[a]
                for row in range(b - a - 1):
                    apart = forest.label[row + 1:] != forest.label[row]
                    if crossing:
                        apart &= own[a + row + 1: b] != own[a + row]
                    others = np.flatnonzero(apart) + row + 1
                    if len(others):
                        forest.join(row, alive(part, row, others))
                    if len(forest.links) == b - a - 1:
                        break
                out += [(int(ids[a + p]), int(ids[a + q])) for p, q in forest.links]
            yield edge_batch(out)

    return dealt_blocks(members, payload, BUCKET_BLOCK).mapInArrow(forests, "a bigint, b bigint")


def set_links(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which pairs of sets reach the threshold, exactly: intersections are sums over slices of the shared vocabulary."""
    n, sizes = len(sets), np.array([len(s) for s in sets])
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), sizes)
    _, column, used = np.unique(values, return_inverse=True, return_counts=True)
    shared = used > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    owner, column = owner[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((n, n), np.float32)
    for low in range(0, int(shared.sum()), CHUNK):
        a, b = np.searchsorted(column, [low, low + CHUNK])
        part = np.zeros((n, min(CHUNK, int(shared.sum()) - low)), np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    either = sizes[:, None] + sizes[None] - both
    return both >= threshold * either - 1e-6


def verified(groups: DataFrame, docs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """``a, b, links`` inside candidate groups: links of ``a`` (b null), and the forest of exact links (links null)."""
    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.large_binary()), batch.column(2)], ["id", "runs", "weight"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches):
            ids, own, weight, i, j = (table.column(c).to_numpy() for c in ("id", "own", "weight", "i", "j"))
            runs, a_side, b_side, links = table.column("runs"), [], [], []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                near = set_links([np.frombuffer(runs[k].as_buffer(), np.uint64) for k in range(a, b)], threshold)
                near &= ids[a:b][:, None] != ids[a:b][None]
                if i[a] != j[a]:
                    near &= own[a:b][:, None] != own[a:b][None]
                total, forest = near @ weight[a:b], Forest(b - a)
                for row in np.flatnonzero(near.any(1)).tolist():
                    forest.join(row, np.flatnonzero(near[row]))
                a_side += ids[a:b].tolist() + [int(ids[a + p]) for p, _ in forest.links]
                b_side += [None] * (b - a) + [int(ids[a + q]) for _, q in forest.links]
                links += total.tolist() + [None] * len(forest.links)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a_side, b_side, links)], ["a", "b", "links"])

    wanted = groups.join(nodes.select("id", "doc_id", "t1", "t2", "weight"), "id")
    t1, t2 = text_keys()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t1.alias("t1"), t2.alias("t2"), "text").join(
        wanted.select("id", "doc_id", "t1", "t2", "weight").hint("shuffle_hash"), ["doc_id", "t1", "t2"]).select("id", "text", "weight")
    # equal rows of one doc_id bring the same set
    payload = texts.mapInArrow(sets_of, "id bigint, runs binary, weight bigint").groupBy("id").agg(
        F.first("runs").alias("runs"), F.first("weight").alias("weight"))
    members = groups.join(nodes.select("id", "bytes"), "id").select(
        F.col("component").alias("bucket"), "id", F.greatest("bytes", F.lit(GROUP_BYTES // GROUP_BLOCK)).alias("weight"))
    return dealt_blocks(members, payload, GROUP_BYTES // 8, GROUP_BYTES).mapInArrow(compared, "a bigint, b bigint, links bigint")


def judged_rows(docs: DataFrame, threshold: float) -> DataFrame:
    """``doc_id, t1, t2, class_id, n_links, kept`` per row."""
    rows = stored(sketches(docs).withColumn("row", F.monotonically_increasing_id()), "sketches")
    named = rows.where("doc_id is not null and h1 is not null")
    first = ["doc_id", "t1", "t2", "row"]
    classes = named.groupBy("h1", "h2").agg(F.min(F.struct(*first)).alias("_first"), F.count("*").alias("weight")).select(
        "h1", "h2", "weight", *(F.col(f"_first.{c}").alias(c) for c in first))
    # numbers in the order of the first rows, so the smallest number of a component has its smallest doc_id
    numbered = classes.repartitionByRange(shuffle_slots(docs), *first).sortWithinPartitions(*first).withColumn("id", F.monotonically_increasing_id())
    classes = stored(numbered, "classes")
    heads = stored(named.select("row", "buckets", "signature", "bytes").join(classes.select("row", "id"), "row").drop("row"), "heads")
    members = heads.select(F.explode("buckets").alias("bucket"), "id", F.lit(1).alias("weight"))
    groups = stored(components(candidate_links(members, heads.select("id", "signature"), threshold)), "groups")
    exact = stored(verified(groups, docs, classes.join(heads.select("id", "bytes"), "id"), threshold), "links")
    found = components(exact.where("b is not null").select("a", "b"))
    links = exact.where("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    heads_of = classes.select(F.col("id").alias("component"), F.col("doc_id").alias("_class"), F.col("row").alias("_kept"))
    per_class = classes.select("id", "h1", "h2", "weight").join(found, "id", "left").join(links, "id", "left").withColumn(
        "component", F.coalesce("component", "id")).join(heads_of, "component").select(
        "h1", "h2", "weight", "_class", "_kept", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("_links"))
    judged = with_groups(named.select(*first, "h1", "h2"), stored(per_class, "judged"), ["h1", "h2"], "weight", rows.count()).select(
        "doc_id", "t1", "t2", "_class", "_links", (F.col("row") == F.col("_kept")).alias("kept"))
    rest = rows.where("doc_id is null or h1 is null").select(
        "doc_id", "t1", "t2", F.col("doc_id").alias("_class"), F.lit(0).cast("long").alias("_links"), F.lit(True).alias("kept"))
    return judged.unionByName(rest).select("doc_id", "t1", "t2", F.col("_class").alias("class_id"), F.col("_links").alias("n_links"), "kept")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, class_id, n_links, kept`` per row: the smallest linked ``doc_id``, and how many other rows link directly."""
    return judged_rows(docs, threshold).select("doc_id", "class_id", "n_links", "kept")


def drop_near(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one row of each class: one with the smallest ``doc_id``."""
    # texts of which some row goes; wordless rows are all kept, repeated or not
    marks = stored(judged_rows(docs, threshold).where("doc_id is not null").groupBy("doc_id", "t1", "t2").agg(
        F.max("kept").alias("_stays"), F.min("kept").alias("_all")).where("not _all"), "marks")
    doc, t1, t2, stays, row = free_names(docs, "_doc", "_t1", "_t2", "_stays", "_row")
    keys = marks.select(*(F.col(c).alias(name) for c, name in zip(marks.columns, (doc, t1, t2, stays))))
    values = (F.col("doc_id").cast("long"), *text_keys())
    on = [F.col(name) == value for name, value in zip((doc, t1, t2), values)]
    kept = docs.where("doc_id is not null").join(keys.hint("shuffle_hash"), on, "left_anti").unionByName(docs.where("doc_id is null"))
    again = keys.where(stays)
    if again.isEmpty():
        return kept
    # first rows of a class that occur several times: one of each, combined before the shuffle
    whole = F.struct(*(F.col(quoted(c)) for c in docs.columns))
    one = docs.join(again, on, "left_semi").groupBy(*values).agg(
        F.min_by(whole, F.xxhash64(*(quoted(c) for c in docs.columns))).alias(row))
    return kept.unionByName(one.select(*(F.col(f"{row}.{quoted(c)}") for c in docs.columns)))

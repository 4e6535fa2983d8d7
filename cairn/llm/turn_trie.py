"""Prefix trie of conversations from padded turn-id matrices.

A conversation is the sequence of the digests of its turns; conversations are dealt into shards by ranges of (sequence, id),
so members of a node lie side by side and only the paths of a shard's first and last conversation reach over its borders.
In a shard, digests become dense turn ids, ``numpy.lexsort`` orders the padded matrices (windows of ``WIDTH`` columns, so one
long conversation does not widen the others), and an OR-accumulated mask of changed columns gives the length each row shares
with the row before it. A node of depth d starts where that length is below d; ``reduceat`` over those starts then
adds up every aggregate of that depth, since all of them are sums over rows:

* children: starts of depth d + 1; leaves: rows whose successor does not continue them;
* saved tokens below a node: tokens a row shares with its predecessor from depth d on.

Nodes on a shard's first and last path are partial sums. They are recombined by key (digest of the prefix) together with
corrections for what the first row of a shard shares with the last row of the shard before it. The numbers that end in such a node
travel as chunks of their text and are hashed in order, a chunk at a time.

Defined results: a null role or text is empty; a null ``turn`` comes first, equal turn numbers are ordered by the turns' digests
(repeated rows are turns of their own); rows with a null ``conv_id`` belong to no conversation and are not read; an empty table
has no nodes, not even a root; extra columns are not read. A conversation is one row, 16 bytes and a count a turn, without its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm.store import shuffle_slots, stored

#: columns of one padded matrix; turns and conversations a shard should hold on average
WIDTH, SHARD_TURNS, SHARD_CONVERSATIONS = 16, 1_000_000, 250_000
ID_BYTES = 16
CHUNK_IDS = 50_000
NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE, PARTIAL, ENDS, BORDER = 0, 1, 2, 3
PART_SCHEMA = (
    "kind int, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, first binary, first_words array<bigint>, last binary")


def turn_lists(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of ``turn, id, words`` in order); ``id`` is a digest of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    # the length keeps role and text apart
    digest = F.md5(F.encode(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"))
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")
    one = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(F.col("turn"), digest.alias("id"), words.alias("words")).alias("_t"))
    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("turns"))


def sequence(turns: Column) -> tuple[Column, Column]:
    """(``ids``, ``words``): the digests one after the other as bytes, and the counts."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["id"]), "")).alias("ids"), F.transform(turns, lambda t: t["words"]).alias("words")


def sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, ids, words`` of every conversation as it is."""
    return turn_lists(turns).select("conv_id", *sequence(F.col("turns")))


def rebuilt_sequences(turns: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """``conv_id, ids, words`` where the first h turns come from the conversation ``conv_id - conv_id % family``; h is the crc32 of the number modulo ``heads``."""
    own = stored(turn_lists(turns), "turns")
    shared = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("_base"), F.slice("turns", 1, max(heads - 1, 1)).alias("_head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    # at most `family` conversations share a base, so no key is hot
    both = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % family).join(shared, "_base", "left")
    head = F.slice(F.coalesce("_head", F.filter("turns", lambda t: F.lit(False))), F.lit(1), h)
    tail = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    return both.select("conv_id", *sequence(F.concat(head, tail)))


def dense_ids(data: bytes) -> np.ndarray:
    """Numbers from 1 in the order of the digests, equal for equal ones."""
    halves = np.frombuffer(data, ">u8").astype(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (halves[order][1:] != halves[order][:-1]).any(1)
    out = np.empty(len(order), np.int32)
    out[order] = np.cumsum(fresh)
    return out


def padded(turn: np.ndarray, starts: np.ndarray, lengths: np.ndarray, window: int) -> np.ndarray:
    """Columns of one window as a matrix, 0 behind a row's end."""
    at = window * WIDTH + np.arange(WIDTH)
    place = np.minimum(starts[:, None] + at, max(len(turn) - 1, 0))
    return np.where(at < lengths[:, None], turn[place] if len(turn) else 0, 0).astype(np.int32)


def sorted_rows(turn: np.ndarray, starts: np.ndarray, lengths: np.ndarray, conv: np.ndarray) -> np.ndarray:
    """Order of the rows by (sequence, number): last window first, each a stable lexsort of the rows that reach it."""
    order = np.argsort(conv, kind="stable")
    for window in range(int(lengths.max(initial=0) - 1) // WIDTH, -1, -1):
        reach = lengths[order] > window * WIDTH
        rows = order[reach]
        matrix = padded(turn, starts[rows], lengths[rows], window)
        order = np.concatenate((order[~reach], rows[np.lexsort(matrix.T[::-1])]))
    return order


def shared_lengths(turn: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many first turns each sorted row shares with the row before it."""
    shared = np.zeros(len(lengths), np.int64)
    rows = np.arange(1, len(lengths))  # those that have not changed so far
    window = 0
    while len(rows):
        here, before = (padded(turn, starts[r], lengths[r], window) for r in (rows, rows - 1))
        changed = np.logical_or.accumulate((here != before) | (here == 0), axis=1)
        shared[rows] += (~changed).sum(1)
        rows = rows[~changed[:, -1]]
        window += 1
    return shared


def prefix_keys(ids: bytes, depth: int) -> list[bytes]:
    """Keys of the nodes of depth 0 to ``depth`` on a path."""
    run, out = hashlib.md5(), []
    for d in range(depth + 1):
        out.append(run.digest())
        run.update(ids[d * ID_BYTES: (d + 1) * ID_BYTES])
    return out


def shard_nodes(conv: np.ndarray, ids: list[bytes], lengths: np.ndarray, words: np.ndarray) -> Iterator[dict[str, list]]:
    """Columns of ``PART_SCHEMA`` for one shard: a batch per depth, then its border row."""
    turn = dense_ids(b"".join(ids))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    order = sorted_rows(turn, starts, lengths, conv)
    conv, lengths, starts = conv[order], lengths[order], starts[order]
    total = np.concatenate(([0], np.cumsum(words)))
    shared = shared_lengths(turn, starts, lengths)
    leaf = np.append(shared[1:], -1) < lengths
    common = total[starts + shared] - total[starts]  # tokens shared with the row before
    n = len(conv)
    first, last = ids[order[0]], ids[order[-1]]
    first_keys, last_keys = prefix_keys(first, int(lengths[0])), prefix_keys(last, int(lengths[-1]))
    rows = np.arange(n)
    above_of = np.zeros(n, np.int64)  # the parent's place among the nodes one depth higher, per row
    above_least = above_key = None
    for depth in range(int(lengths.max()) + 1):
        rows = rows[lengths[rows] >= depth]
        begins = np.flatnonzero(shared[rows] < depth) if depth else np.zeros(1, np.int64)
        sums = lambda values: np.add.reduceat(values.astype(np.int64), begins)  # noqa: B023,E731
        least = np.minimum.reduceat(conv[rows], begins)
        upper = total[starts[rows] + depth - 1] - total[starts[rows]] if depth else np.zeros(len(rows), np.int64)
        ends = sums(lengths[rows] == depth)
        keys: list[bytes | None] = [None] * len(begins)
        if rows[0] == 0:
            keys[0] = first_keys[depth]
        if rows[-1] == n - 1:
            keys[-1] = last_keys[depth]
        digests = []
        for node in range(len(begins)):
            members = conv[rows[begins[node]: begins[node] + ends[node]]].tolist() if ends[node] else []
            if keys[node] is None:
                digests.append(hashlib.sha256(",".join(map(str, members)).encode()).hexdigest() if members else NO_ENDS)
                continue
            digests.append(None)
            for at in range(0, len(members), CHUNK_IDS):
                part = members[at: at + CHUNK_IDS]
                yield {"kind": [ENDS], "key": [keys[node]], "conv_id": part[:1], "first": [",".join(map(str, part)).encode()]}
        parent = above_of[rows[begins]]
        yield {
            "kind": [NODE if k is None else PARTIAL for k in keys], "key": keys,
            "parent_key": [above_key[p] for p in parent] if depth else [None], "conv_id": least, "depth": [depth] * len(begins),
            "parent_conv_id": [int(above_least[p]) if above_key[p] is None else None for p in parent] if depth else [None],
            "n_convs": np.diff(np.append(begins, len(rows))), "n_children": sums((shared[rows] <= depth) & (lengths[rows] > depth)),
            "n_leaves": sums(leaf[rows]), "saved_tokens": sums(np.maximum(common[rows] - upper, 0)), "ends_sha256": digests}
        above_of[rows] = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(rows))))
        above_least, above_key = least, keys
    own = words[starts[0]: starts[0] + lengths[0]].tolist()
    yield {"kind": [BORDER], "conv_id": conv[:1], "first": [first], "first_words": [own], "last": [last]}


def part_batch(columns: dict[str, list]) -> pa.RecordBatch:
    n = len(columns["kind"])
    types = {"key": pa.binary(), "parent_key": pa.binary(), "first": pa.binary(), "last": pa.binary(), "kind": pa.int32(),
             "ends_sha256": pa.string(), "first_words": pa.list_(pa.int64())}
    names = [c.split()[0] for c in PART_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(columns.get(c, [None] * n), types.get(c, pa.int64())) for c in names], names)


def shard_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, partial nodes, chunks of ends and the border row of one shard."""
    conv, ids, words = [], [], []
    for batch in batches:
        conv.append(batch.column(0).to_numpy())
        ids += batch.column(1).to_pylist()
        words.append(batch.column(2).flatten().to_numpy())
    if ids:
        lengths = np.array([len(i) // ID_BYTES for i in ids], np.int64)
        for columns in shard_nodes(np.concatenate(conv), ids, lengths, np.concatenate(words)):
            yield part_batch(columns)


def corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the nodes on a shard's first path counted as if nothing came before it."""
    for batch in batches:
        for first, own, before in zip(*(batch.column(k).to_pylist() for k in range(3))):
            most = min(len(first), len(before)) // ID_BYTES
            a, b = (np.frombuffer(x[: most * ID_BYTES], np.uint8).reshape(-1, ID_BYTES) for x in (first, before))
            differs = np.flatnonzero((a != b).any(1))
            shared = int(differs[0]) if len(differs) else most
            total = np.concatenate(([0], np.cumsum(np.array(own, np.int64))))
            continued = shared == len(before) // ID_BYTES  # then the row before is no leaf
            depths = range(shared + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(prefix_keys(first, shared), pa.binary()), pa.array(depths, pa.int64()),
                 pa.array([-int(d < shared) for d in depths], pa.int64()), pa.array([-int(continued)] * (shared + 1), pa.int64()),
                 pa.array([int(total[shared] - total[max(d - 1, 0)]) for d in depths], pa.int64())],
                ["key", "depth", "n_children", "n_leaves", "saved_tokens"])


def chunk_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key, ends_sha256`` of chunks that come sorted by key and first number."""
    key, run = None, None
    for batch in batches:
        done = []
        for k, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if run is not None:
                    done.append((key, run.hexdigest()))
                key, run = k, hashlib.sha256(chunk)
            else:
                run.update(b"," + chunk)
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.binary()), pa.array([d[1] for d in done], pa.string())], ["key", "ends_sha256"])
    if run is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([run.hexdigest()])], ["key", "ends_sha256"])


def prefix_nodes(rows: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of ``conv_id, ids, words``: ``conv_id`` (smallest member), ``depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256``."""
    rows = stored(rows, "sequences")
    convs, turns = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("words")), F.lit(0))).first()
    shards = max(shuffle_slots(rows), -(-turns // shard_turns), -(-convs // SHARD_CONVERSATIONS))
    parts = stored(rows.repartitionByRange(shards, "ids", "conv_id").mapInArrow(shard_parts, PART_SCHEMA), "trie")
    numbers = ["n_convs", "n_children", "n_leaves", "saved_tokens"]
    # one border row per shard, whatever the number of conversations
    before = F.lag("last").over(Window.orderBy("first", "conv_id"))
    fixes = (parts.where(F.col("kind") == BORDER).select("first", "first_words", before.alias("_before")).where("_before is not null")
             .mapInArrow(corrections, "key binary, depth bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"))
    partial = parts.where(F.col("kind") == PARTIAL).select("key", "parent_key", "conv_id", "depth", *numbers)
    summed = partial.unionByName(fixes, allowMissingColumns=True).groupBy("key", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.max("parent_key").alias("parent_key"), *(F.sum(c).alias(c) for c in numbers))
    chunks = parts.where(F.col("kind") == ENDS).select("key", "first", "conv_id")
    ended = (chunks.repartition(shuffle_slots(rows), "key").sortWithinPartitions("key", "conv_id").select("key", "first")
             .mapInArrow(chunk_digests, "key binary, ends_sha256 string"))
    # two paths per shard: far fewer rows than conversations
    borders = stored(summed.join(ended, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))), "borders")
    out = ["conv_id", "depth", "parent_conv_id", *numbers, "ends_sha256"]
    inner = parts.where(F.col("kind") == NODE)
    waiting = inner.where("parent_key is not null").select("parent_key", *out).unionByName(
        borders.withColumn("parent_conv_id", F.lit(None).cast("long")).select("parent_key", *out))
    parents = borders.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_parent"))
    named = waiting.join(parents, "parent_key", "left").withColumn("parent_conv_id", F.col("_parent")).select(*out)
    return inner.where("parent_key is null").select(*out).unionByName(named)

"""Best-fit packing of tokenised documents into sequences of a fixed number of tokens.

Bounded-space online best fit: a packer keeps at most ``OPEN_BINS`` open bins in a bitset with one bit per free space. A
piece goes to the bin with the least free space that still holds it; when one bin too many is open, the fullest closes.
Pieces arrive in blocks of ``BLOCK``, longest first. Only a document longer than a sequence is cut: its first piece takes
the remainder, the others fill a sequence each.

Tokenising and packing are one pass each; the shuffle between them carries a row of a few numbers per piece, dealt by
hash, so packers get even shares. There is one packer for ``SLOTS_PER_PACKER`` of the session's shuffle partitions.

Defined results: null or empty text is the end token alone; rows that repeat a ``doc_id`` are packed as separate
documents; a null ``doc_id`` is packed too; ties are ordered by ``doc_id`` and content; no rows give no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.store import shuffle_slots

SEQUENCE, END_TOKEN = 1024, 2
#: added token of the tokenizer file; it is matched inside texts before words are
ADDED = "<|endoftext|>", 50256
OPEN_BINS, BLOCK = 8192, 16_384
SLOTS_PER_PACKER = 8
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHED_PIECES, CACHED_CHARS = 400_000, 64


def encoder(ranks_path: str, added: tuple[str, int] | None = None) -> Callable[[str], bytes]:
    """Text to token ids as little-endian uint32 bytes, for a byte-level vocabulary given as ranks.

    A space before a visible character always begins a new token, so words are encoded one at a time and remembered.
    Texts with white space after a space go to the tokenizer whole. Texts are split at the ``added`` token, which is not
    among the ranks, and the parts encoded as texts of their own.
    """
    import base64
    import re

    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    tokens = tiktoken.Encoding("bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    irregular = re.compile(r" (?:\s|$)").search

    def encode(text: str) -> bytes:
        return np.array(tokens(text), dtype="<u4").tobytes()

    class Words(dict):
        def __missing__(self, word: str) -> bytes:
            ids = encode(" " + word)
            if len(word) <= CACHED_CHARS:
                if len(self) >= CACHED_PIECES:
                    self.clear()
                self[word] = ids
            return ids

    words = Words()

    def ids(text: str) -> bytes:
        if irregular(text):
            return encode(text)
        first, *rest = text.split(" ")
        return (encode(first) if first else b"") + b"".join(map(words.__getitem__, rest))

    if added is None:
        return ids
    token, number = added
    between = np.array([number], dtype="<u4").tobytes()
    return lambda text: between.join(map(ids, text.split(token))) if token in text else ids(text)


def cut(ids: bytes, size: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: the remainder first, then full ones."""
    n = len(ids) // 4
    start = 0
    while start < n:
        length = (n - start) % size or size
        yield start, length
        start += length


def tokenise(docs: DataFrame, ranks_path: str, sequence: int = SEQUENCE, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids`` if asked for) per piece of every document."""
    end = np.array([END_TOKEN], dtype="<u4").tobytes()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32()))] if with_ids else []))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(ranks_path, ADDED)
        for batch in batches:
            out: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = ids_of(text.as_py() or "") + end
                for k, (start, length) in enumerate(cut(ids, sequence)):
                    part = ids[4 * start: 4 * (start + length)]
                    out.append((doc, k, start, length, zlib.crc32(part), *([np.frombuffer(part, "<i4")] if with_ids else [])))
            columns = list(zip(*out)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        pieces, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else ""))


class BestFit:
    """Open bins by free space: a bit of ``free`` is set while a bin with that much room is open."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.most = size, open_bins
        self.free, self.bins, self.open, self.made = 0, [[] for _ in range(size + 1)], 0, 0

    def place(self, length: int) -> tuple[int, int]:
        """(bin, offset) of a piece."""
        fits = self.free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            at = self.bins[room].pop()
            self.open -= 1
            if not self.bins[room]:
                self.free ^= 1 << room
        else:
            room, at = self.size, self.made
            self.made += 1
        left = room - length
        if left:
            self.bins[left].append(at)
            self.free |= 1 << left
            self.open += 1
            if self.open > self.most:
                self.close_fullest()
        return at, self.size - room

    def close_fullest(self) -> None:
        room = (self.free & -self.free).bit_length() - 1
        self.bins[room].pop()
        self.open -= 1
        if not self.bins[room]:
            self.free ^= 1 << room


def pack(pieces: DataFrame, packers: int, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    """``pieces`` (``doc_id, piece, start, length, ids_crc32``) with ``sequence_id`` and ``offset``."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 40
        bins = BestFit(sequence, open_bins)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                lengths = block.column("length").to_numpy()
                where = np.zeros((len(lengths), 2), np.int64)
                for i in np.argsort(-lengths, kind="stable"):
                    where[i] = bins.place(int(lengths[i]))
                yield pa.RecordBatch.from_arrays(
                    [*block.columns, pa.array(where[:, 0] + base), pa.array(where[:, 1])], [*block.schema.names, "sequence_id", "offset"])

    order = [F.xxhash64("doc_id", "piece"), F.col("doc_id"), F.col("piece"), F.col("length"), F.col("ids_crc32")]
    dealt = pieces.repartition(packers, *[F.col(c) for c in ("doc_id", "piece", "ids_crc32")]).sortWithinPartitions(*order)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.mapInArrow(fill, f"{kinds}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, ranks_path: str, sequence: int = SEQUENCE, open_bins: int = OPEN_BINS) -> DataFrame:
    """Every piece of every document with its place: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    packers = max(2, shuffle_slots(docs) // SLOTS_PER_PACKER)
    return pack(tokenise(docs, ranks_path, sequence), packers, sequence, open_bins)

"""Benchmark decontamination with a generalised suffix automaton of the test items' words.

Words are runs of ``0-9``, ``a-z`` (``A-Z`` lower-cased) and non-ASCII characters. The automaton holds every run of words
of every item; a document's words stream through it and its state gives the longest run of item words that ends at
each word. Where that run has ``window`` words, the words of the run are hit; an item of fewer words is a window of its
own. Spans that are long enough can be removed, and documents whose hit share is too large dropped.

Items are cut into parts of ``PART_WORDS`` words that overlap by a window less one word, and dealt into blocks of about ``BLOCK_WORDS``
words. Tasks build one automaton per block and write it, as flat arrays, to a table in the shared folder; nothing is built on the
driver, which hands one block at a time from that table to a broadcast. One pass over the documents streams each batch through up
to ``PASS_BLOCKS`` automata, of which a task holds ``HELD_BLOCKS`` at once; only a benchmark of more blocks takes another pass, over
stored rows. So no step holds more than a fixed number of blocks, whatever the size of the benchmark.

Defined results: null text and null items have no words; a null ``item_id`` is hit like others and counts as an item named
by an empty string; items with the same words are all reported, rows that repeat an ``item_id`` once; rows that repeat a ``doc_id`` are judged one by one; an
empty benchmark hits nothing; extra columns pass through.
"""

from __future__ import annotations

import pickle
from array import array
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.names import ddl, free_names
from cairn.llm.store import shuffle_slots, stored
from cairn.llm.words import byte_table

WINDOW = 10
PART_WORDS, BLOCK_WORDS = 50_000, 200_000
PASS_BLOCKS, HELD_BLOCKS = 64, 2
#: words of documents that a task holds at once (and one text)
SLICE_WORDS = 100_000
MARKS = ("_words", "_spans", "_items")


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(byte_table()).split()


class Marker:
    """Streams documents through an automaton; subclasses say how its states are kept."""

    def mark(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[int]]:
        """(spans of hit words, items with an occurring window) of a document."""
        get = self.vocabulary.get
        known = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (known >= 0).view(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        items: set[int] = set()
        for start, end in edges.reshape(-1, 2)[np.diff(edges)[::2] >= self.least] if len(edges) else ():
            state = matched = 0
            for at, word in enumerate(known[start:end].tolist(), int(start) + 1):
                state, matched = self.step(state, matched, word)
                reach = 0
                if matched >= self.window:
                    reach = matched
                    items.update(self.items_at(state))
                if self.near_short[state]:
                    up = state
                    while up > 0:
                        for n, item in self.short_at(up):
                            if n <= matched:
                                items.add(item)
                                reach = max(reach, n)
                        up = self.link[up]
                if reach:
                    while spans and spans[-1][1] >= at - reach:
                        reach = max(reach, at - spans.pop()[0])
                    spans.append((at - reach, at))
        return spans, items


class ItemAutomaton(Marker):
    """Suffix automaton over word numbers while it is built; ``window`` gives what counts as a hit."""

    def __init__(self, window: int):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[str] = []
        self.added: list[list[int]] = []

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` that holds only the runs reached from ``state`` and its suffixes."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        self.link[target] = copy
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new, state = self._state(self.length[last] + 1, {}, 0), last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    def add(self, name: str, words: list[bytes]) -> None:
        state = 0
        for word in words:
            state = self._extend(state, self.vocabulary.setdefault(word, len(self.vocabulary)))
        self.names.append(name)
        self.added.append([self.vocabulary[w] for w in words])

    def finish(self) -> ItemAutomaton:
        """Item lists of the states that stand for a whole window, and per state the nearest short item that ends there."""
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for item, words in enumerate(self.added):
            state = matched = 0
            for word in words:
                state, matched = self.step(state, matched, word)
                if matched >= self.window:
                    self.items.setdefault(self.window_state(state), set()).add(item)
            if 0 < len(words) < self.window:
                self.short.setdefault(state, []).append((len(words), item))
        # the states below which a short item may end, so that a match looks further only where there is something to find
        self.near_short = [False] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            self.near_short[state] = state in self.short or self.near_short[max(0, self.link[state])]
        self.least = min([self.window, *(n for ends in self.short.values() for n, _ in ends)])
        self.added.clear()
        return self

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while state and word not in self.next[state]:
            state = self.link[state]
            matched = self.length[state]
        target = self.next[state].get(word)
        return (target, matched + 1) if target is not None else (0, 0)

    def window_state(self, state: int) -> int:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return state

    def items_at(self, state: int) -> set[int]:
        return self.items[self.window_state(state)]

    def short_at(self, state: int) -> list[tuple[int, int]]:
        return self.short.get(state, [])

    def packed(self) -> bytes:
        """The finished automaton as flat arrays: moves by (state, word), items and short items by state."""
        def grouped(table: dict) -> tuple[np.ndarray, np.ndarray, list]:
            states = sorted(table)
            return np.array(states, np.int64), np.cumsum([0, *(len(table[s]) for s in states)]), [x for s in states for x in sorted(table[s])]

        words = max(len(self.vocabulary), 1)
        moves = sorted((state * words + word, target) for state, to in enumerate(self.next) for word, target in to.items())
        return pickle.dumps({
            "window": self.window, "least": self.least, "names": self.names, "words": list(self.vocabulary),
            "keys": np.array([m[0] for m in moves], np.int64), "targets": np.array([m[1] for m in moves], np.int32),
            "link": np.array(self.link, np.int32), "length": np.array(self.length, np.int32), "near_short": np.array(self.near_short, bool),
            "items": grouped(self.items), "short": grouped(self.short)})


class PackedAutomaton(Marker):
    """An automaton read back from its flat arrays; a move is a binary search."""

    def __init__(self, packed: bytes):
        kept = pickle.loads(packed)
        self.window, self.least, self.names = kept["window"], kept["least"], kept["names"]
        self.vocabulary = {w: i for i, w in enumerate(kept["words"])}
        self.width = max(len(self.vocabulary), 1)
        self.keys = array("q", kept["keys"].tobytes())
        self.targets, self.link, self.length = (array("i", kept[k].tobytes()) for k in ("targets", "link", "length"))
        self.near_short = kept["near_short"].tobytes()
        self.items, self.short = kept["items"], kept["short"]

    def move(self, state: int, word: int) -> int:
        key = state * self.width + word
        at = bisect_left(self.keys, key)
        return self.targets[at] if at < len(self.keys) and self.keys[at] == key else -1

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        while (target := self.move(state, word)) < 0 and state:
            state = self.link[state]
            matched = self.length[state]
        return (target, matched + 1) if target >= 0 else (0, 0)

    def items_at(self, state: int) -> list[int]:
        while self.length[self.link[state]] >= self.window:
            state = self.link[state]
        return self.listed(self.items, state)

    def short_at(self, state: int) -> list[tuple[int, int]]:
        return self.listed(self.short, state)

    @staticmethod
    def listed(table: tuple[np.ndarray, np.ndarray, list], state: int) -> list:
        states, cuts, values = table
        at = int(np.searchsorted(states, state))
        return values[cuts[at]: cuts[at + 1]] if at < len(states) and states[at] == state else []


def item_parts(benchmark: DataFrame, window: int, part_words: int = PART_WORDS) -> DataFrame:
    """``name, words, n``: the items in parts of at most ``part_words`` words that share ``window - 1`` words with the part before."""
    size = max(part_words, window)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                for at in range(0, max(len(words) - window + 1, min(len(words), 1)), size - window + 1):
                    part = words[at: at + size]
                    rows.append((name or "", b" ".join(part), len(part)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.int64())],
                ["name", "words", "n"])

    return benchmark.select(F.col("item_id").cast("string"), "text").mapInArrow(parts, "name string, words binary, n bigint")


def item_blocks(benchmark: DataFrame, window: int, block_words: int = BLOCK_WORDS, part_words: int = PART_WORDS) -> tuple[DataFrame, int]:
    """(stored ``block, automaton`` rows, their number); the automata are built by tasks."""
    parts = stored(item_parts(benchmark, window, part_words).withColumn("row", F.monotonically_increasing_id()), "items")
    blocks = max(1, -(-(parts.agg(F.sum("n")).first()[0] or 0) // block_words))

    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(block: int, automaton: ItemAutomaton) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([automaton.finish().packed()], pa.binary())], ["block", "automaton"])

        now, automaton = None, None
        for batch in batches:
            for block, name, words in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    if automaton is not None:
                        yield row(now, automaton)
                    now, automaton = block, ItemAutomaton(window)
                automaton.add(name, words.split(b" "))
        if automaton is not None:
            yield row(now, automaton)

    dealt = parts.select(F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("long").alias("block"), "name", "words", "row")
    grouped = dealt.repartition(min(blocks, shuffle_slots(benchmark)), "block").sortWithinPartitions("block", "row").drop("row")
    return stored(grouped.mapInArrow(built, "block bigint, automaton binary"), "automata"), blocks


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def mark_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS,
                   part_words: int = PART_WORDS, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` with ``marks``: the number of words, the hit word spans, and the items with occurring windows.

    Columns of those names are replaced.
    """
    docs = docs.drop(*marks)
    spark, text_at = docs.sparkSession, docs.columns.index("text")
    kinds = ("bigint", "array<struct<start:bigint,end:bigint>>", "array<string>")
    marked = docs.withColumns({name: (F.array() if k else F.lit(None)).cast(kinds[k]) for k, name in enumerate(marks)})
    schema = ddl(marked)
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def passes(blocks: list):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, PackedAutomaton] = {}

            def automaton(k: int) -> PackedAutomaton:
                if k not in held:
                    while len(held) >= HELD_BLOCKS:
                        del held[next(iter(held))]
                    held[k] = PackedAutomaton(blocks[k].value)
                    if len(blocks) > HELD_BLOCKS:
                        del blocks[k]._value  # read again from the executor's file for the next batch
                return held[k]

            def marked_slice(texts: list[list[bytes]], spans: list[list], items: list[set]) -> None:
                for k in range(len(blocks)):
                    block = automaton(k)
                    for i, words in enumerate(texts):
                        found, named = block.mark(words)
                        spans[i] += found
                        items[i].update(block.names[n] for n in named)

            # words of a few texts at a time; longer slices where every slice reads all automata again
            limit = SLICE_WORDS * (8 if len(blocks) > HELD_BLOCKS else 1)
            for batch in batches:
                old_spans, old_items = (c.to_pylist() for c in batch.columns[-2:])
                spans = [[(s["start"], s["end"]) for s in old] for old in old_spans]
                items = [set(old) for old in old_items]
                counts, texts, held_words = [], [], 0
                for text in batch.column(text_at):
                    texts.append(words_of(text.as_py()))
                    counts.append(len(texts[-1]))
                    held_words += counts[-1]
                    if held_words >= limit or len(counts) == batch.num_rows:
                        part = slice(len(counts) - len(texts), len(counts))
                        marked_slice(texts, spans[part], items[part])
                        texts, held_words = [], 0
                marks = [pa.array(counts, pa.int64()), pa.array([[{"start": a, "end": b} for a, b in joined(s)] for s in spans], span_type),
                         pa.array([sorted(n) for n in items], pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-3], *marks], batch.schema.names)
        return run

    automata, blocks = item_blocks(benchmark, window, block_words, part_words)
    for first in range(0, blocks, PASS_BLOCKS):
        # one row at a time; broadcasts of a pass end with it
        rows = automata.where(F.col("block").between(first, first + PASS_BLOCKS - 1)).toLocalIterator()
        shared = [spark.sparkContext.broadcast(bytes(r["automaton"])) for r in rows]
        marked = marked.mapInArrow(passes(shared), schema)
        if first + PASS_BLOCKS < blocks:
            marked = stored(marked, "marked")
            for block in shared:
                block.destroy()
    return marked


def remove_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_share: float = 0.5) -> DataFrame:
    """Documents without their hit spans; those with more than ``max_share`` of their words hit are left out.

    A removed span runs from its first word to the next word after it, so what follows keeps its own separators. The
    columns are those of ``docs``.
    """
    text_at = docs.columns.index("text")
    words, hits, items = free_names(docs, *MARKS)
    marked = mark_documents(docs, benchmark, window, marks=(words, hits, items))
    hit = F.aggregate(hits, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    kept = marked.where((F.size(hits) == 0) | (hit <= max_share * F.col(words))).select(*docs.columns, hits)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            for i, spans in enumerate(batch.columns[-1].to_pylist()):
                if spans:
                    texts[i] = without(texts[i], [(s["start"], s["end"]) for s in spans])
            arrays = list(batch.columns[:-1])
            arrays[text_at] = pa.array(texts, arrays[text_at].type)
            yield pa.RecordBatch.from_arrays(arrays, batch.schema.names[:-1])

    return kept.mapInArrow(cut, ddl(docs))


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the word spans."""
    raw = text.encode("utf-8", "surrogatepass")
    low = np.frombuffer(raw.translate(byte_table()), np.uint8)
    edges = np.diff(np.concatenate(([0], (low != 0x20).view(np.int8), [0])))
    starts = np.append(np.flatnonzero(edges == 1), len(raw))
    parts, at = [], 0
    for first, end in spans:
        parts.append(raw[at: starts[first]])
        at = int(starts[end])
    return b"".join([*parts, raw[at:]]).decode("utf-8", "surrogatepass")

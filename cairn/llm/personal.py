"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes that adds what they miss.

Words are runs of non-blank characters. Each has a few numbers that describe its shape (``FIELDS``): runs of character
kinds, digits, length, mixture of letters and digits, punctuation around it, and whether it is one of the cue words of the
labelled table. A word's features are the numbers of itself and its two neighbours. The field is trained by gradient ascent on the
regularised likelihood of the labelled table (``labelled.SENTENCES``) and decoded by Viterbi over whole texts in numpy batches.

Most words need no decoding: where label O leads every other label by at least the largest gain that transitions could give
(``slack``), an exchange argument shows that the best path has O there. Such words cut a text into short runs, which are decoded
exactly, padded by length, each between two Os. So memory is bounded by the longest such run, not by the text.

The patterns (``base_spans``) are matched per kind from left to right without overlap; matches that fail a test (parts of an address,
Luhn, number of digits) are dropped and not tried again. Spans of the field are kept where they overlap no pattern span and pass
the test of their kind; ``secret`` comes from the field alone. Names of persons are not looked for: their shape is that of any capitalised word.

Defined results: null and empty texts have no spans; positions are code points, ends exclusive; rows that repeat a ``doc_id`` are separate
rows; an empty table gives no rows; extra columns are kept by ``tag_documents`` and ``redact``, those named like an output are replaced.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.labelled import KINDS, labelled_rows
from cairn.llm.names import ddl
from cairn.llm.words import mix, text_slices

BASE_KINDS = KINDS[:4]
LABELS = ("O", *KINDS)
FIELDS = ("shape", "digits", "length", "mixture", "before", "behind", "cue")
OFFSETS = (-1, 0, 1)
RIDGE, ROUNDS, RATE, RARE_SHAPES = 0.01, 250, 0.1, 1
CELLS = 200_000
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint,base:boolean>>"
OPENING, CLOSING = b"\"'([{<", b"\"')]}>.,;:!?"

# patterns of the base kinds; possessive where giving back could not help
EMAIL = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
# addresses with bracketed words in place of signs
AT, DOT = r"(?:@|\[at\]|\(at\)|\[@\])", r"(?:\.|\[dot\]|\(dot\)|\[\.\])"
SPELT_EMAIL = re.compile(rf"(?i)[a-z0-9._%+-]++\s*{AT}\s*[a-z0-9-]++(?:\s*{DOT}\s*[a-z0-9-]++)++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    back = [int(d) for d in reversed(digits)]
    return sum(back[::2] + [sum(divmod(2 * d, 10)) for d in back[1::2]]) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    return len(parts) == 4 and all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def is_card(text: str) -> bool:
    digits = digits_of(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The pattern with a local part, read from each ``@`` to the left, which costs no retries on long words."""
    done = 0
    for m in EMAIL.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the fixed patterns, by kind and start."""
    out = [("email", *s) for s in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if is_ip(m[0])]
    out += [("card", *m.span()) for m in CARD.finditer(text) if is_card(m[0])]
    return out + ([("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15] if "+" in text else [])


def kind_table() -> np.ndarray:
    """Per byte: 0 blank, 1 upper, 2 lower or not ASCII, 3 digit, else the byte itself."""
    table = np.arange(256, dtype=np.uint8)
    table[[0x20, *range(0x09, 0x0E)]] = 0
    table[0x41:0x5B], table[0x61:0x7B], table[0x80:], table[0x30:0x3A] = 1, 2, 2, 3
    return table


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def run_sums(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return total[ends] - total[starts]


def hashes(codes: np.ndarray, keep: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the kept codes of each word, in order."""
    at = np.flatnonzero(keep)
    low, high = np.searchsorted(at, starts), np.searchsorted(at, ends)
    word = np.repeat(np.arange(len(starts)), high - low)
    inside = np.arange(len(word)) - np.repeat(np.cumsum(high - low) - (high - low), high - low)
    at = at[np.repeat(low, high - low) + inside]
    powers = np.cumprod(np.full(int((high - low).max(initial=0)) + 1, 0x9E3779B97F4A7C15, np.uint64))
    terms = (codes[at].astype(np.uint64) + np.uint64(1)) * powers[inside]
    full = high > low
    out = np.zeros(len(starts), np.uint64)
    if full.any():
        out[full] = np.add.reduceat(terms, (np.cumsum(high - low) - (high - low))[full])
    return mix(out + (high - low).astype(np.uint64))


class Words:
    """Words of a slice of texts and the numbers that describe them."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        kind = kind_table()[data]
        inside = kind != 0
        fresh = inside.copy()
        fresh[1:] &= ~inside[:-1]
        cuts = offsets[1:-1]
        cuts = cuts[cuts < len(data)]
        fresh[cuts] = inside[cuts]
        self.starts = np.flatnonzero(fresh)
        last = inside.copy()
        last[:-1] &= ~inside[1:] | fresh[1:]
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.data, self.kind = data, kind
        opening, closing = (np.isin(np.arange(256), list(c)) for c in (OPENING, CLOSING))
        low, high = self.starts.copy(), self.ends.copy()
        for _ in range(3):  # punctuation around the word; what remains after three is part of it
            low += (low < high - 1) & opening[data[np.minimum(low, len(data) - 1)]] if len(data) else 0
            high -= (low < high - 1) & closing[data[high - 1]] if len(data) else 0
        self.low, self.high = low, high

    def numbers(self, shapes: np.ndarray, cues: np.ndarray) -> np.ndarray:
        """One row per word with the values of ``FIELDS``; ``shapes`` and ``cues`` are sorted hashes, others count as 0."""
        n = len(self.starts)
        if not n:
            return np.zeros((0, len(FIELDS)), np.int64)
        kind, low, high = self.kind, self.low, self.high
        digits = run_sums(kind == 3, low, high)
        letters = run_sums((kind == 1) | (kind == 2), low, high)
        length = high - low
        ascii_hex = run_sums((kind == 3) | ((lower_table()[self.data] >= 0x61) & (lower_table()[self.data] <= 0x66)), low, high)
        mixture = np.where((digits > 0) & (letters > 0), 1, 0) + np.where(ascii_hex == length, 2, 0)
        mark = lambda at, inside: np.where(inside, self.data[np.clip(at, 0, len(self.data) - 1)].astype(np.int64), 0)
        return np.column_stack([
            known(self.shape_hashes(), shapes), np.searchsorted([0, 2, 3, 4, 6, 9, 12, 19], digits), np.searchsorted([1, 2, 4, 7, 11, 15, 24, 40], length),
            mixture, mark(self.starts, low > self.starts), mark(self.ends - 1, high < self.ends), known(self.word_hashes(), cues)])

    def shape_hashes(self) -> np.ndarray:
        changed = np.ones(len(self.kind), bool)
        changed[1:] = self.kind[1:] != self.kind[:-1]
        changed[self.low] = True
        return hashes(self.kind, changed, self.low, self.high)

    def word_hashes(self) -> np.ndarray:
        return hashes(lower_table()[self.data], np.ones(len(self.data), bool), self.low, self.high)


def known(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """1 + place in the sorted table, 0 for others."""
    if not len(table):
        return np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at + 1, 0)


class Tagger:
    """Weights per (offset, field, value, label) and transitions; borders of a text count as label O."""

    def __init__(self, rows: list[tuple[str, list[tuple[str, int, int]]]]):
        texts = pa.array([text for text, _ in rows], pa.large_string())
        (_, _, data, offsets), = text_slices(texts)
        words = Words(data, offsets)
        labels = np.zeros(len(words.starts), np.int64)
        for k, (text, spans) in enumerate(rows):
            for label, start, end in spans:
                a, b = (offsets[k] + len(text[:at].encode()) for at in (start, end))
                labels[(words.starts >= a) & (words.starts < b)] = LABELS.index(label)
        close = np.zeros(len(labels), bool)
        for away in (-1, 1):
            close |= np.roll(labels > 0, away)
        hashed, shape = words.word_hashes(), words.shape_hashes()
        letters_only = run_sums((words.kind == 1) | (words.kind == 2), words.low, words.high) == words.high - words.low
        self.cues = np.unique(hashed[(labels == 0) & close & letters_only])
        self.shapes = np.unique(shape)
        self.values: list[np.ndarray] = []
        table = words.numbers(self.shapes, self.cues)
        self.values = [np.unique(np.append(table[:, f], -1)) for f in range(len(FIELDS))]
        self.fit(table, labels, words.first)

    def coded(self, table: np.ndarray) -> np.ndarray:
        """Places of the values among those seen in training; others share place 0, as do borders."""
        return np.column_stack([known(table[:, f], self.values[f]) for f in range(len(FIELDS))]) if len(table) else table

    def fit(self, table: np.ndarray, labels: np.ndarray, first: np.ndarray) -> None:
        coded = self.coded(table)
        lengths = np.diff(first)
        n, most, k = len(lengths), int(lengths.max()), len(LABELS)
        sizes = [len(v) + 1 for v in self.values]
        base = np.cumsum([0, *(sizes * len(OFFSETS))])
        ids = np.zeros((n, most, len(OFFSETS) * len(FIELDS)), np.int64)
        gold, mask = np.zeros((n, most), np.int64), np.arange(most) < lengths[:, None]
        for s in range(n):
            rows = np.vstack([np.zeros((1, len(FIELDS)), np.int64), coded[first[s]: first[s + 1]], np.zeros((1, len(FIELDS)), np.int64)])
            for o in range(len(OFFSETS)):
                ids[s, : lengths[s], o * len(FIELDS): (o + 1) * len(FIELDS)] = rows[o: o + lengths[s]]
            gold[s, : lengths[s]] = labels[first[s]: first[s + 1]]
        ids += base[:-1]
        flat = ids[mask]
        weights, moves = np.zeros((base[-1], k)), np.zeros((k, k))
        pad = np.pad(np.where(mask, gold, 0), ((0, 0), (1, 1)))
        seen = np.zeros((k, k))
        live = np.arange(most + 1) <= lengths[:, None]
        np.add.at(seen, (pad[:, :-1][live], pad[:, 1:][live]), 1)
        target = np.zeros((len(flat), k))
        target[np.arange(len(flat)), gold[mask]] = 1
        state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)]
        for step in range(1, ROUNDS + 1):
            emit = np.zeros((n, most, k))
            emit[mask] = weights[flat].sum(1)
            node, edge = marginals(emit, moves, lengths)
            up = np.zeros_like(weights)
            np.add.at(up, flat, (target - node[mask])[:, None, :])
            for at, (value, gradient) in enumerate(((weights, up - RIDGE * weights), (moves, seen - edge - RIDGE * moves))):
                mean, square = state[2 * at], state[2 * at + 1]
                mean += 0.1 * (gradient - mean)
                square += 0.001 * (gradient**2 - square)
                value += RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        self.moves = moves
        self.weights = [[weights[base[o * len(FIELDS) + f]: base[o * len(FIELDS) + f + 1]] for f in range(len(FIELDS))] for o in range(len(OFFSETS))]
        through = moves[:, 1:, None] + moves[None, 1:, :].transpose(0, 1, 2)  # from i over a label to j
        self.slack = float((through - (moves[:, :1, None] + moves[None, :1, :])).max())

    def emissions(self, words: Words) -> np.ndarray:
        coded = self.coded(words.numbers(self.shapes, self.cues))
        radix = np.cumprod([1, *(len(v) + 1 for v in self.values[:-1])])
        types, which = np.unique(coded @ radix, return_inverse=True)
        fields = (types[:, None] // radix) % np.array([len(v) + 1 for v in self.values])
        # one more type for the border of a text
        tables = [np.vstack([sum(self.weights[o][f][fields[:, f]] for f in range(len(FIELDS))), sum(self.weights[o][f][0] for f in range(len(FIELDS)))])
                  for o in range(len(OFFSETS))]
        before, behind = np.roll(which, 1), np.roll(which, -1)
        full = np.flatnonzero(np.diff(words.first))
        before[words.first[:-1][full]] = behind[words.first[1:][full] - 1] = len(types)
        return tables[0][before] + tables[1][which] + tables[2][behind]

    def labels(self, words: Words) -> np.ndarray:
        """The most likely label of every word."""
        out = np.zeros(len(words.starts), np.int8)
        if not len(out):
            return out
        emit = self.emissions(words)
        free = emit[:, 0] - emit[:, 1:].max(1) < self.slack
        begin = free.copy()
        begin[1:] &= ~free[:-1]
        starts_text = np.zeros(len(out) + 1, bool)
        starts_text[words.first] = True
        begin |= free & starts_text[:-1]
        a = np.flatnonzero(begin)
        stop = free.copy()
        stop[:-1] &= ~free[1:] | begin[1:]
        b = np.flatnonzero(stop) + 1
        order = np.argsort(a - b, kind="stable")  # longest first
        a, b = a[order], b[order]
        at = 0
        while at < len(a):
            rows = max(1, CELLS // int(b[at] - a[at]))
            viterbi(emit, self.moves, a[at: at + rows], b[at: at + rows], out)
            at += rows
        return out


def marginals(emit: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(label probabilities, expected transitions) of padded sequences."""
    n, most, k = emit.shape

    def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
        top = x.max(axis, keepdims=True)
        return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))

    ahead, back = np.zeros_like(emit), np.zeros_like(emit)
    ahead[:, 0] = moves[0] + emit[:, 0]
    for t in range(1, most):
        ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + moves, 1) + emit[:, t]
    for t in range(most - 1, -1, -1):
        last = (lengths - 1 == t)[:, None]
        back[:, t] = np.where(last, moves[:, 0], log_sum(moves + (emit[:, t + 1] + back[:, t + 1])[:, None, :], 2) if t + 1 < most else moves[:, 0])
    ends = np.arange(n), lengths - 1
    whole = log_sum(ahead[ends] + moves[:, 0], 1)
    node = np.exp(ahead + back - whole[:, None, None])
    edge = np.zeros((k, k))
    edge[0] += node[:, 0].sum(0)
    edge[:, 0] += node[ends].sum(0)
    for t in range(1, most):
        live = lengths > t
        edge += np.exp(ahead[live, t - 1, :, None] + moves + (emit[live, t] + back[live, t])[:, None, :] - whole[live, None, None]).sum(0)
    return node, edge


def viterbi(emit: np.ndarray, moves: np.ndarray, a: np.ndarray, b: np.ndarray, out: np.ndarray) -> None:
    """Writes the best labels of the runs ``a`` to ``b`` (longest first) between two Os into ``out``."""
    length = b - a
    best = moves[0] + emit[a]
    came = np.zeros((len(a), int(length[0]), emit.shape[1]), np.int8)
    for t in range(1, int(length[0])):
        n = int(np.searchsorted(-length, -t, side="left"))  # runs longer than t
        step = best[:n, :, None] + moves
        came[:n, t] = step.argmax(1)
        best[:n] = step.max(1) + emit[a[:n] + t]
    label = (best + moves[:, 0]).argmax(1)
    for t in range(int(length[0]) - 1, -1, -1):
        n = int(np.searchsorted(-length, -t, side="left"))
        out[a[:n] + t] = label[:n]
        label[:n] = came[np.arange(n), t, label[:n]]


@functools.cache
def default_tagger() -> Tagger:
    return Tagger(labelled_rows())


def passes(kind: str, text: str) -> bool:
    """The test of a kind for spans of the field."""
    n = len(digits_of(text))
    return {"email": bool(SPELT_EMAIL.fullmatch(text)), "ip": is_ip(text), "card": is_card(text),
            "phone": 7 <= n <= 15, "secret": len(text) >= 8}[kind]


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """Without quotes and closing punctuation around; brackets stay where both halves are inside."""
    while start < end and text[start] in "\"'<{":
        start += 1
    while start < end and text[end - 1] in "\"'.,;:!?>}":
        end -= 1
    for left, right in ("()", "[]"):
        if text[start:end].count(left) > text[start:end].count(right) and text[start] == left:
            start += 1
        if text[start:end].count(right) > text[start:end].count(left) and text[end - 1] == right:
            end -= 1
    return start, end


def added_spans(text: str, words: list[tuple[int, int, int]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans of labelled words (label, first and end code point) that pass their test and overlap none of ``base``."""
    taken = sorted((s, e) for _, s, e in base)
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else np.zeros(0, np.int64)
    runs: list[list[int]] = []
    for label, start, end in words:
        if runs and runs[-1][0] == label and not text[runs[-1][2]: start].strip(" \t\n\x0b\x0c\r"):
            runs[-1][2] = end
        else:
            runs.append([label, start, end])
    out = []
    for label, start, end in runs:
        start, end = trimmed(text, start, end)
        before = int(np.searchsorted([s for s, _ in taken], end)) if taken else 0
        if start < end and not (before and reach[before - 1] > start) and passes(LABELS[label], text[start:end]):
            out.append((LABELS[label], start, end))
    return out


def texts_with_spans(tagger: Tagger, texts: pa.Array) -> Iterator[list[tuple[str, int, int, bool]]]:
    """All spans of every text, by kind and start."""
    for row, end, data, offsets in text_slices(texts):
        words = Words(data, offsets)
        label = tagger.labels(words)
        marked = np.flatnonzero(label)
        cuts = np.searchsorted(marked, words.first)
        signs = np.flatnonzero((words.kind == 3) | (data == 0x40))  # every pattern needs a digit or an @
        signed = np.diff(np.searchsorted(signs, offsets)) > 0
        for k in range(end - row):
            here = marked[cuts[k]: cuts[k + 1]]
            if not len(here) and not signed[k]:
                yield []
                continue
            raw = data[offsets[k]: offsets[k + 1]]
            text = raw.tobytes().decode()
            base = base_spans(text) if signed[k] else []
            point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
            spots = [(int(label[w]), int(point[words.starts[w] - offsets[k]]), int(point[words.ends[w] - offsets[k]])) for w in here]
            spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, spots, base)]
            yield sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def tag_documents(docs: DataFrame, column: str = "spans", tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with all spans of ``text`` as an array of ``kind, start, end, base``, by kind and start."""
    docs = docs.drop(column)
    tagger, text_at = tagger or default_tagger(), docs.columns.index("text")

    def tagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            spans = [[dict(zip(("kind", "start", "end", "base"), s)) for s in found] for found in texts_with_spans(tagger, batch.column(text_at))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, kind)], [*batch.schema.names, column])

    return docs.mapInArrow(tagged, f"{ddl(docs)}, `{column}` {SPAN_TYPE}")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, tagger: Tagger | None = None) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; of overlapping spans the first that starts counts."""
    tagger, text_at = tagger or default_tagger(), docs.columns.index("text")

    def hidden(text: str, spans: list[tuple[str, int, int, bool]]) -> str:
        out, at = [], 0
        for kind, start, end, _ in sorted(spans, key=lambda s: (s[1], -s[2])):
            if start >= at:
                out += [text[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*out, text[at:]])

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at)
            shown = [t if t is None or not spans else hidden(t, spans) for t, spans in zip(texts.to_pylist(), texts_with_spans(tagger, texts))]
            yield batch.set_column(text_at, batch.schema.field(text_at), pa.array(shown, texts.type))

    return docs.mapInArrow(written, docs.schema)

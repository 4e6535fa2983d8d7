"""Personal data, importance resampling and the conversation trie against plain versions, on ordinary and awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.llm import personal, queries, resample, turn_trie
from cairn.llm.labelled import SENTENCES, labelled_rows
from cairn.llm.words import text_slices

FOLDER = "/root/testdata/sf0.001"


# --- personal data

def plain_base(text):
    """The patterns as they are written, matched by the regular expression engine alone."""
    def valid(kind, found):
        digits = re.sub("[^0-9]", "", found)
        if kind == "ip":
            return all(int(p) <= 255 for p in found.split("."))
        if kind == "card":
            odd, even = digits[::-1][::2], digits[::-1][1::2]
            total = sum(map(int, odd)) + sum(sum(map(int, str(2 * int(d)))) for d in even)
            return 13 <= len(digits) <= 19 and total % 10 == 0
        return kind == "email" or 9 <= len(digits) <= 15

    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    return [(kind, *m.span()) for kind, p in patterns.items() for m in re.finditer(p, text) if valid(kind, m[0])]


def test_base_spans_equal_the_patterns():
    random.seed(3)
    parts = ["a@b.c", "@", ".", "é", "x.y", "+1 ", "(212) ", "555-0142", "4111 1111 1111 1111", "1.2.3.4", "256", "0255", " ", "-", "\n", "%", "12", "5500-0000-0000-0004", "+", ")"]
    for _ in range(4000):
        text = "".join(random.choices(parts, k=random.randint(1, 9)))
        assert personal.base_spans(text) == plain_base(text), text


def plain_labels(tagger, text):
    """Viterbi over all words with features taken word by word."""
    (_, _, data, offsets), = text_slices(pa.array([text], pa.large_string()))
    words = personal.Words(data, offsets)
    coded = tagger.coded(words.numbers(tagger.shapes, tagger.cues))
    n, border = len(coded), np.zeros(len(personal.FIELDS), int)
    emit = []
    for t in range(n):
        around = [coded[t - 1] if t else border, coded[t], coded[t + 1] if t + 1 < n else border]
        emit.append(sum(tagger.weights[o][f][row[f]] for o, row in enumerate(around) for f in range(len(personal.FIELDS))))
    best, back = tagger.moves[0] + emit[0], []
    for t in range(1, n):
        step = best[:, None] + tagger.moves
        back.append(step.argmax(0))
        best = step.max(0) + emit[t]
    label = [int((best + tagger.moves[:, 0]).argmax())]
    for came in reversed(back):
        label.append(int(came[label[-1]]))
    return label[::-1], tagger.labels(words).tolist()


def test_pruned_decoding_equals_viterbi_over_all_words():
    random.seed(5)
    tagger, vocabulary = personal.default_tagger(), " ".join(t for t, _ in labelled_rows()).split()
    for n in [1, 2, 3] + [random.randint(4, 60) for _ in range(150)]:
        text = " ".join(random.choices([*vocabulary, "\n", "17", "aé", "Zz9", "(at)"], k=n)).strip() or "x"
        want, got = plain_labels(tagger, text)
        assert got == want, text


def test_field_learns_its_table_and_generalises():
    rows = labelled_rows()
    assert len(rows) == len(SENTENCES) < 200
    found = list(personal.texts_with_spans(personal.default_tagger(), pa.array([t for t, _ in rows])))
    for (text, spans), out in zip(rows, found):
        assert {personal.trimmed(text, a, b) for k, a, b in spans if personal.passes(k, text[slice(*personal.trimmed(text, a, b))])} <= {s[1:3] for s in out}, text
        assert all(s[3] for s in out) or spans, text  # nothing is added to sentences without a mark
    fresh = {'password = "hunter2hunter2x"': ("secret", "hunter2hunter2x"), "tel: (030) 555 0199": ("phone", "(030) 555 0199"),
             "write to eva.mai(at)firma.example.de today": ("email", "eva.mai(at)firma.example.de")}
    for text, out in zip(fresh, personal.texts_with_spans(personal.default_tagger(), pa.array(list(fresh)))):
        assert [(k, text[a:b], base) for k, a, b, base in out] == [(*fresh[text], False)]


def test_personal_query_and_odd_rows(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("text is not null").collect()
    got = {r.doc_id: r for r in queries.op11_personal_data(spark, FOLDER).collect()}
    for d in docs:
        base = plain_base(d.text)
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert got[d.doc_id].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [got[d.doc_id][f"n_{k}"] for k in personal.BASE_KINDS] == [sum(b[0] == k for b in base) for k in personal.BASE_KINDS]
        assert set(line.split(",")) - {""} <= set(got[d.doc_id].spans.split(","))
    long = "1 " * 30_000 + "x@y.zz" + " 4111" * 20_000
    texts = [None, "", " \n", "é a@b.cd é", "é a@b.cd é", long, "1" * 100_000, "a" * 100_000, "+" + "1 " * 50_000, "token = \"abcdef0123456789\""]
    rows = [(i, t, 1, [1]) for i, t in enumerate(texts)] + [(None, "10.0.0.1", 2, None)]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, kind int, spans array<int>")
    out = {r.doc_id: [s[:] for s in r.spans] for r in personal.tag_documents(odd).collect()}
    assert out[0] == out[1] == out[2] == out[7] == [] and out[3] == out[4] == [("email", 2, 8, True)] and out[None] == [("ip", 0, 8, True)]
    assert ("email", 60_000, 60_006, True) in out[5] and out[9] == [("secret", 9, 25, False)]
    hidden = {r.doc_id: r.text for r in personal.redact(odd).collect()}
    assert hidden[3] == "é [EMAIL] é" and hidden[0] is None and hidden[9] == 'token = "[SECRET]"'
    assert personal.redact(odd).columns == odd.columns and personal.tag_documents(odd.limit(0)).count() == 0


# --- importance resampling

def test_joined_crcs():
    random.seed(2)
    a, b = ([random.randbytes(random.randint(0, 90)) for _ in range(300)] for _ in range(2))
    crc = lambda xs: np.array([zlib.crc32(x) for x in xs], np.uint32)
    assert (resample.joined_crc(crc(a), crc(b), np.array([len(x) for x in b])) == crc([x + y for x, y in zip(a, b)])).all()


def plain_runs(text, max_run):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    return words, [zlib.crc32(" ".join(words[i: i + n]).encode()) for n in range(1, max_run + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize(("max_run", "buckets", "dictionary"), [(1, 10_000, 200_000), (3, 70_000, 300), (2, 97, 0)])
def test_features_equal_plain_runs(spark, monkeypatch, max_run, buckets, dictionary):
    monkeypatch.setattr(resample, "FIRST_WORDS", 5)
    random.seed(max_run)
    letters = ["ab", "AB", "é", " ", " ", "-", "1", "ß", "\n", "aa", "ba"]
    texts = ["".join(random.choices(letters, k=random.randint(0, 200))) for _ in range(120)] + [None, "", " - ", "x" * 5000, "a b " * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32
    for row in resample.features(docs, "doc_id", buckets, max_run, dictionary).collect():
        words, runs = plain_runs(texts[row.key], max_run)
        assert (row.n_words, row.n_features) == (len(words), len(runs))
        assert sorted(np.frombuffer(bytes(row.buckets), kind).tolist()) == sorted(r % buckets for r in runs)


def test_dictionary_finds_words_over_many_slices():
    """Payloads come from the automaton once it has grown, and are the same as from the bytes."""
    random.seed(9)
    vocabulary = [f"w{i}".encode() for i in range(3000)] + ["é".encode(), b"x" * 100]
    held = resample.PayloadDictionary(2000)
    for _ in range(6):
        words = random.choices(vocabulary, k=4000)
        clean = b" " + b"  ".join(words) + b" "
        inside = np.frombuffer(clean, np.uint8) != 0x20
        edge = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
        assert held.scan(clean, edge[::2], edge[1::2]).tolist() == [zlib.crc32(w) for w in words]
    assert held.automaton is not None and 256 <= len(held.words) <= 2000


def plain_resample(docs, target, max_run, min_words, buckets=10_000):
    features = {k: plain_runs(t, max_run) for k, t in docs}
    have = Counter(r % buckets for _, runs in features.values() for r in runs)
    want = Counter(r % buckets for t in target for r in plain_runs(t, max_run)[1])
    S, T = sum(have.values()), sum(want.values())
    gain = lambda b: math.floor(1000 * math.log((want[b] + 1.0) * (S + buckets) / ((have[b] + 1.0) * (T + buckets))))
    out = {}
    for k, (words, runs) in features.items():
        weight = sum(gain(r % buckets) for r in runs) // len(runs) if runs else 0
        h = int(hashlib.sha256(f"2024:{k}".encode()).hexdigest()[:8], 16)
        out[k] = [len(runs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    able = sorted((k for k in features if len(features[k][0]) >= min_words), key=lambda k: (-out[k][2], k))
    for rank, k in enumerate(able[: 10 * len(able) // 100], 1):
        out[k][3] = rank
    return out


def test_resample_equals_plain_version(spark):
    random.seed(4)
    words = [f"v{i}" for i in range(60)]
    docs = [(k, " ".join(random.choices(words, k=random.randint(0, 40)))) for k in range(400)] + [(900, None), (901, "")]
    target = [" ".join(random.choices(words[:10], k=30)) for _ in range(20)]
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], "doc_id int, text string, rank int, key string")
    items = spark.createDataFrame(list(enumerate(target)), "item_id int, text string")
    for max_run, min_words in ((1, 20), (2, 0)):
        got = {r.doc_id: list(r[1:]) for r in resample.resample(frame, items, max_run=max_run, min_words=min_words).collect()}
        assert got == plain_resample(docs, target, max_run, min_words)
    assert resample.resample(frame.limit(0), items).count() == 0
    assert resample.resample(frame, items.limit(0)).where("rank is not null").count() == sum(len(t.split()) >= 20 for _, t in docs if t) // 10


def test_resample_with_null_and_repeated_ids(spark):
    rows = [(None, "a b"), (None, "a b"), *((7, "a b c") for _ in range(30)), *((k, "c d") for k in range(10, 30))]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = resample.resample(frame, frame.withColumnRenamed("doc_id", "item_id"), min_words=1).collect()
    assert len(out) == len(rows) and all(r.score is None and r["rank"] is None for r in out if r.doc_id is None)
    assert sorted(r["rank"] for r in out if r["rank"]) == [1, 2, 3, 4, 5] and len({r.score for r in out if r.doc_id == 7}) == 1


# --- conversation trie

def plain_nodes(convs):
    members, below = {}, {}
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    for p in members:
        if p:
            below.setdefault(p[:-1], []).append(p)

    def tree(p):
        saved, leaves = (len(members[p]) - 1) * (len(re.findall(r"[^\x20\x09-\x0d]+", p[-1][1])) if p else 0), int(p not in below)
        for child in below.get(p, []):
            s, n = tree(child)
            saved, leaves = saved + s, leaves + n
        return saved, leaves

    out = set()
    for p, m in members.items():
        saved, leaves = tree(p)
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.add((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(below.get(p, [])), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def plain_turns(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


CONVERSATION = "conv_id bigint, turn bigint, role string, text string, ids string, words int"


@pytest.mark.parametrize("shard_turns", [1_000_000, 12])
def test_trie_equals_plain_version(spark, shard_turns):
    """One shard per session slot, and many shards, so that hot paths run over several borders."""
    random.seed(1)
    rows = []
    for c in range(90):
        for t in range(random.randint(1, 7) if c % 9 else 40):
            rows.append((c, None if random.random() < 0.1 else t, random.choice(["user", "assistant", None]), random.choice(["a b", "c", None, "d e  f"]), "x", 1))
    rows += [(c, t, "user", "same", "x", 1) for c in range(200, 300) for t in range(20)] + [(c, 0, "user", "same", "x", 1) for c in range(300, 340)]
    rows += [(None, 0, "user", "a", "x", 1), (0, 0, "user", "a b", "x", 1), (0, 0, "user", "a b", "x", 1), (411, 5, None, None, None, None)]
    frame = spark.createDataFrame(rows, CONVERSATION)
    own = plain_turns(rows)
    got = [tuple(r) for r in turn_trie.prefix_nodes(turn_trie.sequences(frame), shard_turns).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_nodes(own)
    rebuilt = {c: own.get(c - c % 20, [])[: (h := zlib.crc32(str(c).encode()) % 4)] + t[h:] for c, t in own.items()}
    assert any(not t for t in rebuilt.values())
    got = [tuple(r) for r in turn_trie.prefix_nodes(turn_trie.rebuilt_sequences(frame), shard_turns).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_nodes(rebuilt)


def test_trie_of_nothing_and_of_empty_conversations(spark):
    frame = spark.createDataFrame([], CONVERSATION)
    assert turn_trie.prefix_nodes(turn_trie.rebuilt_sequences(frame)).count() == 0
    empty = spark.range(5).select(F.col("id").alias("conv_id"), F.lit(b"").alias("ids"), F.array().cast("array<bigint>").alias("words"))
    row, = turn_trie.prefix_nodes(empty).collect()
    assert row[:] == (0, 0, None, 5, 0, 1, 0, hashlib.sha256(b"0,1,2,3,4").hexdigest())


def test_ends_of_a_hot_node_travel_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(turn_trie, "CHUNK_IDS", 7)
    frame = spark.range(1000).selectExpr("id as conv_id", "0L as turn", "'user' as role", "'hello there' as text")
    got = sorted(turn_trie.prefix_nodes(turn_trie.sequences(frame), 50).collect(), key=lambda r: r.depth)
    assert [(r.n_convs, r.n_leaves, r.saved_tokens) for r in got] == [(1000, 1, 1998), (1000, 1, 1998)]
    assert got[1].ends_sha256 == hashlib.sha256(",".join(map(str, range(1000))).encode()).hexdigest()


def test_windows_of_long_conversations():
    """Rows that differ in later windows than the first."""
    random.seed(6)
    convs = [[random.choice([1, 2]) if t in (3, 17, 40) else 1 for t in range(random.choice([0, 3, 16, 17, 18, 50]))] for _ in range(200)]
    turn, lengths = np.array([t for c in convs for t in c], np.int32), np.array([len(c) for c in convs])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    order = turn_trie.sorted_rows(turn, starts, lengths, np.arange(200))
    assert order.tolist() == sorted(range(200), key=lambda k: (convs[k], k))
    shared = turn_trie.shared_lengths(turn, starts[order], lengths[order])
    ranked = [convs[k] for k in order]
    assert shared.tolist()[1:] == [next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b))) for a, b in zip(ranked, ranked[1:])]

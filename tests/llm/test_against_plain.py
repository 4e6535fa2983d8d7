"""Operators against plain versions of their rules, and cases that once gave wrong rows."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cairn.llm import chat, decontaminate, embeddings, jaccard, language, packing, sharding, suffixes

FOLDER = "/root/testdata/sf0.001"
BASE = " ".join(f"t{i}" for i in range(60))


# --- Jaccard join

def test_rows_that_repeat_a_doc_id_are_judged_one_by_one(spark):
    rows = [(1, BASE), (1, BASE), (2, f"{BASE} more"), (2, "an unrelated text of its own that nothing else resembles"), (3, f"{BASE} more"), (None, BASE)]
    docs = spark.createDataFrame([(*r, k, 0) for k, r in enumerate(rows)], "doc_id int, text string, place int, kept int")
    got = Counter((r.doc_id, r.class_id, r.n_links, r.kept) for r in jaccard.near_duplicates(docs).collect())
    assert got == Counter([(1, 1, 3, True), (1, 1, 3, False), (2, 1, 3, False), (3, 1, 3, False), (2, 2, 0, True), (None, None, 0, True)])
    left = jaccard.drop_near(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or 0, r.text) for r in left.collect()) == sorted((r[0] or 0, r[1]) for r in (rows[0], rows[3], rows[5]))
    assert jaccard.drop_near(docs.limit(0)).count() == 0


def test_isolated_pairs_just_above_the_threshold_are_found(spark):
    """2,000 pairs that share exactly four fifths of their runs, with the production settings."""
    rows = []
    for k in range(2000):
        words = [f"p{k}w{i}" for i in range(84)]  # 80 common runs, and 10 that only either has
        rows += [(2 * k + side, " ".join(words + [f"p{k}{'ab'[side]}{i}" for i in range(10)])) for side in (0, 1)]
    sets = list(jaccard.shingle_sets(pa.array([rows[0][1], rows[1][1]])))
    share = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
    assert 0.8 <= share < 0.81
    out = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id int, text string")).where("n_links = 1 and class_id = doc_id - doc_id % 2").count()
    assert out == 4000


def chance_of_loss(s):
    """Exactly: no common band, or dropped by the comparison of 8-bit values."""
    match = s + (1 - s) / 256
    alive, n = {0: 1.0}, 0
    for need in jaccard.least_matches(jaccard.THRESHOLD):
        for _ in range(jaccard.STEP):
            after = Counter()
            for m, p in alive.items():
                after[m + 1] += p * match
                after[m] += p * (1 - match)
            alive = after
            n += 1
        alive = {m: p for m, p in alive.items() if m >= need}
    return (1 - s**jaccard.BAND_ROWS) ** jaccard.BANDS, 1 - sum(alive.values())


def test_chance_of_losing_a_pair_at_the_threshold():
    band, pruned = chance_of_loss(0.8)
    assert band < 1e-4 and pruned < 1e-4
    assert sum(chance_of_loss(0.85)) < 1e-5


# --- suffixes

def test_a_passage_of_one_letter_words(spark):
    """50 words in 99 characters, the shortest text that can hold a repeated passage."""
    text = " ".join("abcdefghij"[i % 7] for i in range(50))
    assert len(text) == 99
    docs = spark.createDataFrame([(k, text) for k in range(3)], "doc_id int, text string")
    assert sorted(tuple(r) for r in suffixes.repeated_passages(docs).collect()) == [(k, 0, 50) for k in range(3)]


# --- embeddings

def test_components_near_the_limits_of_a_double(spark):
    rows = [(1, [1e-170, 0.0]), (2, [0.0, 1e-170]), (3, [0.0, 1e170]), (4, [1e170, 1e160]), (5, [5e-324, 0.0]), (6, [-1e300, 0.0])]
    out = {r.vec_id: r[1:] for r in embeddings.near_dedup(spark.createDataFrame(rows, "vec_id int, embedding array<double>")).collect()}
    assert out == {1: (2, 1, True), 2: (1, 2, True), 3: (1, 2, False), 4: (2, 1, False), 5: (2, 1, False), 6: (0, 6, True)}


def test_number_of_tables_stays_small():
    assert embeddings.table_plan(10_000)[1] < 20 and embeddings.table_plan(10**9)[1] < 300


# --- sharding

def plain_ring(keys, shards, virtual):
    """Every key walks clockwise on its own until a shard has room."""
    points = sharding.ring_points(shards, virtual)
    room = {s: len(keys) // shards + (s < len(keys) % shards) for s in range(shards)}
    arcs = {}
    for place, key in sorted(keys):
        at = next((i for i, (p, _) in enumerate(points) if p >= place), 0)
        arcs.setdefault(at, []).append(key)
    out, over = {}, []
    for at, (_, shard) in enumerate(points):
        for key in arcs.get(at, []):
            if room[shard]:
                room[shard] -= 1
                out[key] = shard
            else:
                over.append((at, key))
    for at, key in over:
        while not room[points[at][1]]:
            at = (at + 1) % len(points)
        room[points[at][1]] -= 1
        out[key] = points[at][1]
    return out


def test_shards_equal_a_walk_of_every_key(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    places = [(r.p, r.doc_id) for r in docs.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.RING)).alias("p")).collect()]
    got = {r.doc_id: (r.shard, r.slot) for r in sharding.assign_shards(docs, 7, 16).collect()}
    assert {d: s for d, (s, _) in got.items()} == plain_ring(places, 7, 16)
    for shard in range(7):
        slots = sorted(slot for s, slot in got.values() if s == shard)
        assert slots == list(range(len(slots)))


def test_one_more_shard_moves_little(spark):
    docs = spark.range(10_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before, after = ({r.doc_id: r.shard for r in sharding.assign_shards(docs, shards=n).collect()} for n in (40, 41))
    assert 1 / 41 <= sum(before[d] != after[d] for d in before) / len(before) + 0.001 < 0.05


# --- packing

def test_bins_are_chosen_as_by_a_search_over_all_open_ones():
    random.seed(8)
    for most in (1, 3, 50):
        bins, free, made = packing.BestFit(100, most), {}, 0
        for _ in range(3000):
            length = random.choice([random.randint(1, 100), random.randint(1, 20)])
            at, offset = bins.place(length)
            fitting = [room for room in free.values() if room >= length]
            if fitting:
                assert free[at] == min(fitting) and offset == 100 - free[at]
            else:
                assert (at, offset) == (made, 0)
                made, free[at] = made + 1, 100
            free[at] -= length
            if not free[at]:
                del free[at]
            if len(free) > most:  # one of the fullest closes: the one the packer no longer holds
                held = {b for room in bins.bins for b in room}
                closed, = set(free) - held
                assert free[closed] == min(free.values())
                del free[closed]
            assert {b: room for room, at_room in enumerate(bins.bins) for b in at_room} == free


def test_packing_of_ties_and_many_equal_documents(spark):
    docs = spark.createDataFrame([(k % 3, "same text") for k in range(500)] + [(None, None)] * 5, "doc_id int, text string")
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken")).toPandas()
    assert len(out) == 505
    for _, part in out.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 1024


# --- language

def plain_language(rows, texts, buckets=512):
    """Bit classifiers as log odds of trigram shares, decoding by weighted logistic loss; counted in dictionaries."""
    def grams(text):
        low = "".join(chr(b + 32) if 65 <= b <= 90 else chr(b) if 97 <= b <= 122 or b >= 128 else " " for b in (text or "").encode())
        cells = [low[i: i + 3] for i in range(len(low) - 2) if low[i: i + 3] != "   "]
        return Counter((int.from_bytes(g.encode("latin-1"), "big") * 0x9E3779B1 % 2**32) >> (32 - int(math.log2(buckets))) for g in cells)

    languages = sorted({lang for lang, _ in rows})
    shares = []
    for lang in languages:
        total = np.zeros(buckets)
        for own, text in rows:
            if own == lang and (g := grams(text)):
                for cell, n in g.items():
                    total[cell] += n / g.total()
        total = total + total.sum() * 1e-6 + 1e-12
        shares.append(total / total.sum())
    bits = [[1] + [1 if m >> i & 1 else -1 for i in range(len(languages) - 1)] for m in range(2 ** (len(languages) - 1) - 1)]
    fitted = []
    for bit in bits:
        mean = lambda sign: np.mean([s for s, b in zip(shares, bit) if b == sign], 0)  # noqa: B023,E731
        odds = np.log(mean(1)) - np.log(mean(-1))
        low, high = (min if sign > 0 else max for sign in (1, -1))
        low, high = low(s @ odds for s, b in zip(shares, bit) if b > 0), high(s @ odds for s, b in zip(shares, bit) if b < 0)
        fitted.append((odds, (low + high) / 2, max((low - high) / 2, 1e-9)))
    whole = sum(half for _, _, half in fitted)
    out = []
    for text in texts:
        if not any(c.isalpha() for c in text or ""):
            out.append(("und", 0.0))
            continue
        g, losses = grams(text), np.zeros(len(languages))
        for bit, (odds, centre, half) in zip(bits, fitted):
            margin = sum(odds[cell] * n for cell, n in g.items()) / max(g.total(), 1)
            margin = min(max((margin - centre) / half, -4), 4)
            losses += [math.log1p(math.exp(-language.GAIN * margin * b)) * half / whole * len(bits) for b in bit]
        odds = np.exp(losses.min() - losses)
        out.append((languages[int(odds.argmax())], float(odds.max() / odds.sum())))
    return out


def test_languages_equal_a_plain_version(spark):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").where("lang is not null and length(text) < 3000").collect()][:120]
    texts = [t for _, t in rows[::3]] + [None, "", "12 34", "a", "été", "der die das", "the of and", "日本"]
    model = language.fit_languages(spark.createDataFrame(rows, "lang string, text string"), 512)
    names, scores, _ = model.predict(pa.array(texts))
    want = plain_language(rows, texts)
    assert names == [n for n, _ in want] and np.allclose(scores, [s for _, s in want])


# --- decontamination

def plain_marks(text, items, window):
    words, hit, named = decontaminate.words_of(text), set(), set()
    for name, item in items:
        w = decontaminate.words_of(item)
        for i in range(max(len(w) - window, 0) + 1 if w else 0):
            part = w[i: i + window]
            for at in range(len(words) - len(part) + 1):
                if words[at: at + len(part)] == part:
                    hit |= set(range(at, at + len(part)))
                    named.add(str(name))
    return hit, named


@pytest.mark.parametrize(("block", "part", "at_once"), [(40, 12, 2), (15, 5, 1), (10**6, 10**6, 64)])
def test_items_in_many_blocks_and_longer_than_a_block(spark, monkeypatch, block, part, at_once):
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", at_once)
    random.seed(block)
    letters = [f"w{i}" for i in range(6)]
    items = [(k, " ".join(random.choices(letters, k=random.choice([0, 2, 5, 9, 60])))) for k in range(14)] + [(3, "w1 w2 w1 w2 w1 w2"), (3, "w1 w2 w1 w2 w1 w2")]
    docs = [(k, " ".join(random.choices([*letters, "other"], weights=[4] * 6 + [1], k=random.randint(0, 80)))) for k in range(40)]
    bench = spark.createDataFrame(items, "item_id int, text string")
    out = decontaminate.mark_documents(spark.createDataFrame(docs, "doc_id int, text string"), bench, window=5, block_words=block, part_words=part).collect()
    assert len(out) == 40
    for r in out:
        hit, named = plain_marks(r.text, items, 5)
        assert {k for s in r._spans for k in range(s.start, s.end)} == hit and r._items == sorted(named)


# --- chat

def test_equal_turns_are_ordered_by_what_was_said(spark):
    rows = [(1, 0, "user", t, 7, "x") for t in ("<|b", "<a", "\\", "[INST]", "a" * 100_000)]
    turns = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string, n_turns int, formatted string")
    out = chat.format_chats(turns.withColumn("parts", chat.text_part(F.col("text")))).select(chat.parse_chat(F.col("formatted")).alias("t")).first()
    assert [t.text for t in out.t] == sorted(r[3] for r in rows)

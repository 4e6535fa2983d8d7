"""Every pipeline stage against a plain version of its rule, on what its predecessor kept, awkward rows included."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cairn.llm import decontaminate, language, line_dedup, quality

FOLDER = "/root/testdata/sf0.001"
#: columns of the caller that have the names of the operators' own columns
CLASHING = ("_score", "_own", "_doc", "_tid", "_gone", "_dropped", "_away", "_words", "_spans", "_items", "n_lines", "N_Dropped", "id", "bucket",
            "label", "text_id", "quality", "good", "x")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def with_clashes(df):
    return df.select("*", *[F.lit(k).alias(c) for k, c in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    repeated = "a line that very many of the documents in this little table have in common"
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").limit(3).collect()]
    good = [r.text for r in docs.join(spark.read.parquet(f"{FOLDER}/labels.parquet").where("quality = 1"), "doc_id")
            .orderBy("doc_id").limit(12).collect()]
    texts = [None, "", " ", "\n\n", "été ÀÉ ß 😀", " ".join(good * 20), " ".join(good * 20) + " more"]
    texts += [f"{g}\n {repeated.upper() if k % 2 else repeated}\t\n{k}" for k, g in enumerate(good)]
    texts += [f"{good[0]} {items[0]} {good[1]}", f"{items[1]}\n{items[2]}"]
    rows = [(10**6 + k, t, None, "s", None) for k, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, good[3], None, None, None), (None, None, None, None, None)]
    return with_clashes(docs.unionByName(spark.createDataFrame(rows, docs.schema)))


@pytest.fixture(scope="module")
def kept(spark, documents, tmp_path_factory):
    """The rows before the first stage and after each."""
    base, out, docs = tmp_path_factory.mktemp("stages"), [documents.collect()], documents
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        result = stage(spark, docs, FOLDER)
        if k < 4:
            assert result.schema.simpleString() == documents.schema.simpleString()
        result.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append(docs.collect())
    return out


def plain_statistics(texts):
    """The statistics of the classifier, counted text by text."""
    out = []
    for text in texts:
        raw, w = (text or "").encode(), words(text)
        size, n = max(len(raw), 1), len(w)
        count = lambda test: sum(map(test, raw))  # noqa: B023,E731
        upper, digits, marks = count(lambda b: 65 <= b <= 90), count(lambda b: 48 <= b <= 57), count(lambda b: b in b".,;:'?-")
        symbols = count(lambda b: 33 <= b <= 126 and not chr(b).isalnum() and b not in b".,;:'?-")
        lines = raw.count(b"\n")
        repeats = sum(a == b for a, b in zip(w, w[1:]))
        top = max(Counter(b for b in raw if b not in b" \t\n\x0b\x0c\r").values(), default=0)
        most, log = max(n, 1), math.log1p
        out.append([log(n), log((size - lines) / most), *(math.sqrt(c / size) for c in (upper, digits, marks, symbols, count(lambda b: b >= 128))),
                    log(100 * lines / most), log(len(set(w))) / log(most), log(100 * repeats / most), log(symbols) / log(size), log(top) / log(size)])
    return np.array(out).reshape(len(texts), -1)


def test_quality_stage(spark, kept):
    before, after = kept[0], kept[1]
    assert np.allclose(plain_statistics([r.text for r in before]), quality.statistics(pa.array([r.text for r in before], pa.string())))
    labels = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect():
        labels[r.doc_id].append(r.quality)
    learnt = [(r.text, y) for r in before for y in labels[r.doc_id] if y is not None]

    def shares(x):
        n = np.expm1(x[:, :1])
        return middle + (x[:, 1:] - middle) * n / (n + quality.SHORT_WORDS)

    x = plain_statistics([t for t, _ in learnt])
    middle = np.median(x[:, 1:], 0)
    x, y = shares(x), np.array([k == 1 for _, k in learnt])
    centre, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = (shares(plain_statistics([r.text for r in before])) - centre) / scale
    densities = []
    for group in (((x - centre) / scale)[y], ((x - centre) / scale)[~y]):
        spread = 0.9 * np.cov(group.T, bias=True)
        spread += 0.1 * max(np.trace(np.cov(group.T, bias=True)) / len(spread), 1e-3) * np.eye(len(spread))
        far = np.einsum("ij,ij->i", z - group.mean(0), np.linalg.solve(spread, (z - group.mean(0)).T).T)
        densities.append(math.log(len(group) / len(x)) - np.linalg.slogdet(spread)[1] / 2 - far / 2)
    score = 1 / (1 + np.exp(-np.clip(densities[0] - densities[1], -30, 30)))
    want = [tuple(r) for r, s in zip(before, score) if s >= quality.THRESHOLD]
    assert 50 < len(want) < len(before) and sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in after)


def test_line_stage(kept):
    holders = defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(UPPER)
    for r in kept[1]:
        for line in (r.text or "").split("\n"):
            if r.doc_id is not None and len(key(line)) >= 40:
                holders[key(line)].add(r.doc_id)

    def cleaned(r):
        gone = lambda line: r.doc_id is not None and len(holders[key(line)]) >= 5 and max(holders[key(line)]) != r.doc_id
        return "\n".join(line for line in (r.text or "").split("\n") if not gone(line))

    assert sorted(str((r.doc_id, cleaned(r))) for r in kept[1]) == sorted(str((r.doc_id, r.text or "")) for r in kept[2])
    assert any(cleaned(r) != r.text for r in kept[1]) and all(r.n_chars == len(r.text) for r in kept[2] if r.text is not None)
    assert all([r[c] for c in CLASHING] == list(range(len(CLASHING))) for r in kept[2])


def test_jaccard_stage(kept):
    """One row of every class of linked rows stays, one with its smallest doc_id; rows are judged by themselves."""
    rows, sets = kept[2], []
    for r in rows:
        w = words(r.text)
        sets.append({tuple(w[i: i + 5]) for i in range(max(len(w) - 4, 1))} if w and r.doc_id is not None else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and group[i] != group[j] and both >= 0.8 * len(sets[i] | sets[j]):
                group = [group[j] if g == group[i] else g for g in group]
    classes = defaultdict(list)
    for r, g in zip(rows, group):
        classes[g].append(r)
    assert len(classes) < len(rows) and len(kept[3]) == len(classes)
    left = Counter(repr(tuple(r)) for r in kept[3])
    for members in classes.values():
        first = [r for r in members if r.doc_id == min((m.doc_id for m in members if m.doc_id is not None), default=None)]
        stays = next(k for k in (repr(tuple(r)) for r in first) if left[k])
        left[stays] -= 1
    assert not +left


def test_decontamination_stage(spark, kept):
    windows = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r.text)
        windows |= {tuple(w[i: i + 10]) for i in range(max(len(w) - 9, 1))} if w else set()
    want, cut = [], 0
    for r in kept[3]:
        w, hit = words(r.text), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i: i + n]) in windows:
                    hit |= set(range(i, i + n))
        cut += 0 < len(hit) <= len(w) / 2
        if 2 * len(hit) <= len(w):
            want.append((r.doc_id, [x for i, x in enumerate(w) if i not in hit], None if hit else r.text))
    got = sorted(((r.doc_id, words(r.text), r.text) for r in kept[4]), key=str)
    texts = {(d, tuple(w)): t for d, w, t in want}
    assert cut and sorted(str(r[:2]) for r in want) == sorted(str(r[:2]) for r in got)
    assert all(texts[d, tuple(w)] in (None, t) for d, w, t in got)


def test_packing_stage(kept):
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, places, total = [], defaultdict(list), 0
    for r in kept[4]:
        ids = [*tokens.encode(r.text or "", add_special_tokens=False).ids, 2]
        total += len(ids)
        start = 0
        while start < len(ids):
            n = (len(ids) - start) % 1024 or 1024
            want.append((r.doc_id, start, n, zlib.crc32(np.array(ids[start: start + n], "<u4").tobytes())))
            start += n
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.start, r.length, r.ids_crc32)) for r in kept[5])
    for r in kept[5]:
        places[r.sequence_id].append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert [o for o, _ in spans] == [0, *np.cumsum([n for _, n in spans])[:-1].tolist()] and sum(n for _, n in spans) <= 1024
    assert len(places) <= math.ceil(total / 1024) * 1.05 + 2


def test_columns_of_the_outputs_names_are_replaced(spark):
    docs = spark.createDataFrame([(1, "some words", 0, 0, 0, 0, 0, 0)],
                                 "doc_id int, text string, n_lines int, quality_score int, lang_pred int, _words int, _spans int, _items int")
    bench = spark.createDataFrame([(1, "words")], "item_id int, text string")
    assert line_dedup.drop_lines(docs).first().n_lines == 1
    model = quality.fit_quality(docs, spark.createDataFrame([(1, 1)], "doc_id int, quality int"), None)
    assert quality.score_quality(docs, model).first().quality_score == 1.0
    assert language.predict_language(docs, language.fit_languages(docs.withColumn("lang", F.lit("en")))).first().lang_pred == "en"
    row = decontaminate.mark_documents(docs, bench).first()
    assert (row._words, row._items) == (2, ["1"])
    assert decontaminate.remove_hits(docs, bench).first().asDict()["_words"] == 0

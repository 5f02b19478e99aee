"""Importance resampling against a plain version, and the bracket on scores that tie."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import corpus, words
from tonewright.llm import gram_hash, importance
from tonewright.llm.queries import op12_importance


def words_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def checksums(text):
    w = words_of(text)
    return [zlib.crc32(" ".join(w[i : i + n]).encode()) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


ODD = ["", "a", "A b", "Été çà 12 x" * 3, "x" * 200 + " yy " + "z" * 50, "  a  b, c d!", "日本語 🎉 a", "a\x00b\x7fc", "ÀÉ e´"]


def long_words(seed):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abAZ09é-_.") for _ in range(draw.choice([1, 3, 8, 70, 130]))) for _ in range(30))


@pytest.mark.parametrize("block", [4 << 20, 50])
def test_features(monkeypatch, block):
    monkeypatch.setattr(importance, "BLOCK", block)
    texts = ODD + [long_words(i) for i in range(40)] + [t for _, t, _ in corpus() if t][:30]
    got = [[0, []] for _ in texts]
    for begin, some in importance.blocks([t.encode() for t in texts]):
        for n_words, runs in importance.features(some):
            for i, n in enumerate(n_words.tolist()):
                got[begin + i][0] += n
            for text, crc in runs:
                for i, c in zip(text.tolist(), crc.tolist(), strict=True):
                    got[begin + i][1].append(c)
    assert [(n, sorted(c)) for n, c in got] == [(len(words_of(t)), sorted(checksums(t))) for t in texts]


def test_moves_of_any_length():
    import numpy as np

    a, b = b"some words", [b"x" * n for n in (0, 1, 63, 64, 65, 1000, 70001)]
    moved = gram_hash.moved(np.full(len(b), zlib.crc32(a), np.uint32), np.array([len(x) for x in b]))
    assert [int(m) ^ zlib.crc32(x) for m, x in zip(moved, b, strict=True)] == [zlib.crc32(a + x) for x in b]


def by_hand(rows, target, buckets=10_000, seed=42, share=(5, 100), least=20):
    s = Counter(c % buckets for _, t in rows for c in checksums(t))
    t = Counter(c % buckets for x in target for c in checksums(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
        for b in range(buckets)
    ]
    out = []
    for d, text in rows:
        found = checksums(text)
        weight = sum(gain[c % buckets] for c in found)
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([d, len(found), weight, score, None, len(words_of(text))])
    drawn = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for rank, r in enumerate(drawn[: share[0] * len(drawn) // share[1]], 1):
        r[4] = rank
    return sorted(tuple(map(repr, r[:5])) for r in out)


def compared(frame):
    return sorted(tuple(map(repr, r)) for r in frame.select("doc_id", "n_features", "weight", "score", "rank").collect())


TARGET = [" ".join(words(1, 50)), None, "", " ".join(words(2, 30))]


@pytest.mark.parametrize("share", [(5, 100), (50, 100), (1, 1), (0, 1)])
def test_resampling(spark, docs, share):
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = importance.resample(docs, target, drawn_of=share)
    assert compared(got) == by_hand([(d, t) for d, t, _ in corpus()], TARGET, share=share)


def test_equal_rows_at_the_cutoff(spark):
    """A third of the rows are one row; as many of them are drawn as there is room for."""
    text = " ".join(words(3, 40))
    rows = [(7, text)] * 60 + [(i, " ".join(words(40 + i, 30))) for i in range(100, 220)] + [(None, text)] * 5
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    target = spark.createDataFrame([(text,)], "text string")
    for share in ((5, 100), (20, 100), (30, 100), (60, 100)):
        assert compared(importance.resample(frame, target, drawn_of=share)) == by_hand(rows, [text], share=share)


@pytest.mark.parametrize("accuracy", [2, 5, 10_000])
def test_bracket_holds_the_cutoff(spark, accuracy):
    """Also when the sketch is useless and the bracket has to be widened."""
    draw = random.Random(5)
    scores = [draw.choice([draw.randrange(-50, 50), 3]) for _ in range(3000)]
    frame = spark.createDataFrame([(s,) for s in scores], "score bigint")
    for drawn in (1, 2, 150, 1499, 2999, 3000):
        low, high, above = importance.bracket(frame, drawn, len(scores), accuracy)
        assert above == sum(s > high for s in scores)
        assert above < drawn <= above + sum(low <= s <= high for s in scores)


def test_places(spark):
    rows = [(i % 7, None if i % 5 == 0 else i % 11, i) for i in range(1000)]
    frame = spark.createDataFrame(rows, "score bigint, doc_id bigint, row bigint").repartition(6)
    got = sorted((r.place, (r.score, r.doc_id, r.row)) for r in importance.placed(frame).collect())
    want = sorted(rows, key=lambda r: (-r[0], r[1] is not None, r[1] or 0, r[2]))
    assert got == list(enumerate(want, 1))


def test_nothing(spark, no_docs, docs):
    target = spark.createDataFrame([], "text string")
    assert importance.resample(no_docs, target).count() == 0
    assert compared(importance.resample(docs, target)) == by_hand([(d, t) for d, t, _ in corpus()], [])


def test_query(spark, small_tables):
    got = op12_importance(spark, small_tables)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    target = [r.text for r in spark.read.parquet(f"{small_tables}/benchmark.parquet").collect()]
    assert compared(got) == by_hand([(d, t) for d, t, _ in corpus()], target)
    assert got.where(F.col("rank").isNotNull()).count() > 0

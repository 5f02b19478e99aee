"""Runs against a search of all periods, and the grammar by deriving it."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import corpus
from tonewright.llm import periodic_runs, repair
from tonewright.llm.queries import op13_periodic_runs


def by_hand(w):
    best = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                best.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))


def periodic_texts(seed, n=150):
    draw, texts = random.Random(seed), []
    for _ in range(n):
        k, w = draw.choice([1, 2, 2, 3, 5, 20]), []
        while len(w) < draw.choice([5, 20, 60, 150]):
            kind = draw.random()
            if kind < 0.4:
                w += [str(draw.randrange(k)) for _ in range(draw.randint(1, 15))]
            elif kind < 0.8:
                u = [str(draw.randrange(k)) for _ in range(draw.randint(1, 9))]
                w += u * draw.randint(2, 8) + u[: draw.randint(0, len(u))]
            elif w:
                s = draw.randrange(len(w))
                w += w[s : s + draw.randint(1, 40)]
        texts.append(" ".join(w).encode())
    fib = ["a", "b"]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])
    thue = "0"
    while len(thue) < 4096:
        thue += thue.translate(str.maketrans("01", "10"))
    return texts + [b"", b" \n", b"a", b"a " * 12, b"a " * 11, b"a b " * 6, b"x " * 500, " ".join(fib[-1]).encode(), " ".join(thue[:700]).encode()]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("at_once", [1 << 20, 100])
def test_runs(monkeypatch, seed, at_once):
    monkeypatch.setattr(periodic_runs, "_AT_ONCE", at_once)
    texts = periodic_texts(seed)
    assert periodic_runs.find(texts) == [by_hand(t.split()) for t in texts]


def test_long_thue_morse_words():
    """Its halves have equal hashes of this kind; results don't rest on hashes."""
    thue = "0"
    while len(thue) < 8192:
        thue += thue.translate(str.maketrans("01", "10"))
    text = (" ".join(thue) + " x y" * 10).encode()
    assert periodic_runs.find([text]) == [by_hand(text.split())]


def test_hashes_that_lie(monkeypatch):
    class Lying(periodic_runs.Equality):
        def reach(self, at, period, limit, back):
            true = super().reach(at, period, limit, back)
            return np.where((true > 2) & (at % 3 == 0), limit, true)

    texts = periodic_texts(3)
    monkeypatch.setattr(periodic_runs, "Equality", Lying)
    assert periodic_runs.find(texts) == [by_hand(t.split()) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=80))
def test_grammar_derives_the_sequence(sequence):
    rules, rest = repair.compress(sequence, 4)

    def derived(x):
        return [x] if x < 4 else derived(rules[x - 4][0]) + derived(rules[x - 4][1])

    assert [w for x in rest for w in derived(x)] == sequence
    pairs = list(zip(rest, rest[1:], strict=False))
    assert all(pairs.count(p) < 2 or p[0] == p[1] for p in pairs)


def test_most_frequent_pair_goes_first():
    rules, rest = repair.compress([1, 2, 1, 2, 3, 0, 3, 0, 1, 2], 4)
    assert rules[:2] == [(1, 2), (3, 0)] and rest[-1] == 4


def planted(d, text):
    h, w = zlib.crc32(b"" if d is None else str(d).encode()), (text or "").encode().split()
    g, n = h // 10, len(w)
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(d, text):
    w = planted(d, text)
    runs, dropped = by_hand(w), set()
    for s, n, q in runs:
        dropped |= set(range(s + q, s + n))
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    kept = b" ".join(x for i, x in enumerate(w) if i not in dropped)
    return (d, len(runs), *shown, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query(spark, periodic_tables):
    tables, rows = periodic_tables
    got = op13_periodic_runs(spark, tables)
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256"
    assert got.columns == names.split()
    want = [expected(d, t) for d, t in rows]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    assert sum(1 for r in want if r[1]) > 20


@pytest.fixture(scope="module")
def periodic_tables(spark, tmp_path_factory):
    """The corpus without its longest text (the search by hand is quadratic), and periodic texts."""
    rows = [(d, t) for d, t, _ in corpus() if len(t or "") < 20_000]
    rows += [(1000 + i, t.decode()) for i, t in enumerate(periodic_texts(4, 60))]
    rows += [(2000 + i, rows[i][1]) for i in range(60)]
    folder = str(tmp_path_factory.mktemp("periodic"))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    frame.repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def test_operator_with_other_columns(docs, no_docs):
    got = periodic_runs.find_runs(docs)
    assert got.columns == ["doc_id", "runs", "collapsed"]
    one = {r.doc_id: r for r in got.where("doc_id in (122, 123, 124, 133)").collect()}
    assert all(one[d].runs == [] and bytes(one[d].collapsed) == b"" for d in (122, 123, 124))
    assert [tuple(r) for r in one[133].runs] == [(0, 200, 5)]
    assert bytes(one[133].collapsed) == b"| | ** && ##"
    assert periodic_runs.find_runs(no_docs).count() == 0

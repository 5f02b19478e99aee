"""Forests and boosting against plain versions that look at every document and split."""

import hashlib
import math
import random

import pytest
from pyspark.sql import functions as F

from tonewright.operators import trees

DEPTH = 4


def documents(seed, n=60, size=25):
    draw = random.Random(seed)
    out = []
    for d in range(n):
        terms = draw.sample(range(size), draw.randint(0, 8))
        label = float((3 in terms or draw.random() < 0.2) and 7 not in terms)
        out.append((d, label, {f"t{t}": draw.choice([0.05, 0.2, 0.31, 0.6, 1.0]) for t in terms}))
    return out


def frame(spark, rows):
    flat = [(d, y, sorted(x.items())) for d, y, x in rows]
    schema = "doc_id bigint, label double, entries array<struct<term: string, w: double>>"
    return spark.createDataFrame(flat, schema).repartition(3)


def bin_of(w):
    return 31 - min(30, max(0, math.floor(-4 * math.log2(w) + 0.137)))


def best_split(rows, allowed, scale):
    """(term, bin) of the best split of rows (bins, n, s), or None."""
    all_n, all_s = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = None
    for term in sorted({t for x, _, _ in rows for t in x if allowed(t)}):
        for b in sorted({x[term] for x, _, _ in rows if term in x}):
            n = sum(m for x, m, _ in rows if x.get(term, 0) >= b)
            s = sum(v for x, _, v in rows if x.get(term, 0) >= b)
            if not 0 < n < all_n:
                continue
            q = lambda s, n: (s / scale) * (s / scale) / n
            gain = math.floor((q(all_s - s, all_n - n) + q(s, n) - q(all_s, all_n)) * 1e6)
            if gain > 0 and (best is None or gain > best[0]):
                best = (gain, term, b)
    return best and best[1:]


def grow(rows, allowed, scale, node=0, level=0):
    """Nodes {number: (term, bin, n, s)} of a tree on rows (bins, n, s)."""
    split = best_split(rows, lambda t: allowed(node, t), scale) if level < DEPTH else None
    total = (sum(r[1] for r in rows), sum(r[2] for r in rows))
    out = {node: (*(split or (None, None)), *total)}
    if split:
        goes = lambda x: x.get(split[0], 0) >= split[1]
        out |= grow([r for r in rows if not goes(r[0])], allowed, scale, 2 * node + 1, level + 1)
        out |= grow([r for r in rows if goes(r[0])], allowed, scale, 2 * node + 2, level + 1)
    return out


def walk(tree, x):
    at = 0
    while tree[at][0] is not None:
        at = 2 * at + 1 + (x.get(tree[at][0], 0) >= tree[at][1])
    return tree[at]


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def forest_by_hand(rows, features, n_trees, seed):
    bounds, total = [], 0.0
    for k in range(8):
        total += math.exp(-1) / math.factorial(k)
        bounds.append(math.floor(total * 2**32))
    below = 2147483647 * math.ceil(math.sqrt(features)) // features
    out = []
    for t in range(n_trees):
        def allowed(node, term, t=t):
            h = md5(f"{seed}:{t}:{node}")
            a, b = 1 + int(h[:7], 16), int(h[7:14], 16)
            return n_trees == 1 or (a * int(md5(term)[:7], 16) + b) % 2147483647 < below

        sample = []
        for d, y, x in rows:
            u = int(md5(f"{seed}:{t}:{d}")[:8], 16)
            n = sum(u >= b for b in bounds) if n_trees > 1 else 1
            if n:
                sample.append(({k: bin_of(w) for k, w in x.items()}, n, n * int(y)))
        out.append(grow(sample, allowed, 1.0))
    return out


def boosting_by_hand(rows, rounds, rate=0.1):
    margins, out = [0.0] * len(rows), []
    bins = [{k: bin_of(w) for k, w in x.items()} for _, _, x in rows]
    for k in range(rounds):
        sample = []
        for (_, y, _), x, m in zip(rows, bins, margins, strict=True):
            sign = 2 * y - 1
            r = 4 * sign / (1 + math.exp(2 * sign * m)) if k else sign
            sample.append((x, 1, math.floor(r * 1e6 + 0.5)))
        tree = grow(sample, lambda node, t: True, 1e6)
        out.append(tree)
        for i, x in enumerate(bins):
            _, _, n, s = walk(tree, x)
            margins[i] += (rate if k else 1.0) * (s / 1_000_000 / n)
    return out, margins


def table(model, rows):
    got = {}
    for r in trees.tree_table(model, rows).collect():
        got.setdefault(r["tree"], {})[r["node"]] = (r["term"], r["bin"], r["n"], r["s"])
    return [got[t] for t in sorted(got)]


@pytest.mark.parametrize("n_trees, features", [(1, 25), (3, 25), (8, 4)])
def test_forest(spark, n_trees, features):
    rows = documents(n_trees)
    weighted = frame(spark, rows)
    model = trees.fit_forest(weighted, features, n_trees, DEPTH, seed=5)
    want = forest_by_hand(rows, features, n_trees, 5)
    assert table(model, weighted) == want
    assert any(len(t) > 3 for t in want)
    got = {r["doc_id"]: r for r in trees.predict_trees(weighted, model).collect()}
    for d, _, x in rows:
        bins = {k: bin_of(w) for k, w in x.items()}
        votes = sum(2 * leaf[3] > leaf[2] for leaf in (walk(t, bins) for t in want))
        assert got[d]["score"] == votes and got[d]["prediction"] == int(votes > n_trees / 2)


def test_all_rounds_of_boosting(spark):
    rows = documents(11, n=40, size=12)
    weighted = frame(spark, rows)
    model = trees.fit_boosting(weighted, iterations=30)
    want, margins = boosting_by_hand(rows, 30)
    assert table(model, weighted) == want and len(want) == 30
    got = {r["doc_id"]: r for r in trees.predict_trees(weighted, model).collect()}
    for (d, _, _), m in zip(rows, margins, strict=True):
        assert got[d]["score"] == pytest.approx(m, abs=1e-12)
        assert got[d]["prediction"] == int(m > 0)


def test_boosting_by_terms_is_one_job_a_level(spark, monkeypatch):
    """Small blocks, documents without a label: the same trees as by rows, and no sums are exchanged."""
    rows = documents(5, n=60, size=12)
    rows += [(100 + i, None, x) for i, (_, _, x) in enumerate(rows[:6])]
    weighted = frame(spark, rows).repartition(3)
    by_rows = trees.fit_boosting(weighted, iterations=4, limit=0)
    counted = []
    monkeypatch.setattr(trees, "_best_splits", lambda *a: counted.append(a) or [])
    monkeypatch.setattr(trees, "BLOCK_ROWS", 7)
    by_terms = trees.fit_boosting(weighted, iterations=4)
    assert table(by_terms, weighted) == table(by_rows, weighted)
    assert not counted and any(len(t.nodes) > 3 for t in by_terms.trees)


def test_a_forest_in_blocks(spark, monkeypatch):
    """Copies are drawn once, not once a level, and a level isn't walked in expressions."""
    rows = documents(4, n=50)
    rows += [(100 + i, None, x) for i, (_, _, x) in enumerate(rows[:6])]
    weighted = frame(spark, rows).repartition(3)
    drawn = []
    monkeypatch.setattr(trees, "BLOCK_ROWS", 9)
    draw = trees.copies
    monkeypatch.setattr(trees, "copies", lambda *a: drawn.append(a) or draw(*a))
    monkeypatch.setattr(trees, "_literal", None)
    blocked = trees.fit_forest(weighted, 20, 5, DEPTH)
    assert len(drawn) == 1
    monkeypatch.setattr(trees, "BLOCK_ROWS", 1 << 20)
    assert table(blocked, weighted) == table(trees.fit_forest(weighted, 20, 5, DEPTH), weighted)


def test_equal_splits_go_by_term(spark):
    rows = [(i, float(i % 2), {"b": 0.5, "a": 0.5} if i % 2 else {}) for i in range(10)]
    model = trees.fit_boosting(frame(spark, rows), iterations=1, depth=1)
    assert model.trees[0].nodes[0].term == "a"


def test_documents_without_terms_and_single_classes(spark):
    empty = frame(spark, [(1, 1.0, {}), (2, 0.0, {})])
    one_class = frame(spark, [(i, 1.0, {"a": 0.3}) for i in range(5)])
    for weighted in (empty, one_class, empty.limit(0)):
        for model in (trees.fit_forest(weighted, 3), trees.fit_boosting(weighted, iterations=2)):
            assert all(x.term is None for t in model.trees for x in t.nodes.values())
            assert trees.predict_trees(weighted, model).count() == weighted.count()
    model = trees.fit_boosting(one_class, iterations=2)
    assert {r["prediction"] for r in trees.predict_trees(empty, model).collect()} == {1}
    assert trees.predict_trees(empty, model, drop_empty=True).count() == 0


def test_bins():
    assert [bin_of(w) for w in (1.0, 0.5, 0.25, 1e-9)] == [31, 27, 23, 1]


def test_levels_move_counts_and_no_documents(spark, monkeypatch):
    """What is exchanged in a level are sums by tree, node, term and bin."""
    plans = []
    best = trees._best_splits

    def seen(counted, *rest):
        plans.append(counted._jdf.queryExecution().executedPlan().toString())
        return best(counted, *rest)

    monkeypatch.setattr(trees, "_best_splits", seen)
    trees.fit_forest(frame(spark, documents(3)), 25)
    assert plans and all(p.count("Exchange hashpartitioning") == 1 for p in plans)
    assert all("partial_sum" in p and "Join" not in p and "ArrowEval" not in p for p in plans)


def test_weight_bin_column(spark):
    weights = [1.0, 0.5, 0.333, 0.1, 0.01, 1e-9, 2**-0.5]
    rows = spark.createDataFrame([(w,) for w in weights], "w double")
    got = rows.select("w", trees.weight_bin(F.col("w")).alias("b")).collect()
    assert all(r["b"] == bin_of(r["w"]) for r in got)

import math
import os
import time
from collections import Counter

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.mllib.classification import LogisticRegressionWithSGD, SVMWithSGD
from pyspark.mllib.linalg import SparseVector
from pyspark.mllib.regression import LabeledPoint
from pyspark.sql import functions as F

from tonewright.functions import text
from tonewright.operators import (
    blocks,
    bayes,
    collocation,
    committee,
    estimators,
    evaluate,
    linear,
    sampling,
    scoring,
    split,
    tfidf,
    vectors,
)
from tonewright.operators.term_table import TermTable
from tonewright.plans import train_predict
from tonewright.sources import files, tables, workspace


@pytest.fixture(scope="module")
def fitted(corpus):
    vocabulary, weighted = tfidf.fit_transform(corpus)
    return vocabulary, weighted.persist()


def brute_weights(corpus):
    docs = {
        r["doc_id"]: Counter(r["t"])
        for r in corpus.select("doc_id", text.unigrams(F.col("text")).alias("t")).collect()
    }
    df = Counter(t for c in docs.values() for t in c)
    idf = {t: math.log((1 + len(docs)) / (1 + n)) + 1 for t, n in df.items()}
    weights = {}
    for d, c in docs.items():
        raw = {t: n * idf[t] for t, n in c.items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        weights[d] = {t: x / norm for t, x in raw.items()}
    return weights


def as_dict(weighted):
    return {
        r["doc_id"]: {e["term"]: e["w"] for e in r["entries"]} for r in weighted.collect()
    }


def test_weights_equal_brute_force(corpus, fitted):
    got, expected = as_dict(fitted[1]), brute_weights(corpus)
    assert got.keys() == expected.keys()
    for d in got:
        assert got[d] == pytest.approx(expected[d])
    for entries in got.values():
        if entries:
            assert sum(x * x for x in entries.values()) == pytest.approx(1)


@pytest.fixture
def shuffled(spark):
    """No join becomes a broadcast unless it is asked for."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_shuffle_join_gives_the_same_as_broadcast(corpus, fitted, monkeypatch, shuffled):
    vocabulary, _ = fitted
    monkeypatch.setattr("tonewright.operators.term_table.HOT_SHARE", 20)
    rows = tfidf.explode_counts(tfidf.count_terms(corpus), outer=True)
    key = lambda r: (r["doc_id"], r["term"] or "")
    expected = sorted(vocabulary.table.attach(rows).collect(), key=key)
    for fitted_rows in (False, True):
        narrow = vocabulary.table.attach(rows, limit=0, fitted=fitted_rows)
        assert "SortMergeJoin [term" in plan_of(narrow)
        assert [r.asDict() for r in sorted(narrow.collect(), key=key)] == [
            r.asDict() for r in expected
        ]


def test_scores_by_shuffle_equal_scores_by_broadcast(corpus, fitted, monkeypatch, shuffled):
    vocabulary, weighted = fitted
    counted = tfidf.count_terms(corpus)
    model = bayes.fit_naive_bayes(weighted, vocabulary)
    results = []
    for limit in (1 << 30, 0):
        attach = TermTable.attach
        monkeypatch.setattr(TermTable, "attach", lambda *a, _f=attach, _n=limit, **b: _f(*a, **b | {"limit": _n}))
        scored = bayes.predict_counts(counted, model)
        weighed = tfidf.weigh(counted, vocabulary)
        assert ("SortMergeJoin [term" in plan_of(scored)) == (limit == 0)
        results.append(
            (
                {r["doc_id"]: (r["prediction"], round(r["score0"], 9)) for r in scored.collect()},
                {d: {t: round(x, 9) for t, x in e.items()} for d, e in as_dict(weighed).items()},
            )
        )
        monkeypatch.undo()
    assert results[0] == results[1]


def test_a_term_that_only_the_scored_rows_have_is_spread(spark, fitted, monkeypatch, shuffled):
    vocabulary, _ = fitted
    monkeypatch.setattr("tonewright.operators.term_table.HOT_SHARE", 10)
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("strange").alias("term"))
    seen = {}
    joined = type(rows).join

    def watched(self, other, on=None, how=None):
        if on == ["term", "salt"]:
            seen["salts"] = self.select("term", "salt").distinct().count()
        return joined(self, other, on, how)

    monkeypatch.setattr(type(rows), "join", watched)
    got = vocabulary.table.attach(rows, limit=0)
    assert seen["salts"] >= 10
    assert got.count() == 1000 and got.where("idf IS NOT NULL").count() == 0


def test_unseen_terms_are_dropped_before_the_length(spark, fitted):
    vocabulary, _ = fitted
    other = spark.createDataFrame([(1, "good zebra"), (2, "zebra")], "doc_id bigint, text string")
    got = as_dict(tfidf.transform(other, vocabulary))
    assert got[1] == pytest.approx({"good": 1.0}) and got[2] == {}


def test_naive_bayes_equals_the_library(fitted):
    vocabulary, weighted = fitted
    model = bayes.fit_naive_bayes(weighted, vocabulary)
    index = vectors.index_terms(vocabulary)
    assert [r["term"] for r in index.frame.orderBy("idx").collect()] == sorted(
        r["term"] for r in vocabulary.terms.collect()
    )
    stored = vectors.to_vectors(weighted, index)
    library = NaiveBayes(smoothing=1.0).fit(stored)
    assert list(library.pi) == pytest.approx(list(model.pi))
    theta = {r["term"]: (r["theta0"], r["theta1"]) for r in model.table.frame.collect()}
    for r in index.frame.collect():
        for c in (0, 1):
            assert library.theta[c, r["idx"]] == pytest.approx(theta[r["term"]][c])
    ours = {r["doc_id"]: r["prediction"] for r in bayes.predict(weighted, model).collect()}
    theirs = {r["doc_id"]: r["prediction"] for r in estimators.predict(library, stored).collect()}
    assert ours == theirs


def test_counts_score_like_weights_and_empty_documents_can_be_dropped(corpus, fitted):
    vocabulary, weighted = fitted
    model = bayes.fit_naive_bayes(weighted, vocabulary)
    counted = tfidf.count_terms(corpus)
    by_weight = {r["doc_id"]: r for r in bayes.predict(weighted, model).collect()}
    by_count = {r["doc_id"]: r for r in bayes.predict_counts(counted, model).collect()}
    for d, r in by_weight.items():
        assert by_count[d]["score1"] == pytest.approx(r["score1"])
    kept = bayes.predict_counts(counted, model, drop_empty=True)
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 7}


def brute_descent(weights, labels, loss, steps):
    coef = Counter()
    for k in range(1, steps + 1):
        gradient = Counter()
        for d, x in weights.items():
            margin = sum(w * coef[t] for t, w in x.items())
            sign = 2 * labels[d] - 1
            if loss == "hinge":
                r = -sign if margin * sign < 1 else 0.0
            else:
                r = 1 / (1 + math.exp(-margin)) - labels[d]
            for t, w in x.items():
                gradient[t] += r * w / len(weights)
        rate = 1 / math.sqrt(k)
        coef = Counter({t: coef[t] * (1 - rate * 0.01) - rate * g for t, g in gradient.items()})
    return coef


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_gradient_descent(corpus, fitted, loss):
    labels = {r["doc_id"]: r["label"] for r in corpus.collect()}
    model = linear.fit_gradient_descent(fitted[1], loss, iterations=4)
    got = {r["term"]: r["coef"] for r in model.table.frame.collect()}
    expected = brute_descent(brute_weights(corpus), labels, loss, 4)
    assert model.steps == 4 and got == pytest.approx(dict(expected))


@pytest.mark.parametrize(
    "loss, library", [("hinge", SVMWithSGD), ("logistic", LogisticRegressionWithSGD)]
)
def test_gradient_descent_equals_the_library(spark, corpus, fitted, loss, library):
    vocabulary, weighted = fitted
    index = {r["term"]: r["idx"] for r in vectors.index_terms(vocabulary).frame.collect()}
    labels = {r["doc_id"]: r["label"] for r in corpus.collect()}
    points = [
        LabeledPoint(labels[d], SparseVector(len(index), {index[t]: w for t, w in x.items()}))
        for d, x in as_dict(weighted).items()
    ]
    rdd = spark.sparkContext.parallelize(points, 2)
    expected = library.train(rdd, iterations=6, step=1.0, regParam=0.01, intercept=False)
    model = linear.fit_gradient_descent(weighted, loss, iterations=6)
    for r in model.table.frame.collect():
        assert r["coef"] == pytest.approx(expected.weights[index[r["term"]]], abs=1e-12)


def above(plan: str, scan: str) -> list[str]:
    """Operators of a plan from its root down to the scan whose line holds ``scan``."""
    path: list[tuple[int, str]] = []
    for line in plan.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
        path = [p for p in path if p[0] < depth] + [(depth, line.strip())]
        if scan in line:
            return [name for _, name in path]
    raise AssertionError(f"{scan} isn't in the plan")


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_descent_in_document_blocks(spark, corpus, fitted, loss, monkeypatch):
    """Beyond the limit the corpus isn't moved again: nothing is exchanged between its scan and the
    partial sums of the gradient."""
    plans = []
    store = blocks.DocumentBlocks.store

    def seen(self, coefficients):
        plans.append(coefficients._jdf.queryExecution().executedPlan().toString())
        return store(self, coefficients)

    monkeypatch.setattr(blocks.DocumentBlocks, "store", seen)
    monkeypatch.setattr(blocks.DocumentBlocks, "ROWS", 5)
    labels = {r["doc_id"]: r["label"] for r in corpus.collect()}
    tables = {t.name for t in spark.catalog.listTables()}
    model = linear.fit_gradient_descent(fitted[1], loss, iterations=4, limit=0)
    got = {r["term"]: r["coef"] for r in model.table.frame.collect()}
    assert model.steps == 4
    assert got == pytest.approx(dict(brute_descent(brute_weights(corpus), labels, loss, 4)))
    assert {t.name for t in spark.catalog.listTables()} == tables
    assert len(plans) == 4
    for plan in plans[1:]:
        path = above(plan, "block_rows")
        assert sum("SortMergeJoin" in p for p in path) == 1 and "Broadcast" not in plan
        exchanges = [i for i, p in enumerate(path) if "Exchange" in p]
        partial = next(i for i, p in enumerate(path) if "partial_" in p)
        assert len(exchanges) == 1 and exchanges[0] < partial, "\n".join(path)
        assert not any("Exchange" in p for p in above(plan, "block_terms")[-3:])


def test_descent_writes_no_table_for_a_step(fitted, monkeypatch):
    """Steps are jobs on packed rows: what is written doesn't depend on their number."""
    names = []
    write = linear.materialize
    monkeypatch.setattr(linear, "materialize", lambda f, name, *a, **b: names.append(name) or write(f, name, *a, **b))
    model = linear.fit_gradient_descent(fitted[1], "hinge", iterations=6, tolerance=0.0)
    assert model.steps == 6 and len(names) == 3


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_descent_on_packed_rows_equals_joins(spark, loss, monkeypatch):
    """Labels that are NULL, ids that repeat with other labels, ids that are text or NULL, small blocks."""
    rows = [
        ("a", 1.0, {"x": 0.6, "y": 0.8}),
        ("a", 0.0, {"y": 1.0}),
        ("b", None, {"x": 0.8, "z": 0.6}),
        ("c", 0.0, {"x": 1.0}),
        ("d", None, {}),
        (None, 1.0, {"u": 0.6, "x": 0.8}),
    ]
    rows = [(d, y, list(x.items())) for d, y, x in rows]
    weighted = spark.createDataFrame(
        rows, "doc_id string, label double, entries array<struct<term: string, w: double>>"
    )
    monkeypatch.setattr(linear, "BLOCK_ROWS", 2)
    monkeypatch.setattr(linear, "RANGE", 3)
    tables = [
        {r["term"]: (r["df"], r["coef"]) for r in model.table.frame.collect()}
        for model in (
            linear.fit_gradient_descent(weighted, loss, 5, tolerance=0.0),
            linear.fit_gradient_descent(weighted, loss, 5, tolerance=0.0, limit=0),
        )
    ]
    assert tables[0].keys() == tables[1].keys() and len(tables[0]) == 4
    for term, (df, coef) in tables[1].items():
        assert tables[0][term][0] == df
        assert tables[0][term][1] == (None if coef is None else pytest.approx(coef, abs=1e-12))


def test_scopes_belong_to_their_thread(spark):
    """A table written in one thread isn't deleted by the end of another's scope."""
    import threading

    inside, ended, kept = threading.Event(), threading.Event(), []

    def other():
        inside.wait(30)
        kept.append(workspace.materialize(spark.range(2).toDF("x"), "other"))
        ended.set()

    thread = threading.Thread(target=other)
    thread.start()
    with workspace.temporary(spark):
        inside.set()
        ended.wait(60)
    thread.join()
    assert kept[0].count() == 2


def test_gradient_descent_stops_when_settled(fitted):
    model = linear.fit_gradient_descent(fitted[1], "logistic", iterations=9, tolerance=10.0)
    assert model.steps == 2


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def soon(holds, seconds=20):
    """Whether something holds before long; Spark deletes files in the background."""
    until = time.time() + seconds
    while not holds() and time.time() < until:
        time.sleep(0.2)
    return holds()


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, conf = shuffle_files(spark), spark.conf.get(workspace._CLEANUP, None)
    sums = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("s"))
    written = workspace.materialize(sums.repartition(3, "s"), "sums")
    assert soon(lambda: shuffle_files(spark) <= before)
    assert written.count() == 7 and spark.conf.get(workspace._CLEANUP, None) == conf


@pytest.mark.parametrize("loss", ["hinge", "logistic"])
def test_a_descent_leaves_its_model_only(spark, fitted, loss, monkeypatch):
    """The tables it was made of go, and a step leaves no shuffle files behind."""
    fitted[1].count()
    folder = workspace.shared_folder(spark)
    kept, gradient, left = set(os.listdir(folder)), linear._gradient, []

    def seen(packed, coef, loss):
        before = shuffle_files(spark)
        found = gradient(packed, coef, loss)
        if packed.is_cached and coef.any():  # the first step makes the blocks as well
            left.append(soon(lambda: shuffle_files(spark) <= before))
        return found

    monkeypatch.setattr(linear, "_gradient", seen)
    linear.fit_gradient_descent(fitted[1], loss, iterations=3, tolerance=0.0)
    assert left == [True, True]
    tables_left = [x.rsplit("-", 1)[0] for x in set(os.listdir(folder)) - kept]
    assert tables_left == [f"{loss}-3"]


@pytest.mark.parametrize("classifier", ["svm", "logistic"])
def test_linear_predictions_shuffle_no_entries(spark, corpus, classifier):
    """The same as from weighted rows, also for repeated and empty documents and unknown terms; what is
    exchanged are sums of documents."""
    new = [(11, "good dull words"), (11, "good dull words"), (11, "bad"), (12, ""), (None, "moving story"), (13, "xyz")]
    unlabeled = spark.createDataFrame(new, "doc_id bigint, text string")
    corpus = train_predict.prepare(corpus, unlabeled)
    got = train_predict.train_and_predict(corpus, classifier, iterations=3)
    loss = "hinge" if classifier == "svm" else "logistic"
    weighed = tfidf.weigh(corpus.unlabeled, corpus.vocabulary)
    expected = linear.predict_linear(weighed, linear.fit_gradient_descent(corpus.weighted, loss, 3))
    rows = [{r["doc_id"]: (r["margin"], r["prediction"]) for r in x.collect()} for x in (got, expected)]
    assert rows[0].keys() == {11, 12, 13, None} and got.columns == expected.columns
    for doc, (margin, prediction) in rows[1].items():
        assert rows[0][doc] == (pytest.approx(margin, abs=1e-12), prediction)
    assert "collect_list" not in got._jdf.queryExecution().executedPlan().toString()


def test_labels_come_to_the_documents(spark, corpus, monkeypatch):
    """Documents are not exchanged for their labels, unless those are beyond the limit."""
    documents = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1.0), (1, 0.0), (3, 0.0), (None, 1.0)], "doc_id bigint, label double")
    monkeypatch.setattr(tables, "_LABEL_BYTES", tables.LABELS_LIMIT)
    far = tables.with_label_if_known(documents, labels)
    monkeypatch.undo()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = tables.with_label_if_known(documents, labels)
        plans = [x._jdf.queryExecution().executedPlan().toString() for x in (near, far)]
        assert "SortMergeJoin" not in plans[0] and "SortMergeJoin" in plans[1]
        rows = [Counter(tuple(r) for r in x.collect()) for x in (near, far)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows[0] == rows[1] and rows[0][(1, "a", 0.0)] == rows[0][(None, "d", None)] == 1


def gaussian(rows, terms, x):
    """Log joint of a dense Gaussian model, by class."""
    n = len(rows)
    columns = {t: [r.get(t, 0.0) for _, r in rows] for t in terms}

    def variance(v):
        return sum(a * a for a in v) / len(v) - (sum(v) / len(v)) ** 2

    widest = max(variance(v) for v in columns.values())
    eps = 1e-9 * widest if widest > 1e-12 else 1e-9
    scores = []
    for c in (0, 1):
        mine = [r for y, r in rows if y == c]
        if not mine:
            scores.append(None)
            continue
        total = math.log(len(mine) / n)
        for t in terms:
            v = [r.get(t, 0.0) for r in mine]
            mu, var = sum(v) / len(v), max(variance(v), 0.0) + eps
            total -= 0.5 * (math.log(2 * math.pi * var) + (x.get(t, 0.0) - mu) ** 2 / var)
        scores.append(total)
    return scores


@pytest.mark.parametrize("rounds", [1, 2])
def test_committee_equals_dense_models(corpus, fitted, rounds):
    vocabulary, weighted = fitted
    bucket = {1: 0, 2: 0, 3: 1, 4: 1, 5: 2, 6: 4, 7: 4}
    bucketed = weighted.withColumn(
        "bucket",
        F.element_at(
            F.create_map(*(F.lit(x) for p in bucket.items() for x in p)),
            F.col("doc_id").cast("int"),
        ),
    )
    trained = committee.fit_committee(bucketed, vocabulary, models=4, rounds=rounds)
    assert sorted(trained.members) == [0, 1, 2]
    scored = committee.score_members(bucketed, trained)
    weights = brute_weights(corpus)
    labels = {r["doc_id"]: r["label"] for r in corpus.collect()}
    terms = sorted({t for x in weights.values() for t in x})
    rows = scored.collect()
    assert len(rows) == 7 * 3
    for r in rows:
        m = r["model_id"]
        uses = [m] if rounds == 1 else [m, (m + 1) % 4]
        train = [(labels[d], weights[d]) for d, b in bucket.items() if b in uses]
        for c, expected in enumerate(gaussian(train, terms, weights[r["doc_id"]])):
            got = r[f"score{c}"]
            assert got is None if expected is None else got == pytest.approx(expected, rel=1e-5)
    blocked = committee.score_members(bucketed, trained, limit=0).collect()
    by_key = {(r["doc_id"], r["model_id"]): (r["score0"], r["score1"]) for r in rows}
    for r in blocked:
        for got, want in zip((r["score0"], r["score1"]), by_key.pop((r["doc_id"], r["model_id"]))):
            assert got is None if want is None else got == pytest.approx(want, rel=1e-9)
    assert not by_key
    packed = committee.member_scores(bucketed, trained)
    for vote in (committee.soft_vote, committee.hard_vote):
        a, b = ({r["doc_id"]: (r["votes0"], r["votes1"], r["prediction"]) for r in vote(x).collect()} for x in (scored, packed))
        assert a.keys() == b.keys() and all(a[d] == pytest.approx(b[d]) for d in a)
    soft = committee.soft_vote(scored).collect()
    hard = committee.hard_vote(scored).collect()
    assert all(r["votes0"] + r["votes1"] == pytest.approx(3) for r in soft)
    assert all(r["votes0"] + r["votes1"] == 3 for r in hard)


def test_committee_in_document_blocks_moves_no_rows(spark, corpus, fitted, monkeypatch):
    """Nothing is exchanged between the rows of the corpus and the sums by document."""
    plans = []
    fold = committee._folded

    def seen(*args):
        folded = fold(*args)
        plans.append(folded._jdf.queryExecution().executedPlan().toString())
        return folded

    monkeypatch.setattr(committee, "_folded", seen)
    vocabulary, weighted = fitted
    bucketed = weighted.withColumn("bucket", (F.col("doc_id") % 5).cast("int"))
    bucketed = workspace.materialize(bucketed, "bucketed")
    trained = committee.fit_committee(bucketed, vocabulary, models=4)
    committee.member_scores(bucketed, trained, limit=0)
    path = above(plans[0], "block_rows")
    assert not any("Exchange" in p for p in path) and "Broadcast" not in plans[0]
    committee.member_scores(bucketed, trained).collect()
    assert "explode(members" not in plans[1] and plans[1].count("Exchange hashpartitioning(doc_id") == 1


def test_committee_lets_dealt_documents_lie(corpus, monkeypatch):
    """Documents in blocks go nowhere after their counts, nor do the committee's sums, and terms that
    many blocks have are broadcast; scores are those of the plain corpus."""
    written, plans = [], []
    fold, write = committee._folded, blocks.materialize_buckets

    def named(frame, name, key, buckets):
        written.append(name)
        return write(frame, name, key, buckets)

    def seen(*args):
        folded = fold(*args)
        plans.append(folded._jdf.queryExecution().executedPlan().toString())
        return folded

    monkeypatch.setattr(blocks, "materialize_buckets", named)
    monkeypatch.setattr(committee, "_folded", seen)

    def known(scored):
        assert "block" not in scored.columns
        return {(r["doc_id"], r["model_id"]): (r["score0"], r["score1"]) for r in scored.collect()}

    counted = workspace.materialize(tfidf.count_terms(corpus), "counts").withColumn(
        "bucket", (F.col("doc_id") % 5).cast("int")
    )
    vocabulary = tfidf.fit_vocabulary(counted)
    plain = tfidf.weigh(counted, vocabulary)
    trained = committee.fit_committee(plain, vocabulary, models=4)
    want = known(committee.score_members(plain, trained))
    assert len(want) == 7 * 4
    weights = {r["doc_id"]: dict(r["entries"]) for r in plain.collect()}
    for vocabulary_limit in (0, 1 << 20):
        counts = blocks.deal(counted, 20, "block-counts")
        dealt = tfidf.weigh_dealt(counts, vocabulary, vocabulary_limit)
        got = {r["doc_id"]: dict(r["entries"]) for r in dealt.frame.collect()}
        assert got.keys() == weights.keys()
        assert all(got[d] == pytest.approx(weights[d]) for d in got)
    trained = committee.fit_committee(dealt, vocabulary, models=4)
    size = trained.table.size
    for limit in (0, size - 1, size):
        del plans[:], written[:]
        scores = known(committee.score_members(dealt, trained, limit))
        assert scores.keys() == want.keys()
        for key, pair in scores.items():
            assert all(g is None if w is None else g == pytest.approx(w, rel=1e-9) for g, w in zip(pair, want[key]))
        assert written == ([] if limit == size else ["block-terms"])
        path = above(plans[0], "block_weights")
        assert not any("Exchange" in p for p in path)
        assert ("Broadcast" in plans[0]) == (limit > 0)
    some = committee.score_members(dealt.where(F.col("bucket") >= 4), trained, 0)
    assert {r["doc_id"] for r in some.collect()} == {4}


def test_committee_scores_a_corpus_of_other_blocks(corpus, monkeypatch):
    """Documents that lie in more blocks than the committee's sums, as many unlabeled ones do."""
    counted = workspace.materialize(tfidf.count_terms(corpus), "counts").withColumn(
        "bucket", (F.col("doc_id") % 5).cast("int")
    )
    vocabulary = tfidf.fit_vocabulary(counted)
    dealt = tfidf.weigh_dealt(blocks.deal(counted, 20, "block-counts"), vocabulary)
    trained = committee.fit_committee(dealt, vocabulary, models=4)
    want = {(r["doc_id"], r["model_id"]): r["score1"] for r in committee.score_members(dealt, trained).collect()}
    monkeypatch.setattr(blocks.DocumentBlocks, "ROWS", 1)
    more = tfidf.weigh_dealt(blocks.deal(counted, 20, "block-counts"), vocabulary)
    assert more.blocks > dealt.blocks
    got = {(r["doc_id"], r["model_id"]): r["score1"] for r in committee.score_members(more, trained, trained.table.size - 1).collect()}
    assert got.keys() == want.keys()
    assert all(got[k] is None if v is None else got[k] == pytest.approx(v, rel=1e-9) for k, v in want.items())


def test_bayes_on_a_vocabulary_in_parts(spark, monkeypatch):
    """Beyond the limit the model comes from the counts, a part of the vocabulary at a time, and the weights
    are not put together; repeated, empty and unknown documents as in the plain way."""
    rows = [(1, "good film good", 1.0), (1, "bad film", 1.0), (2, "bad end", 0.0), (None, "moving story", 0.0), (3, "", 1.0), (1, "dull", 0.0)]
    corpus = train_predict.prepare(
        spark.createDataFrame(rows, "doc_id bigint, text string, label double"),
        spark.createDataFrame([(7, "good end"), (7, "dull film xyz"), (8, ""), (None, "bad"), (9, "xyz")], "doc_id bigint, text string"),
    )
    plain = bayes.fit_naive_bayes(corpus.weighted, corpus.vocabulary, documents=corpus.labeled)
    never = corpus.weighted.withColumn("entries", F.raise_error(F.lit("weighed")).cast(corpus.weighted.schema["entries"].dataType))
    monkeypatch.setattr("tonewright.operators.term_table.PART_ROWS", 2)
    assert len(corpus.vocabulary.table.parts(0)) > 2
    model = bayes.fit_naive_bayes(never, corpus.vocabulary, documents=corpus.labeled, limit=0)
    assert model.pi == plain.pi
    got, want = ({r["term"]: (r["df"], *map(r.__getitem__, ("idf", "theta0", "theta1"))) for r in m.table.frame.collect()} for m in (model, plain))
    assert got.keys() == want.keys()
    assert all(got[t] == pytest.approx(want[t], rel=1e-12) for t in want)
    columns = ("theta0", "theta1", "n_terms")
    got, want = ({r["doc_id"]: [r[c] for c in columns] for r in scoring.score_counts(corpus.unlabeled, plain.table, *columns[:2], limit=limit).collect()} for limit in (0, 1 << 30))
    assert got.keys() == want.keys() == {7, 8, 9, None}
    assert all(got[d] == pytest.approx(want[d], rel=1e-12) for d in want)


def test_votes_tie_for_class_zero(spark):
    scored = spark.createDataFrame(
        [(1, 0, -1.0, -2.0), (1, 1, -2.0, -1.0), (2, 0, -1.0, -1.0), (3, 0, None, -1.0)],
        "doc_id bigint, model_id int, score0 double, score1 double",
    )
    for vote in (committee.soft_vote, committee.hard_vote):
        got = {r["doc_id"]: r["prediction"] for r in vote(scored).collect()}
        assert got == {1: 0.0, 2: 0.0, 3: 1.0}


def test_collocations(corpus, monkeypatch):
    monkeypatch.setattr("tonewright.operators.term_table.HOT_SHARE", 10)
    sentences = [
        s for r in corpus.select(text.sentence_terms(F.col("text")).alias("s")).collect() for s in r["s"]
    ]
    singles = Counter(t for s in sentences for t in s)
    pairs = Counter(p for s in sentences for p in zip(s, s[1:]))
    total = sum(singles.values())
    for limit in (0, 1 << 20):
        got = collocation.score_bigrams(corpus, limit).collect()
        assert {(r["first"], r["second"]): r["n_pair"] for r in got} == dict(pairs)
        for r in got:
            n11, n12 = r["n_pair"], singles[r["first"]] - r["n_pair"]
            n21 = singles[r["second"]] - n11
            n22 = total - n11 - n12 - n21
            margins = (n11 + n12) * (n11 + n21) * (n12 + n22) * (n21 + n22)
            expected = total * (n11 * n22 - n12 * n21) ** 2 / margins
            assert r["chi_square"] == pytest.approx(expected)
    assert collocation.top_collocations(corpus, 3).count() == 3


def test_first_per_class(spark):
    rows = spark.range(1000).selectExpr("lpad(id, 4, '0') AS name", "double(id % 3 = 0) AS label")
    got = sampling.first_per_class(rows, 5, shards=7).orderBy("label", "name").collect()
    assert [r["name"] for r in got] == ["0001", "0002", "0004", "0005", "0007"] + [
        "0000", "0003", "0006", "0009", "0012"
    ]


def test_buckets_are_stable_and_cover_all(spark):
    ids = spark.range(3000).select("id", split.stable_bucket(F.col("id"), 50).alias("b"))
    first = {r["id"]: r["b"] for r in ids.collect()}
    again = {r["id"]: r["b"] for r in ids.repartition(7).collect()}
    assert first == again and set(first.values()) == set(range(50))


def test_accuracy_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "prediction double, label double")
    assert evaluate.accuracy(empty).first()["accuracy"] is None


@pytest.fixture
def folders(tmp_path):
    texts = {
        "train/pos/1.txt": "good film", "train/pos/sub/2.v2.txt": "wonderful\nfilm",
        "train/neg/3.txt": "bad film", "train/neg/4.txt": "awful film",
        "test/pos.5.txt": "wonderful good", "test/6.txt": "awful bad", "test/7.txt": "",
    }
    for name, content in texts.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)
    return tmp_path


def test_readers(spark, folders):
    labeled = files.read_labeled(spark, f"{folders}/train").collect()
    assert {(r["name"], r["text"], r["label"]) for r in labeled} == {
        ("1", "good film", 1.0), ("2", "wonderful\nfilm", 1.0),
        ("3", "bad film", 0.0), ("4", "awful film", 0.0),
    }
    unlabeled = files.read_unlabeled(spark, f"{folders}/test").collect()
    assert {(r["name"], r["text"]) for r in unlabeled} >= {("pos", "wonderful good"), ("6", "awful bad")}


def test_bytes_that_are_no_text(spark, tmp_path):
    """Malformed files are read, in either way, and no other file changes."""
    contents = {
        "good.txt": "naïve 日本 🎉".encode(), "empty.txt": b"", "lone.v2.txt": b"a\xffb", "cut.txt": b"ab\xe2\x82",
        "overlong.txt": b"\xc0\x80x", "surrogate.txt": b"\xed\xa0\x80", "latin.txt": "é".encode("latin-1"),
    }
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    del contents["empty.txt"]  # Spark's file index leaves empty files out
    got = {r["name"]: r["text"] for r in files.read_unlabeled(spark, str(tmp_path)).collect()}
    assert got == {n.split(".")[0]: c.decode("utf-8", "replace") for n, c in contents.items()}
    strict = {r["name"]: r["text"] for r in files.read_unlabeled(spark, str(tmp_path), malformed="null").collect()}
    assert {n for n, t in strict.items() if t is None} == {"lone", "cut", "overlong", "surrogate", "latin"}
    listed = {r["name"]: r["length"] for r in files.list_files(spark, str(tmp_path)).collect()}
    assert listed == {n.split(".")[0]: len(c) for n, c in contents.items()}
    one = spark.createDataFrame([(b"\xe9",)], "content binary")
    assert one.select(files.decoded(F.col("content"), "ISO-8859-1").alias("t")).first()["t"] == "é"
    stored = files.compact(files.read_unlabeled(spark, str(tmp_path)), str(tmp_path / "table"))
    assert stored.count() == len(contents)


def test_files_are_written_by_the_tasks(spark, tmp_path):
    """Not through Hadoop's local file system, which starts a process for each file; bytes as they are,
    NULL as an empty line, none for no rows."""
    rows = [(bytearray(b"\xffa"),), (bytearray("Être\n".encode()),), (None,), (bytearray(b""),)]
    texts = spark.createDataFrame(rows, "raw binary").select(F.col("raw").cast("string").alias("text"))
    files.write_texts(texts.repartition(2), str(tmp_path / "few"))
    found = list((tmp_path / "few").iterdir())
    assert sorted(p.read_bytes() for p in found) == sorted([b"\n", b"\n", b"\xffa\n", "Être\n\n".encode()])
    assert all(p.suffix == ".txt" for p in found)
    files.write_texts(texts.limit(0), str(tmp_path / "none"))
    assert files.read_unlabeled(spark, str(tmp_path / "none")).count() == 0


def test_many_splits_of_small_files_make_fewer_tasks(spark, tmp_path, monkeypatch):
    files.write_texts(spark.range(99).select(F.col("id").cast("string").alias("text")), str(tmp_path / "many"))
    monkeypatch.setattr(files, "SPLITS_PER_SLOT", 0)
    monkeypatch.setattr(files, "SPLITS_OF_A_TASK", 3)
    monkeypatch.setattr(files, "spread", lambda scan, key: scan)
    raw = spark.read.format("binaryFile").load(str(tmp_path / "many")).rdd.getNumPartitions()
    back = files.read_unlabeled(spark, str(tmp_path / "many"))
    assert back.rdd.getNumPartitions() == -(-raw // 3) < raw
    assert sorted(int(r["text"]) for r in back.collect()) == list(range(99))


def test_small_files_share_tasks(spark, tmp_path):
    files.write_texts(spark.range(200).select(F.col("id").cast("string").alias("text")), str(tmp_path / "many"))
    many = [p for p in (tmp_path / "many").iterdir() if p.suffix == ".txt"]
    assert len(many) == 200
    raw = spark.read.format("binaryFile").load(str(tmp_path / "many"))
    assert raw.rdd.getNumPartitions() < 50
    back = files.read_unlabeled(spark, str(tmp_path / "many"))
    assert sorted(int(r["text"]) for r in back.collect()) == list(range(200))


@pytest.mark.parametrize(
    "classifier, options",
    [("bayes", {}), ("svm", {"iterations": 2}), ("logistic", {"iterations": 2}), ("forest", {}), ("boosting", {"iterations": 2})],
)
def test_whole_job(spark, folders, classifier, options):
    output = f"{folders}/predictions"
    train_predict.run(
        files.read_labeled(spark, f"{folders}/train"),
        files.read_unlabeled(spark, f"{folders}/test"),
        output,
        classifier,
        **options,
    )
    lines = {r["value"] for r in spark.read.text(output).collect()}
    one, zero = ("1.0", "0.0") if classifier == "bayes" else ("1", "0")
    assert {line.split(",")[0] for line in lines} >= {"pos", "6"}
    if classifier in ("bayes", "svm", "logistic"):
        assert {f"pos,{one}", f"6,{zero}"} <= lines
    back = files.read_predictions(spark, output)
    assert set(back.columns) == {"name", "prediction"} and back.where("prediction IS NULL").count() == 0


def test_shared_folder_is_the_clusters(spark):
    assert workspace.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_temporary_tables_go_and_lasting_ones_stay(spark):
    folder = workspace.shared_folder(spark)
    before = set(os.listdir(folder))
    with workspace.temporary(spark):
        first = workspace.materialize(spark.range(3).toDF("x"), "first")
        second = workspace.materialize(first, "second", lasting=True)
    left = set(os.listdir(folder)) - before
    assert len(left) == 1 and left.pop().startswith("second-") and second.count() == 3


def test_a_whole_job_leaves_no_tables(spark, corpus, tmp_path):
    folder = workspace.shared_folder(spark)
    before = set(os.listdir(folder))
    unlabeled = corpus.select("doc_id", F.col("doc_id").cast("string").alias("name"), "text")
    train_predict.run(corpus, unlabeled, str(tmp_path / "lines"))
    assert set(os.listdir(folder)) == before
    assert spark.read.text(str(tmp_path / "lines")).count() == 7


def test_sizes_beyond_32_and_64_bits(spark):
    one = spark.range(1)
    size = tfidf.dense_size_gb(F.lit(20_000_000_000), F.lit(100_000_000))
    assert one.select(size.alias("s")).first()["s"] == 20_000_000_000 * 100_000_000 * 8 >> 30
    table = TermTable(one, 1 << 31, 0, 0)
    with pytest.raises(ValueError, match="columns"):
        vectors.to_vectors(one, table)

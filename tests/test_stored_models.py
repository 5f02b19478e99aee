"""Stored vectorizers and committees: an update equals training on everything."""

import pytest
from pyspark.sql import functions as F

from tonewright.operators import committee, stored_models, tfidf, vectors
from tonewright.sources import store


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "store")


def _rows(frame):
    return sorted(map(tuple, frame.collect()))


def _batches(rows, n):
    return [rows.where(F.col("doc_id") % n == i) for i in range(n)]


def test_updated_vocabulary_equals_fitted(corpus, folder):
    counted = tfidf.count_terms(corpus)
    for i, batch in enumerate(_batches(counted, 3)):
        assert stored_models.update_vocabulary(batch, folder, f"b{i}").number == i + 1
    fitted = tfidf.fit_vocabulary(counted)
    loaded = stored_models.load_vocabulary(corpus.sparkSession, folder)
    assert (loaded.documents, loaded.size) == (fitted.documents, fitted.size)
    assert _rows(loaded.terms) == _rows(fitted.terms)


def test_vectorizer_in_another_session(spark, corpus, folder):
    vocabulary, _ = tfidf.fit_transform(corpus, "bigram")
    stored_models.update_vocabulary(tfidf.count_terms(corpus, "bigram"), folder, "all", "bigram")
    other = spark.newSession()
    rows = other.createDataFrame(corpus.collect(), corpus.schema)
    stored = stored_models.transform_stored(rows, folder)
    got = _rows(tfidf.explode_entries(stored).select("doc_id", "term", F.round("w", 9)))
    direct = tfidf.explode_entries(tfidf.transform(corpus, vocabulary, "bigram"))
    assert got == _rows(direct.select("doc_id", "term", F.round("w", 9)))


def test_old_versions_stay(spark, corpus, folder):
    early, late = _batches(tfidf.count_terms(corpus), 2)
    stored_models.update_vocabulary(early, folder, "early")
    first = _rows(stored_models.load_vocabulary(spark, folder, 1).terms)
    stored_models.update_vocabulary(late, folder, "late")
    assert _rows(stored_models.load_vocabulary(spark, folder, 1).terms) == first
    assert store.versions(spark, folder) == [1, 2]
    with pytest.raises(ValueError):
        store.load(spark, folder, 3)


def test_batch_sent_twice_counts_once(spark, corpus, folder):
    counted = tfidf.count_terms(corpus)
    first = stored_models.update_vocabulary(counted, folder, "a")
    assert stored_models.update_vocabulary(counted, folder, "a").number == first.number
    assert store.versions(spark, folder) == [1]


def test_taken_version_fails(spark, corpus, folder):
    version = stored_models.update_vocabulary(tfidf.count_terms(corpus), folder, "a")
    with pytest.raises(FileExistsError):
        store.commit(spark, folder, 1, version.tables, {}, version.facts)


def test_unnamed_part_is_not_read(spark, corpus, folder):
    counted = tfidf.count_terms(corpus)
    stored_models.update_vocabulary(counted, folder, "a")
    before = _rows(stored_models.load_vocabulary(spark, folder).terms)
    store.write_part(tfidf.document_frequency(counted), folder, "terms")  # a writer that died
    assert _rows(stored_models.load_vocabulary(spark, folder).terms) == before


def test_other_analyzer_is_refused(corpus, folder):
    stored_models.update_vocabulary(tfidf.count_terms(corpus), folder, "a")
    with pytest.raises(ValueError):
        stored_models.update_vocabulary(tfidf.count_terms(corpus, "bigram"), folder, "b", "bigram")


def test_many_parts_are_added_up(spark, corpus, folder, monkeypatch):
    monkeypatch.setattr(stored_models, "MOST_PARTS", 2)
    counted = tfidf.count_terms(corpus)
    sizes = []
    for i, batch in enumerate(_batches(counted, 4)):
        version = stored_models.update_vocabulary(batch, folder, str(i))
        sizes.append(len(version.tables["terms"]))
    assert sizes == [1, 2, 1, 2]
    assert _rows(stored_models.load_vocabulary(spark, folder).terms) == _rows(
        tfidf.fit_vocabulary(counted).terms
    )


def test_empty_batch_and_empty_store(spark, corpus, folder):
    with pytest.raises(ValueError):
        stored_models.load_vocabulary(spark, folder)
    counted = tfidf.count_terms(corpus)
    stored_models.update_vocabulary(counted.limit(0), folder, "none")
    assert stored_models.load_vocabulary(spark, folder).size == 0
    stored_models.update_vocabulary(counted, folder, "all")
    assert stored_models.load_vocabulary(spark, folder).documents == corpus.count()


@pytest.mark.parametrize("rounds", [1, 2])
def test_updated_committee_equals_trained(spark, corpus, folder, rounds):
    vocabulary, weighted = tfidf.fit_transform(corpus)
    rows = weighted.withColumn("bucket", (F.col("doc_id") % 5).cast("int")).persist()
    for i, batch in enumerate(_batches(rows, 2)):
        stored_models.update_committee(batch, folder, str(i), vocabulary, models=4)
    trained = committee.fit_committee(rows, vocabulary, models=4, rounds=rounds)
    loaded = stored_models.load_committee(spark, folder, rounds=rounds)
    assert loaded.members.keys() == trained.members.keys()
    for model, member in trained.members.items():
        assert loaded.members[model].n == member.n
        assert loaded.members[model].base == pytest.approx(member.base)
    numbers = [F.round(c, 9) for c in ("mu0", "var0", "mu1", "var1")]
    assert _rows(committee.parameters(loaded).select("model_id", "term", *numbers)) == _rows(
        committee.parameters(trained).select("model_id", "term", *numbers)
    )


def test_blocks_hold_the_same_vectors(corpus):
    vocabulary, weighted = tfidf.fit_transform(corpus)
    index = vectors.index_terms(vocabulary)
    whole = {r["doc_id"]: r["features"] for r in vectors.to_vectors(weighted, index).collect()}
    width = 4
    seen = {d: {} for d in whole}
    for r in vectors.to_vector_blocks(weighted, index, width).collect():
        assert r["features"].size == min(width, index.rows - r["block"] * width)
        for i, w in zip(r["features"].indices, r["features"].values, strict=True):
            seen[r["doc_id"]][r["block"] * width + int(i)] = w
    expected = {d: dict(zip(map(int, v.indices), v.values, strict=True)) for d, v in whole.items()}
    assert {d: pytest.approx(v) for d, v in expected.items()} == seen
    with pytest.raises(ValueError):
        vectors.to_vector_blocks(weighted, index, 1 << 31)

"""

Every query runs over whole tables and whole texts. Doubles are rounded on both sides, because
the order of a distributed sum is not fixed.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import ORACLES  # noqa: E402
from tonewright.functions import stem, text  # noqa: E402
from tonewright.operators import (  # noqa: E402
    bayes,
    collocation,
    committee,
    estimators,
    evaluate,
    linear,
    sampling,
    split,
    stored_models,
    tfidf,
    trees,
    vectors,
)
from tonewright.plans import holdout, train_predict, vote  # noqa: E402
from tonewright.sources import files, tables, workspace  # noqa: E402

try:
    import corpus_pipeline
    from tonewright.llm import queries as llm_queries
except ImportError as missing:
    if (missing.name or "").split(".")[0] != "corpus_pipeline" and missing.name != "tonewright.llm":
        raise
    corpus_pipeline = llm_queries = None

SMALL = "/root/testdata/sf0.001"
Query = Callable[[SparkSession, str], DataFrame]


# --- inputs -------------------------------------------------------------------------------------


def _labeled(spark: SparkSession, sf: str) -> DataFrame:
    return tables.with_label(tables.read_documents(spark, sf), tables.read_labels(spark, sf))


def _fitted(spark: SparkSession, sf: str) -> tuple[tfidf.Vocabulary, DataFrame]:
    return tfidf.fit_transform(_labeled(spark, sf))


def _counted(spark: SparkSession, sf: str) -> DataFrame:
    return tfidf.count_terms(_labeled(spark, sf))


def _vocabulary(spark: SparkSession, sf: str) -> tfidf.Vocabulary:
    return tfidf.fit_vocabulary(workspace.materialize(_counted(spark, sf), "counts"))


def _prepared(spark: SparkSession, sf: str, analyze: str = "unigram"):
    return train_predict.prepare_tables(
        tables.read_documents(spark, sf), tables.read_labels(spark, sf), analyze
    )


def _r(column: str, places: int = 6):
    return F.round(F.col(column), places).alias(column)


def _listed(column: str, count: str):
    return [F.size(column).alias(count), F.array_join(column, "|").alias(column)]


# --- text ---------------------------------------------------------------------------------------


def strip_steps(spark, sf):
    html = F.col("text")
    pages = tables.read_pages(spark, sf)
    return pages.select(
        "doc_id",
        F.md5(text.strip_markup(html)).alias("no_markup"),
        F.md5(text.strip_digits(html)).alias("no_digits"),
        F.md5(text.strip_punctuation(html)).alias("no_punctuation"),
        F.md5(text.collapse_space(html)).alias("one_space"),
    )


def clean_documents(spark, sf):
    return tables.read_documents(spark, sf).select(
        "doc_id", text.clean(F.col("text")).alias("cleaned")
    )


def clean_pages(spark, sf):
    return tables.read_pages(spark, sf).select(
        "doc_id", text.clean(F.col("text")).alias("cleaned")
    )


def decode_text(spark, sf):
    documents = tables.read_documents(spark, sf)
    raw = documents.withColumn("raw", F.encode("text", "UTF-8"))
    return raw.select("doc_id", F.md5(text.decode(F.col("raw"))).alias("digest"))


def sentences(spark, sf):
    cut = text.sentences(text.clean(F.col("text"))).alias("sentences")
    return tables.read_documents(spark, sf).select("doc_id", cut).select(
        "doc_id", *_listed("sentences", "n_sentences")
    )


def tokens(spark, sf):
    words = text.tokens(F.col("text")).alias("tokens")
    return tables.read_documents(spark, sf).select("doc_id", words).select(
        "doc_id", *_listed("tokens", "n_tokens")
    )


def stopword_filtered(spark, sf):
    words = text.drop_stop_words(text.tokens(F.col("text"))).alias("tokens")
    return tables.read_documents(spark, sf).select("doc_id", words).select(
        "doc_id", *_listed("tokens", "n_tokens")
    )


def stem_vocabulary(spark, sf):
    words = text.drop_stop_words(text.tokens(F.col("text")))
    exploded = tables.read_documents(spark, sf).select(F.explode_outer(words).alias("token"))
    distinct = exploded.where("token IS NOT NULL").distinct()
    return distinct.select("token", stem.stem_word(F.col("token")).alias("stem"))


def _terms(analyze: str) -> Query:
    def query(spark, sf):
        terms = text.analyzer(analyze)(F.col("text")).alias("terms")
        return tables.read_documents(spark, sf).select("doc_id", terms).select(
            "doc_id", *_listed("terms", "n_terms")
        )

    return query


def collocations_top300(spark, sf):
    return collocation.top_collocations(tables.read_documents(spark, sf))


# --- corpus -------------------------------------------------------------------------------------


def _sample(k: int) -> Query:
    def query(spark, sf):
        """Ranks names only; the texts of the chosen documents come after."""
        named = tables.read_labels(spark, sf).withColumn("name", F.col("doc_id").cast("string"))
        documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
        chosen = sampling.with_documents(sampling.first_per_class(named, k), documents)
        return chosen.select("name", "label", F.md5("text").alias("digest"))

    return query


def union_classes(spark, sf):
    labels = tables.read_labels(spark, sf)
    documents = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    classes = (tables.with_label(documents, labels.where(F.col("label") == c)) for c in (1.0, 0.0))
    return files.union_classes(*classes).select("doc_id", "label", F.md5("text").alias("digest"))


def _lengths(spark, sf):
    """Lengths are taken where the texts are read, so no text is shuffled."""
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    return documents.select("doc_id", F.length("text").alias("n_chars"))


def label_join(spark, sf):
    joined = tables.with_label(_lengths(spark, sf), tables.read_labels(spark, sf))
    return joined.select("doc_id", "label", "n_chars")


def name_join(spark, sf):
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    file_name = F.concat_ws(".", "doc_id", "source", F.lit("txt"))
    names = documents.select("doc_id", files.document_name(file_name).alias("name"))
    return tables.with_name(_lengths(spark, sf), names)


def bucket_split(spark, sf):
    key = F.col("doc_id")
    return tables.read_documents(spark, sf).select(
        "doc_id",
        split.stable_bucket(key, 50).alias("bucket"),
        (split.stable_bucket(key, 50) < 40).alias("in_committee"),
        split.is_train(key).alias("in_train"),
    )


def random_split(spark, sf):
    """What must hold of a drawn split: each row is in one part, and in no more than one."""
    stored = workspace.materialize(tables.read_labels(spark, sf), "labels")
    train, test = split.random_split(stored)
    parts = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    drawn = parts.groupBy("doc_id").agg(F.countDistinct("part").alias("parts"))
    judged = stored.join(drawn, "doc_id", "left")
    return judged.agg(
        F.count("*").alias("n_rows"),
        F.count(F.when(F.col("parts") > 1, 1)).alias("n_both"),
        F.count(F.when(F.col("parts").isNull(), 1)).alias("n_neither"),
    )


def _as_files(rows: DataFrame, folder: str) -> None:
    """One file for each row of ``doc_id, text``; the id is the first line."""
    lead = F.concat(F.col("doc_id").cast("string"), F.lit("\n"))
    files.write_texts(rows.select(F.concat(lead, "text").alias("text")), folder)


def _from_files(back: DataFrame) -> DataFrame:
    """``doc_id`` and the digest of the text, without the line feed that the writer adds."""
    doc_id = F.substring_index("text", "\n", 1)
    start = F.length(doc_id) + 2
    body = F.substring(F.col("text"), start, F.length("text") - start)
    extra = [c for c in back.columns if c not in ("doc_id", "name", "text")]
    return back.select(doc_id.cast("bigint").alias("doc_id"), *extra, F.md5(body).alias("digest"))


def corpus_roundtrip(spark, sf):
    """The labeled documents as one file each, read back from the folders of their classes.

    One file for each document is the format that is read, not a way to store a large corpus.
    """
    folder = f"{workspace.shared_folder(spark)}/corpus-{workspace.new_name()}"
    corpus = workspace.materialize(_labeled(spark, sf), "corpus")
    for label, part in ((1.0, "pos"), (0.0, "neg")):
        _as_files(corpus.where(F.col("label") == label), f"{folder}/{part}")
    return _from_files(files.read_labeled(spark, folder))


def unlabeled_folder(spark, sf):
    """The documents without a label as files, read as the corpus that is to be predicted."""
    folder = f"{workspace.shared_folder(spark)}/unlabeled-{workspace.new_name()}"
    everything = tables.with_label_if_known(
        tables.read_documents(spark, sf), tables.read_labels(spark, sf)
    )
    _as_files(everything.where("label IS NULL"), folder)
    back = files.read_unlabeled(spark, folder)
    listed = files.list_files(spark, folder).select(F.col("path").alias("doc_id"), "length")
    return _from_files(back.join(listed, "doc_id"))


_BAD_BYTES = ("FF", "C3", "C080", "EDA080", "F0908D")


def decoded_folder(spark, sf):
    """All documents as files, every second one with bytes that are no UTF-8 in front; read twice,
    with replacements and with NULL for the whole text."""
    folder = f"{workspace.shared_folder(spark)}/bytes-{workspace.new_name()}"
    documents = tables.read_documents(spark, sf)
    bad = F.array(*(F.unhex(F.lit(x)) for x in _BAD_BYTES))
    front = F.when(F.col("doc_id") % 2 == 1, F.get(bad, (F.col("doc_id") % 5).cast("int")))
    raw = F.concat(F.coalesce(front, F.unhex(F.lit(""))), F.col("text").cast("binary"))
    _as_files(documents.select("doc_id", raw.cast("string").alias("text")), folder)
    whole = files.read_unlabeled(spark, folder, malformed="null")
    whole = whole.select("doc_id", F.col("text").isNull().alias("malformed"))
    return _from_files(files.read_unlabeled(spark, folder).join(whole, "doc_id"))


# --- vectorizing --------------------------------------------------------------------------------


def term_frequency(spark, sf):
    return tfidf.explode_counts(_counted(spark, sf).drop("label"))


def document_frequency(spark, sf):
    return tfidf.document_frequency(_counted(spark, sf))


def vocabulary(spark, sf):
    return vectors.index_terms(_vocabulary(spark, sf)).frame.select("term", "idx", "df")


def idf(spark, sf):
    return _vocabulary(spark, sf).terms.select("term", _r("idf"))


def tfidf_l2(spark, sf):
    _, weighted = _fitted(spark, sf)
    return tfidf.explode_entries(weighted).select("doc_id", "term", _r("w"))


def tfidf_transform_unlabeled(spark, sf):
    corpus = _prepared(spark, sf)
    weighted = tfidf.weigh(corpus.unlabeled, corpus.vocabulary)
    return tfidf.explode_entries(weighted).select("doc_id", "term", _r("w"))


def tfidf_alternate(spark, sf):
    _, weighted = tfidf.fit_transform(_labeled(spark, sf), "plain")
    return tfidf.explode_entries(weighted).select("doc_id", "term", _r("w"))


def feature_count(spark, sf):
    return _vocabulary(spark, sf).terms.agg(F.count("*").alias("n_features"))


def dense_size_estimate(spark, sf):
    fitted = _vocabulary(spark, sf)
    size = fitted.terms.agg(F.count("*").alias("n_columns")).withColumn(
        "n_rows", F.lit(fitted.documents).cast("bigint")
    )
    return size.select(
        "n_rows",
        "n_columns",
        tfidf.dense_size_gb(F.col("n_rows"), F.col("n_columns")).alias("size_gb"),
    )


def rows_from_triples(spark, sf):
    fitted, weighted = _fitted(spark, sf)
    index = vectors.index_terms(fitted)
    triples = index.attach(tfidf.explode_entries(weighted), how="inner", drop=("df", "idf"))
    rows = tfidf.rows_from_triples(triples.select("doc_id", "idx", "w"))
    cells = F.transform(
        "row",
        lambda e: F.concat_ws(":", e["idx"], F.round(e["w"] * 1e6).cast("bigint")),
    )
    return rows.select("doc_id", F.size("row").alias("n_cells"), F.array_join(cells, " ").alias("row"))


def vector_pipeline(spark, sf):
    """Library Naive Bayes on vectors: the same predictions as on the tables."""
    fitted, weighted = _fitted(spark, sf)
    stored = vectors.to_vectors(weighted, vectors.index_terms(fitted))
    model = estimators.naive_bayes().fit(stored)
    scored = estimators.predict(model, stored).select("doc_id", "prediction")
    held = stored.select("doc_id", "label", *vectors.digest(F.col("features")))
    return held.join(scored, "doc_id")


def vector_blocks(spark, sf):
    """Vectors of at most 1,000 columns, where a corpus has more terms than a vector has columns."""
    fitted, weighted = _fitted(spark, sf)
    blocks = vectors.to_vector_blocks(weighted, vectors.index_terms(fitted), 1000)
    return blocks.select("doc_id", "block", *vectors.digest(F.col("features")))


# --- stored models ------------------------------------------------------------------------------


def _halves(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two batches of a corpus: what came first, and what came later."""
    early = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 > 0
    return rows.where(early), rows.where(~early)


def _stored_vocabulary(spark, counted: DataFrame) -> str:
    folder = workspace.new_folder(spark, "vectorizer")
    for name, batch in zip(("early", "late"), _halves(counted), strict=True):
        stored_models.update_vocabulary(batch, folder, name)
    return folder


def vocabulary_update(spark, sf):
    """The idf of a stored vocabulary that was updated by a second batch."""
    counted = workspace.materialize(_counted(spark, sf), "counts")
    folder = _stored_vocabulary(spark, counted)
    return stored_models.load_vocabulary(spark, folder).terms.select("term", "df", _r("idf"))


def tfidf_transform_stored(spark, sf):
    """Weights of the unlabeled documents under a vectorizer that is read from its folder."""
    folder = _stored_vocabulary(spark, workspace.materialize(_counted(spark, sf), "counts"))
    unlabeled = tables.read_documents(spark, sf).join(
        tables.read_labels(spark, sf).select("doc_id"), "doc_id", "left_anti"
    )
    weighted = stored_models.transform_stored(unlabeled, folder)
    return tfidf.explode_entries(weighted).select("doc_id", "term", _r("w"))


def committee_update(spark, sf):
    """The second round of a stored committee that was updated by a second batch."""
    fitted, rows = vote.bucketed_corpus(_labeled(spark, sf))
    folder = workspace.new_folder(spark, "committee")
    for name, batch in zip(("early", "late"), _halves(rows), strict=True):
        stored_models.update_committee(batch, folder, name, fitted)
    return _parameters(stored_models.load_committee(spark, folder))


def _parameters(trained: committee.Committee) -> DataFrame:
    return committee.parameters(trained).select(
        "model_id", "term", *(_r(c, 9) for c in ("mu0", "var0", "mu1", "var1"))
    )


# --- classifiers --------------------------------------------------------------------------------


def nb_train(spark, sf):
    fitted, weighted = _fitted(spark, sf)
    model = bayes.fit_naive_bayes(weighted, fitted, documents=_labeled(spark, sf))
    return model.table.frame.select(
        "term",
        _r("theta0"),
        _r("theta1"),
        F.round(F.lit(model.pi[0]), 6).alias("pi0"),
        F.round(F.lit(model.pi[1]), 6).alias("pi1"),
    )


def nb_predict_unlabeled(spark, sf):
    predicted = train_predict.train_and_predict(_prepared(spark, sf))
    return predicted.select(
        F.col("doc_id").cast("string").alias("name"), "prediction", _r("score0"), _r("score1")
    )


def nb_predict_bigrams(spark, sf):
    predicted = train_predict.train_and_predict(_prepared(spark, sf, "bigram"))
    return predicted.select(
        F.col("doc_id").cast("string").alias("name"), "prediction", _r("score0"), _r("score1")
    )


def _nb_accuracy(analyze: str = "unigram", fit_on: str = "all") -> Query:
    def query(spark, sf):
        measured = holdout.bayes_accuracy(_labeled(spark, sf), analyze, fit_on)
        return measured.select("n_test", "n_correct", _r("accuracy"))

    return query


def _linear(loss: str, iterations: int, train_only: bool = False) -> Query:
    def query(spark, sf):
        _, weighted = _fitted(spark, sf)
        if train_only:
            weighted, _ = split.holdout_split(weighted)
        model = linear.fit_gradient_descent(weighted, loss, iterations)
        return model.table.frame.select("term", _r("coef", 9))

    return query


def _linear_accuracy(loss: str, iterations: int) -> Query:
    def query(spark, sf):
        measured = holdout.linear_accuracy(_labeled(spark, sf), loss, iterations)
        return measured.select("n_test", "n_correct", _r("accuracy"))

    return query


def _linear_predictions(loss: str, iterations: int) -> Query:
    def query(spark, sf):
        predicted = train_predict.train_and_predict(
            _prepared(spark, sf), "svm" if loss == "hinge" else loss, iterations=iterations
        )
        return predicted.select("doc_id", _r("margin"), "prediction")

    return query


def _tree_holdout(kind: str, **options) -> Query:
    def query(spark, sf):
        fitted, weighted = holdout.weighted_corpus(_labeled(spark, sf))
        predicted = holdout.tree_predictions(fitted, weighted, kind, **options)
        return predicted.select("doc_id", "label", _r("score"), "prediction")

    return query


def _tree_nodes(kind: str, **options) -> Query:
    """The model as a table, trained on the documents that aren't held out."""

    def query(spark, sf):
        fitted, weighted = holdout.weighted_corpus(_labeled(spark, sf))
        train = weighted.where(split.is_train(F.col("doc_id")))
        return trees.tree_table(holdout.fit_trees(fitted, train, kind, **options), weighted)

    return query


def _tree_accuracy(kind: str, **options) -> Query:
    def query(spark, sf):
        measured = holdout.tree_accuracy(_labeled(spark, sf), kind, **options)
        return measured.select("n_test", "n_correct", _r("accuracy"))

    return query


def _tree_unlabeled(kind: str, **options) -> Query:
    def query(spark, sf):
        predicted = train_predict.train_and_predict(_prepared(spark, sf), kind, **options)
        return predicted.select("doc_id", _r("score"), "prediction")

    return query


def prediction_sink(spark, sf):
    """Prediction lines written and read back."""
    predicted = train_predict.train_and_predict(_prepared(spark, sf))
    named = predicted.withColumn("name", F.col("doc_id").cast("string"))
    folder = f"{workspace.shared_folder(spark)}/predictions-{workspace.new_name()}"
    files.write_predictions(evaluate.named_predictions(named), folder)
    return spark.read.text(folder).withColumnRenamed("value", "line")


# --- committee ----------------------------------------------------------------------------------


def gnb_bucket_stats(spark, sf):
    _, rows = vote.bucketed_corpus(_labeled(spark, sf))
    sums = committee.term_statistics(rows, committee.TRAIN_BUCKETS, rounds=1)
    return sums.select("model_id", "term", *(_r(c) for c in ("s0", "ss0", "s1", "ss1")))


def gnb_second_round(spark, sf):
    fitted, rows = vote.bucketed_corpus(_labeled(spark, sf))
    return _parameters(committee.fit_committee(rows, fitted))


def soft_vote(spark, sf):
    votes = vote.vote_on_holdout(_labeled(spark, sf))
    return votes.select("doc_id", "label", _r("votes0", 3), _r("votes1", 3), "prediction")


def hard_vote(spark, sf):
    votes = vote.vote_on_holdout(_labeled(spark, sf), committee.hard_vote)
    return votes.select("doc_id", "label", "votes0", "votes1", "prediction")


def committee_predict_unlabeled(spark, sf):
    """The whole committee votes on the documents without a label, each model once."""
    votes = vote.vote_on_unlabeled(_prepared(spark, sf))
    return votes.select("doc_id", "votes0", "votes1", "prediction")


def voted_accuracy(spark, sf):
    return vote.voted_accuracy(_labeled(spark, sf)).select("n_test", "n_correct", _r("accuracy"))


def resubstitution_accuracy(spark, sf):
    measured = vote.resubstitution_accuracy(_labeled(spark, sf))
    return measured.select("n_test", "n_correct", _r("accuracy"))


# --- contract -----------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Trains on the labeled documents and predicts the others."""
    return nb_predict_unlabeled(spark, SMALL)


def _llm_queries() -> dict[str, Query]:
    """The operators for training data, if their package is there."""
    if llm_queries is None:
        return {}
    return llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}


def queries() -> dict[str, Query]:
    """One query for each operator."""
    return {
        "strip_steps": strip_steps,
        "clean_documents": clean_documents,
        "clean_pages": clean_pages,
        "decode_text": decode_text,
        "sentences": sentences,
        "tokens": tokens,
        "stopword_filtered": stopword_filtered,
        "stem_vocabulary": stem_vocabulary,
        "terms_unigram": _terms("unigram"),
        "terms_bigram": _terms("bigram"),
        "terms_alt": _terms("plain"),
        "collocations_top300": collocations_top300,
        "sample_k_per_class": _sample(1000),
        "sample_100_per_class": _sample(100),
        "union_classes": union_classes,
        "label_join": label_join,
        "name_join": name_join,
        "bucket_split": bucket_split,
        "random_split": random_split,
        "corpus_roundtrip": corpus_roundtrip,
        "unlabeled_folder": unlabeled_folder,
        "decoded_folder": decoded_folder,
        "term_frequency": term_frequency,
        "document_frequency": document_frequency,
        "vocabulary": vocabulary,
        "idf": idf,
        "tfidf_l2": tfidf_l2,
        "tfidf_transform_unlabeled": tfidf_transform_unlabeled,
        "tfidf_alternate": tfidf_alternate,
        "feature_count": feature_count,
        "dense_size_estimate": dense_size_estimate,
        "rows_from_triples": rows_from_triples,
        "vector_pipeline": vector_pipeline,
        "vector_blocks": vector_blocks,
        "vocabulary_update": vocabulary_update,
        "tfidf_transform_stored": tfidf_transform_stored,
        "nb_train": nb_train,
        "nb_predict_unlabeled": nb_predict_unlabeled,
        "nb_predict_bigrams": nb_predict_bigrams,
        "nb_holdout_accuracy": _nb_accuracy(),
        "nb_holdout_accuracy_train_fit": _nb_accuracy(fit_on="train"),
        "nb_holdout_accuracy_bigrams": _nb_accuracy("bigram"),
        "svm_one_step": _linear("hinge", 1, train_only=True),
        "svm_one_step_accuracy": _linear_accuracy("hinge", 1),
        "svm_gd3": _linear("hinge", 3),
        "logreg_gd3": _linear("logistic", 3),
        "svm_holdout_accuracy": _linear_accuracy("hinge", 100),
        "logreg_holdout_accuracy": _linear_accuracy("logistic", 100),
        "svm_predict_unlabeled": _linear_predictions("hinge", 100),
        "logreg_predict_unlabeled": _linear_predictions("logistic", 100),
        "svm_gd100": _linear("hinge", 100),
        "logreg_gd100": _linear("logistic", 100),
        "random_forest": _tree_holdout("forest"),
        "forest_nodes": _tree_nodes("forest"),
        "forest_accuracy": _tree_accuracy("forest"),
        "forest_300_accuracy": _tree_accuracy("forest", trees=300),
        "forest_predict_unlabeled": _tree_unlabeled("forest"),
        "gbt": _tree_holdout("boosting"),
        "gbt_nodes_3": _tree_nodes("boosting", iterations=3),
        "gbt_accuracy": _tree_accuracy("boosting"),
        "gbt_predict_unlabeled": _tree_unlabeled("boosting"),
        "prediction_sink": prediction_sink,
        "gnb_bucket_stats": gnb_bucket_stats,
        "gnb_second_round": gnb_second_round,
        "committee_update": committee_update,
        "soft_vote": soft_vote,
        "hard_vote": hard_vote,
        "committee_predict_unlabeled": committee_predict_unlabeled,
        "voted_accuracy": voted_accuracy,
        "resubstitution_accuracy": resubstitution_accuracy,
    } | _llm_queries()


def oracle_sql() -> dict[str, str]:
    """SQL for each query that has a form in SQL."""
    if llm_queries is None:
        return dict(ORACLES)
    piped = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return ORACLES | llm_queries.ORACLES | piped

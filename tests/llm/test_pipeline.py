"""The stages of the pipeline on a small corpus."""

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import words
from tests.llm.test_operators import components_by_hand, cut_by_hand
from tonewright.llm import language_id


def test_stages(spark, docs):
    rows = docs.collect()
    first = corpus_pipeline.STAGES[0][1](spark, docs, "")
    assert first.columns == docs.columns
    kept = first.select("doc_id", "text", "lang").collect()
    letters = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect() if r.text and any(c.isalpha() for c in r.text)]
    assert Counter(map(tuple, kept)) == Counter(letters) and len(kept) < len(rows)
    second = corpus_pipeline.STAGES[1][1](spark, first, "")
    assert second.columns == docs.columns
    one = Counter(r[0] for r in second.select("doc_id").collect())
    expected = Counter(d for (d, _, _, stays), n in components_by_hand(letters).items() if stays for _ in range(n))
    assert one == expected
    third = corpus_pipeline.STAGES[2][1](spark, second, "")
    assert third.columns == docs.columns
    before = [tuple(r) for r in second.select("doc_id", "text", "lang").collect()]
    sizes = Counter({d: n - m for (d, n, m, _, _) in cut_by_hand(before)})
    for r in third.collect():
        assert 0 <= sizes[r.doc_id] - len(r.text.encode()) <= 6 * 40
    fourth = corpus_pipeline.STAGES[3][1](spark, third, "")
    assert fourth.columns == docs.columns and fourth.count() == third.count()
    last = corpus_pipeline.STAGES[4][1](spark, fourth, "")
    assert {r.doc_id for r in last.select("doc_id").collect()} == {r.doc_id for r in fourth.collect()}


def test_documents_without_labels_stay(spark, docs):
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.STAGES[0][1](spark, unlabelled, "")
    assert kept.columns == docs.columns
    expected = Counter((r.doc_id, r.text) for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == expected and len(expected) > 100


def test_near_duplicates_go_by_row(spark):
    """A null id or an id shared with a copy takes no other text along; of equal rows one stays."""
    text = {c: " ".join(words(ord(c), 40)) for c in "abcdefg"}
    rows = [(1, text["a"]), (None, text["a"]), (None, text["b"]), (2, text["a"]), (2, text["c"])]
    rows += [(3, text["d"])] * 3 + [(None, text["e"])] * 2 + [(4, text["f"]), (4, text["f"] + " x"), (None, None)]
    rows += [(None, text["g"]), (None, text["g"] + " y")]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id bigint, text string, label string, row string")
    second = corpus_pipeline.STAGES[1][1](spark, frame.repartition(3), "")
    assert second.columns == frame.columns
    got = Counter((r.doc_id, (r.text or "")[: len(text["f"])]) for r in second.collect() if r.doc_id == 4)
    assert got == {(4, text["f"]): 1}
    got = Counter((r.doc_id, r.text) for r in second.collect() if r.doc_id != 4 and not (r.text or "").startswith(text["g"]))
    assert got == Counter([(1, text["a"]), (None, text["b"]), (2, text["c"]), (3, text["d"]), (None, text["e"]), (None, None)])
    assert second.where(F.col("text").startswith(text["g"])).count() == 1


def test_empty_table(spark, no_docs):
    docs = no_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_stage_order():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "suffix_dedup", "pii", "packing"]
    assert language_id.UNKNOWN == "und"

"""A few whole queries against their SQL on the smallest tables; ``check.py`` runs them all."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import difference, duck

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize(
    "name",
    ["clean_pages", "terms_unigram", "tfidf_l2", "nb_predict_unlabeled", "logreg_gd3", "soft_vote"],
)
def test_query_equals_sql(spark, name):
    got = queries()[name](spark, SMALL).toPandas()
    assert difference(got, duck(SMALL).execute(oracle_sql()[name]).df()) is None


def test_entry(spark):
    assert entry(spark).columns == ["name", "prediction", "score0", "score1"]

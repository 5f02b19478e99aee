import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def corpus(spark):
    rows = [
        (1, "A good film. Good acting, good end!", 1.0),
        (2, "Bad film. Bad acting and a bad end.", 0.0),
        (3, "Really?! A wonderful, moving story.", 1.0),
        (4, "A dull story... wasted actors", 0.0),
        (5, "the and of", 1.0),
        (6, "", 0.0),
        (7, "good good bad", 1.0),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, label double").persist()

import random

import pytest

CLASHING = "node id key kept value bucket row n sketch h virtual_slot size rank block found start length"


def words(seed: int, n: int, size: int = 400) -> list[str]:
    draw = random.Random(seed)
    stock = ["".join(draw.choice("abcdeiorstl") for _ in range(draw.randint(2, 9))) for _ in range(size)]
    return [draw.choice(stock) for _ in range(n)]


def near(text: str, seed: int, changes: int) -> str:
    draw, out = random.Random(seed), text.split()
    for _ in range(changes):
        out[draw.randrange(len(out))] = f"new{draw.randrange(10**6)}"
    return " ".join(out)


def corpus() -> list[tuple]:
    """Documents with copies, near copies, shared passages, nulls, blanks and a very long text."""
    base = " ".join(words(1, 120))
    passage = " ".join(words(2, 60))
    rows = [(i, " ".join(words(100 + i, 20 + 7 * i)) + ".\n" + " ".join(words(300 + i, 15)), "en") for i in range(12)]
    rows += [(20 + i, near(base, i, i % 4), "en") for i in range(40)]
    rows += [(70 + i, " ".join(words(500 + i, 25)) + " " + passage + " " + " ".join(words(600 + i, 10)), "en") for i in range(40)]
    rows += [(120, base, "en"), (121, base, "en"), (121, base, "en"), (122, None, "en"), (123, "", None), (124, "  \n ", "en")]
    rows += [(None, base, "en"), (None, None, None), (125, "one two", "en"), (126, "one two", "en"), (127, "b", None)]
    rows += [(128, "été çà où 日本語 🎉 " * 40, "fr"), (129, " ".join(words(9, 30000)), "en"), (130, "a" * 5000, "en"), (131, "xx" + "a" * 3000, "en")]
    rows += [(132, "\x00\x1c á ΑΣ <|endoftext|> it's I'LL x", "en"), (133, "| | ** && ##\n" * 40, "en")]
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    """The corpus with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string")
    return frame.withColumns({c: F.lit("x") for c in CLASHING.split()}).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def small_tables(spark, docs, tmp_path_factory):
    """A folder of tables as queries read them, with the corpus above as documents."""
    folder = str(tmp_path_factory.mktemp("tables"))
    docs.write.parquet(f"{folder}/documents.parquet")
    target = [(i, " ".join(words(s, n))) for i, (s, n) in enumerate([(1, 50), (2, 30), (104, 40)])]
    spark.createDataFrame([*target, (None, None)], "item_id bigint, text string").write.parquet(
        f"{folder}/benchmark.parquet"
    )
    return folder

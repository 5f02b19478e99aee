"""Quality by weak supervision: rules vote or abstain, and a label model weighs them.

Each rule looks at counts of the whole text and votes for good, for bad, or not at all. Vote
patterns are counted over all documents; expectation-maximisation on these counts estimates how
often each rule casts each vote on good and on bad documents, and a document is kept if it passes the base rules and its posterior chance
of being good is at least one half. No single rule of the model can throw a document out.

Defined results: null and empty texts have no words and fail the base rules; repeated rows get
equal results; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.llm import label_model
from tonewright.sources.workspace import materialize

SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_distinct_words",
    "n_letter_words",
    "n_ends",
    "n_symbol_words",
    "n_other_chars",
)
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_WIDE = re.compile(rb"[\x80-\xbf]")
_END = re.compile(rb"[.!?]")
_PUNCTUATION = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
_USUAL = b".,;:!?'\"()-"


def repeated_words(words: list[bytes]) -> int:
    """Words covered by windows of three words that occur twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen, again = set(), set()
    for window in windows:
        if window in seen:
            again.add(window)
        seen.add(window)
    covered, reach = 0, 0
    for i, window in enumerate(windows):
        if window in again:
            covered += i + 3 - max(i, reach)
            reach = i + 3
    return covered


def counts_of(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``. In UTF-8, the white space of ``bytes.split`` is exactly the space
    and the control characters 9 to 13."""
    body = (text or "").encode()
    words = body.split()
    joined = b"".join(words)
    plain = len(joined) - (0 if joined.isascii() else len(_WIDE.findall(joined)))
    symbols = len(joined) - len(joined.translate(None, SYMBOLS))
    lines = [line for line in body.split(b"\n") if line.strip(b" \t\r\v\f")]
    distinct = set(words)
    lettered = {w for w in distinct if _LETTER.search(w)}
    n_lettered = len(words) if len(lettered) == len(distinct) else sum(w in lettered for w in words)
    return (
        len(words),
        plain,
        symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(distinct),
        n_lettered,
        len(_END.findall(joined)),
        sum(len(w) != len(w.translate(None, SYMBOLS)) for w in words) if symbols else 0,
        len(joined) - len(joined.translate(None, _PUNCTUATION)) - (len(joined) - len(joined.translate(None, _USUAL))),
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, whole.num_rows, 2000):
            batch = whole.slice(begin, 2000)
            rows = [counts_of(text) for text in batch.column(1).to_pylist()]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(COUNTS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["doc_id", *COUNTS]
            )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, tuple[Column, Column]]:
    """Conditions to vote for good and for bad; a rule abstains where neither holds."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    mean = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    dup = F.col("n_dup_lines") / lines
    repeat = F.col("n_repeat_words") / words
    variety = F.col("n_distinct_words") / F.sqrt(words)
    letters = F.col("n_letter_words") / words
    ends = F.col("n_ends") / words
    symbol_words = F.col("n_symbol_words") / words
    others = F.col("n_other_chars") / F.greatest(F.col("word_chars"), F.lit(1))
    several = F.col("n_lines") >= 4
    return {
        "length": (F.col("n_words") >= 80, F.col("n_words") < 50),
        "word_length": ((mean >= 3) & (mean <= 10), (mean < 2.5) | (mean > 14)),
        "symbols": (symbols <= 0.02, symbols > 0.1),
        "duplicate_lines": (several & (dup <= 0.1), several & (dup > 0.3)),
        "repetition": (repeat <= 0.1, repeat > 0.3),
        "variety": (variety >= 3, variety < 1.5),
        "letters": (letters >= 0.9, letters < 0.7),
        "symbol_words": (symbol_words <= 0.01, symbol_words > 0.05),
        "other_characters": (others <= 0.01, others > 0.05),
        "sentences": ((ends >= 0.02) & (ends <= 0.35), (ends == 0) | (ends > 0.6)),
    }


def votes() -> Column:
    """The pattern of votes, a character for each rule."""
    return F.concat(
        *(
            F.when(good, label_model.YES).when(bad, label_model.NO).otherwise(label_model.ABSTAIN)
            for good, bad in rules().values()
        )
    )


def measure(docs: DataFrame) -> DataFrame:
    """Counts and vote pattern of each document."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS)
    return rows.mapInArrow(_count, schema).withColumn("votes", votes())


def judge(docs: DataFrame, least: float = 0.5) -> tuple[DataFrame, label_model.ConditionalModel]:
    """Counts, votes, ``base_failed``, ``quality`` and ``kept`` of all documents, and the model.

    The patterns number three for each rule at most, multiplied, whatever the number of documents,
    so they go to the driver and the posteriors come back by broadcast.
    """
    spark = docs.sparkSession
    measured = materialize(measure(docs), "counts")
    patterns = {r["votes"]: r["count"] for r in measured.groupBy("votes").count().collect()}
    model = label_model.fit_conditional(patterns, len(rules()))
    posteriors = [(p, model.posterior(p)) for p in sorted(patterns)]
    table = spark.createDataFrame(posteriors, "votes string, quality double")
    judged = measured.join(F.broadcast(table), "votes", "left").withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least)), model

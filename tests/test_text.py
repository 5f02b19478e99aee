import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonewright.functions import stem, text
from tonewright.functions.wordlists import STOP_WORDS

CASES = [
    ("Great<br /><br />film", ["great", "film"]),
    ("a <b\nc> d", ["b", "c", "d"]),
    ("5 < 6", []),
    ("Really?! Yes.", ["realli", "?", "!", "ye", "."]),
    ("well... ok", ["well", "...", "ok"]),
    ("don't", []),
    ("cannot", []),
    ("I'm gonna wanna. wanna", ["gon", "na", "wan", "na", ".", "wan", "na"]),
    ("the and of", []),
    ("", []),
    ("12345", []),
    ("Être déçu", ["être", "déçu"]),
    ("a.b x.... y..... z.. w", ["a.b", "x", "...", ".", "y", "...", "..", "z..", "w"]),
]


def test_unigrams(spark):
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = frame.select("i", text.unigrams(F.col("t")).alias("u")).orderBy("i").collect()
    # "m" is no stop word of the 127
    expected = [e if "I'm" not in t else ["m", *e] for t, e in CASES]
    assert [r["u"] for r in got] == expected


@pytest.mark.parametrize(
    "sentence, pairs",
    [
        ("good film. bad end.", ["good film", "film .", "bad end", "end ."]),
        ("good", []),
        ("", []),
    ],
)
def test_bigrams_stay_in_their_sentence(spark, sentence, pairs):
    row = spark.range(1).select(text.bigrams(F.lit(sentence)).alias("b")).first()
    assert row["b"] == pairs


def test_plain_analyzer_drops_sentence_marks(spark):
    row = spark.range(1).select(text.plain_unigrams(F.lit("Well, cannot go... Stop!")).alias("t"))
    assert row.first()["t"] == ["well", "cannot", "go", "stop"]


def test_sentences(spark):
    row = spark.range(1).select(text.sentences(F.lit("One. Two?! three")).alias("s")).first()
    assert row["s"] == ["One.", "Two?!", "three"]


STEMS = """
caresses caress ponies poni ties tie caress caress cats cat feed feed agreed agre plastered plaster
bled bled motoring motor sing sing conflated conflat troubled troubl sized size hopping hop tanned
tan falling fall hissing hiss fizzed fizz failing fail filing file happy happi sky sky relational
relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit conformabli
conform radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam
predication predic operator oper feudalism feudal decisiveness decis hopefulness hope callousness
callous formaliti formal sensitiviti sensit sensibiliti sensibl triplicate triplic formative form
formalize formal electriciti electr electrical electr hopeful hope goodness good revival reviv
allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible
defens irritant irrit replacement replac adjustment adjust dependent depend adoption adopt
communism commun activate activ angulariti angular effective effect bowdlerize bowdler probate
probat rate rate cease ceas controll control roll roll dying die flies fli died die spied spi enjoy
enjoy fli fli used use owed owe is is news news psychology psycholog sensationally sensat
additionally addit nationally nation skies sky beautifully beauti toys toy movies movi exceed exceed
bed bed ing ing ... ... été été
""".split()


def test_stems(spark):
    pairs = list(zip(STEMS[::2], STEMS[1::2]))
    frame = spark.createDataFrame(pairs, "word string, stem string")
    got = frame.withColumn("got", stem.stem_word(F.col("word")))
    assert got.where("got <> stem").collect() == []


def test_stop_words():
    assert len(STOP_WORDS) == len(set(STOP_WORDS)) == 127


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="aB1 .?!<>\n\t'&é", max_size=40), min_size=1, max_size=20))
def test_clean_is_idempotent_and_equals_its_steps(spark, texts):
    raw = F.col("t")
    steps = text.collapse_space(
        text.strip_punctuation(text.strip_digits(text.strip_markup(raw)))
    )
    once = text.clean(raw)
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for row in frame.select(once, text.clean(once), steps).collect():
        assert row[0] == row[1] == row[2]


def test_batches_of_words_get_the_stems_of_the_steps(spark):
    """Endings of every step, short and irregular words, NULL; whole batches take one Python evaluation."""
    words = "caresses ponies dies cats feed agreed plastered motoring sky flying happy say hopping falling".split()
    words += "filing yyed relationalli conditionalli formalli apologi rational triplicate hopeful revival".split()
    words += "adoption controll rate cease us a é été skies dying innings allied ties".split() + ["", "#", "##"]
    rows = spark.createDataFrame([(words, [words[:9], [], words[9:]]), ([None, "cats"], None), (None, [["cats"], None])],
                                 "ws array<string>, wss array<array<string>>")
    flat = rows.select(stem.stem_array(F.col("ws")).alias("a"), stem.stem_by_steps(F.col("ws")).alias("b"))
    assert "ArrowEvalPython" in flat.select("a")._jdf.queryExecution().executedPlan().toString()
    for r in flat.collect():
        assert r["a"] == r["b"]
    nested = F.transform("wss", lambda ws: stem.stem_by_steps(ws))
    for r in rows.select(stem.stem_arrays(F.col("wss")).alias("a"), nested.alias("b")).collect():
        assert r["a"] == r["b"]

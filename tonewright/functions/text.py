"""Cleaning and tokenizing as plain Catalyst expressions.

Everything here maps a string column to a string or array column with built-in functions, so it
runs inside the scan stage: no Python worker, no shuffle, and column pruning still works.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonewright.functions.binding import let
from tonewright.functions.stem import stem_array, stem_arrays
from tonewright.functions.wordlists import (
    ASCII_SPACE,
    CONTRACTIONS,
    PUNCTUATION,
    SPACED_CONTRACTION,
    STOP_WORDS,
    UNICODE_SPACE,
)

Analyzer = Callable[[Column], Column]

_PUNCT_CLASS = re.escape(PUNCTUATION)
_NOISE = f"[0-9{_PUNCT_CLASS}{ASCII_SPACE}]+"
_TOKEN_GAP = f"[{ASCII_SPACE}{UNICODE_SPACE}]+"
_NOT_WORD_BEFORE = "(?<![A-Za-z0-9_])"
_NOT_WORD_AFTER = "(?![A-Za-z0-9_])"
_CONTRACTION = (
    f"{_NOT_WORD_BEFORE}("
    + "|".join(f"{a}(?={b}{_NOT_WORD_AFTER})" for a, b in CONTRACTIONS)
    + f"|{SPACED_CONTRACTION[0]}(?={SPACED_CONTRACTION[1]}(?:[{ASCII_SPACE}]|\\z))"
    + ")"
)


def strip_markup(text: Column) -> Column:
    """Each tag becomes one space; a tag never spans lines."""
    return F.regexp_replace(text, r"<[^>\n]*>", " ")


def strip_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[0-9]+", " ")


def strip_punctuation(text: Column) -> Column:
    """Punctuation becomes space, but ``? ! .`` stay to keep the sentence structure."""
    return F.regexp_replace(text, f"[{_PUNCT_CLASS}]", " ")


def collapse_space(text: Column) -> Column:
    return F.regexp_replace(text, f"[{ASCII_SPACE}]+", " ")


def clean(text: Column) -> Column:
    """Markup, digits, punctuation and runs of white space each become a single space.

    The last three steps all end in one space, so any mixed run of those characters is replaced
    in one pass over the text instead of three.
    """
    return F.regexp_replace(strip_markup(text), _NOISE, " ")


def decode(raw: Column) -> Column:
    """UTF-8 text of a binary column."""
    return F.decode(raw, "UTF-8")


def sentences(cleaned: Column) -> Column:
    """Sentences of a cleaned text: a break follows ``. ? !`` before a space."""
    return F.filter(F.split(cleaned, r"(?<=[.?!]) "), lambda s: F.trim(s) != "")


def _spaced_words(text: Column) -> Column:
    """Lower-cased text with one sentence to a line and a space at every word boundary.

    Working on the whole text instead of on each sentence keeps the regular expressions out of
    higher-order functions and so inside whole-stage codegen. Cleaned text has no line feed,
    which leaves it free to mark the sentence breaks.
    """
    lined = F.regexp_replace(F.lower(clean(text)), r"(?<=[.?!]) ", "\n")
    dots = F.replace(lined, F.lit("..."), F.lit(" ... "))
    stops = F.regexp_replace(dots, r"(?<![.])[.](?=\n|\z)", " .")
    marks = F.regexp_replace(stops, r"[?!]", " $0 ")
    return F.regexp_replace(marks, _CONTRACTION, "$1 ")


def tokens(text: Column) -> Column:
    """Lower-cased word tokens, with ``.``, ``?``, ``!`` and ``...`` as tokens."""
    return F.filter(F.split(_spaced_words(text), _TOKEN_GAP), lambda t: t != "")


def sentence_tokens(text: Column) -> Column:
    """Tokens as an array for each sentence."""
    return F.transform(
        F.split(_spaced_words(text), "\n"),
        lambda s: F.filter(F.split(s, _TOKEN_GAP), lambda t: t != ""),
    )


def drop_stop_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.filter(words, lambda t: (t != "") & ~t.isin(*stop_words))


def unigrams(text: Column) -> Column:
    """Stemmed terms in text order, duplicates kept."""
    return F.filter(stem_array(drop_stop_words(tokens(text))), lambda t: t != "")


def adjacent_pairs(words: Column) -> Column:
    """Neighbours joined by a space."""
    return let(
        words,
        lambda ws: F.transform(
            F.slice(ws, F.lit(1), F.greatest(F.size(ws) - 1, F.lit(0))),
            lambda w, i: F.concat(w, F.lit(" "), F.get(ws, i + 1)),
        ),
    )


def sentence_terms(text: Column) -> Column:
    """Stemmed terms as an array for each sentence."""
    words = F.transform(sentence_tokens(text), lambda s: drop_stop_words(s))
    return F.transform(stem_arrays(words), lambda s: F.filter(s, lambda t: t != ""))


def bigrams(text: Column) -> Column:
    """Pairs of neighbouring terms; no pair crosses a sentence break."""
    return F.flatten(F.transform(sentence_terms(text), adjacent_pairs))


def plain_unigrams(text: Column) -> Column:
    """Simpler analyzer: sentence marks are removed and words are what spaces separate."""
    unmarked = F.regexp_replace(F.lower(clean(text)), r"[?!.]+", "")
    words = F.split(unmarked, " +")
    return F.filter(stem_array(drop_stop_words(words)), lambda t: t != "")


ANALYZERS: dict[str, Analyzer] = {
    "unigram": unigrams,
    "bigram": bigrams,
    "plain": plain_unigrams,
}


def analyzer(choice: str | Analyzer = "unigram") -> Analyzer:
    """An analyzer by name, or the given callable."""
    if callable(choice):
        return choice
    return ANALYZERS[choice]

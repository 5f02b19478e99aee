"""Porter stemming as Catalyst expressions.

Each step maps a word to a word with ``CASE``, suffix tests and look-around-free regular
expressions. On arrays the steps are chained with ``transform``: a step's input is then a bound
lambda variable, so no expression is copied into the next one and the plan stays small.

The rules are those of Porter (1980) with the later ``bli``/``logi`` rules and the usual
extensions: a list of irregular words, ``ies``/``ied`` of four-letter words, final ``y`` after a
consonant, ``alli`` and ``fulli``, and two-letter stems such as ``us(e)``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from tonewright.functions.binding import let
from tonewright.functions.wordlists import IRREGULAR_STEMS

# A ``y`` counts as a vowel after a consonant and as a consonant elsewhere. The alternatives never
# overlap, so the patterns have a single way to match.
_HAS_VOWEL = "^(?:[^aeiou][^aeiouy]*[aeiouy]|[aeiou])"
_ONE_GROUP = _HAS_VOWEL + "[aeiou]*[^aeiou]"
_TWO_GROUPS = _ONE_GROUP + "[^aeiouy]*[aeiouy][aeiou]*[^aeiou]"
_EXACTLY_ONE = _ONE_GROUP + r"[^aeiouy]*(?:[aeiouy][aeiou]*)?\z"
_SHORT_END = r"^(?:[^aeiou][^aeiouy]*[aeiouy][^aeiouwxy]|[aeiou][^aeiou])\z"

# Suffix -> replacement, longer suffixes before those they end in. A rule applies
# when the rest of the word has at least one vowel-consonant group.
STEP2_SUFFIXES = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "fulli": "ful",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
}
STEP3_SUFFIXES = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
# Removed when the rest has at least two vowel-consonant groups.
STEP4_SUFFIXES = (
    "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize".split()
)


def _cut(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _ends(word: Column, suffix: str) -> Column:
    return F.endswith(word, F.lit(suffix))


def _by_ending(
    word: Column, suffixes: Iterable[str], branch: Callable[[str], Column]
) -> Column:
    """``CASE`` over suffixes, first by their last two letters.

    Most words end in none of them, so one hash lookup settles those, and the others are compared
    with the few suffixes that share their ending. Suffix order is kept within an ending.
    """
    groups: dict[str, list[str]] = {}
    for suffix in suffixes:
        groups.setdefault(suffix[-2:], []).append(suffix)
    case = F.when(~F.substring(word, -2, 2).isin(*groups), word)
    for ending, group in groups.items():
        inner = None
        for suffix in group:
            test = (_ends(word, suffix), branch(suffix))
            inner = F.when(*test) if inner is None else inner.when(*test)
        case = case.when(_ends(word, ending), inner.otherwise(word))
    return case.otherwise(word)


def _without(word: Column, suffix: str, pattern: str, new: str = "") -> Column:
    """The word with its suffix replaced if what is left of it matches, else the word."""
    rest = _cut(word, len(suffix))
    return F.when(rest.rlike(pattern), F.concat(rest, F.lit(new)) if new else rest).otherwise(word)


def step_plural(w: Column) -> Column:
    return (
        F.when(~_ends(w, "s") | _ends(w, "ss") & ~_ends(w, "sses"), w)
        .when(_ends(w, "sses"), _cut(w, 2))
        .when(_ends(w, "ies"), F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
        .otherwise(_cut(w, 1))
    )


def step_past(w: Column) -> Column:
    """Cuts ``ed`` and ``ing``, leaving a ``#`` where :func:`step_repair` may mend the end."""
    return (
        F.when(~(_ends(w, "ed") | _ends(w, "ing")), w)
        .when(_ends(w, "ied"), F.when(F.length(w) == 4, _cut(w, 1)).otherwise(_cut(w, 2)))
        .when(_ends(w, "eed"), F.when(_cut(w, 3).rlike(_ONE_GROUP), _cut(w, 1)).otherwise(w))
        .when(_ends(w, "ed") & _cut(w, 2).rlike(_HAS_VOWEL), F.concat(_cut(w, 2), F.lit("#")))
        .when(_ends(w, "ing") & _cut(w, 3).rlike(_HAS_VOWEL), F.concat(_cut(w, 3), F.lit("#")))
        .otherwise(w)
    )


def step_repair(w: Column) -> Column:
    last = F.substring(w, -2, 1)
    doubled = (last == F.substring(w, -3, 1)) & (
        ~last.isin(*"aeiouy") | w.rlike(r"[^aeiouy]yy#\z")
    )
    return (
        F.when(~_ends(w, "#"), w)
        .when(w.rlike(r"(?:at|bl|iz)#\z"), F.concat(_cut(w, 1), F.lit("e")))
        .when(doubled & (F.length(w) > 2), F.when(last.isin(*"lsz"), _cut(w, 1)).otherwise(_cut(w, 2)))
        .when(_cut(w, 1).rlike(_SHORT_END), F.concat(_cut(w, 1), F.lit("e")))
        .otherwise(_cut(w, 1))
    )


def step_y(w: Column) -> Column:
    turned = w.rlike(r".(?:[^aeiouy]|[aeiou]y)y\z") | w.rlike(r"^.[^aeiouy]y\z")
    return F.when(_ends(w, "y") & turned, F.concat(_cut(w, 1), F.lit("i"))).otherwise(w)


def _alli(w: Column) -> Column:
    """``alli`` becomes ``al``, and the step then starts again on the shorter word."""
    return (
        F.when(_ends(w, "ationalli"), _without(w, "ationalli", _ONE_GROUP, "ate"))
        .when(_ends(w, "tionalli"), _without(w, "tionalli", _ONE_GROUP, "tion"))
        .otherwise(w)
    )


def step_two(w: Column) -> Column:
    def branch(suffix: str) -> Column:
        if suffix == "alli":
            again = _alli(w)
            return F.when(_ends(w, "tionalli") & (again != w), again).otherwise(
                _without(w, "alli", _ONE_GROUP, "al")
            )
        if suffix == "logi":
            return F.when(_cut(w, 3).rlike(_ONE_GROUP), _cut(w, 1)).otherwise(w)
        return _without(w, suffix, _ONE_GROUP, STEP2_SUFFIXES[suffix])

    return _by_ending(w, [*STEP2_SUFFIXES, "alli", "logi"], branch)


def step_three(w: Column) -> Column:
    return _by_ending(
        w, STEP3_SUFFIXES, lambda s: _without(w, s, _ONE_GROUP, STEP3_SUFFIXES[s])
    )


def step_four(w: Column) -> Column:
    def branch(suffix: str) -> Column:
        # Only "ion" is cut from "sion" and "tion".
        return _without(w, "ion" if suffix in ("sion", "tion") else suffix, _TWO_GROUPS)

    return _by_ending(w, [*STEP4_SUFFIXES, "sion", "tion"], branch)


def step_final_e(w: Column) -> Column:
    rest = _cut(w, 1)
    dropped = rest.rlike(_TWO_GROUPS) | (rest.rlike(_EXACTLY_ONE) & ~rest.rlike(_SHORT_END))
    return F.when(_ends(w, "e") & dropped, rest).otherwise(w)


def step_final_ll(w: Column) -> Column:
    return F.when(_ends(w, "ll") & w.rlike(_TWO_GROUPS), _cut(w, 1)).otherwise(w)


STEPS = (
    step_plural,
    step_past,
    step_repair,
    step_y,
    step_two,
    step_three,
    step_four,
    step_final_e,
    step_final_ll,
)


def finish(word: Column, stemmed: Column) -> Column:
    """Words of one or two letters stay, irregular words have their own stem."""
    by_stem: dict[str, list[str]] = {}
    for irregular, stem in IRREGULAR_STEMS.items():
        by_stem.setdefault(stem, []).append(irregular)
    own = None
    for stem, forms in by_stem.items():
        test = (word.isin(*forms), F.lit(stem))
        own = F.when(*test) if own is None else own.when(*test)
    return (
        F.when(F.length(word) <= 2, word).when(word.isin(*IRREGULAR_STEMS), own).otherwise(stemmed)
    )


def stem_by_steps(words: Column) -> Column:
    """Stem of every element of an array of lower-cased words, as expressions: what :func:`stem_array`
    is held against."""

    def stems(bound: Column) -> Column:
        stemmed = bound
        for step in STEPS:
            stemmed = F.transform(stemmed, step)
        return F.zip_with(bound, stemmed, finish)

    return let(words, stems)


def python_stemmer() -> Callable[[str], str]:
    """The steps for a single word. All is inside, so that workers need no package to run it."""
    has_vowel, short_end = (re.compile(x.replace(r"\z", r"\Z")).search for x in (_HAS_VOWEL, _SHORT_END))
    one_group, two_groups = re.compile(_ONE_GROUP).search, re.compile(_TWO_GROUPS).search
    exactly_one = re.compile(_EXACTLY_ONE.replace(r"\z", r"\Z")).search
    mend = re.compile(r"(?:at|bl|iz)#\Z").search
    double_y = re.compile(r"[^aeiouy]yy#\Z").search
    turned = re.compile(r".(?:[^aeiouy]|[aeiou]y)y\Z|^.[^aeiouy]y\Z").search
    irregular = dict(IRREGULAR_STEMS)
    two, three = dict(STEP2_SUFFIXES), dict(STEP3_SUFFIXES)

    def by_ending(suffixes: Iterable[str]) -> dict[str, list[str]]:
        groups: dict[str, list[str]] = {}
        for suffix in suffixes:
            groups.setdefault(suffix[-2:], []).append(suffix)
        return groups

    second = by_ending([*two, "alli", "logi"])
    third, fourth = by_ending(three), by_ending([*STEP4_SUFFIXES, "sion", "tion"])

    def suffix_of(w: str, groups: dict[str, list[str]]) -> str | None:
        return next((s for s in groups.get(w[-2:], ()) if w.endswith(s)), None)

    def cut(w: str, n: int) -> str:
        return w[: max(len(w) - n, 0)]

    def without(w: str, suffix: str, fits: Callable, new: str = "") -> str:
        rest = cut(w, len(suffix))
        return rest + new if fits(rest) else w

    def plural(w: str) -> str:
        if not w.endswith("s") or w.endswith("ss") and not w.endswith("sses"):
            return w
        if w.endswith("sses"):
            return cut(w, 2)
        return cut(w, 2) if w.endswith("ies") and len(w) != 4 else cut(w, 1)

    def past(w: str) -> str:
        if w.endswith("ied"):
            return cut(w, 1 if len(w) == 4 else 2)
        if w.endswith("eed"):
            return cut(w, 1) if one_group(cut(w, 3)) else w
        if w.endswith("ed") and has_vowel(cut(w, 2)):
            return cut(w, 2) + "#"
        if w.endswith("ing") and has_vowel(cut(w, 3)):
            return cut(w, 3) + "#"
        return w

    def repair(w: str) -> str:
        if not w.endswith("#"):
            return w
        if mend(w):
            return cut(w, 1) + "e"
        last, before = w[-2:-1], w[-3:-2]
        if last == before and (last not in tuple("aeiouy") or double_y(w)) and len(w) > 2:
            return cut(w, 1) if last in tuple("lsz") else cut(w, 2)
        return cut(w, 1) + "e" if short_end(cut(w, 1)) else cut(w, 1)

    def step_2(w: str) -> str:
        suffix = suffix_of(w, second)
        if suffix is None:
            return w
        if suffix == "logi":
            return cut(w, 1) if one_group(cut(w, 3)) else w
        if suffix == "alli":
            again = w
            if w.endswith("ationalli"):
                again = without(w, "ationalli", one_group, "ate")
            elif w.endswith("tionalli"):
                again = without(w, "tionalli", one_group, "tion")
            return again if again != w else without(w, "alli", one_group, "al")
        return without(w, suffix, one_group, two[suffix])

    def stem(word: str) -> str:
        if len(word) <= 2:
            return word
        if word in irregular:
            return irregular[word]
        w = repair(past(plural(word)))
        if w.endswith("y") and turned(w):
            w = cut(w, 1) + "i"
        w = step_2(w)
        suffix = suffix_of(w, third)
        if suffix is not None:
            w = without(w, suffix, one_group, three[suffix])
        suffix = suffix_of(w, fourth)
        if suffix is not None:
            w = without(w, "ion" if suffix in ("sion", "tion") else suffix, two_groups)
        rest = cut(w, 1)
        if w.endswith("e") and (two_groups(rest) or exactly_one(rest) and not short_end(rest)):
            w = rest
        return cut(w, 1) if w.endswith("ll") and two_groups(w) else w

    return stem


#: Words whose stems a task keeps.
_KEPT = 500_000


def _stem_batches(depth: int) -> Callable[[pa.Array], pa.Array]:
    """Stems of the words of a batch of arrays, ``depth`` deep; each word that a task meets is stemmed once."""
    stem, known, most = python_stemmer(), {}, _KEPT

    def stems(words: pa.Array) -> pa.Array:
        coded = words.dictionary_encode()
        if len(known) > most:
            known.clear()
        found = []
        for word in coded.dictionary.to_pylist():
            if word not in known:
                known[word] = stem(word)
            found.append(known[word])
        return pa.array(found, pa.string()).take(coded.indices)

    def mapped(arrays: pa.Array, depth: int) -> pa.Array:
        if not depth:
            return stems(arrays)
        lengths = arrays.value_lengths().fill_null(0)
        ends = pc.cumulative_sum(lengths)
        offsets = pa.concat_arrays([pa.array([0], ends.type), ends]).cast(pa.int32())
        inner = mapped(arrays.flatten(), depth - 1)
        return pa.ListArray.from_arrays(offsets, inner, mask=arrays.is_null())

    def stemmed(arrays: pa.Array) -> pa.Array:
        return mapped(arrays, depth)

    return stemmed


def stem_array(words: Column) -> Column:
    """Stem of every element of an array of lower-cased words. Not for use inside a lambda."""
    return F.arrow_udf(_stem_batches(1), "array<string>")(words)


def stem_arrays(words: Column) -> Column:
    """As :func:`stem_array`, for an array of arrays."""
    return F.arrow_udf(_stem_batches(2), "array<array<string>>")(words)


def stem_word(word: Column) -> Column:
    """Stem of one word."""
    return F.get(stem_array(F.array(word)), F.lit(0))

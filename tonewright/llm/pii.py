"""Personal data by patterns and by weak supervision.

The base patterns always count. Beyond them, tokens that look as if they held something private are
candidates. Labelers of three sorts vote on each candidate or abstain: patterns, a gazetteer of words
that announce such data, and the context. Expectation-maximisation on the counts of vote patterns
estimates how reliable the labelers are; the resulting chances train a span classifier (logistic
regression on binary features), which decides by the features alone. Base spans stay in any case and
take no part in the training: they are certain, and would make all else look private.

Votes and features have a fixed number of patterns, so only their counts go to the driver, however
large the corpus.

Defined results: null and empty texts have no spans; spans count code points, with the end
exclusive; repeated rows get equal results; texts of any length are scanned in linear time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import exp, log, log2

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonewright.llm import label_model
from tonewright.llm.batches import giving_back, parts

#: In the order in which spans are listed.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE = 4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]{8,}+|\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}")
_KNOWN = re.compile(r"AKIA[0-9A-Z]{16}|[0-9a-f]{32,}|[0-9A-F]{32,}|gh[pousr]_[A-Za-z0-9]{30,}|sk-[A-Za-z0-9-]{20,}")
_HEX = re.compile(r"[0-9a-fA-F]{20,}")
#: Words that announce private data, the gazetteer.
ANNOUNCING = ("token", "secret", "password", "passwd", "pwd", "key", "apikey", "auth", "credential",
              "phone", "tel", "mobile", "fax", "email", "mail", "card", "iban", "account", "ssn")
_ANNOUNCED = re.compile(r"(?i)\b(?:" + "|".join(ANNOUNCING) + r")\b[^A-Za-z]{0,6}$")
_ASSIGNED = re.compile(r"[=:]\s{0,2}[\"']?$")
#: What looks like a token and is none: dates, numbers, and names with numbers such as versions.
_DATE = re.compile(r"[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}(?:T[0-9]+)?|[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4}")
_NUMBER = re.compile(r"[+-]?[0-9]+(?:[-/_][0-9]+)*")
_NAMED = re.compile(r"[A-Za-z]+(?:[-_/][A-Za-z]+)*[-_/]?[0-9]+(?:[-_/](?:[A-Za-z]+|[0-9]+))*")
_PLAIN = re.compile(r"[a-z]{2,}[,.]?\s$")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@domain`` in time linear in the text: the leftmost start for
    an ``@`` is where the run of allowed characters before it begins, or the last match ended."""
    spans, done, at = [], 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in _LOCAL:
            begin -= 1
        match = _DOMAIN.match(text, at + 1) if begin < at else None
        if match:
            spans.append((begin, match.end()))
            done = match.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return spans


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base patterns, by kind and start."""
    found = [(0, s, e) for s, e in _emails(text)]
    for match in _IP.finditer(text) if "." in text else ():
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in match[0].split(".")):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() >= 13:
            digits = match[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, *match.span()))
    for match in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
            found.append((3, *match.span()))
    return found


def _entropy(token: str) -> float:
    n = len(token)
    return -sum(c / n * log2(c / n) for c in (token.count(x) for x in set(token)))


def votes_and_features(text: str, start: int, end: int) -> tuple[str, int]:
    """What the labelers say about a span, and its features as bits."""
    token = text[start:end]
    before, after = text[max(0, start - 24) : start], text[end : end + 1]
    digits = sum(c.isdigit() for c in token)
    upper = sum(c.isupper() for c in token)
    known = bool(_KNOWN.fullmatch(token))
    announced = bool(_ANNOUNCED.search(before))
    assigned = bool(_ASSIGNED.search(before))
    quoted = before[-1:] in "\"'" and after in "\"'" and bool(before and after)
    surprising = len(token) >= 16 and digits >= 3 and digits < len(token) and _entropy(token) > 3.0
    phone = bool(_LOCAL_PHONE.fullmatch(token))
    date, number = bool(_DATE.fullmatch(token)), bool(_NUMBER.fullmatch(token)) and not phone
    named = bool(_NAMED.fullmatch(token))
    changes = sum(x.isdigit() != y.isdigit() for x, y in zip(token, token[1:], strict=False))
    yes, no, none = label_model.YES, label_model.NO, label_model.ABSTAIN
    votes = (
        yes if known or phone else none,
        yes if announced else none,
        yes if assigned or quoted else no if _PLAIN.search(before) and not (known or phone) else none,
        yes if surprising else no if len(token) < 16 and not phone else none,
        no if date or number else none,
        no if named else none,
        no if phone is False and changes <= 2 else yes if changes >= 6 and not date else none,
    )
    features = (
        date or number, named, 2 * digits >= len(token), bool(_HEX.fullmatch(token)) and not number,
        upper >= 4 and digits >= 2, announced, assigned or quoted, len(token) >= 20, phone,
        surprising,
    )
    return "".join(votes), sum(1 << i for i, f in enumerate(features) if f)


LABELERS, FEATURES = 7, 10
#: What a labeler's vote is taken to be worth before any is seen: how often it votes yes and no, for
#: private spans and for others. It keeps the classes apart where the corpus has one of them only.
BELIEF = {label_model.YES: (0.45, 0.05), label_model.NO: (0.05, 0.45), label_model.ABSTAIN: (0.5, 0.5)}


def _union(base: list[tuple[int, int, int]]) -> list[list[int]]:
    """The stretches that base spans cover, apart from each other and in order."""
    out: list[list[int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, str, int, bool]]:
    """``(kind, start, end, votes, features, base)`` of base spans, which have no votes, and of
    suspicious tokens beside them."""
    out = [(k, s, e, "", 0, True) for k, s, e in base]
    taken = _union(base)
    at = 0
    for match in _CANDIDATE.finditer(text):
        s, e = match.span()
        token = match[0]
        if token.isalpha() or sum(map(str.isdigit, token)) < 2:
            continue
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if at < len(taken) and taken[at][0] < e:
            continue
        kind = 3 if _LOCAL_PHONE.fullmatch(token) else 4
        out.append((kind, s, e, *votes_and_features(text, s, e), False))
    return out


_SCHEMA = (
    "array<struct<kind: int, start: int, end: int, votes: string, features: int, base: boolean>>"
)
_DIGIT = re.compile(r"[0-9]")


@giving_back
def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "end", "votes", "features", "base")
    kind = pa.list_(
        pa.struct(
            [("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.string()),
             ("features", pa.int32()), ("base", pa.bool_())]
        )
    )
    for batch in (part for whole in batches for part in parts(whole, 1)):
        out = []
        for text in batch.column(1).to_pylist():
            if not text or not (_DIGIT.search(text) or "@" in text):
                out.append([])
                continue
            found = candidates(text, base_spans(text))
            out.append([dict(zip(names, c, strict=True)) for c in found])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["row", "found"])


def train(patterns: list[tuple[str, int, int]], rounds: int = 300) -> tuple[label_model.ConditionalModel, list[float]]:
    """Label model and weights of the span classifier (features, then the intercept).

    ``patterns`` are ``(votes, features, count)``; the classifier takes gradient steps on the
    expected log loss under the label model's chances.
    """
    totals: dict[str, int] = {}
    for votes, _, n in patterns:
        totals[votes] = totals.get(votes, 0) + n
    model = label_model.fit_conditional(totals, LABELERS, belief=BELIEF)
    weights = [0.0] * (FEATURES + 1)
    total = sum(n for _, _, n in patterns)
    rows = [
        ([i for i in range(FEATURES) if f >> i & 1] + [FEATURES], n, model.posterior(v))
        for v, f, n in sorted(patterns)
    ]
    for _ in range(rounds if total else 0):
        gradient = [1e-4 * w for w in weights]
        for on, n, p in rows:
            z = sum(weights[i] for i in on)
            error = n / total * (1 / (1 + exp(-max(-60.0, min(60.0, z)))) - p)
            for i in on:
                gradient[i] += error
        weights = [w - 2.0 * g for w, g in zip(weights, gradient, strict=True)]
    return model, weights


def accepted(weights: list[float], least: float = 0.5) -> list[int]:
    """The feature patterns that the classifier takes for private."""
    odds = log(least / (1 - least))
    return [
        f for f in range(1 << FEATURES)
        if weights[FEATURES] + sum(weights[i] for i in range(FEATURES) if f >> i & 1) >= odds
    ]


def _found(docs: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    rows = docs.select(F.struct(*carry).alias("row"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(_find, f"row {kind}, found {_SCHEMA}")


def find(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``row`` (the carried columns), ``base`` and ``spans``: arrays of ``(kind, start, end)``.

    The texts are scanned twice, to train and to decide, and not stored or shuffled.
    """
    seen = _found(docs, ("doc_id",)).select(F.explode("found").alias("c")).where("NOT c.base")
    counted = seen.groupBy("c.votes", "c.features").count()
    _, weights = train([tuple(r) for r in counted.collect()])  # at most 3^7 * 2^10 patterns
    codes = F.lit([-1, *accepted(weights)])
    found = _found(docs, carry)
    plain = lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
    base = F.transform(F.filter("found", lambda c: c["base"]), plain)
    taken = F.filter("found", lambda c: c["base"] | F.array_contains(codes, c["features"]))
    return found.select(
        "row", F.array_sort(base).alias("base"), F.array_sort(F.transform(taken, plain)).alias("spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(spans, lambda c: F.concat_ws(":", F.element_at(names, c["kind"] + 1), c["start"], c["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda c: c["kind"] == KINDS.index(kind))).cast("bigint")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets. What sticks out of a span that is
    replaced already is replaced by its own kind; spans inside others leave no mark. Positions are
    code points, as in Spark's own strings."""
    names = F.array(*(F.lit(f"[{k.upper()}]") for k in KINDS))
    by_start = F.array_sort(
        F.transform(spans, lambda c: F.struct(c["start"].alias("s"), (-c["end"]).alias("e"), c["kind"].alias("k")))
    )
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done: Column, c: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(c["s"] - done["at"], F.lit(0)))
        new = F.struct(
            F.concat(done["out"], gap, F.element_at(names, c["k"] + 1)).alias("out"), (-c["e"]).alias("at")
        )
        return F.when(-c["e"] > done["at"], new).otherwise(done)

    rest = lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(by_start, state, step, rest))

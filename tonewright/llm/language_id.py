"""Language identification by cross-parsing with suffix automata.

Each language has a suffix automaton of labelled text. A new text is parsed against it into the
longest phrases that occur in that text: the automaton follows the symbols until there is no
transition, which ends a phrase, and starts again. The language that needs the fewest phrases for
each symbol, weighted by the logarithm of its sample's length, has the lowest cross-parsing entropy
and wins.

Texts are parsed whole. They are cut into blocks of ``BLOCK`` symbols that start at the root, so
that one step moves all blocks of a batch at once; a cut adds at most one phrase, the same for all
languages, and so does a cut of a long text after each ``CHARACTERS``, which bound the memory.
Each letter of the samples counts by itself in lower case, whatever their number, letters that no
sample has as one, and all else as one gap.

The model is fitted on a bounded sample: of each of the ``LANGUAGES`` most frequent languages,
``PIECES`` distinct texts with the smallest hashes give up to ``PIECE`` characters each, from a place
that the hash picks, up to ``SYMBOLS`` symbols, or ``TOTAL`` over all languages. Counting and choosing
cover all rows. The arcs of the automata are kept sparse, at most three for each symbol,
in an array of twice their number.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text
when nothing is labelled; ties go to the first language by name; repeated rows get equal results.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from math import log2

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tonewright.llm import batches as limits

LANGUAGES = 256
PIECES = 64
PIECE = 1000
SYMBOLS = 24_000
TOTAL = 600_000
BLOCK = 512
LANES = 2048
CHARACTERS = 1 << 20
UNKNOWN = "und"


class Automaton:
    """A suffix automaton: its arcs in the order of state and symbol, those of the root apart."""

    def __init__(self, sample: list[int], size: int):
        link, length, moves = [-1], [0], [{}]
        last = 0
        for c in sample:
            new = len(moves)
            moves.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    copy = len(moves)
                    moves.append(dict(moves[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        self.size = size
        self.root = np.zeros(size, dtype=np.int64)
        for c, to in moves[0].items():
            self.root[c] = to
        self._place(moves)

    def _place(self, moves: list[dict[int, int]]) -> None:
        """Puts the arcs of all states but the root into one array, each state's at its own shift by
        symbol, so that no two arcs meet: the states with the most arcs first, at the first shift that is free."""
        n = 2 * sum(map(len, moves)) + 2 * self.size
        taken = bytearray(n + self.size)
        self.shift = np.zeros(len(moves), dtype=np.int64)
        self.owner = np.full(n + self.size, -1, dtype=np.int64)
        self.to = np.zeros(n + self.size, dtype=np.int64)
        begin = 0
        for state in sorted(range(1, len(moves)), key=lambda x: (-len(moves[x]), x)):
            arcs = list(moves[state])
            shift = begin
            while any(taken[shift + c] for c in arcs):
                shift = (shift + 1) % n
            if len(arcs) > 1 or shift != begin:
                begin = (begin + 7919) % n  # free places are found soon if they aren't sought from the same end
            self.shift[state] = shift
            for c in arcs:
                taken[shift + c] = 1
                self.owner[shift + c] = state
                self.to[shift + c] = moves[state][c]

    def phrases(self, steps: np.ndarray) -> np.ndarray:
        """How many phrases each lane has; a step holds a symbol of every lane, the last is padding."""
        state = np.zeros(steps.shape[1], dtype=np.int64)
        begun = np.zeros(steps.shape[1], dtype=np.int64)
        for symbols in steps:
            at = self.shift.take(state)
            at += symbols
            goes_on = self.owner.take(at) == state
            begun += ~goes_on
            state = np.where(goes_on, self.to.take(at), self.root.take(symbols))
        return begun - (steps == self.size - 1).sum(axis=0)


class Parser:
    """The automata of all languages, and the parsing of many texts at once."""

    def __init__(self, samples: dict[str, str]):
        self.names = sorted(samples)
        # 0 is the gap, 1 a letter that no sample has, the last the padding
        self.symbol = np.fromiter(
            (unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), np.int32, 0x110000
        )
        points = [self._points(text) for text in samples.values()]
        letters = np.unique(np.concatenate(points)) if points else np.empty(0, dtype=np.uint32)
        letters = letters[self.symbol[letters] == 1]
        self.symbol[letters] = np.arange(2, len(letters) + 2)
        self.size = len(letters) + 3
        limit = min(SYMBOLS, TOTAL // max(1, len(samples)))
        self.automata, self.bits = [], []
        for name in self.names:
            sample = self._symbols(samples[name])[0][:limit]
            self.automata.append(Automaton(sample.tolist(), self.size))
            self.bits.append(log2(max(2, len(sample))))

    @staticmethod
    def of(samples: dict[str, str]) -> Parser:
        return limits.sole(("language", tuple(sorted(samples.items()))), lambda: Parser(samples))

    @staticmethod
    def _points(text: str) -> np.ndarray:
        return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)

    def _symbols(self, text: str) -> tuple[np.ndarray, bool]:
        """Symbols with single gaps, and whether there is a letter."""
        symbols = self.symbol[self._points(text)]
        keep = symbols != 0
        keep[1:] |= keep[:-1].copy()
        return symbols[keep], bool((symbols != 0).any())

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases by language and text, for symbols of texts; ``LANES`` blocks at a time."""
        blocks = np.array([-(-len(s) // BLOCK) for s in texts], dtype=np.int64)
        owner = np.repeat(np.arange(len(texts)), blocks)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        counts = np.zeros((len(self.automata), len(texts)), dtype=np.int64)
        for begin in range(0, len(owner), LANES):
            own, at = owner[begin : begin + LANES], place[begin : begin + LANES]
            steps = np.full((BLOCK, len(own)), self.size - 1, dtype=np.int32)
            for lane, (i, k) in enumerate(zip(own.tolist(), at.tolist(), strict=True)):
                block = texts[i][k * BLOCK : (k + 1) * BLOCK]
                steps[: len(block), lane] = block
            for l, automaton in enumerate(self.automata):
                np.add.at(counts[l], own, automaton.phrases(steps))
        return counts

    def parse(self, texts: list[str | None]) -> tuple[list[str], list[float], list[bool]]:
        """Language and score of each text, and whether it has a letter. The score is the share of
        the best language if each bit of code length halves the odds."""
        names, scores, letters = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        sizes = np.zeros(len(texts), dtype=np.int64)
        counts = np.zeros((len(self.names), len(texts)), dtype=np.int64)
        for begin, end in limits.cuts([min(len(t or ""), CHARACTERS) for t in texts], len(texts), CHARACTERS):
            longest = max(len(t or "") for t in texts[begin:end])
            for at in range(0, longest, CHARACTERS):
                found = [self._symbols((t or "")[at : at + CHARACTERS]) for t in texts[begin:end]]
                sizes[begin:end] += [len(s) for s, _ in found]
                letters[begin:end] = [a or b for a, (_, b) in zip(letters[begin:end], found, strict=True)]
                if self.names:
                    counts[:, begin:end] += self.phrases([s for s, _ in found])
        rows = [i for i, letter in enumerate(letters) if letter]
        if not rows or not self.names:
            return names, scores, letters
        bits = counts[:, rows] * np.array(self.bits)[:, None]
        best = (bits / sizes[rows]).argmin(axis=0)
        gap = np.minimum(bits - bits.min(axis=0), 1000.0)
        share = 1.0 / np.exp2(-gap).sum(axis=0)
        for i, b, s in zip(rows, best, share, strict=True):
            names[i], scores[i] = self.names[b], float(s)
        return names, scores, letters


def held_out(doc_id: Column) -> Column:
    """Documents that no model may learn from. A null id is not held out."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return F.coalesce(remainder == 2, F.lit(False))


def fit(labelled: DataFrame) -> dict[str, str]:
    """Samples of text by language from ``text`` and ``lang``; at most ``TOTAL`` times the longest
    letter's bytes, and at most ``LANGUAGES * PIECES`` texts, come to the driver."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    seen = rows.groupBy("lang", "h").count()
    common = seen.groupBy("lang").agg(F.sum("count").alias("n")).orderBy(F.desc("n"), "lang")
    ranked = seen.select(
        "lang", "h", F.row_number().over(Window.partitionBy("lang").orderBy("h")).alias("place")
    )
    chosen = ranked.where(f"place <= {PIECES}").join(
        F.broadcast(common.limit(LANGUAGES).select("lang")), "lang"
    )
    # at most LANGUAGES * PIECES rows
    texts = rows.join(F.broadcast(chosen.select("lang", "h")), ["lang", "h"])
    # a text begins like many others, so its piece is from anywhere
    place = F.pmod("h", F.greatest(F.length("text") - PIECE + 1, F.lit(1))).cast("int")
    piece = F.col("text").substr(place + 1, F.lit(PIECE))
    pieces = texts.groupBy("lang", "h").agg(F.min(piece).alias("piece"))
    samples: dict[str, list[str]] = {}
    for row in pieces.orderBy("lang", "h").collect():
        samples.setdefault(row["lang"], []).append(row["piece"])
    return {lang: "\n".join(parts) for lang, parts in samples.items()}


def language(text: Column, samples: dict[str, str]) -> Column:
    """``struct(lang, score, letter)`` of a text; ``letter`` also holds where nothing is labelled."""

    @F.pandas_udf("lang string, score double, letter boolean")
    def parsed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        parser = Parser.of(samples)
        for series in batches:
            names: list[str] = []
            scores: list[float] = []
            letters: list[bool] = []
            for begin, end in limits.cuts([len(t or "") for t in series], 1000, CHARACTERS):
                found = parser.parse(series.iloc[begin:end].tolist())
                names += found[0]
                scores += found[1]
                letters += found[2]
            yield pd.DataFrame({"lang": names, "score": scores, "letter": letters})
        limits.give_back()

    return parsed(text.cast("string"))


def identify(docs: DataFrame, samples: dict[str, str] | None = None) -> DataFrame:
    """All columns with ``identified``; learns from the documents that are not held out."""
    if samples is None:
        samples = fit(docs.where(~held_out(F.col("doc_id"))))
    return docs.withColumn("identified", language(F.col("text"), samples))

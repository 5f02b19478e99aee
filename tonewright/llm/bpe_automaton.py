"""Byte-pair encoding as a deterministic automaton over tokens, and its decoding.

The automaton accepts exactly the token sequences that byte-pair merging produces. It begins as
one state with an arc for each base symbol. The merges are compiled in in their order: the gadget
of a merge (x, y) -> z takes the arc y away behind every arc x and lets z lead where y led. A
state is therefore known by the token on the arc into it. Copying arc sets for each gadget would
take the square of the vocabulary, so a state holds only the arcs that its own merges took away
and a link to the state from which it was split off (that of y for z), with the rank at which that
happened; an arc for z exists where the arc for x did at that rank.

Every prefix of a word has exactly one path, so the path of a word is found from left to right by
table lookups, without trying merges. Decoding emits the labels of the arcs.

Defined results: a null or empty text has no ids and decodes to the empty text.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from struct import pack

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
_MOST = 600_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the characters from 256 on.
    """
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(kept)]
    return [chr(b) if b in set(kept) else chr(256 + others.index(b)) for b in range(256)]


class Automaton:
    """States and arcs for a vocabulary and its merges; ``end`` marks the last symbol of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str):
        self.label = {i: token for token, i in vocab.items()}
        self.end = end
        #: arcs that a merge took away from a state: (token into it, token of the arc) -> rank
        self.taken: dict[tuple[int, int], int] = {}
        #: token -> (left part, right part, rank of its gadget)
        self.parts: dict[int, tuple[int, int, int]] = {}
        #: labels as a tree of symbols; only base symbols and merges have arcs
        self.spelled: dict = {}
        for symbol in byte_alphabet():
            for base in {symbol, symbol + end} & vocab.keys():
                self._spell(vocab[base])
        for rank, (x, y) in enumerate(merges):
            self._gadget(vocab[x], vocab[y], vocab[x + y], rank)
        #: arcs that have been looked up, by state and token
        self.arcs: dict[tuple[int, int], bool] = {}

    def _gadget(self, x: int, y: int, z: int, rank: int) -> None:
        if (x, y) in self.taken or z in self.parts:
            return  # the arc is gone already: a later equal merge never applies
        self.taken[x, y] = rank
        self.parts[z] = (x, y, rank)
        self._spell(z)

    def _spell(self, token: int) -> None:
        """Enters a label in the tree of symbols, where ``""`` holds the token that ends there."""
        label, end = self.label[token], self.end
        if end and label.endswith(end):
            cut = len(label) - len(end) - 1
            symbols = [*label[:cut], label[cut:]]
        else:
            symbols = [*label]
        node = self.spelled
        for symbol in symbols:
            node = node.setdefault(symbol, {})
        node[""] = token

    def has_arc(self, state: int, token: int) -> bool:
        """Whether the state behind the token ``state`` has an arc for ``token``.

        Follows both links back: states to the one they were split off from, arcs to the left part
        they were made from. An arc taken away at a rank counts for a later copy of its state only
        if the copy came after, and for a later arc only if that was made after it; of two gadgets
        of the same rank the one on the left applies first.
        """
        known = self.arcs.get((state, token))
        if known is None:
            if len(self.arcs) > _MOST:
                self.arcs.clear()
            known = self.arcs[state, token] = self._look(state, token)
        return known

    def _look(self, state: int, token: int) -> bool:
        infinite = len(self.label) + len(self.taken)
        x, until_x = state, infinite
        while True:
            y, until_y = token, infinite
            while True:
                rank = self.taken.get((x, y))
                if rank is not None and rank < until_x and rank <= until_y:
                    return False
                if y not in self.parts:
                    break
                y, _, until_y = self.parts[y]
            if x not in self.parts:
                return True
            _, x, until_x = self.parts[x]

    def encode(self, word: str) -> list[int]:
        """Ids of the only path that spells a word in the byte alphabet.

        Long arcs are tried first. A prefix that some path spells has no other path, so a place
        from which no arc leads on is marked and never entered again.
        """
        symbols = [*word[:-1], word[-1] + self.end]
        stop, arcs = len(symbols), self.arcs
        state, at = -1, 0
        path: list[int] = []
        open_: list[tuple[int, list[tuple[int, int]]]] = []  # places and the arcs not tried there
        dead: set[int] = set()
        while at < stop:
            labels: list[tuple[int, int]] = []
            node, to = self.spelled, at
            while to < stop:
                node = node.get(symbols[to])
                if node is None:
                    break
                to += 1
                if "" in node:
                    labels.append((to, node[""]))
            while True:
                if not labels:
                    dead.add(at)
                    at, labels = open_.pop()
                    path.pop()
                    state = path[-1] if path else -1
                    continue
                to, token = labels.pop()
                if to not in dead and (
                    state < 0 or (arcs.get((state, token)) or self.has_arc(state, token))
                ):
                    break
            open_.append((at, labels))
            path.append(token)
            state, at = token, to
        return path


class WordTokenizer:
    """A tokenizer file of the word kind: normalization, pre-splitting, automaton, labels."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        merges = [tuple(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"])
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        alphabet = byte_alphabet()
        self.alphabet = {b: alphabet[b] for b in range(256)}
        self.labels = [""] * (1 + max([*self.automaton.label, *self.special.values()]))
        for i, token in [*self.automaton.label.items(), *((i, t) for t, i in self.special.items())]:
            self.labels[i] = token
        self.known_words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}

    @staticmethod
    @lru_cache(maxsize=2)
    def of(path: str) -> WordTokenizer:
        return WordTokenizer(path)

    def _word(self, word: str) -> bytes:
        ids = self.known_words.get(word)
        if ids is None:
            plain = word.isascii() and word.isprintable()  # these stand for themselves
            spelled = word if plain else "".join(map(self.alphabet.__getitem__, word.encode()))
            path = self.automaton.encode(spelled)
            ids = pack(f"<{len(path)}I", *path)
            if len(self.known_words) > _MOST:
                self.known_words.clear()
            self.known_words[word] = ids
        return ids

    def _part(self, part: str) -> bytes:
        out = []
        for piece in self.cut.split(part) if "<" in part else (part,):
            if piece in self.special:
                out.append(pack("<I", self.special[piece]))
            else:
                if piece.isascii():
                    piece = piece.lower()
                else:
                    piece = "".join([c.lower() for c in unicodedata.normalize("NFC", piece)])
                out += [self._word(word) for word in self.words.findall(piece)]
        return b"".join(out)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers. Words never reach across a space, so
        what stands between spaces is looked up as a whole."""
        if not text:
            return b""
        parts, known = text.split(" "), self.known
        while True:
            try:
                return b"".join([known[part] for part in parts])
            except KeyError:
                if len(known) > _MOST:
                    known.clear()
                for part in parts:
                    if part not in known:
                        known[part] = self._part(part)

    def decode(self, ids: bytes) -> str:
        """The labels of the arcs, with a space between any two."""
        return " ".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_decode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids (little-endian unsigned 32-bit integers), decoded`` of all texts.

    Rows stay in the task that read them; a worker compiles the automaton once.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string"
    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of(path)
        for whole in batches:
            for begin in range(0, whole.num_rows, 1000):
                batch = whole.slice(begin, 1000)
                ids = [tokenizer.encode(text) for text in batch.column(1).to_pylist()]
                decoded = [tokenizer.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return rows.mapInArrow(run, schema)

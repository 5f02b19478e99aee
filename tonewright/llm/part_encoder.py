"""Ids of many texts at once by a word-level BPE tokenizer, each different word encoded once."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Entries of each memory, and characters of a part or word that is worth remembering.
_MOST, _LONGEST = 600_000, 64
#: Characters of text that are worked on at once; longer texts are taken in parts.
BLOCK = 4 << 20
#: Characters whose kind is the same in all versions of Unicode, and whose lower case neither
#: depends on neighbours nor combines with them: ASCII and Latin letters.
_PLAIN = re.compile("[\\t\\n\\r -~À-ÖØ-öø-įı-ɏ]*")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
_KIND[[9, 10, 13, 32]] = _SPACE
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x61:0x7B] = _LETTER
_KIND[0x80:] = _LETTER
_ENDINGS = [e.encode() for e in ("s", "t", "re", "ve", "m", "ll", "d")]


def word_starts(data: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the words of lower-cased plain text begin: runs of letters, single digits, runs of other
    characters, and an apostrophe with one of the usual endings behind it, unless it follows another
    character of its kind."""
    past = np.concatenate([[np.uint8(_SPACE)], kind[:-1]])
    starts = (kind != _SPACE) & ((kind != past) | (kind == _DIGIT))
    for at in np.flatnonzero(starts & (data == 0x27)).tolist():
        for ending in _ENDINGS:
            end = at + 1 + len(ending)
            if data[at + 1 : end].tobytes() == ending:
                starts[at + 1] = False
                if end < len(data) and kind[end] == _LETTER:
                    starts[end] = True
                break
    return starts


class PartEncoder:
    """Encodes each different word once, for vocabularies with lower case and word ends.

    Right for the word pattern of ``word_starts`` and pre-splitting that drops white space. Plain
    texts are split into words on their bytes; words that are new go through the tokenizer many at a
    time, and the tokens with which words end tell them apart. All other texts go through the
    tokenizer as they are, in the parts between spaces. A memory that is full is emptied.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(end)]] = True
        self.known: dict[str, bytes] = {}
        self.words: dict[bytes, bytes] = {}

    @staticmethod
    @lru_cache(maxsize=2)
    def of(path: str) -> PartEncoder:
        return PartEncoder(path)

    def _learn_words(self, words: list[bytes]) -> list[bytes]:
        joined = [b" ".join(words[i : i + 1000]).decode() for i in range(0, len(words), 1000)]
        encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, dtype="<u4") for e in encoded])
        stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
        raw = ids.tobytes()
        pieces = [raw[i:j] for i, j in zip([0, *stops[:-1]], stops, strict=True)]
        if len(self.words) > _MOST:
            self.words.clear()
        self.words.update((w, x) for w, x in zip(words, pieces, strict=True) if len(w) <= _LONGEST)
        return pieces

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of plain texts, all at once."""
        lowered = [t.lower().encode() for t in texts]
        data = np.frombuffer(b"\n".join(lowered) + b"\n", dtype=np.uint8)
        kind = _KIND[data]
        starts = word_starts(data, kind)
        inside = kind != _SPACE
        places = np.cumsum(inside, dtype=np.int32)
        offsets = np.append(places[starts] - 1, places[-1]).astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])]
        coded = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
        words = coded.dictionary.to_pylist()
        ids = list(map(self.words.get, words))
        new = [i for i, x in enumerate(ids) if x is None]
        if new:
            for i, x in zip(new, self._learn_words([words[i] for i in new]), strict=True):
                ids[i] = x
        sizes = np.array(list(map(len, ids)), dtype=np.int64) // 4
        begins = np.cumsum(sizes) - sizes
        code = coded.indices.to_numpy(zero_copy_only=False)
        counts = sizes[code]
        past = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(begins[code] - past[:-1], counts) + np.arange(past[-1])
        raw = np.frombuffer(b"".join(ids), dtype="<u4")[at].tobytes()
        ends = np.cumsum([len(t) + 1 for t in lowered])
        stops = (past[np.cumsum(starts)[ends - 1]] * 4).tolist()
        return [raw[i:j] for i, j in zip([0, *stops[:-1]], stops, strict=True)]

    def _other(self, text: str) -> bytes:
        parts, known = text.split(" "), self.known
        new = list({p for p in parts if p not in known})
        encoded = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        learnt = {p: np.array(e.ids, dtype="<u4").tobytes() for p, e in zip(new, encoded, strict=True)}
        out = b"".join([x if (x := known.get(p)) is not None else learnt[p] for p in parts])
        if len(known) > _MOST:
            known.clear()
        known.update((p, x) for p, x in learnt.items() if len(p) <= _LONGEST)
        return out

    def _block(self, texts: list[str]) -> list[bytes]:
        plain = [_PLAIN.fullmatch(t) is not None and "<|" not in t for t in texts]
        done = iter(self._plain([t for t, p in zip(texts, plain, strict=True) if p]) if any(plain) else ())
        return [next(done) if p else self._other(t) for t, p in zip(texts, plain, strict=True)]

    def encode(self, texts: list[str | None]) -> Iterator[tuple[int, bytes]]:
        """For each text, its number and ids as little-endian unsigned 32-bit integers.

        A null is an empty text. A text beyond ``BLOCK`` comes in several parts, in order, cut at
        spaces.
        """
        held: list[str] = []
        begin, size = 0, 0
        for i, text in enumerate([*texts, None]):
            text = text or ""
            if held and (i == len(texts) or size + len(text) > BLOCK):
                for k, ids in enumerate(self._block(held)):
                    yield begin + k, ids
                held, size = [], 0
            if not held:
                begin = i
            if len(text) <= BLOCK:
                held.append(text)
                size += len(text)
                continue
            at = 0
            while at < len(text):
                cut = text.find(" ", at + BLOCK)
                cut = len(text) if cut < 0 else cut
                yield i, self._block([text[at:cut]])[0]
                at = cut
            begin = i + 1

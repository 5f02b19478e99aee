"""Token ids of whole texts by a public vocabulary, with a memory of what stands between spaces."""

from __future__ import annotations

import base64
import os
import re

import numpy as np
import public_tokenizers
import tiktoken

from tonewright.llm.batches import sole

#: White space on both sides of a space, or two of it at the end: the pattern joins such runs.
_RUN = re.compile(r"\s \s|\s \Z")
_MOST = 600_000


class SpaceSplitEncoder:
    """Encodes with the byte-level vocabulary of a tokenizer file.

    Printable parts take the rank file of the same vocabulary, which gives the same ids in
    less time; parts with marked tokens or control characters take the tokenizer itself.
    Its pattern always begins a new word at a space behind another character, so a text may be
    encoded in the parts between spaces, and invented or repeated words are looked up. Texts with
    longer runs of white space go through the tokenizer as a whole. The memory is emptied when it
    has ``_MOST`` entries, so it is bounded.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(os.path.splitext(path)[0] + ".tiktoken", "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in lines},
            special_tokens={},
        )
        self.spaced = np.array([token.startswith(b" ") for token in self._tokens(lines)])
        self.known: dict[str, bytes] = {}

    @staticmethod
    def of(path: str) -> SpaceSplitEncoder:
        return sole(("encoder", path), lambda: SpaceSplitEncoder(path))

    @staticmethod
    def _tokens(lines: list[list[bytes]]) -> list[bytes]:
        return [base64.b64decode(t) for t, _ in sorted(lines, key=lambda line: int(line[1]))]

    def _whole(self, text: str) -> bytes:
        if not text:
            return b""
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of parts that each begin with a space: only a part's first token begins with one."""
        if not parts:
            return []
        ids = np.array(self.ranks.encode_ordinary("".join(parts)), dtype="<u4")
        begins = np.flatnonzero(self.spaced[ids]) * 4
        raw = ids.tobytes()
        return [raw[i:j] for i, j in zip(begins, [*begins[1:], len(raw)], strict=True)]

    def _learn(self, parts: set[str]) -> None:
        plain = [
            p
            for p in parts
            if p.replace("\n", "").isprintable() and p[:1].strip() and "<|" not in p
        ]
        known = self.known
        known.update(zip(plain, self._parts([f" {p}" for p in plain]), strict=True))
        known.update((p, self._whole(f" {p}")) for p in parts if p not in known)

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null: none."""
        return [self.encode(text) for text in texts]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _RUN.search(text):
            return self._whole(text)
        first, *rest = text.split(" ")
        known = self.known
        while True:
            try:
                tail = b"".join([known[part] for part in rest])
                break
            except KeyError:
                if len(known) > _MOST:
                    known.clear()
                self._learn({part for part in rest if part not in known})
        return self._whole(first) + tail

"""CRC-32 of all runs of up to three words, for many texts at once.

The checksum of joined strings follows from those of its parts: the first is moved past the bytes
of the second, which is linear, so it takes four table lookups. Words are run through the usual
byte table side by side; pairs and triples cost two such moves for each word.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np

#: ASCII letters and digits and all bytes from 0x80 on belong to words; upper case becomes lower.
_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if chr(b).isalnum() or b >= 0x80 else 32 for b in range(256)
)
_SIDE_BY_SIDE = 48
_DIRECT = 64


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_TABLE = _byte_table()


def _apply(move: np.ndarray, crc: np.ndarray) -> np.ndarray:
    """``move`` (4 x 256) on each checksum: one lookup for each of its bytes."""
    out = move[0][crc & 255]
    for k in (1, 2, 3):
        out = out ^ move[k][(crc >> np.uint32(8 * k)) & 255]
    return out


def _moves() -> tuple[np.ndarray, list[np.ndarray]]:
    """Moves past 0 to 63 bytes, and past powers of two."""
    one = np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])
    direct = [one]
    while len(direct) < _DIRECT:
        last = direct[-1]
        direct.append(_TABLE[last & 255] ^ (last >> np.uint32(8)))
    powers = [direct[1]]
    while len(powers) < 40:
        powers.append(_apply(powers[-1], powers[-1]))
    return np.stack(direct), powers


_MOVE, _POWERS = _moves()
_FLAT = _MOVE.reshape(-1)
_SPACE = np.uint32(zlib.crc32(b" "))


def moved(crc: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Checksums moved past as many bytes as ``by`` says."""
    base = np.minimum(by, _DIRECT - 1) * 1024
    out = _FLAT[base + (crc & 255)]
    for k in (1, 2, 3):
        out = out ^ _FLAT[base + 256 * k + ((crc >> np.uint32(8 * k)) & 255)]
    long = np.flatnonzero(by >= _DIRECT)
    if len(long):
        value, left = crc[long], by[long]
        for power in _POWERS:
            odd = left & 1 == 1
            value = np.where(odd, _apply(power, value), value)
            left = left >> 1
            if not left.any():
                break
        out[long] = value
    return out


@dataclass
class Words:
    """Checksum and length in bytes of each word, and the number of its text."""

    crc: np.ndarray
    length: np.ndarray
    text: np.ndarray

    def last(self, n: int) -> Words:
        return Words(self.crc[-n:], self.length[-n:], self.text[-n:])

    def after(self, before: Words) -> Words:
        return Words(
            np.concatenate([before.crc, self.crc]),
            np.concatenate([before.length, self.length]),
            np.concatenate([before.text, self.text]),
        )


def words_of(texts: list[bytes]) -> Words:
    """Words of UTF-8 texts, lower-cased in ASCII."""
    low = b" ".join(texts).translate(_WORD_BYTES)
    data = np.frombuffer(low, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=bool)
    np.not_equal(data, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, lengths = edges[::2], edges[1::2] - edges[::2]
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    text = np.searchsorted(begins, starts, side="right") - 1
    rising = np.minimum(lengths, _SIDE_BY_SIDE + 1).astype(np.uint8)
    order = np.argsort(rising, kind="stable")[::-1]
    at, rising = starts[order], rising[order[::-1]]
    state = np.full(len(at), 0xFFFFFFFF, dtype=np.uint32)
    for j in range(min(_SIDE_BY_SIDE, int(rising.max(initial=0)))):
        n = len(at) - int(np.searchsorted(rising, j, side="right"))
        now = state[:n]
        state[:n] = _TABLE[(now ^ data[at[:n] + j]) & 255] ^ (now >> np.uint32(8))
    crc = np.empty_like(state)
    crc[order] = ~state
    for i in np.flatnonzero(lengths > _SIDE_BY_SIDE):
        crc[i] = zlib.crc32(low[starts[i] : starts[i] + lengths[i]])
    return Words(crc, lengths, text)


def runs_of(words: Words, known: int = 0) -> list[tuple[np.ndarray, np.ndarray]]:
    """(text, checksum) of all single words, pairs and triples, each joined by one space.

    Runs that end among the first ``known`` words are left out.
    """
    crc, length, text = words.crc, words.length, words.text
    spaced = moved(np.full(len(crc), _SPACE, dtype=np.uint32), length) ^ crc
    out = [(text[known:], crc[known:])]
    joined = crc
    for n in (1, 2):
        joined = moved(joined[:-1], length[n:] + 1) ^ spaced[n:]
        skip = max(0, known - n)
        same = text[n:][skip:] == text[:-n][skip:] if len(text) > n else np.zeros(0, dtype=bool)
        out.append((text[n:][skip:][same], joined[skip:][same]))
        if len(joined) == 0:
            joined = crc[:0]
    return out

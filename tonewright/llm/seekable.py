"""Files of independent zstandard frames with a table of their places at the end.

The layout is the public seekable format: data frames one after the other, then a skippable frame
that lists for each frame its compressed size, its size and the low 32 bits of the XXH64 checksum
of its content, closed by the number of frames, a flag byte and a mark. Any zstandard reader
decompresses such a file to the plain content; one that knows the table reads single frames.

Before the table stands one more skippable frame, listed there with size 0: the index of documents
(key, first id, number of ids) as an Arrow stream behind its own checksum.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard

INDEX_MAGIC, TABLE_MAGIC, MARK = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
CHECKSUMS = 0x80
FOOTER, ENTRY = struct.Struct("<IBI"), struct.Struct("<III")
#: Bytes of a frame's content, unless a document ends it earlier.
FRAME = 1 << 18


class Damaged(ValueError):
    """A frame, the index or the table isn't what was written."""


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class Writer:
    """Writes documents of 4-byte ids to a stream, frame by frame.

    Frames end between documents; only a document larger than a frame is cut. At any time one frame
    and the index of the documents so far are in memory.
    """

    def __init__(self, stream, key: pa.DataType, level: int = 3):
        self.stream, self.key = stream, key
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.entries: list[tuple[int, int, int]] = []
        self.waiting: list[bytes] = []
        self.size = 0
        self.names: list = []
        self.counts: list[int] = []
        self.written = 0

    def begin(self, name: object) -> None:
        """Opens the next document."""
        self.names.append(name)
        self.counts.append(0)

    def add(self, ids: bytes) -> None:
        """More ids of the open document."""
        self.counts[-1] += len(ids) // 4
        if self.waiting and self.size + len(ids) > FRAME:
            self._flush()
        for at in range(0, len(ids), FRAME):
            part = ids[at : at + FRAME]
            self.waiting.append(part)
            self.size += len(part)
            if self.size >= FRAME:
                self._flush()

    def _flush(self) -> None:
        if self.size:
            content = b"".join(self.waiting)
            frame = self.packer.compress(content)
            self.stream.write(frame)
            check = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
            self.entries.append((len(frame), len(content), check))
            self.written += len(frame)
            self.waiting, self.size = [], 0

    def close(self) -> None:
        self._flush()
        counts = np.array(self.counts, dtype=np.int64)
        columns = [pa.array(self.names, self.key), pa.array(np.cumsum(counts) - counts), pa.array(counts)]
        index = pa.RecordBatch.from_arrays(columns, ["doc_id", "first", "n_tokens"])
        sink = pa.BufferOutputStream()
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        with pa.ipc.new_stream(sink, index.schema, options=options) as out:
            out.write_batch(index)
        body = sink.getvalue().to_pybytes()
        frame = _skippable(INDEX_MAGIC, xxhash.xxh64_digest(body) + body)
        self.entries.append((len(frame), 0, xxhash.xxh64_intdigest(b"") & 0xFFFFFFFF))
        table = b"".join(ENTRY.pack(*e) for e in self.entries)
        table += FOOTER.pack(len(self.entries), CHECKSUMS, MARK)
        frame += _skippable(TABLE_MAGIC, table)
        self.stream.write(frame)
        self.written += len(frame)
        self.stream.close()


class Reader:
    """Reads an opened file (``seek``, ``read``, ``size``) by its table; ``opened`` counts frames."""

    def __init__(self, file):
        self.file = file
        end = file.size()
        count, flags, mark = FOOTER.unpack(self._at(end - FOOTER.size, FOOTER.size))
        if mark != MARK or not flags & CHECKSUMS or end < FOOTER.size + 8 + count * ENTRY.size:
            raise Damaged("no table of frames at the end")
        start = end - FOOTER.size - count * ENTRY.size
        magic, size = struct.unpack("<II", self._at(start - 8, 8))
        if magic != TABLE_MAGIC or size != end - start:
            raise Damaged("the table of frames has another size")
        self.table = np.frombuffer(self._at(start, count * ENTRY.size), "<u4").reshape(-1, 3)
        self.places = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        self.content = np.concatenate([[0], np.cumsum(self.table[:, 1], dtype=np.int64)])
        if self.places[-1] != start - 8:
            raise Damaged("the frames don't fill the file")
        self.unpacker = zstandard.ZstdDecompressor()
        self.opened = 0

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def index(self) -> pa.RecordBatch:
        """Key, first id and number of ids of each document in the file."""
        raw = self._at(int(self.places[-2]), int(self.table[-1, 0]))
        magic, _ = struct.unpack("<II", raw[:8])
        if magic != INDEX_MAGIC or xxhash.xxh64_digest(raw[16:]) != raw[8:16]:
            raise Damaged("the index of documents")
        return pa.ipc.open_stream(raw[16:]).read_next_batch()

    def frame(self, i: int) -> bytes:
        """The content of a frame, checked."""
        packed = self._at(int(self.places[i]), int(self.table[i, 0]))
        try:
            content = self.unpacker.decompress(packed)
        except zstandard.ZstdError as error:
            raise Damaged(f"frame {i}") from error
        if len(content) != self.table[i, 1] or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != self.table[i, 2]:
            raise Damaged(f"frame {i}")
        self.opened += 1
        return content

    def ids(self, spans: Iterator[tuple[int, int]]) -> Iterator[bytes]:
        """The ids ``first`` to ``first + n`` for each span; only frames that hold some are read.

        Spans may come in any order; the last frame is kept, so that neighbours share it.
        """
        kept, content = -1, b""
        for first, n in spans:
            low, high = 4 * first, 4 * (first + n)
            at = int(np.searchsorted(self.content, low, side="right")) - 1
            parts = []
            while low < high:
                if at != kept:
                    kept, content = at, self.frame(at)
                base = int(self.content[at])
                parts.append(content[low - base : high - base])
                low = min(high, base + len(content))
                at += 1
            yield parts[0] if len(parts) == 1 else b"".join(parts)

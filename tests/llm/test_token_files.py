"""Token files: exact round trips, the format itself, and reading only what is asked for."""

import io
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
import zstandard
from tokenizers import Tokenizer

from tests.llm.conftest import corpus
from tonewright.llm import part_encoder, seekable, token_files
from tonewright.llm.queries import op11_token_files

ODD = [
    None, "", "  a  b", "it's I'LL x<|endoftext|> <|startoftext|>y", "é ́a ΑΣ Σ\t\n x", "\x00\x1c x", "'s",
    "it'st ''s !'s 're'll x'", "'", "a's't 12's é's'", "l'été d'\n'm", "1²½ a×b ǅ İI ŉ", "x" * 300,
]


def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return np.array(tokenizer_.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


tokenizer_ = tokenizer()


def joined(encoder, texts):
    out = [b""] * len(texts)
    for i, ids in encoder.encode(texts):
        out[i] += ids
    return out


@pytest.mark.parametrize("block", [4 << 20, 60])
def test_encoder_equals_the_tokenizer(monkeypatch, block):
    monkeypatch.setattr(part_encoder, "BLOCK", block)
    encoder = part_encoder.PartEncoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ODD + [t for _, t, _ in corpus()][:60]
    assert joined(encoder, texts) == [ids_of(t) for t in texts]
    assert joined(encoder, texts) == [ids_of(t) for t in texts]  # now remembered


def test_encoder_with_a_full_memory(monkeypatch):
    monkeypatch.setattr(part_encoder, "_MOST", 3)
    encoder = part_encoder.PartEncoder(public_tokenizers.path("word_bpe_49k.json"))
    assert joined(encoder, ODD * 2) == [ids_of(t) for t in ODD * 2]


def written(documents):
    sink = io.BytesIO()
    close, sink.close = sink.close, lambda: None
    writer = seekable.Writer(sink, pa.int64())
    for name, parts in documents:
        writer.begin(name)
        for part in parts:
            writer.add(part)
    writer.close()
    return sink.getvalue()


class Opened(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def some_documents():
    draw = np.random.default_rng(1)
    sizes = [0, 1, 5, 70_000, 200_000, 3, 0, 65_536, 10]
    return [(i, [draw.integers(0, 49_000, n).astype("<u4").tobytes()]) for i, n in enumerate(sizes)]


def test_format():
    """Plain zstandard readers see the ids; the table lists every frame with its checksum."""
    documents = some_documents()
    raw = written(documents)
    content = b"".join(b"".join(parts) for _, parts in documents)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
    assert plain.read() == content
    frames, flags, mark = struct.unpack("<IBI", raw[-9:])
    assert mark == 0x8F92EAB1 and flags == 0x80
    table = struct.unpack(f"<{3 * frames}I", raw[-9 - 12 * frames : -9])
    assert raw[-9 - 12 * frames - 8 :][:8] == struct.pack("<II", 0x184D2A5E, 12 * frames + 9)
    at = 0
    for i in range(frames - 1):
        packed, size, check = table[3 * i : 3 * i + 3]
        frame = zstandard.ZstdDecompressor().decompress(raw[at : at + packed])
        assert len(frame) == size <= seekable.FRAME and xxhash.xxh64_intdigest(frame) & 0xFFFFFFFF == check
        at += packed
    assert raw[at : at + 4] == struct.pack("<I", 0x184D2A50) and table[-2] == 0


def test_reader_opens_only_frames_that_are_wanted():
    documents = some_documents()
    raw = written(documents)
    reader = seekable.Reader(Opened(raw))
    index = reader.index().to_pydict()
    assert index["n_tokens"] == [len(b"".join(p)) // 4 for _, p in documents]
    spans = list(zip(index["first"], index["n_tokens"]))
    assert list(reader.ids(spans)) == [b"".join(p) for _, p in documents]
    one = seekable.Reader(Opened(raw))
    assert list(one.ids([spans[8]])) == [documents[8][1][0]] and one.opened == 1
    none = seekable.Reader(Opened(raw))
    assert list(none.ids([spans[0], spans[6]])) == [b"", b""] and none.opened == 0


@pytest.mark.parametrize("place", [20, -3, -20, -40])
def test_damage_is_noticed(place):
    raw = bytearray(written(some_documents()))
    raw[place] ^= 1
    with pytest.raises(seekable.Damaged):
        reader = seekable.Reader(Opened(bytes(raw)))
        index = reader.index().to_pydict()
        list(reader.ids(zip(index["first"], index["n_tokens"])))


def expected(rows, end=1):
    """(doc_id, start, n_tokens, crc) in ascending order of ids, rows without one first."""
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, at = [], 0
    for d, t, _ in ordered:
        ids = ids_of(t) + np.array([end], "<u4").tobytes()
        out.append((d, at, len(ids) // 4, ids))
        at += len(ids) // 4
    return out


def by_id(rows):
    """Start is compared for ids that one row has; rows of one id may stand in any order."""
    rows = [tuple(r) for r in rows]
    single = {d for d, *_ in rows if sum(x[0] == d for x in rows) == 1}
    return sorted((repr(d), s if d in single else -1, n, x) for d, s, n, x in rows)


def test_files_hold_the_corpus_in_order(spark, docs, tmp_path):
    listed = token_files.write(docs, str(tmp_path / "out"), file_docs=40)
    want = expected(corpus())
    got = token_files.read(spark, str(tmp_path / "out")).select("doc_id", "start", "n_tokens", "ids").collect()
    assert by_id(got) == by_id(want)
    starts = sorted((r.start, r.n_tokens) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    files = sorted(listed.collect(), key=lambda r: r.start)
    assert len(files) > len(corpus()) / 40 and max(r.n_docs for r in files) <= 40
    assert sum(r.n_ids for r in files) == sum(n for _, _, n, _ in want)
    names = [r.first_doc for r in files]
    assert names == sorted(names, key=lambda d: -1 if d is None else d)


def test_fetch(spark, docs, tmp_path):
    token_files.write(docs, str(tmp_path / "out"))
    wanted = spark.createDataFrame([(121,), (129,), (None,), (122,), (10**6,), (129,)], "doc_id bigint")
    got = token_files.fetch(wanted, str(tmp_path / "out")).collect()
    want = [r for r in expected(corpus()) if r[0] in (121, 129, None, 122)]
    assert by_id(got) == by_id(want)


def test_no_documents(spark, no_docs, tmp_path):
    assert token_files.write(no_docs, str(tmp_path / "out")).count() == 0
    assert token_files.read(spark, str(tmp_path / "out")).count() == 0
    assert token_files.fetch(no_docs, str(tmp_path / "out")).count() == 0


def test_names_of_any_kind(spark, tmp_path):
    frame = spark.createDataFrame([("b", "x y"), ("a", "z"), (None, "")], "doc_id string, text string")
    token_files.write(frame, str(tmp_path / "out"))
    got = token_files.read(spark, str(tmp_path / "out")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, "a", "b"]


def test_starts_over_many_parts(spark):
    rows = [(p, k, p % 7 + k) for p in range(3000) for k in range(2)]
    got = token_files._add_starts(spark.createDataFrame(rows, "part int, number int, n_ids bigint")).collect()
    at = 0
    for r in sorted(got):
        assert r.start == at
        at += r.n_ids


def test_query(spark, small_tables):
    want = [(d, s, n, zlib.crc32(x)) for d, s, n, x in expected(corpus())]
    got = op11_token_files(spark, small_tables)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert by_id(got.collect()) == by_id(want)

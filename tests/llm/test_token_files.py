from __future__ import annotations

import io
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from pulsegrid.llm import catalog, token_files
from pulsegrid.llm.token_files import Encoder, Reader, Writer, read_token_files, token_digest, write_token_files

PATH = str(catalog.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return Encoder(PATH, 1)


def plain(encoder, text):
    return encoder.tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


pieces = st.sampled_from(
    ["the", "The", "foo.", "x,", "it's", "'LL", "Å", "Å", "é", "12", "a1.", "İ", "<|endoftext|>", "<|ENDOFTEXT|>",
     "a<|startoftext|>b", "...", "%%%", "b***", " ", " ", "ß!", "日本", "\x0b", "\x1c", "\x00", "\U0001f600", "'s.", ".'s"]
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.one_of(pieces, st.text(max_size=5)), st.sampled_from([" ", "\n", "", "\t", "\r\n", "  "])), max_size=12))
def test_pieces_encode_as_whole_texts(encoder, parts):
    text = "".join(a + b for a, b in parts).encode("utf-8", "replace").decode()
    ((ids, counts),) = list(encoder.blocks([text]))
    assert ids.tolist() == plain(encoder, text) and counts.tolist() == [len(ids)]


latin = st.text(st.characters(min_codepoint=0xC0, max_codepoint=0x17F) | st.sampled_from("abz.,!?;:*$%&#'-"), min_size=1, max_size=8)


@settings(max_examples=500, deadline=None)
@given(st.lists(latin, min_size=1, max_size=8))
def test_latin_words_encode_as_whole_texts(encoder, words):
    assert encoder.direct
    ((ids, _),) = list(encoder.blocks([" ".join(words)]))
    assert ids.tolist() == plain(encoder, " ".join(words))


def test_words_are_encoded_once_while_they_are_kept(monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_WORDS", 50)
    rng = random.Random(4)
    texts = [" ".join(f"w{'abcdefghij'[rng.randrange(10)]}{'xyz'[rng.randrange(3)]}" for _ in range(30)) for _ in range(40)]
    texts += [t.replace("w", "It's") for t in texts]
    one = Encoder(PATH, 1)
    for _ in range(2):
        list(one.blocks(texts))
    assert one.encodings == len({w.lower() for t in texts for w in t.split()})
    # frequent words outlive the generations that rare ones fill
    monkeypatch.setattr(token_files, "KEPT_WORDS", 200)
    two = Encoder(PATH, 1)
    rare = 0
    for k in range(100):
        words = [f"rare{'abcdefghij'[k // 10]}{'abcdefghij'[k % 10]}{'abcdefghij'[j]}" for j in range(10)]
        rare += len(words)
        list(two.blocks([" ".join(words + [f"often{x}" for x in "abcdefghij"] * 5)]))
    assert two.older is not None and two.encodings == rare + 10


def test_a_worker_keeps_its_encoder_until_another_operator_runs():
    from pulsegrid.llm.common import lean

    kept = Encoder.of_worker(PATH, 1, True)
    list(lean(lambda b: b, keeps="encoder")([]))
    assert Encoder.of_worker(PATH, 1, True) is kept
    list(lean(lambda b: b)([]))
    assert Encoder.of_worker(PATH, 1, True) is not kept


def test_blocks_and_reset(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_WORDS", 50)
    monkeypatch.setattr(token_files, "KEPT_WORDS", 20)
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randrange(1, 9) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts[5] = None
    texts[9] = "x <|endoftext|> y"
    flat = [(x.tolist(), n.tolist()) for x, n in Encoder(PATH, 1).blocks(texts)]
    assert sum((a for a, _ in flat), []) == sum((plain(encoder, t) for t in texts), [])
    assert sum((n for _, n in flat), []) == [len(plain(encoder, t)) for t in texts]


def test_file_layout_seeks_and_checks(monkeypatch):
    monkeypatch.setattr(token_files, "FRAME_IDS", 7)
    docs = [(None, [1]), (-3, []), (5, list(range(40))), (5, [9, 1]), (2**40, [65535] * 14)]
    buffer = io.BytesIO()
    writer = Writer(buffer, 2)
    for i, ids in docs:
        writer.put(i, np.array(ids, np.uint32))
    writer.close()
    data = buffer.getvalue()
    assert writer.bytes == len(data)
    reader = Reader(pa.BufferReader(data))
    assert [reader.ids(k).tolist() for k in range(5)] == [ids for _, ids in docs]
    assert reader.docs["id"].tolist() == [0, -3, 5, 5, 2**40] and reader.docs["null"].tolist() == [1, 0, 0, 0, 0]
    whole = b"".join(zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).readall() for _ in [0])
    assert np.frombuffer(whole, "<u2").tolist() == sum((ids for _, ids in docs), [])
    bad = bytearray(data)
    at = int(reader.offsets[reader.first[2]]) + 12
    bad[at] ^= 1
    broken = Reader(pa.BufferReader(bytes(bad)))
    assert broken.ids(4).tolist() == [65535] * 14  # other documents can still be read
    with pytest.raises(Exception):
        broken.ids(2)


def table(spark, rows):
    return spark.createDataFrame([(i, t, 3, 0) for i, t in rows], "doc_id long, text string, part int, tie int")


def test_round_trip(spark, encoder, workdir):
    rows = [(i, f"The word {i}, and more.\nline " * (i % 7)) for i in range(300)] + [(None, "a"), (7, None), (7, ""), (8, "b" * 50_000), (9, "b"), (9, "b")]
    rows[4] = (4, "lorem ipsum! " * 20_000)
    random.Random(2).shuffle(rows)
    docs = table(spark, rows)
    folder = f"file://{workdir}/out"
    got = token_digest(docs, PATH, 1, folder).collect()
    assert len(got) == len(rows)
    want = sorted((i, len(plain(encoder, t)), zlib.crc32(np.array(plain(encoder, t), "<u4").tobytes())) for i, t in rows if i is not None)
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got if r["doc_id"] is not None) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])
    names = [f.base_name for f in pafs.LocalFileSystem().get_file_info(pafs.FileSelector(f"{workdir}/out"))]
    assert all(n.startswith("part-") for n in names)
    manifest = write_token_files(docs, f"{workdir}/again", PATH)
    some = read_token_files(manifest, f"{workdir}/again", doc_ids=[4, 9, 12345]).collect()
    assert sorted(r["doc_id"] for r in some) == [4, 9, 9, 9]
    assert next(r["ids"] for r in some if r["doc_id"] == 4) == plain(encoder, "lorem ipsum! " * 20_000)


def test_empty_table(spark):
    assert token_digest(table(spark, [(1, "a")]).limit(0), PATH).count() == 0

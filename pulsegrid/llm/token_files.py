"""Token-id files: independent zstandard frames, seek table, checksums.

One file per range of ``doc_id``; files and documents stand in ascending id
order. Layout of a file:

* frames: each document is one frame, a long one several of ``FRAME_IDS``
  ids; every frame is an independent zstandard frame of little-endian
  unsigned integers of ``width`` bytes (2 or 4);
* document table, in a skippable frame: width (1 byte), number of documents (8 bytes), then
  per document id (8 bytes), null flag of the id (1 byte), number of ids (8 bytes);
* seek table, in a skippable frame, laid out as the public zstandard seekable
  format: per frame compressed size, decompressed size and checksum (low
  half of XXH64 of the content), then number of frames, descriptor and magic.

Readers take the two tables from the end of a file and fetch and decompress
only the frames of the requested documents. Any zstandard tool can decompress a whole file.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pulsegrid.config import new_scratch_dir
from pulsegrid.llm.common import Vocabulary, bounded_batches, lean, of_worker, stored

FRAME_IDS = 1 << 18
LEVEL = 1
TABLE_MAGIC, SEEK_FRAME_MAGIC, SEEK_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
HAS_CHECKSUMS = 0x80
BLOCK_WORDS = 200_000
KEPT_WORDS = 1_000_000  # words kept by a Python worker, in two generations
DOC = np.dtype([("id", "<i8"), ("null", "u1"), ("n", "<u8")])
FRAME = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])

MANIFEST = "file string, part int, docs long, tokens long, bytes long"
READ_SCHEMA = "doc_id long, part int, nth long, tokens_before long, n_tokens long, ids_crc32 long"


# --- encoding ------------------------------------------------------------


class Encoder:
    """Whole texts to ids, each distinct word encoded once while it is kept.

    Tokenizers that drop white space and split at it encode a text as the
    concatenation of its words. Words are cut at ASCII white space, and A-Z is
    lowered where the tokenizer does so itself. A word of Latin letters, with or without punctuation at its end, goes
    straight to the tokenizer's model: normalising and splitting it could only
    cut off the punctuation (checked against the tokenizer when the encoder is
    made). Other words go through the tokenizer; texts that may hold special
    tokens or rare control characters go through it whole. Only for
    tokenizers with such rules, as ``word_bpe``; ``piecewise=False`` encodes every text whole.

    Words are kept in two generations: when the newer one is full it becomes the
    older, whose words move on as they are met again, so frequent words are
    encoded once however many rare ones pass by.
    """

    LETTERS = "a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"  # Latin-1: lower case is one letter, nothing to compose
    PIECES = re.compile(f"([{LETTERS}]+)([.,!?;:*$%&#]*)")
    SAMPLES = ("word", "été", "straße", "ÀÖØÞ", "naïve,", "end...", "a!?", "ÿ;", "qu")
    CONTROLS = bytes(c for c in range(32) if c not in b"\t\n\r") + b"\x7f"

    def __init__(self, path: str, end_id: int, piecewise: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.end_id, self.piecewise = end_id, piecewise
        self.width = 2 if max(self.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        # bytes as the letters that byte-level models stand them for
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in printed)}
        self.direct = piecewise and all(
            self._pieces(w.encode()) == self.tokenizer.encode(w, add_special_tokens=False).ids for w in self.SAMPLES
        )
        self.older = None
        self.encodings = 0  # words encoded so far
        self._begin()

    @classmethod
    def of_worker(cls, path: str, end_id: int, piecewise: bool) -> "Encoder":
        """The encoder of this Python process: later tasks find the words of
        earlier ones encoded, until a task of another operator needs the memory."""
        return of_worker("encoder", (path, end_id, piecewise), lambda: cls(path, end_id, piecewise))

    def _begin(self) -> None:
        """A new generation."""
        self.words = Vocabulary()
        self.words[b""] = 0  # the end of a document
        self.encoded = 1
        self.ids = array("I", [self.end_id])
        self.starts = array("Q", [0, 1])
        self.own = 0

    def blocks(self, texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Blocks of whole texts: their ids, and the number of ids of each."""
        words: list[int] = []
        counts: list[int] = []
        for text in texts:
            data = (text or "").encode("utf-8", "replace")
            if not self.piecewise or b"<|" in data or len(data.translate(None, self.CONTROLS)) != len(data):
                if text:
                    self.own += 1
                    words.append(self.words[(self.own,)])
                    self._fill(text)
                n = bool(text)
            else:
                pieces = data.lower().split()
                words.extend(map(self.words.__getitem__, pieces))
                n = len(pieces)
            words.append(0)
            counts.append(n + 1)
            if len(words) >= BLOCK_WORDS:
                yield self._gather(words, counts)
                words, counts = [], []
                if len(self.words) > KEPT_WORDS // 2:
                    self.older = (self.words, self.ids, self.starts)
                    self._begin()
        if counts:
            yield self._gather(words, counts)

    def _pieces(self, word: bytes) -> list[int] | None:
        """Ids of a word of letters and final punctuation; None for others."""
        found = self.PIECES.fullmatch(word.decode("utf-8", "replace"))
        if not found:
            return None
        letters, tail = found.groups()
        if not letters.isascii():
            letters = letters.lower().encode().decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(letters)]
        return ids + [t.id for t in self.tokenize(tail)] if tail else ids

    def _fill(self, text: str | None = None) -> None:
        """Ids of what was numbered since the last call: words, and ``text`` for a text of its own."""
        new = []
        for k, w in enumerate(reversed(self.words)):
            if len(self.words) - 1 - k < self.encoded:
                break
            new.append(w)
        new.reverse()
        known, ids, starts = self.older or ({}, None, None)
        found: list = []
        for w in new:
            at = known.get(w) if isinstance(w, bytes) else None
            if at is not None:
                found.append(ids[starts[at] : starts[at + 1]])
                continue
            self.encodings += 1
            if not isinstance(w, bytes):
                found.append(self.tokenizer.encode(text, add_special_tokens=False).ids)
            else:
                found.append(self._pieces(w) if self.direct else None)
        rest = [k for k, own in enumerate(found) if own is None]
        texts = [new[k].decode("utf-8", "replace") for k in rest]
        for k, own in zip(rest, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False) if rest else ()):
            found[k] = own.ids
        for own in found:
            self.ids.extend(own)
            self.starts.append(len(self.ids))
        self.encoded = len(self.words)

    def _gather(self, words: list[int], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        self._fill()
        starts = np.frombuffer(self.starts, np.uint64).astype(np.int64)
        index = np.asarray(words, np.int64)
        first = starts[index]
        lengths = starts[index + 1] - first
        ends = np.cumsum(lengths)
        place = np.repeat(first - (ends - lengths), lengths) + np.arange(ends[-1])
        ids = np.frombuffer(self.ids, np.uint32)[place]
        last = np.cumsum(counts) - 1
        return ids, np.diff(ends[last], prepend=0)


# --- one file --------------------------------------------------------------


def open_store(folder: str):
    """File system and path of a folder given as a URI or a path."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(folder)


class Writer:
    """Writes documents in the order given; ``close`` adds the tables."""

    def __init__(self, out, width: int):
        import xxhash
        import zstandard

        self.out, self.width, self.kind = out, width, f"<u{width}"
        self.pack = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True).compress
        self.check = xxhash.xxh64_intdigest
        self.frames, self.docs, self.bytes, self.tokens = array("I"), [], 0, 0

    def put(self, doc_id: int | None, ids: np.ndarray) -> None:
        for k in range(0, max(1, len(ids)), FRAME_IDS):
            raw = ids[k : k + FRAME_IDS].astype(self.kind).tobytes()
            packed = self.pack(raw)
            self.out.write(packed)
            self.bytes += len(packed)
            self.frames.extend((len(packed), len(raw), self.check(raw) & 0xFFFFFFFF))
        self.docs.append((doc_id or 0, doc_id is None, len(ids)))
        self.tokens += len(ids)

    def close(self) -> None:
        table = struct.pack("<BQ", self.width, len(self.docs)) + np.array(self.docs, DOC).tobytes()
        frames = np.frombuffer(self.frames, np.uint32).astype("<u4").tobytes()
        n = len(self.frames) // 3
        seek = frames + struct.pack("<IBI", n, HAS_CHECKSUMS, SEEK_MAGIC)
        for magic, content in ((TABLE_MAGIC, table), (SEEK_FRAME_MAGIC, seek)):
            self.out.write(struct.pack("<II", magic, len(content)) + content)
            self.bytes += 8 + len(content)


class Reader:
    """Reads the tables of an open file; ``ids`` fetches one document."""

    def __init__(self, source):
        import xxhash
        import zstandard

        self.source, self.check = source, xxhash.xxh64_intdigest
        self.unpack = zstandard.ZstdDecompressor().decompress
        size = source.size()
        n, kind, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or kind != HAS_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        seek = size - 9 - n * FRAME.itemsize
        self.frames = np.frombuffer(self._at(seek, n * FRAME.itemsize), FRAME)
        self.offsets = np.concatenate([[0], np.cumsum(self.frames["packed"].astype(np.int64))])
        table = self._at(int(self.offsets[-1]), seek - 8 - int(self.offsets[-1]))
        magic, _, self.width, docs = struct.unpack_from("<IIBQ", table)
        if magic != TABLE_MAGIC:
            raise ValueError("no document table before the seek table")
        self.docs = np.frombuffer(table, DOC, docs, 17)
        per_doc = np.maximum(1, -(-self.docs["n"].astype(np.int64) // FRAME_IDS))
        self.first = np.concatenate([[0], np.cumsum(per_doc)])

    def _at(self, start: int, n: int) -> bytes:
        self.source.seek(start)
        return self.source.read(n)

    def ids(self, nth: int) -> np.ndarray:
        """Ids of the document at place ``nth``; its frames are checked."""
        out = []
        a, b = int(self.first[nth]), int(self.first[nth + 1])
        data = self._at(int(self.offsets[a]), int(self.offsets[b] - self.offsets[a]))
        base = int(self.offsets[a])
        for k in range(a, b):
            packed = data[int(self.offsets[k]) - base : int(self.offsets[k + 1]) - base]
            raw = self.unpack(packed, max_output_size=int(self.frames["size"][k]))
            if self.check(raw) & 0xFFFFFFFF != int(self.frames["check"][k]):
                raise ValueError(f"checksum of frame {k} does not match")
            out.append(np.frombuffer(raw, f"<u{self.width}"))
        return np.concatenate(out).astype(np.uint32)


# --- Spark jobs ------------------------------------------------------------


def _write_part(batches, folder: str, path: str, end_id: int, piecewise: bool):
    from pyspark import TaskContext

    store, root = open_store(folder)
    part = TaskContext.get().partitionId()
    encoder = Encoder.of_worker(path, end_id, piecewise)
    final = f"{root}/part-{part:06d}.ztok"
    # an attempt writes under a name of its own and renames: a lost or repeated attempt leaves no half file
    attempt = f"{root}/_attempt-{part:06d}-{TaskContext.get().taskAttemptId()}"
    writer, out = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        if writer is None:
            store.create_dir(root, recursive=True)
            out = store.open_output_stream(attempt)
            writer = Writer(out, encoder.width)
        ids = iter(batch.column(0).to_pylist())
        for flat, counts in encoder.blocks(batch.column(1).cast(pa.large_string()).to_pylist()):
            at = 0
            for n in counts.tolist():
                writer.put(next(ids), flat[at : at + n])
                at += n
    if writer is None:
        return
    writer.close()
    out.close()
    from pyarrow import fs

    if store.get_file_info(final).type != fs.FileType.NotFound:
        store.delete_file(final)
    store.move(attempt, final)
    yield pa.RecordBatch.from_pydict(
        {"file": [final.rsplit("/", 1)[1]], "part": pa.array([part], pa.int32()), "docs": [len(writer.docs)],
         "tokens": [writer.tokens], "bytes": [writer.bytes]}
    )


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id",
    text_col: str = "text", piecewise: bool = True,
) -> DataFrame:
    """Encode every whole text of ``docs``, append ``end_id`` to each, and
    write token files into ``folder`` (a path that all machines share) in
    ascending id order. Returns the manifest, one row per file.

    A null text is encoded as an empty one: the end id only. Null ids come
    first; rows that repeat are all written. Rows are dealt by ranges of id
    and a hash of the text. An empty table gives no file.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    dealt = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    write = lean(lambda batches: _write_part(batches, folder, tokenizer, end_id, piecewise), keeps="encoder")
    return stored(bounded_batches(dealt).mapInArrow(write, MANIFEST), "token-manifest")


def _read_part(batches, folder: str, wanted: frozenset | None, with_ids: bool):
    store, root = open_store(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with store.open_input_file(f"{root}/{row['file']}") as source:
                reader = Reader(source)
                before = np.concatenate([[0], np.cumsum(reader.docs["n"].astype(np.int64))])
                places = range(len(reader.docs))
                if wanted is not None:
                    places = np.flatnonzero(np.isin(reader.docs["id"], list(wanted)) & (reader.docs["null"] == 0)).tolist()
                for k in range(0, len(places), 1000):
                    chosen = places[k : k + 1000]
                    ids = [reader.ids(i) for i in chosen]
                    out = {
                        "doc_id": pa.array([None if reader.docs["null"][i] else int(reader.docs["id"][i]) for i in chosen], pa.int64()),
                        "part": pa.array([row["part"]] * len(chosen), pa.int32()),
                        "nth": pa.array(list(chosen), pa.int64()),
                        "tokens_before": pa.array(before[list(chosen)], pa.int64()),
                        "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    }
                    if with_ids:
                        out["ids"] = pa.array([x.astype(np.int64) for x in ids], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)


def read_token_files(
    manifest: DataFrame, folder: str, doc_ids: Iterable[int] | None = None, with_ids: bool = True
) -> DataFrame:
    """Documents of the files named by ``manifest``, each checked against its
    checksums: id, part, place in the file, number of ids before it in the
    file, number of ids, crc32 of the ids, and the ids. With ``doc_ids`` (a
    short list) only their frames are fetched and decompressed."""
    wanted = None if doc_ids is None else frozenset(doc_ids)
    schema = READ_SCHEMA + (", ids array<long>" if with_ids else "")
    files = manifest.select("file", "part").repartition(max(1, manifest.count()))
    return files.mapInArrow(lean(lambda batches: _read_part(batches, folder, wanted, with_ids), keeps="encoder"), schema)


def token_digest(docs: DataFrame, tokenizer: str, end_id: int = 1, folder: str | None = None) -> DataFrame:
    """Write ``docs`` as token files (into ``folder``, by default a new one in the shared
    folder), read the files back: ``doc_id, start`` (ids of all documents
    before it), ``n_tokens, ids_crc32, file``."""
    spark: SparkSession = docs.sparkSession
    folder = folder or new_scratch_dir(spark, "token-files")
    manifest = write_token_files(docs, folder, tokenizer, end_id)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    offsets = manifest.select("part", "file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("offset"))
    read = read_token_files(manifest, folder, with_ids=False)
    # one row per file; without the hint Spark would judge the other side by the manifest's size
    return read.join(F.broadcast(offsets), "part").select(
        "doc_id", (F.col("offset") + F.col("tokens_before")).cast("long").alias("start"), "n_tokens", "ids_crc32", "file"
    )

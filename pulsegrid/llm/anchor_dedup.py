"""Removal of long passages that stand in an earlier document, by
difference-cover anchors.

A window is ``width`` consecutive words of one document. A word goes if a window
that covers it also starts in a document with a smaller id.

1. Difference cover: residues ``D`` modulo a period ``v`` such that for any two
   places ``i`` and ``j`` some shift below ``v`` moves both onto residues
   of ``D``. Only the ``width - v + 1`` words from such cover places on are hashed,
   about ``sqrt(v)`` of ``v`` places. Any match of ``width`` words holds a
   shared anchor at the same offset in both documents.
2. Anchors go to hash ranges, once per block of documents, with the least and
   the greatest document of the block that has them. A range answers each block by one bit per
   anchor: do different documents have it?
3. Extension: each shared anchor is extended by the words that a window may have before and after
   it. Of every window so reached the whole ``width`` words are hashed (80 bits, of both sides and the
   anchor) and go to hash ranges with the least document of the block; the answer is one bit:
   has a document earlier than any of the block's the same words? A passage that m
   documents share costs m rows, not their pairs, and a block sends it once.
4. The covered words of each document are merged and removed.

Blocks hold documents as word numbers and their distinct words, compressed: texts are read and split
once. Each answer table is stored; blocks meet their answers by block number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import write_scratch
from pulsegrid.llm.common import Vocabulary, bounded_batches, lean, mix64, stored, trim
from pulsegrid.llm.packed import pack, pack_sorted, range_of, unpack, unpack_sorted

BLOCK_WORDS = 500_000  # a longer document is a block of its own
RANGE_KEYS = 1_000_000

# perfect difference sets: each difference modulo the period comes about exactly once
COVERS = {
    1: (0,),
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}

BLOCKS = "block long, words_n long, ids binary, known binary, counts binary, seq binary, words binary"
KEYS = "part int, block long, keys binary, checks binary, low binary, more binary"
ANSWERS = "step int, part int, block long, bits binary"
OUT = "doc_id long, n_words long, removed array<struct<start:bigint,length:bigint>>, kept string"

FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64


def cover_for(width: int) -> tuple[int, tuple[int, ...]]:
    """Period and residues for windows of ``width`` words: the longest period
    that leaves anchors of two fifths of a window."""
    v = max(p for p in COVERS if width - p + 1 >= max(1, -(-2 * width // 5)))
    return v, COVERS[v]


# --- hashes of a block -------------------------------------------------------------


class Block:
    """Documents of one block, opened."""

    def __init__(self, row, width: int):
        import xxhash
        import zstandard

        self.width = width
        self.id = unpack(row["ids"], np.int64)  # 0 where null
        self.named = unpack(row["known"], np.uint8).astype(bool)
        self.counts = unpack(row["counts"], np.int64)
        self.starts = np.cumsum(self.counts) - self.counts
        self.seq = unpack(row["seq"], np.uint32)
        self.words = zstandard.ZstdDecompressor().decompress(row["words"]).split()
        table = np.fromiter(map(xxhash.xxh64_intdigest, self.words), np.uint64, len(self.words))
        self.hashes = table[self.seq] if len(self.seq) else np.zeros(0, np.uint64)
        n = len(self.seq)
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.place = np.arange(n) - self.starts[self.doc]
        self.left = self.counts[self.doc] - self.place  # words from here to the document's end
        self.known = self.named[self.doc]
        powers = np.full(n + 1, FACTOR, np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers, dtype=np.uint64)
        powers[1:] = pow(FACTOR, -1, 1 << 64)
        self.inverse = np.cumprod(powers, dtype=np.uint64)

    def sums(self, salt: int = 0) -> np.ndarray:
        own = mix64(self.hashes + np.uint64(salt)) if salt else self.hashes
        out = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(own * self.powers[:-1], out=out[1:])
        return out

    def at(self, sums: np.ndarray, places: np.ndarray, n: int) -> np.ndarray:
        """Hash of the ``n`` words from each place on."""
        return mix64((sums[places + n] - sums[places]) * self.inverse[places])

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Cover places, and the hashes of their anchors."""
        v, cover = cover_for(self.width)
        size = self.width - v + 1
        wanted = np.zeros(v, bool)
        wanted[list(cover)] = True
        whole = self.known & (self.counts[self.doc] >= self.width) & (self.left >= size)
        places = np.flatnonzero(whole & wanted[self.place % v])
        return places, self.at(self.sums(), places, size)

    def windows(self, shared: np.ndarray) -> np.ndarray:
        """Places of the windows that hold one of the ``shared`` anchors."""
        v, _ = cover_for(self.width)
        first = np.maximum(shared - v + 1, self.starts[self.doc[shared]])
        reach = np.zeros(len(self.seq) + 1, np.int64)
        np.add.at(reach, first, 1)
        np.add.at(reach, shared + 1, -1)
        return np.flatnonzero((np.cumsum(reach)[:-1] > 0) & (self.left >= self.width))


class Groups:
    """Equal (key, check) rows of arrays, in ascending order."""

    def __init__(self, keys: np.ndarray, checks: np.ndarray | None = None):
        self.order = np.argsort(keys, kind="stable") if checks is None else np.lexsort((checks, keys))
        keys = keys[self.order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        if checks is not None:
            checks = checks[self.order]
            new[1:] |= checks[1:] != checks[:-1]
        self.first = np.flatnonzero(new)
        self.index = np.empty(len(keys), np.int64)  # of each row: its group
        self.index[self.order] = np.cumsum(new) - 1
        self.keys = keys[self.first]
        self.checks = None if checks is None else checks[self.first]

    def least(self, values: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(values[self.order], self.first) if len(self.first) else values[:0]

    def most(self, values: np.ndarray) -> np.ndarray:
        return np.maximum.reduceat(values[self.order], self.first) if len(self.first) else values[:0]


# --- tasks ---------------------------------------------------------------------------


def _block_rows(batches) -> Iterator[pa.RecordBatch]:
    import zstandard
    from pyspark import TaskContext

    part, made = TaskContext.get().partitionId(), 0
    ids, counts, seqs, vocab, size = [], [], [], Vocabulary(), 0

    def close() -> pa.RecordBatch:
        nonlocal made
        made += 1
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([(part << 32) + made], pa.int64()),
                "words_n": pa.array([sum(counts)], pa.int64()),
                "ids": pa.array([pack(np.array([i or 0 for i in ids], np.int64))], pa.binary()),
                "known": pa.array([pack(np.array([i is not None for i in ids], np.uint8))], pa.binary()),
                "counts": pa.array([pack(np.array(counts, np.int64))], pa.binary()),
                "seq": pa.array([pack(np.concatenate(seqs))], pa.binary()),
                "words": pa.array([zstandard.ZstdCompressor(level=1).compress(b" ".join(vocab))], pa.binary()),
            }
        )

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            words = (text.as_py() or b"").split()
            ids.append(doc_id)
            counts.append(len(words))
            seqs.append(np.fromiter(map(vocab.__getitem__, words), np.uint32, len(words)))
            size += len(words) + 1
            if size >= BLOCK_WORDS:
                yield close()
                ids, counts, seqs, vocab, size = [], [], [], Vocabulary(), 0
    if ids:
        yield close()


def _key_rows(block: int, groups: Groups, low: np.ndarray, more: np.ndarray | None, parts: int) -> Iterator[dict]:
    cuts = np.searchsorted(range_of(groups.keys, parts), np.arange(parts + 1))
    for p in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[p], cuts[p + 1])
        yield {
            "part": p, "block": block, "keys": pack_sorted(groups.keys[own]),
            "checks": None if groups.checks is None else pack(groups.checks[own]),
            "low": pack(low[own]), "more": None if more is None else pack(more[own]),
        }


def _anchor_rows(batches, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in ("keys", "checks", "low", "more"))])
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row, width)
            places, hashes = block.anchors()
            groups, ids = Groups(hashes), block.id[block.doc[places]]
            low = groups.least(ids)
            for out in _key_rows(row["block"], groups, low, groups.most(ids) - low, parts):
                yield pa.RecordBatch.from_pylist([out], schema)


def _range_answers(key, rows: pd.DataFrame, step: int) -> pd.DataFrame:
    """One range: a bit per key of each block. Step 0: do several documents
    have it? Step 1: has an earlier document than any of the block's own it?"""
    lists = [unpack_sorted(k) for k in rows["keys"]]
    low = [unpack(x, np.int64) for x in rows["low"]]
    checks = None if step == 0 else np.concatenate([unpack(c, np.uint16) for c in rows["checks"]])
    groups = Groups(np.concatenate(lists), checks)
    least = groups.least(np.concatenate(low))[groups.index]
    if step == 0:
        high = np.concatenate(low) + np.concatenate([unpack(x, np.int64) for x in rows["more"]])
        bits = least != groups.most(high)[groups.index]
    else:
        bits = least < np.concatenate(low)
    cuts = np.cumsum([len(k) for k in lists])[:-1]
    trim()
    return pd.DataFrame(
        {
            "step": step, "part": int(key[0]), "block": rows["block"],
            "bits": [pack(np.packbits(b)) for b in np.split(bits, cuts)],
        }
    )


def _bits(answers: pd.DataFrame, step: int, keys: np.ndarray, parts: int) -> np.ndarray:
    """The answers of a step in the order of the block's keys."""
    sizes = np.bincount(range_of(keys, parts).astype(np.int64), minlength=parts)
    out = [np.zeros(0, bool)]
    for part, bits in answers[answers["step"] == step].sort_values("part")[["part", "bits"]].itertuples(index=False):
        out.append(np.unpackbits(unpack(bits, np.uint8), count=int(sizes[part])).astype(bool))
    return np.concatenate(out)


def _windows(blocks: pd.DataFrame, answers: pd.DataFrame, width: int, parts: int) -> tuple[Block, np.ndarray, Groups, np.ndarray]:
    """A block, the windows that its shared anchors extend to, their groups,
    and the least document of each group."""
    block = Block(blocks.iloc[0], width)
    places, hashes = block.anchors()
    anchors = Groups(hashes)
    shared = _bits(answers, 0, anchors.keys, parts)
    windows = block.windows(places[shared[anchors.index]]) if shared.any() else np.zeros(0, np.int64)
    keys = block.at(block.sums(), windows, width)
    checks = (block.at(block.sums(salt=1), windows, width) >> np.uint64(48)).astype(np.uint16)
    groups = Groups(keys, checks)
    return block, windows, groups, groups.least(block.id[block.doc[windows]])


def _window_rows(blocks: pd.DataFrame, answers: pd.DataFrame, width: int, parts: int, window_parts: int) -> pd.DataFrame:
    trim()
    if not len(blocks) or not len(answers):
        return pd.DataFrame({c.split()[0]: [] for c in KEYS.split(", ")})
    _, _, groups, low = _windows(blocks, answers, width, parts)
    rows = list(_key_rows(int(blocks["block"].iloc[0]), groups, low, None, window_parts))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in KEYS.split(", ")])


def _removed(blocks: pd.DataFrame, answers: pd.DataFrame, width: int, parts: int, window_parts: int) -> pd.DataFrame:
    trim()
    names = [c.split()[0] for c in OUT.split(", ")]
    if not len(blocks):
        return pd.DataFrame({c: [] for c in names})
    block, windows, groups, low = _windows(blocks, answers, width, parts)
    gone = np.zeros(len(block.seq), bool)
    if len(windows):
        before = _bits(answers, 1, groups.keys, window_parts)
        repeated = windows[before[groups.index] | (block.id[block.doc[windows]] > low[groups.index])]
        cover = np.zeros(len(block.seq) + 1, np.int64)
        np.add.at(cover, repeated, 1)
        np.add.at(cover, repeated + width, -1)
        gone = np.cumsum(cover)[:-1] > 0
    rows = []
    ids = [i if named else None for i, named in zip(block.id.tolist(), block.named.tolist())]
    for doc_id, a, n in zip(ids, block.starts.tolist(), block.counts.tolist()):
        own, seq, spans = gone[a : a + n], block.seq[a : a + n], []
        if own.any():
            edges = np.flatnonzero(np.diff(own, prepend=False, append=False))
            spans = [(s, e - s) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist())]
            seq = seq[~own]
        rows.append((doc_id, n, spans, b" ".join(map(block.words.__getitem__, seq.tolist())).decode("utf-8", "replace")))
    out = pd.DataFrame(rows, columns=names)
    out["doc_id"] = pd.array(ids, "Int64")
    return out


def remove_repeated_passages(
    docs: DataFrame, width: int = 50, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, removed, kept`` of every row: its number of words, the
    stretches of words removed (start, length), and the words left, joined by one space.

    Words are runs of anything but ASCII white space, unchanged. A window is ``width``
    consecutive words; a document of fewer has none and stays whole. All windows are judged on the input. Windows
    that a document repeats within itself stay. A null text has no words. Rows that share
    an id are one document here: none is earlier than the other. A row without
    an id is neither earlier nor later than any: it stays whole and removes nothing. An
    empty table gives an empty result. Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    blocks, _ = write_scratch(bounded_batches(rows).mapInArrow(lean(_block_rows), BLOCKS), "anchor-blocks")
    size = blocks.agg(F.sum("words_n")).first()[0] or 0
    v, cover = cover_for(width)
    parts = int(-(-size * len(cover) // (v * RANGE_KEYS)) or 1)
    window_parts = int(-(-size // (2 * RANGE_KEYS)) or 1)
    keys = blocks.mapInArrow(lean(lambda b: _anchor_rows(b, width, parts)), KEYS)

    def answer(step: int):
        return lambda key, rows: _range_answers(key, rows, step)

    shared = stored(keys.groupBy("part").applyInPandas(answer(0), ANSWERS), "anchor-answers")

    def extend(b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        return _window_rows(b, a, width, parts, window_parts)

    def remove(b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        return _removed(b, a, width, parts, window_parts)

    windows = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInPandas(extend, KEYS)
    earlier = stored(windows.groupBy("part").applyInPandas(answer(1), ANSWERS), "window-answers")
    answers = shared.unionByName(earlier)
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(remove, OUT)


def passage_digest(docs: DataFrame, width: int = 50) -> DataFrame:
    """Per document: words, removed words, digest of the kept ones."""
    return remove_repeated_passages(docs, width).select(
        "doc_id", "n_words",
        F.coalesce(F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["length"]), F.lit(0)).cast("long").alias("n_removed"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )

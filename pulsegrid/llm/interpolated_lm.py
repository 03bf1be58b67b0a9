"""Language-model scoring by deleted interpolation.

Bigram and unigram maximum-likelihood estimates and a uniform share for
unknown words are mixed. The weight of the bigram estimate depends on the
bucket (power of two) of its context's frequency; the weights are learned by
expectation-maximisation on held-out counts: one eighth of the training
documents is kept out of the counts while the weights are fitted, and counts
again in the final model.

The corpus is tokenised once into blocks of whole documents. A block lists
its distinct n-grams once each, as sorted 64-bit hashes in packed columns, dealt by ranges
of the hash. The task of a range sums the counts of all blocks and answers
each block with the totals in the block's own order, so only counts travel back.
Blocks then score their documents. No table of n-grams is broadcast, and a
frequent word costs one entry per block.

The fit needs, for held-out tokens, only how often each combination of
bucket and estimates occurs: a histogram of bounded size (estimates to a
quarter of an octave) over all held-out documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import Vocabulary, bounded_batches, id_remainder, lean, mix64, stored, text_bytes, trim
from pulsegrid.llm.packed import pack, pack_sorted, range_of, unpack, unpack_sorted

FOLDS, TEST_FOLD, FIT_SHARE = 7, 2, 8
TRAIN, FIT, TEST = 0, 1, 2  # counted; counted, but held out of the fit; never counted
BLOCK_TOKENS = 1_500_000
RANGE_TOKENS = 2_000_000
BUCKETS = 32
PER_OCTAVE = 4
NONE = -(1 << 15)  # no estimate
ROUNDS = 60

BLOCKS = "block long, role int, tokens long, doc_ids array<long>, counts array<int>, seq binary, words binary"
KEYS = "gram int, part int, block long, role int, keys binary, counts binary"
TOTALS = "block long, gram int, part int, full binary, kept binary, words long, tokens long, kept_words long, kept_tokens long"
HISTOGRAM = "bucket int, two int, one int, n long"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


# --- blocks ----------------------------------------------------------------


def _block_rows(batches) -> Iterator[pa.RecordBatch]:
    """Documents of one role to blocks; word 0 of a block is the end."""
    import xxhash
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    made = 0

    class Open:
        def __init__(self):
            self.vocab = Vocabulary()
            self.vocab[None] = 0
            self.ids, self.counts, self.seqs, self.tokens = [], [], [], 0

    def close(role: int, b: Open) -> pa.RecordBatch:
        nonlocal made
        words = np.fromiter(
            (1 if w is None else xxhash.xxh64_intdigest(w) for w in b.vocab), np.uint64, len(b.vocab)
        )
        made += 1
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([(part << 32) + made], pa.int64()),
                "role": pa.array([role], pa.int32()),
                "tokens": pa.array([b.tokens], pa.int64()),
                "doc_ids": pa.array([b.ids], pa.list_(pa.int64())),
                "counts": pa.array([b.counts], pa.list_(pa.int32())),
                "seq": pa.array([pack(np.concatenate(b.seqs))], pa.binary()),
                "words": pa.array([pack(words)], pa.binary()),
            }
        )

    opened = {r: Open() for r in (TRAIN, FIT, TEST)}
    for batch in batches:
        texts = batch.column(2).cast(pa.large_string()).to_pylist()
        for doc_id, role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            b = opened[role]
            words = text_bytes(text).split()
            words.append(None)
            b.seqs.append(np.fromiter(map(b.vocab.__getitem__, words), np.uint32, len(words)))
            b.ids.append(doc_id)
            b.counts.append(len(words))
            b.tokens += len(words)
            if b.tokens >= BLOCK_TOKENS:
                yield close(role, b)
                opened[role] = Open()
    for role, b in opened.items():
        if b.ids:
            yield close(role, b)


class Block:
    """A block's tokens and its sorted distinct n-grams."""

    def __init__(self, seq: bytes, words: bytes):
        self.seq = unpack(seq, np.uint32).astype(np.int64)
        self.words = unpack(words, np.uint64)
        # the context of a document's first token is the end of another document
        self.prev = np.concatenate([[0], self.seq[:-1]])

    def grams(self, gram: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted distinct hashes; which of them each token (2) or word (1) is."""
        if gram == 1:
            return np.unique(self.words, return_inverse=True)
        pairs = mix64(self.words[self.prev] * np.uint64(0x9E3779B97F4A7C15) + self.words[self.seq])
        return np.unique(pairs, return_inverse=True)


def _key_rows(batches, parts: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            block = Block(row["seq"], row["words"])
            for gram in (1, 2):
                keys, index = block.grams(gram)
                which = index[block.seq] if gram == 1 else index
                counts = np.bincount(which, minlength=len(keys)).astype(np.uint32)
                cuts = np.searchsorted(range_of(keys, parts[gram]), np.arange(parts[gram] + 1))
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    a, b = cuts[p], cuts[p + 1]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "gram": pa.array([gram], pa.int32()),
                            "part": pa.array([p], pa.int32()),
                            "block": pa.array([row["block"]], pa.int64()),
                            "role": pa.array([row["role"]], pa.int32()),
                            "keys": pa.array([pack_sorted(keys[a:b])], pa.binary()),
                            "counts": pa.array([pack(counts[a:b])], pa.binary()),
                        }
                    )


def _range_totals(key, rows: pd.DataFrame) -> pd.DataFrame:
    """Totals of one range of hashes, in the order of each block's keys."""
    gram, part = int(key[0]), int(key[1])
    lists = [unpack_sorted(k) for k in rows["keys"]]
    role = np.repeat(rows["role"].to_numpy(), [len(k) for k in lists])
    counts = np.concatenate([unpack(c, np.uint32) for c in rows["counts"]]).astype(np.float64)
    keys, index = np.unique(np.concatenate(lists), return_inverse=True)
    full = np.bincount(index, counts * (role != TEST), len(keys)).astype(np.uint64)
    kept = np.bincount(index, counts * (role == TRAIN), len(keys)).astype(np.uint64)
    out, at = [], 0
    for block, r, k in zip(rows["block"], rows["role"], lists):
        here = index[at : at + len(k)]
        at += len(k)
        out.append((block, gram, part, pack(full[here]), pack(kept[here]) if r == FIT else None, None, None, None, None))
    out.append((-1, gram, part, None, None, int((full > 0).sum()), int(full.sum()), int((kept > 0).sum()), int(kept.sum())))
    names = [c.split()[0] for c in TOTALS.split(", ")]
    trim()
    return pd.DataFrame(out, columns=names).astype({n: "Int64" for n in names[5:]})


def _counts(block: Block, totals: pd.DataFrame, which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: count of the bigram, of its context, of the word."""
    values = {}
    for gram in (1, 2):
        rows = totals[totals["gram"] == gram].sort_values("part")
        values[gram] = np.concatenate([unpack(x, np.uint64) for x in rows[which]]).astype(np.int64)
    word = values[1][block.grams(1)[1]]
    return values[2][block.grams(2)[1]], word[block.prev], word[block.seq]


# --- weights ---------------------------------------------------------------


def bucket_of(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else 1 + floor(log2 of its count)."""
    return np.where(context > 0, np.minimum(np.frexp(context.astype(np.float64))[1], BUCKETS - 1), 0)


def level_of(estimate: np.ndarray) -> np.ndarray:
    """Estimates to steps of a quarter octave; NONE for 0."""
    with np.errstate(divide="ignore"):
        steps = np.round(np.log2(estimate) * PER_OCTAVE)
    return np.where(estimate > 0, steps, NONE).astype(np.int64)


def _histogram(blocks: pd.DataFrame, totals: pd.DataFrame, n: int, v: int) -> pd.DataFrame:
    if not len(blocks):
        return pd.DataFrame({"bucket": [], "two": [], "one": [], "n": []}).astype("int64")
    block = Block(blocks["seq"].iloc[0], blocks["words"].iloc[0])
    pair, context, word = _counts(block, totals, "kept")
    # estimates relative to the uniform share 1 / (v + 1)
    two = level_of(pair / np.maximum(1, context) * (v + 1))
    one = level_of(word / max(1, n) * (v + 1))
    seen, count = np.unique(np.stack([bucket_of(context), two, one], axis=1), axis=0, return_counts=True)
    return pd.DataFrame({"bucket": seen[:, 0], "two": seen[:, 1], "one": seen[:, 2], "n": count})


def _em(left: np.ndarray, right: np.ndarray, n: np.ndarray) -> float:
    """Weight of ``left`` in a mixture with ``right``, by EM."""
    weight = 0.5
    if n.sum() == 0:
        return weight
    for _ in range(ROUNDS):
        part = weight * left
        weight = float((n * part / (part + (1 - weight) * right)).sum() / n.sum())
        weight = min(max(weight, 1e-6), 1 - 1e-6)
    return weight


def fit_weights(histogram: list[tuple[int, int, int, int]]) -> tuple[float, list[float]]:
    """Weight of the unigram against the uniform estimate, and per bucket of
    the bigram against both, from held-out counts. A bucket without held-out
    tokens takes the weight of the nearest lower one."""
    rows = np.array(histogram, np.float64).reshape(-1, 4)
    estimate = lambda x: np.where(x > NONE, np.exp2(x / PER_OCTAVE), 0.0)
    one, two, n = estimate(rows[:, 2]), estimate(rows[:, 1]), rows[:, 3]
    low = _em(one, np.ones(len(rows)), n)
    rest = low * one + (1 - low)
    weights, last = [0.0], 0.5
    for b in range(1, BUCKETS):
        here = rows[:, 0] == b
        if n[here].sum():
            last = _em(two[here], rest[here], n[here])
        weights.append(last)
    return low, weights


# --- scores ----------------------------------------------------------------


def _score(blocks: pd.DataFrame, totals: pd.DataFrame, n: int, v: int, low: float, high: list[float]) -> pd.DataFrame:
    if not len(blocks):
        return pd.DataFrame({c.split()[0]: [] for c in SCORES.split(", ")})
    block = Block(blocks["seq"].iloc[0], blocks["words"].iloc[0])
    pair, context, word = _counts(block, totals, "full")
    counts = np.asarray(blocks["counts"].iloc[0], np.int64)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    one = low * word / max(1, n) + (1 - low) / (v + 1)
    weight = np.asarray(high)[bucket_of(context)]
    mixed = weight * pair / np.maximum(1, context) + (1 - weight) * one
    add = lambda x: np.add.reduceat(x, starts)
    return pd.DataFrame(
        {
            "doc_id": pd.array([None if d is None or d != d else int(d) for d in blocks["doc_ids"].iloc[0]], "Int64"),
            "held_out": bool(blocks["role"].iloc[0] == TEST),
            "n_tokens": counts,
            "n_known": add((word > 0).astype(np.int64)),
            "base_score": add(np.log10((word + 1) / (n + 1 * (v + 1)))),
            "score": add(np.log10(mixed)),
        }
    )


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Log10 probability of every whole text under the model learned from the
    rows whose crc32(id as text) modulo 7 is not 2: ``doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score``.

    Tokens are words between ASCII white space, A-Z lowered, then one end. A
    null or empty text is the end alone. A null id belongs to the training rows.
    Rows that repeat count and are scored each. ``base_score`` is the add-one
    unigram baseline. Without training rows every token is unknown and
    scores 0. An empty table gives an empty result.
    """
    fold = F.coalesce(F.crc32(F.col(id_col).cast("string")), F.lit(0))
    role = F.when(id_remainder(id_col, FOLDS) == TEST_FOLD, TEST).when((fold / FOLDS).cast("long") % FIT_SHARE == 0, FIT)
    rows = docs.select(
        F.col(id_col).cast("long"), role.otherwise(TRAIN).cast("int").alias("role"), F.col(text_col).cast("string")
    )
    blocks = stored(bounded_batches(rows).mapInArrow(lean(_block_rows), BLOCKS), "lm-blocks")
    size = blocks.agg(F.sum("tokens")).first()[0] or 0
    parts = {1: -(-size // (8 * RANGE_TOKENS)) or 1, 2: -(-size // RANGE_TOKENS) or 1}
    keys = blocks.select("block", "role", "seq", "words").mapInArrow(lean(lambda b: _key_rows(b, parts)), KEYS)
    totals = stored(keys.groupBy("gram", "part").applyInPandas(_range_totals, TOTALS), "lm-totals")
    sums = totals.filter("block = -1 and gram = 1").agg(
        *[F.coalesce(F.sum(c), F.lit(0)) for c in ("words", "tokens", "kept_words", "kept_tokens")]
    )
    v, n, kept_v, kept_n = sums.first()
    answers = totals.filter("block >= 0")

    def together(blocks: DataFrame, answers: DataFrame, work, schema: str) -> DataFrame:
        return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(work, schema)

    held = together(
        blocks.filter(F.col("role") == FIT).select("block", "seq", "words"),
        answers.filter("kept is not null").select("block", "gram", "part", "kept"),
        lambda b, t: _histogram(b, t, kept_n, kept_v), HISTOGRAM,
    )
    histogram = held.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).collect()  # buckets x levels x levels
    low, high = fit_weights([tuple(r) for r in histogram])
    low = low if n else 0.0
    scored = together(
        blocks.select("block", "role", "doc_ids", "counts", "seq", "words"),
        answers.select("block", "gram", "part", "full"),
        lambda b, t: _score(b, t, n, v, low, high), SCORES,
    )
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score"
    )

"""Periodic runs of words, found through a run-length grammar.

A run is a maximal stretch of words with smallest period ``q`` (words ``q``
apart are identical) that holds at least ``EXPONENT`` periods.

* Recompression: the sequence of word numbers is compressed by rounds. A round
  first replaces every block of equal symbols by one symbol (a run-length
  rule), then every adjacent pair of a left and a right symbol by one (the
  sides are drawn per round from a hash). Equal places of the sequence are
  compressed alike but for a few symbols at their ends. :class:`Grammar` keeps each
  round's symbols and the boundaries they share with the round below.
* Longest common extensions: two places are extended by comparing symbols of
  the highest round at whose boundaries both stand, climbing first and
  descending at the end: a handful of comparisons per round, whatever the
  extension's length. A block of equal symbols is one comparison. Nothing is hashed, so extensions are exact.
* Harmonic grid: a run of period ``q`` holds ``EXPONENT`` consecutive multiples
  of ``q``, whose words are equal. Such grid places are the candidates, n/q for
  each q, and their extensions both ways are the stretches of period ``q``. A stretch
  stands for its smallest period only.

No suffix array or suffix tree is built. Documents of a block are joined by
separators that occur once, which no extension can cross.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import Vocabulary, bounded_batches, lean, mix64

EXPONENT = 4
SHORTEST = 6
BLOCK_WORDS = 150_000  # a longer document is a block of its own
QUERIES = 200_000  # candidates extended at once
SMALL = 16  # a round of so few symbols is compressed no further

RUNS = "runs array<struct<start:bigint,length:bigint,period:bigint>>"
SCHEMA = f"doc_id long, n_words long, {RUNS}, collapsed string"


# --- the grammar ---------------------------------------------------------------


class Level:
    """Symbols of one round. ``up``: the boundary's number in the next round
    (-1: inside one of its symbols), ``down``: the way back; ``phrase``, in rounds that go on to blocks, the
    next round's symbol that each symbol belongs to."""

    __slots__ = ("symbols", "up", "down", "phrase")

    def __init__(self, symbols: np.ndarray):
        # one mark before the first and one after the last symbol: neither equals anything
        self.symbols = np.concatenate([[-2], symbols, [-1]])
        self.up = self.down = self.phrase = None

    def cut(self, first: np.ndarray, blocks: bool) -> None:
        """The next round's symbols begin where ``first`` holds."""
        n = len(first)
        self.down = np.append(np.flatnonzero(first), n)
        self.up = np.full(n + 1, -1, np.int64)
        self.up[self.down] = np.arange(len(self.down))
        if blocks:
            self.phrase = np.cumsum(first) - 1


class Grammar:
    """Run-length grammar of ``sequence`` (numbers from 0)."""

    def __init__(self, sequence: np.ndarray):
        symbols = np.asarray(sequence, np.int64)
        self.levels = [Level(symbols)]
        self.fresh = int(symbols.max()) + 1 if len(symbols) else 0
        while len(symbols) > SMALL and len(self.levels) < 200:
            symbols = self._next(symbols, *self._blocks(symbols), blocks=True)
            symbols = self._next(symbols, *self._pairs(symbols), blocks=False)

    def _next(self, symbols, first, number, blocks: bool) -> np.ndarray:
        self.levels[-1].cut(first, blocks)
        out = symbols[first]
        changed = number >= 0
        if changed.any():
            _, index = np.unique(number[changed], return_inverse=True)
            out[changed] = self.fresh + index
            self.fresh += int(index.max()) + 1
        self.levels.append(Level(out))
        return out

    def _blocks(self, symbols):
        """Blocks of equal symbols: where they begin, and what tells the rules apart (-1: single symbol, no rule)."""
        first = np.ones(len(symbols), bool)
        first[1:] = symbols[1:] != symbols[:-1]
        lengths = np.diff(np.append(np.flatnonzero(first), len(symbols)))
        return first, np.where(lengths > 1, symbols[first] * (len(symbols) + 1) + lengths, -1)

    def _pairs(self, symbols):
        """Pairs of a left and a right symbol. No two neighbours are equal here, so a quarter of them pair up on average."""
        salt = np.uint64(len(self.levels) * 0x9E3779B97F4A7C15 % (1 << 64))
        right = (mix64(symbols.astype(np.uint64) + salt) & np.uint64(1)).astype(bool)
        paired = ~right[:-1] & right[1:]
        first = np.ones(len(symbols), bool)
        first[1:] = ~paired
        number = np.full(len(symbols), -1, np.int64)
        number[:-1][paired] = symbols[:-1][paired] * np.int64(self.fresh) + symbols[1:][paired]
        return first, number[first]

    def extend(self, i: np.ndarray, j: np.ndarray, forward: bool = True) -> np.ndarray:
        """Length of the longest common extension from the boundaries ``i`` and
        ``j`` (i < j), to the right, or to the left."""
        at, to = np.array(i, np.int64), np.array(j, np.int64)
        stopped = np.full(len(at), len(self.levels) - 1)  # the round in which symbols first differ
        climbing = np.arange(len(at))
        for number, level in enumerate(self.levels[:-1]):
            waiting = climbing
            while len(waiting):
                apart = (level.up[at[waiting]] < 0) | (level.up[to[waiting]] < 0)
                waiting = waiting[apart]
                equal = self._advance(level, at, to, waiting, forward)
                stopped[waiting[~equal]] = number
                waiting = waiting[equal]
            climbing = climbing[stopped[climbing] > number]
            at[climbing], to[climbing] = level.up[at[climbing]], level.up[to[climbing]]
        for number in range(len(self.levels) - 1, -1, -1):
            level = self.levels[number]
            here = np.flatnonzero(stopped >= number)
            waiting = here
            while len(waiting):
                waiting = waiting[self._advance(level, at, to, waiting, forward)]
            if number:
                below = self.levels[number - 1].down
                at[here], to[here] = below[at[here]], below[to[here]]
        return at - i if forward else i - at

    def _advance(self, level: Level, at, to, which, forward: bool) -> np.ndarray:
        """Pass equal symbols (of equal blocks as many as both have left);
        tells where they are equal."""
        a, b = at[which], to[which]
        side = int(forward)
        equal = level.symbols[a + side] == level.symbols[b + side]
        a, b, moved = a[equal], b[equal], which[equal]
        if level.phrase is None:
            step = np.ones(len(a), np.int64)
        elif forward:
            step = np.minimum(level.down[level.phrase[a] + 1] - a, level.down[level.phrase[b] + 1] - b)
        else:
            step = np.minimum(a - level.down[level.phrase[a - 1]], b - level.down[level.phrase[b - 1]])
        step = step if forward else -step
        at[moved], to[moved] = a + step, b + step
        return equal


# --- runs of a sequence -----------------------------------------------------------


def _grid(sequence: np.ndarray, longest: int) -> Iterable[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Candidates in bounded pieces: grid place, period, and the last place of
    the stretch of candidates it begins."""
    waiting, size = [], 0
    for q in range(1, longest + 1):
        words = sequence[::q]
        if len(words) < EXPONENT:
            break
        equal = words[1:] == words[:-1]
        whole = equal[: 2 - EXPONENT]
        for k in range(1, EXPONENT - 1):
            whole = whole & equal[k : len(equal) - (EXPONENT - 2 - k)]
        places = np.flatnonzero(whole)
        if not len(places):
            continue
        begins = np.ones(len(places), bool)
        begins[1:] = np.diff(places) > 1
        begin = np.flatnonzero(begins)
        end = np.append(begin[1:], len(places)) - 1
        waiting.append((places[begin] * q, np.full(len(begin), q), places[end] * q))
        size += len(begin)
        if size >= QUERIES:
            yield tuple(map(np.concatenate, zip(*waiting)))
            waiting, size = [], 0
    if waiting:
        yield tuple(map(np.concatenate, zip(*waiting)))


def find_runs(sequence: np.ndarray, longest: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, sorted by start, then period.
    ``longest``: no period beyond it is looked for (none can have a run
    beyond a ``EXPONENT``-th of the sequence)."""
    n = len(sequence)
    grammar, found = None, [np.zeros((3, 0), np.int64)]
    for place, period, last in _grid(sequence, min(n // EXPONENT, longest or n)):
        grammar = grammar or Grammar(sequence)
        while len(place):
            start = place - grammar.extend(place, place + period, forward=False)
            end = place + period + grammar.extend(place, place + period)
            whole = end - start >= np.maximum(SHORTEST, EXPONENT * period)
            found.append(np.stack([start, end - start, period])[:, whole])
            # the next stretch of this period holds no pair of this one's end
            place = ((end - period) // period + 1) * period
            more = place <= last
            place, period, last = place[more], period[more], last[more]
    runs = np.concatenate(found, axis=1)
    runs = runs[:, np.lexsort((runs[2], runs[1], runs[0]))]
    smallest = np.ones(runs.shape[1], bool)
    smallest[1:] = (runs[:2, 1:] != runs[:2, :-1]).any(axis=0)
    runs = runs[:, smallest]
    return tuple(runs[:, np.lexsort((runs[2], runs[0]))])


# --- Spark job ------------------------------------------------------------------


def _block(ids: list, seqs: list[np.ndarray], words: list[bytes]) -> pa.RecordBatch:
    """Runs and collapsed texts of the documents of one block."""
    sizes = np.array([len(s) for s in seqs], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    sequence = np.empty(int((sizes + 1).sum()), np.int64)
    for s, a, n in zip(seqs, starts.tolist(), sizes.tolist()):
        sequence[a : a + n] = s
    sequence[starts + sizes] = len(words) + np.arange(len(seqs))  # separators
    start, length, period = find_runs(sequence, int(sizes.max()) // EXPONENT)
    depth = np.zeros(len(sequence) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    kept = np.cumsum(depth)[:-1] == 0
    doc = np.searchsorted(starts, start, side="right") - 1
    cuts = np.searchsorted(doc, np.arange(len(seqs) + 1))
    texts = []
    for s, a, n in zip(seqs, starts.tolist(), sizes.tolist()):
        own = kept[a : a + n]
        s = s if own.all() else s[own]
        texts.append(b" ".join(map(words.__getitem__, s.tolist())))
    runs = pa.StructArray.from_arrays(
        [pa.array(start - starts[doc]), pa.array(length), pa.array(period)], ["start", "length", "period"]
    )
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(ids, pa.int64()),
            "n_words": pa.array(sizes),
            "runs": pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), runs),
            "collapsed": pa.array(texts, pa.binary()).cast(pa.string()),
        }
    )


def _documents(batches, rewrite):
    for batch in batches:
        ids, seqs, vocab, size = [], [], Vocabulary(), 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())):
            words = (text.as_py() or b"").split()
            seq = np.fromiter(map(vocab.__getitem__, words), np.int64, len(words))
            seqs.append(seq if rewrite is None else rewrite(doc_id, seq))
            ids.append(doc_id)
            size += len(words) + 1
            if size >= BLOCK_WORDS:
                yield _block(ids, seqs, list(vocab))
                ids, seqs, vocab, size = [], [], Vocabulary(), 0
        if ids:
            yield _block(ids, seqs, list(vocab))


def periodic_runs(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rewrite: Callable[[int | None, np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row: its runs (start,
    length, period, in words, by start, then period), and its words without
    those that a run repeats after its first period, joined by one space.

    Words are runs of anything but ASCII white space, unchanged. A text that is null, empty
    or blank has no words, no runs and an empty collapsed text. Rows that repeat
    are all returned; a null id is kept. An empty table gives an empty result.
    Other columns are not read. ``rewrite`` may replace the word numbers of a
    document before runs are looked for. A map over documents: nothing is
    shuffled, a document is held whole by one task, with about 150 bytes per word.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return bounded_batches(rows).mapInArrow(lean(lambda batches: _documents(batches, rewrite)), SCHEMA)


def planted_run(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """The words of a document of which a tail may be made periodic: with ``h``
    the crc32 of the id as text and ``g = h // 10``, where 10 divides ``h``
    the words from ``g % n`` on repeat with a period of a third or less of what follows.
    A null id is never planted."""
    import zlib

    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])


def runs_digest(docs: DataFrame) -> DataFrame:
    """Per document of ``docs``, tails planted as :func:`planted_run` does: number of runs, the longest
    run (ties: smallest start, then period; nulls without a run), and digests
    of all runs and of the collapsed text."""
    found = periodic_runs(docs, rewrite=planted_run)
    best = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"], r["start"], r["period"]))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    out = found.select("doc_id", "runs", "n_words", best.alias("best"), F.array_join(lines, "").alias("lines"), "collapsed")
    start, length, period = F.col("best.start"), F.col("best.length"), F.col("best.period")
    return out.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )

"""Toxicity by maximum-scoring segments of token log-odds.

Units are whole words and their runs of 3 to 6 characters (word ends
marked), so that inflected forms share evidence. An unbroken run of any length is taken in
stretches of ``STRETCH`` characters, each with the units that begin in it, in learning as in scoring: a
long run is as many positions as it has stretches, and what is said of words below holds of stretches. A unit's log-odds between
toxic and clean documents have a Dirichlet prior (``FLAT`` for each, and the units'
shares in both together, worth ``PRIOR`` counts); units whose z-score reaches ``MIN_Z``
and whose lower bound reaches ``MIN_ODDS`` form the lexicon, at most ``LEXICON`` of them. A word
that stands in ``WORD_DOCS`` documents is judged by itself, a rarer one by its best
unit: it scores that lower bound, any other word a small negative drift.

A linear-time scan finds every maximal scoring segment of a document (all
disjoint passages that cannot be extended or split to score higher). With lambda the root of
E[exp(lambda s)] = 1 over words of clean documents, a document of n words has
a segment of score S or more by chance with probability at most n exp(-lambda S): the
extreme-value law. A passage is significant if that stays below
``MAX_CHANCE``. The excess lambda S - ln n, summed over passages, goes through
a logistic curve.

Lexicon and curve are learned on a bounded sample of labelled documents
(``SAMPLE_DOCS`` of each label, in the order of a hash of the id); the curve on a fifth that
the lexicon does not see. Scoring is a map over all whole texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import bounded_batches, id_remainder, lean, stored, text_bytes
from pulsegrid.llm.learning import fit_logistic, label_weights, sample_ids

FOLDS, HELD_FOLD = 5, 0
SAMPLE_DOCS = 5_000
CURVE_SHARE = 5
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GRAMS = range(3, 7)
PRIOR = 1_000.0
FLAT = 0.5
MIN_Z = 3.0
MIN_ODDS = 1.0
MIN_DOCS = 3
WORD_DOCS = 10
LEXICON = 50_000
DRIFT = 0.1
MAX_CHANCE = 1e-2
KEPT_WORDS = 500_000
STRETCH = 64
FLUSH = 200_000  # units held at once in learning


def stretches(word: bytes) -> list[str]:
    """The marked word, cut every ``STRETCH`` characters; each stretch goes on into the
    next as far as units that begin in it reach, so every unit stands in one."""
    marked = f"^{word.decode('utf-8', 'replace')}$"
    return [marked[k : k + STRETCH + GRAMS[-1] - 1] for k in range(0, max(1, len(marked) - GRAMS[0] + 1), STRETCH)]


def positions(text: str | None) -> tuple[list[bytes | str], range | list[int]]:
    """The stretches of a text in order, a word of one stretch as its bytes, and the number
    of the word that each is of."""
    words = WORD.findall(text_bytes(text))
    if max(map(len, words), default=0) <= STRETCH:  # bytes, so no more characters either
        return words, range(len(words))
    out, of = [], []
    for k, w in enumerate(words):
        own = [w] if len(w) <= STRETCH else stretches(w)
        out += own
        of += [k] * len(own)
    return out, of


def marked(stretch: bytes | str) -> str:
    return stretches(stretch)[0] if isinstance(stretch, bytes) else stretch


def units(stretch: str) -> set[str]:
    """A marked stretch and its runs of characters that begin in it."""
    out = {stretch}
    for n in GRAMS:
        out.update(stretch[k : k + n] for k in range(min(STRETCH, len(stretch) - n + 1)))
    return out


# --- segments ------------------------------------------------------------


def maximal_segments(scores: list[tuple[int, float]], gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in linear time. ``scores`` are the
    positive entries (place, score); every place between scores ``-gap``.
    Returns first place, last place, score of each segment, in order."""
    # each candidate: first place, last place, sum before it, sum up to its end, index of the
    # nearest earlier candidate whose sum before is smaller
    found: list[list] = []
    total, at = 0.0, 0
    for place, score in scores:
        total -= gap * (place - at)
        at = place + 1
        new = [place, place, total, total + score, -1]
        total += score
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= new[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= new[3]:
                new[4] = j
                found.append(new)
                break
            new = [found[j][0], new[1], found[j][2], new[3], -1]
            del found[j:]
    return [(a, b, after - before) for a, b, before, after, _ in found]


class Model:
    """Lexicon, rate of the extreme-value law, curve."""

    def __init__(self, lexicon: dict[str, float], rate: float, curve: tuple[float, float]):
        self.lexicon, self.rate, self.curve = lexicon, rate, curve
        self.known: dict[bytes, float] = {}

    def word_score(self, word: bytes | str) -> float:
        text = marked(word)
        best = self.lexicon.get(text)
        if best is None:
            best = max(self.lexicon.get(u, 0.0) for u in units(text))
        return best or -DRIFT

    def passages(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of positions, and (first, last position, score) of every maximal segment."""
        words, _ = positions(text)
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in set(words).difference(known):
            known[w] = self.word_score(w)
        positive = [(k, s) for k, s in enumerate(map(known.__getitem__, words)) if s > 0]
        return len(words), maximal_segments(positive, DRIFT)

    def excess(self, n: int, score: float) -> float:
        """By how much a segment beats chance in a text of ``n`` words (nats)."""
        return self.rate * score - math.log(max(1, n))

    def value(self, text: str | None) -> float:
        n, found = self.passages(text)
        return sum(max(0.0, self.excess(n, s)) for _, _, s in found)

    def score(self, value: float) -> float:
        return 1 / (1 + math.exp(-(self.curve[0] + self.curve[1] * math.log1p(value))))


# --- learning --------------------------------------------------------------


def _word_rows(batches) -> Iterator[pa.RecordBatch]:
    """Distinct stretches of each document."""
    for batch in batches:
        labels, words = [], []
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()).to_pylist()):
            own = set(positions(text)[0])
            words += map(marked, own)
            labels += [y] * len(own)
        yield pa.RecordBatch.from_pydict({"label": pa.array(labels, pa.int32()), "word": pa.array(words, pa.string())})


def _unit_rows(batches) -> Iterator[pa.RecordBatch]:
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {"unit": pa.array(names, pa.string()), "toxic": pa.array(toxic, pa.int64()), "clean": pa.array(clean, pa.int64())}
        )

    for batch in batches:
        names, toxic, clean = [], [], []
        for word, t, c in zip(*(batch.column(k).to_pylist() for k in range(3))):
            own = units(word)
            names += own
            toxic += [t] * len(own)
            clean += [c] * len(own)
            if len(names) >= FLUSH:
                yield rows()
                names, toxic, clean = [], [], []
        yield rows()


def log_odds(sample: DataFrame) -> DataFrame:
    """``unit, toxic, clean, odds, z`` of the units of ``label, text`` rows;
    counts are of words in documents (each document counts a word once)."""
    words = sample.mapInArrow(lean(_word_rows), "label int, word string").groupBy("word").agg(
        F.sum(F.col("label").cast("long")).alias("toxic"), F.sum(1 - F.col("label").cast("long")).alias("clean")
    )
    counts = words.mapInArrow(lean(_unit_rows), "unit string, toxic long, clean long").groupBy("unit").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    counts = stored(counts, "toxic-units")
    nt, nc = (float(x or 0) for x in counts.agg(F.sum("toxic"), F.sum("clean")).first())
    prior = (F.col("toxic") + F.col("clean")) * F.lit(PRIOR / max(1.0, nt + nc)) + FLAT
    mass = PRIOR + FLAT * counts.count()
    t, c = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(t / (nt + mass - t)) - F.log(c / (nc + mass - c))
    return counts.withColumn("odds", odds).withColumn("z", odds / F.sqrt(1 / t + 1 / c))


def rate_of(histogram: dict[float, float]) -> float:
    """Lambda: the positive root of the mean of exp(lambda s) = 1."""
    total = sum(histogram.values())

    def mean(x: float) -> float:
        return sum(n * math.exp(min(700.0, x * s)) for s, n in histogram.items()) / total - 1

    if sum(s * n for s, n in histogram.items()) >= 0:
        return 0.0
    lo, hi = 0.0, 1e-3
    while mean(hi) < 0 and hi < 1e3:
        lo, hi = hi, 2 * hi
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if mean(mid) < 0 else (lo, mid)
    return lo


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model learned from labelled rows that are not held out. Without toxic or without clean rows the
    score is the known label's; without both, 0."""
    bounded_batches(docs)
    ids = sample_ids(labels, label_col, FOLDS, HELD_FOLD, SAMPLE_DOCS, "toxic-sample")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    sample = stored(
        texts.join(F.broadcast(ids), "_id").withColumn("key", F.xxhash64("text"))
        .dropDuplicates(["key", "label"]).select("_id", "label", "text"),
        "toxic-texts",
    )
    kinds = {r[0] for r in sample.select("label").distinct().collect()}
    if kinds != {0, 1}:
        return Model({}, 0.0, (40.0 if kinds == {1} else -40.0, 0.0))
    curve_part = F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(CURVE_SHARE)) == 0
    odds = log_odds(sample.filter(~curve_part).select("label", "text"))
    lower = F.col("odds") - 1.64 * F.col("odds") / F.col("z")
    odds = odds.withColumn("s", lower)
    strong = (F.col("z") >= MIN_Z) & (F.col("toxic") >= MIN_DOCS) & (F.col("s") >= MIN_ODDS)
    whole = F.col("unit").rlike(r"^\^.*\$$") | (F.length("unit") > GRAMS[-1])  # words and stretches
    common = whole & (F.col("toxic") + F.col("clean") >= WORD_DOCS)
    words = odds.filter(common & ~strong).orderBy(F.desc(F.col("toxic") + F.col("clean")), "unit").limit(LEXICON)
    lexicon = {r["unit"]: 0.0 for r in words.select("unit").collect()}
    rows = odds.filter(strong).orderBy(F.desc("z"), "unit").limit(LEXICON)
    lexicon |= {r["unit"]: r["s"] for r in rows.select("unit", "s").collect()}
    model = Model(lexicon, 0.0, (0.0, 1.0))
    held = sample.filter(curve_part).select("label", "text")

    def measure(batches):
        for batch in batches:
            out = [[], [], [], []]
            for y, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()).to_pylist()):
                n, found = model.passages(text)
                scores = [model.known[w] for w in positions(text)[0]]
                out[0].append(y)
                out[1].append(n)
                out[2].append([s for _, _, s in found])
                out[3].append([s for s in scores if s > 0])
            kinds = (pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["label", "n", "found", "scores"])

    seen = held.mapInArrow(lean(measure), "label int, n long, found array<double>, scores array<double>").collect()  # bounded sample
    clean = [r for r in seen if r["label"] == 0]
    histogram = {-DRIFT: float(sum(r["n"] - len(r["scores"]) for r in clean)) + 1}
    # a lexicon score that clean words never had counts half a word in all
    strong_scores = [s for s in lexicon.values() if s > 0]
    for s in strong_scores:
        histogram[s] = histogram.get(s, 0.0) + 0.5 / len(strong_scores)
    for r in clean:
        for s in r["scores"]:
            histogram[s] = histogram.get(s, 0.0) + 1
    model.rate = rate_of(histogram)
    y = np.array([r["label"] for r in seen], np.int64)
    if len(y) == 0 or y.min() == y.max():
        model.curve = (-3.0, 3.0)
        return model
    value = np.array([sum(max(0.0, model.excess(r["n"], s)) for s in r["found"]) for r in seen])
    weight = label_weights(labels, label_col, FOLDS, HELD_FOLD, y)
    model.curve = fit_logistic(np.log1p(value), y, weight)
    return model


# --- Spark jobs ----------------------------------------------------------------


def _fresh(model: Model) -> Model:
    return Model(model.lexicon, model.rate, model.curve)


def score_documents(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted, n_passages`` of every whole text.

    Labels are learned only from rows whose crc32(id as text) modulo 5 is not
    0; only the words of a text are inputs of its score. A null text has no
    words, as an empty one. A null id is held out by remainder 0; rows that repeat are scored
    each; conflicting labels are learned both; null labels are ignored. An
    empty table gives an empty result.
    """
    model = _fresh(fit(docs, labels, label_col, id_col, text_col))
    limit = -math.log(MAX_CHANCE)

    def run(batches):
        for batch in batches:
            score, count = [], []
            for text in batch.column(1).cast(pa.large_string()).to_pylist():
                n, found = model.passages(text)
                over = [model.excess(n, s) for _, _, s in found]
                score.append(model.score(sum(max(0.0, x) for x in over)))
                count.append(sum(x >= limit for x in over))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "score": pa.array(score, pa.float64()), "n_passages": pa.array(count, pa.int32())}
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = bounded_batches(rows).mapInArrow(lean(run), "doc_id long, score double, n_passages int")
    return scored.select(
        "doc_id", (id_remainder("doc_id", FOLDS) == HELD_FOLD).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_passages",
    )


def toxic_passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every significant passage: ``doc_id, first_word, last_word, score, excess``."""
    model = _fresh(model)
    limit = -math.log(MAX_CHANCE)

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()).to_pylist()):
                n, found = model.passages(text)
                of = positions(text)[1]
                out += [(doc_id, of[a], of[b], s, model.excess(n, s)) for a, b, s in found if model.excess(n, s) >= limit]
            columns = list(zip(*out)) or [[]] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            names = ["doc_id", "first_word", "last_word", "score", "excess"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return bounded_batches(rows).mapInArrow(lean(run), "doc_id long, first_word long, last_word long, score double, excess double")

"""Document quality from a linear-chain conditional random field over lines.

Every line of a document is good or bad. A line's features are shares of
character classes, word statistics and repetition, those of the line itself
and of the lines before and after it; transition weights tie neighbouring
labels. Forward-backward gives each line's probability of being good, and
their mean, weighted by the lines' lengths, is the document's quality, which
a logistic curve turns into a calibrated score.

The field and the curve are fitted on the driver, on a bounded sample of labelled documents
(``SAMPLE_DOCS`` of each label, in the order of a hash of the id). Every one of them is
learned from: whole if it has no more lines than the sample's line limit, else by a run of
that many consecutive lines, from a line that a hash of the id picks. The limit is ``DOC_LINES``, or less
where the sample would pass ``SAMPLE_LINES`` lines in all: then the greatest that does not. The
lines of a training document bear its label. Scoring is a map over all whole texts: no shuffle.
A long text is scored in pieces, with a few numbers per line kept, by the same features and marginals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import bounded_batches, id_remainder, lean, stored
from pulsegrid.llm.learning import fit_logistic, label_weights, sample_ids

FOLDS, HELD_FOLD = 3, 1
SAMPLE_DOCS = 3_000
SAMPLE_LINES = 200_000
DOC_LINES = 2_000  # of one training document
BLOCK_BYTES = 2_000_000
LONG_BYTES = 2_000_000  # a longer text is scored by itself, piece by piece
STEPS = 150
DECAY = 1e-4
OWN = 14  # features of a line
TWICE = 12  # the one that tells whether a line stands more than once in its text
WIDTH = 3 * OWN + 3

LOWER, UPPER, DIGIT, SPACE, STOP, BANG, PIPE, SIGN, WIDE = range(9)


def _classes() -> np.ndarray:
    table = np.full(256, SIGN, np.uint8)
    table[128:] = WIDE
    for chars, kind in ((b" \t\r\x0b\x0c", SPACE), (b".,;:?'\"()-", STOP), (b"!", BANG), (b"|", PIPE)):
        table[list(chars)] = kind
    table[ord("a") : ord("z") + 1] = LOWER
    table[ord("A") : ord("Z") + 1] = UPPER
    table[ord("0") : ord("9") + 1] = DIGIT
    return table


CLASSES = _classes()
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, their lengths, and the number of lines of each
    text. An empty text is one empty line."""
    own, length, per_text, key = line_table(texts)
    text = np.repeat(np.arange(len(texts)), per_text)
    own[:, TWICE] = repeated(text, key) * (length > 0)
    return own, length, per_text


def repeated(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Which lines stand more than once in their text, by the hashes of the lines."""
    by = np.lexsort((key, text))
    same = (key[by][1:] == key[by][:-1]) & (text[by][1:] == text[by][:-1])
    twice = np.zeros(len(key), bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    return twice


def line_table(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """:func:`line_features` but for whether a line is repeated (0), and the hash of each line."""
    data = b"\n".join(texts) + b"\n"
    buf = np.frombuffer(data, np.uint8)
    ends = np.flatnonzero(buf == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    per_text = np.array([t.count(b"\n") + 1 for t in texts], np.int64)
    length = (ends - starts).astype(np.float64)
    kind = CLASSES[buf]
    kind[ends] = SPACE
    total = np.maximum(length, 1)

    def share(mask: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (sums[ends] - sums[starts]) / total

    shares = {k: share(kind == k) for k in range(9)}
    # words by a rolling hash: equal words have equal hashes
    inside = kind != SPACE
    edge = np.diff(inside.astype(np.int8), prepend=0)
    first = np.flatnonzero(edge == 1)
    last = np.flatnonzero(edge == -1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(buf)), dtype=np.uint64)])
    word = (sums[last] - sums[first]) * _powers(INVERSE, len(buf))[first]
    line = np.searchsorted(ends, first)
    n_lines = len(ends)
    words = np.bincount(line, minlength=n_lines).astype(np.float64)
    again = np.zeros(len(word), bool)
    again[1:] = (word[1:] == word[:-1]) & (line[1:] == line[:-1])
    repeats = np.bincount(line, again, n_lines) / np.maximum(words, 1)
    order = np.lexsort((word, line))
    new = np.ones(len(word), bool)
    new[1:] = (word[order][1:] != word[order][:-1]) | (line[order][1:] != line[order][:-1])
    distinct = np.bincount(line[order], new, n_lines) / np.maximum(words, 1)
    key = (sums[ends] - sums[starts]) * _powers(INVERSE, len(buf))[starts]
    return _own(shares, words, length, repeats, distinct), length, per_text, key


def _own(shares: dict[int, np.ndarray], words, length, repeats, distinct) -> np.ndarray:
    """The features of lines from shares of character classes, word counts, shares of repeated and of distinct words."""
    letters = shares[LOWER] + shares[UPPER] + shares[WIDE]
    own = np.stack(
        [
            shares[UPPER] / np.maximum(letters, 1e-9) * (letters > 0), shares[DIGIT], shares[SPACE], shares[STOP], shares[BANG],
            shares[PIPE], shares[SIGN], letters, np.log1p(words) / 5, np.minimum(length / np.maximum(words, 1), 50) / 10,
            repeats, 1 - distinct, np.zeros(len(words)), (length == 0).astype(np.float64),
        ],
        axis=1,
    )
    own[:, 4:7] = np.sqrt(own[:, 4:7])
    return own


def long_line(line: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, length and hash of one line of any length, read in pieces of
    ``BLOCK_BYTES``: what is kept is 8 bytes per word."""
    counts, hashes, inside = np.zeros(9, np.int64), [], False
    total, power, inverse = np.zeros(1, np.uint64), 1, 1  # sum so far; BASE to the offset, and its inverse
    start = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # sum and inverse at the start of a word that goes on
    ahead, back = _powers(BASE, BLOCK_BYTES + 1), _powers(INVERSE, BLOCK_BYTES + 1)
    for at in range(0, len(line), BLOCK_BYTES):
        buf = np.frombuffer(line, np.uint8, min(BLOCK_BYTES, len(line) - at), at)
        n = len(buf)
        kind = CLASSES[buf]
        counts += np.bincount(kind, minlength=9)
        sums = np.concatenate([total, total + np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * (ahead[:n] * np.uint64(power)), dtype=np.uint64)])
        edge = np.diff((kind != SPACE).astype(np.int8), prepend=np.int8(inside))
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begin = np.concatenate([start[0], sums[first]]), np.concatenate([start[1], back[first] * np.uint64(inverse)])
        hashes.append((sums[last] - begin[0][: len(last)]) * begin[1][: len(last)])
        start = begin[0][len(last) :], begin[1][len(last) :]
        inside = bool(kind[-1] != SPACE)
        total = sums[-1:]
        power, inverse = power * int(ahead[n]) % (1 << 64), inverse * int(back[n]) % (1 << 64)
    hashes.append((total - start[0]) * start[1])
    word = np.concatenate(hashes)
    words = np.array([len(word)], np.float64)
    length = np.array([len(line)], np.float64)
    shares = {k: counts[k : k + 1] / np.maximum(length, 1) for k in range(9)}
    again = np.array([(word[1:] == word[:-1]).sum()]) / np.maximum(words, 1)
    word.sort()
    distinct = np.array([(np.diff(word) != 0).sum() + (len(word) > 0)]) / np.maximum(words, 1)
    return _own(shares, words, length, again, distinct), length, total


def line_pieces(text: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """:func:`line_table` of a long text, piece by piece: whole lines of
    ``BLOCK_BYTES`` together, or one line that is longer."""
    at = 0
    while at <= len(text):
        end = text.rfind(b"\n", at, at + BLOCK_BYTES)
        if len(text) - at <= BLOCK_BYTES:
            end = len(text)
        elif end < 0:
            end = text.find(b"\n", at)
            end = len(text) if end < 0 else end
        if end - at > BLOCK_BYTES:
            yield long_line(text[at:end])
        else:
            own, length, _, key = line_table([text[at:end]])
            yield own, length, key
        at = end + 1


def with_neighbours(own: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after, and a bias; flags tell
    the first and the last line of a text."""
    first = np.zeros(len(own), bool)
    first[np.concatenate([[0], np.cumsum(per_text)[:-1]])] = True
    last = np.roll(first, -1)
    out = np.zeros((len(own), WIDTH))
    out[:, :OWN] = own
    out[1:, OWN : 2 * OWN] = own[:-1]
    out[first, OWN : 2 * OWN] = 0
    out[:-1, 2 * OWN : 3 * OWN] = own[1:]
    out[last, 2 * OWN : 3 * OWN] = 0
    out[:, -3], out[:, -2], out[:, -1] = first, last, 1
    return out


# --- the field ---------------------------------------------------------------


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(unary: np.ndarray, per_text: np.ndarray, moves: np.ndarray):
    """All texts at once, a step per line number. ``unary``: score of label 1
    of each line; ``moves``: 2 x 2 transition scores. Returns each line's
    probability of label 1, expected moves, and the log partition of each text."""
    n = len(per_text)
    order = np.argsort(-per_text, kind="stable")
    starts = np.concatenate([[0], np.cumsum(per_text)[:-1]])[order]
    lengths = per_text[order]
    alive = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=0))), side="left")  # texts longer than k
    score = np.stack([np.zeros(len(unary)), unary], axis=1)
    ahead = np.zeros((len(unary), 2))
    for k, m in enumerate(alive):
        at = starts[:m] + k
        ahead[at] = score[at] if k == 0 else score[at] + _sum_exp(ahead[at - 1][:, :, None] + moves, 1)
    back = np.zeros((len(unary), 2))
    expected = np.zeros((2, 2))
    ends = starts + lengths - 1
    partition = _sum_exp(ahead[ends], 1) if n else np.zeros(0)
    for k in range(len(alive) - 2, -1, -1):
        m = alive[k + 1]
        at = starts[:m] + k
        step = moves + (score[at + 1] + back[at + 1])[:, None, :]
        back[at] = _sum_exp(step, 2)
        expected += np.exp(ahead[at][:, :, None] + step - partition[:m, None, None]).sum(axis=0)
    of = np.zeros(n)
    of[order] = partition
    good = np.exp(ahead[:, 1] + back[:, 1] - np.repeat(of, per_text))
    return np.clip(good, 0, 1), expected, of


def chain_marginals(unary: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The marginals of :func:`forward_backward` for one text of many lines, in
    about three times the square root of their number of steps.

    The lines are cut into equal blocks that advance side by side: one pass gives the product of each block's 2 x 2
    steps, from which follow the messages at all cuts; two more passes carry them through the blocks.
    """
    n = len(unary)
    size = max(1, int(np.sqrt(n)))
    blocks = -(-(n - 1) // size)  # of steps from line to line
    if blocks < 1:
        return 1 / (1 + np.exp(-unary))
    to = np.zeros(blocks * size)
    to[: n - 1] = unary[1:]
    to = to.reshape(blocks, size)
    live = (np.arange(blocks * size) < n - 1).reshape(blocks, size)

    def step(t: int) -> np.ndarray:
        out = np.repeat(moves[None], blocks, 0)
        out[:, :, 1] += to[:, t, None]
        out[~live[:, t]] = [[0, -1e30], [-1e30, 0]]  # no step: nothing changes
        return out

    whole = step(0)
    for t in range(1, size):
        whole = _sum_exp(whole[:, :, :, None] + step(t)[:, None], 2)
    ahead, back = np.zeros((blocks, 2)), np.zeros((blocks, 2))
    message = np.array([0.0, unary[0]])
    for b in range(blocks):
        ahead[b] = message
        message = _sum_exp(message[:, None] + whole[b], 0)
        message -= message.max()
    message = np.zeros(2)
    for b in range(blocks - 1, -1, -1):
        back[b] = message
        message = _sum_exp(whole[b] + message, 1)
        message -= message.max()
    odds = np.zeros(blocks * size + 1)  # log odds of label 1: from the left, then from both sides
    odds[0] = unary[0]
    inner = odds[1:].reshape(blocks, size)
    for t in range(size):
        ahead = _sum_exp(ahead[:, :, None] + step(t), 1)
        ahead -= ahead.max(axis=1, keepdims=True)
        inner[:, t] = ahead[:, 1] - ahead[:, 0]
    for t in range(size - 1, -1, -1):
        inner[:, t] += back[:, 1] - back[:, 0]
        back = _sum_exp(step(t) + back[:, None], 2)
        back -= back.max(axis=1, keepdims=True)
    odds[0] += back[0, 1] - back[0, 0]
    return 1 / (1 + np.exp(-np.clip(odds[:n], -700, 700)))


def long_quality(text: bytes, w: np.ndarray, moves: np.ndarray) -> float:
    """:func:`quality` of one long text in bounded memory. The text is gone through twice: for the hashes
    of its lines (8 bytes a line), then for the features, which leave one number a line."""
    key = np.concatenate([key for _, _, key in line_pieces(text)])
    twice = repeated(np.zeros(len(key), np.int8), key)
    n, at = len(key), 0
    del key
    unary, length = np.zeros(n), np.zeros(n)
    last = np.zeros((0, OWN))  # the line before the piece at hand and, once known, after the one before

    def close(rows: np.ndarray, first: int, count: int, before: int) -> None:
        """Scores of ``count`` lines of ``rows`` from place ``before`` on: line ``first`` of the text and following."""
        x = with_neighbours(rows, np.array([len(rows)]))[before : before + count]
        x[:, -3] = np.arange(first, first + count) == 0
        x[:, -2] = np.arange(first, first + count) == n - 1
        unary[first : first + count] = x @ w

    for own, size, _ in line_pieces(text):
        own[:, TWICE] = twice[at : at + len(own)] * (size > 0)
        length[at : at + len(own)] = size
        rows = np.concatenate([last, own])
        # the last line of a piece waits for the next piece
        open_at = at - min(len(last), 1)
        before = len(last) - min(len(last), 1)
        final = at + len(own) == n
        count = len(rows) - before - (0 if final else 1)
        close(rows, open_at, count, before)
        at += len(own)
        last = rows[-2:]
    weight = np.maximum(length, 1)
    good = chain_marginals(unary, moves)
    return float((good * weight).sum() / weight.sum())


def fit_field(x: np.ndarray, per_text: np.ndarray, labels: np.ndarray, weight: np.ndarray | None = None):
    """Weights and moves of greatest likelihood (Adam, whole sample a step)."""
    y = np.repeat(labels, per_text).astype(np.float64)
    scale = np.maximum(x.std(axis=0), 0.05)
    shift = np.where(np.arange(x.shape[1]) == x.shape[1] - 1, 0, x.mean(axis=0))
    scale[-1] = 1
    z = (x - shift) / scale
    first = np.concatenate([[0], np.cumsum(per_text)[:-1]])
    follows = np.ones(len(y), bool)
    follows[first] = False
    seen = np.zeros((2, 2))
    at = np.flatnonzero(follows)
    np.add.at(seen, (y[at - 1].astype(int), y[at].astype(int)), 1)
    params = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, STEPS + 1):
        w, moves = params[:-4], params[-4:].reshape(2, 2)
        good, expected, _ = forward_backward(z @ w, per_text, moves)
        slope = np.concatenate([z.T @ (y - good), (seen - expected).reshape(-1)]) / max(1, len(y)) - DECAY * params
        m = 0.9 * m + 0.1 * slope
        v = 0.999 * v + 0.001 * slope**2
        params = params + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    w = params[:-4] / scale
    w[-1] -= (shift * w)[:-1].sum()
    return w, params[-4:].reshape(2, 2)


def quality(x: np.ndarray, length: np.ndarray, per_text: np.ndarray, w: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Mean probability of a good line, weighted by length (an empty line weighs 1)."""
    good, _, _ = forward_backward(x @ w, per_text, moves)
    starts = np.concatenate([[0], np.cumsum(per_text)[:-1]]).astype(np.int64)
    weight = np.maximum(length, 1)
    return np.add.reduceat(good * weight, starts) / np.add.reduceat(weight, starts)


def log_odds(value: np.ndarray) -> np.ndarray:
    v = np.clip(value, 1e-4, 1 - 1e-4)
    return np.log(v / (1 - v))


# --- Spark jobs ----------------------------------------------------------------


def _blocks(batches) -> Iterator[tuple[list, list[bytes]]]:
    """Whole texts of an Arrow stream in blocks of some megabytes."""
    for batch in batches:
        ids, texts, size = [], [], 0
        keys = batch.column(0).to_pylist()
        for key, text in zip(keys, batch.column(1).cast(pa.large_binary())):
            data = text.as_py() or b""
            ids.append(key)
            texts.append(data)
            size += len(data)
            if size >= BLOCK_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        if ids:
            yield ids, texts


def _sample_rows(batches) -> Iterator[pa.RecordBatch]:
    for keys, texts in _blocks(batches):
        own, length, per_text = line_features(texts)
        cuts = np.cumsum(per_text)[:-1]
        rows = {"label": [], "own": [], "length": [], "before": []}
        for key, a, n in zip(keys, np.split(own, cuts), np.split(length, cuts)):
            lo, hi = key["start"], key["start"] + key["run"]
            left = max(0, lo - 1)
            rows["label"].append(key["label"])
            rows["own"].append(a[left : hi + 1].tobytes())  # with the neighbours of the run
            rows["length"].append(n[lo:hi].tobytes())
            rows["before"].append(lo - left)
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows.values(), kinds)], list(rows))


def line_limit(lines: np.ndarray) -> int:
    """Most lines taken of one document: ``DOC_LINES``, or the greatest number (one at
    least) with which documents of ``lines`` lines give ``SAMPLE_LINES`` in all."""
    lo, hi = 1, DOC_LINES
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if np.minimum(lines, mid).sum() <= SAMPLE_LINES else (lo, mid - 1)
    return lo


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str) -> DataFrame:
    """``label, own, length, before`` of the bounded sample: features of each document's run of
    lines and of the lines next to it, lengths of the run, and the number of lines (0 or 1) before it."""
    ids = sample_ids(labels, label_col, FOLDS, HELD_FOLD, SAMPLE_DOCS, "crf-sample")
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    lines = F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"))), F.lit(0)) + 1
    found = texts.join(F.broadcast(ids), "_id").select("_id", "label", "text").dropDuplicates(["_id", "label"])
    found = stored(found.withColumn("lines", lines), "crf-texts")
    limit = line_limit(np.array([r["lines"] for r in found.select("lines").collect()], np.int64))  # a number a document
    run = F.least(F.col("lines"), F.lit(limit))
    start = F.pmod(F.xxhash64("_id", F.lit(11)), F.col("lines") - run + 1).cast("int")
    chosen = found.select(F.struct("label", start.alias("start"), run.alias("run")).alias("key"), "text")
    return bounded_batches(chosen).mapInArrow(lean(_sample_rows), "label int, own binary, length binary, before int")


class Model:
    """Weights, moves and curve; ``scores`` needs numpy only."""

    def __init__(self, w, moves, curve):
        self.w, self.moves, self.curve = w, moves, curve

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.w is None:
            return np.full(len(texts), self.curve[0])
        long = np.array([len(t) > LONG_BYTES for t in texts])
        value = np.zeros(len(texts))
        if not long.all():
            own, length, per_text = line_features([t for t, far in zip(texts, long) if not far])
            value[~long] = quality(with_neighbours(own, per_text), length, per_text, self.w, self.moves)
        for k in np.flatnonzero(long).tolist():
            value[k] = long_quality(texts[k], self.w, self.moves)
        return 1 / (1 + np.exp(-(self.curve[0] + self.curve[1] * log_odds(value))))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """The model learned from labelled rows that are not held out. With rows of one label
    only, every score is that label's; without any, 0.5."""
    sample = training_sample(docs, labels, label_col, id_col, text_col).collect()  # bounded, see above
    y = np.array([r["label"] for r in sample], np.int64)
    if not len(y) or y.min() == y.max():
        return Model(None, None, (float(y[0]) if len(y) else 0.5, 0.0))
    lengths = [np.frombuffer(r["length"], np.float64) for r in sample]
    per_text = np.array([len(x) for x in lengths], np.int64)
    owns = [np.frombuffer(r["own"], np.float64).reshape(-1, OWN) for r in sample]
    own_of = np.array([len(a) for a in owns], np.int64)
    starts = np.concatenate([[0], np.cumsum(own_of)[:-1]]) + np.array([r["before"] for r in sample])
    run = np.repeat(starts - np.concatenate([[0], np.cumsum(per_text)[:-1]]), per_text) + np.arange(per_text.sum())
    x = with_neighbours(np.concatenate(owns), own_of)[run]
    w, moves = fit_field(x, per_text, y)
    value = quality(x, np.concatenate(lengths), per_text, w, moves)
    weight = label_weights(labels, label_col, FOLDS, HELD_FOLD, y)
    return Model(w, moves, fit_logistic(log_odds(value), y, weight))


def score_documents(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every whole text.

    Labels are learned only from rows whose crc32(id as text) modulo 3 is not
    1; inputs of a score are characters of the text. A null text counts as empty, which is one
    empty line. Lines end at a line feed. A null id is not held out; rows that
    repeat are scored each; conflicting labels are learned both; null labels
    are ignored. An empty table gives an empty result.
    """
    model = fit(docs, labels, label_col, id_col, text_col)

    def run(batches):
        for ids, texts in _blocks(batches):
            score = model.scores(texts)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    scored = bounded_batches(rows).mapInArrow(lean(run), "doc_id long, score double")
    return scored.select(
        "doc_id", (id_remainder("doc_id", FOLDS) == HELD_FOLD).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs``, all columns, without the rows scored below ``threshold``.
    One map over the rows; the texts are not shuffled."""
    model = fit(docs, labels)
    names, kinds = docs.columns, docs.schema
    at = names.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary())
            keep, block, size = [], [], 0
            for k, text in enumerate(texts):
                block.append(text.as_py() or b"")
                size += len(block[-1])
                if size >= BLOCK_BYTES or k == len(texts) - 1:
                    keep += (model.scores(block) >= threshold).tolist()
                    block, size = [], 0
            yield batch.filter(pa.array(keep, pa.bool_()))

    return bounded_batches(docs).mapInArrow(lean(run), kinds)

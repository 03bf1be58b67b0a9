"""Benchmark decontamination on a distributed positional inverted index.

The documents are cut into shards of consecutive rows. For each shard the
index stores postings: the sorted term numbers, and per term the sorted
positions at which it stands, where the texts of the shard follow one another
on one axis of positions. One row of the index table is one shard, so no
term's postings grow beyond a shard, however frequent the term is, and no
document's text is shuffled. Terms that no query uses are left out
unless ``terms`` is None.

A phrase is found in a shard by intersecting the offset-adjusted postings of
its terms, the rarest first: positions p of term k become starts p - k; the
starts that remain are looked up in the next rarest list, and so on. Terms within a
distance (proximity) are found from the postings of the rarest term as well.

Query items are handled in blocks of at most ``BLOCK_WORDS`` words, each
sent to the tasks as one bounded value; an item that is longer comes in pieces that overlap by a
window less one word. Items of one block need only the postings of their own words. For
several blocks the index of all words is stored once and read once per block.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.common import bounded_batches, lean, stored, text_bytes, unused

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")  # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z is lowered
SHARD_WORDS = 400_000
BLOCK_WORDS = 200_000
WINDOW = 10

INDEX_SCHEMA = (
    "shard long, row_ids array<long>, doc_ids array<long>, crcs array<long>, starts array<long>, "
    "terms array<long>, offsets array<long>, positions array<int>"
)
ITEM_SCHEMA = "item_id string, words array<string>"
MATCH_SCHEMA = "row_id long, doc_id long, item_id string, start long, length int"
HIT_SCHEMA = "row_id long, doc_id long, text_crc32 long, n_words long, n_hit long, n_items long, items array<string>, hits array<long>"


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall(text_bytes(text))


def term_number(word: bytes) -> int:
    """64-bit number of a term, the same on every machine."""
    import xxhash

    return (xxhash.xxh64_intdigest(word) - (1 << 63)) or 1


# --- index ---------------------------------------------------------------


def _index_rows(batches, terms: frozenset | None) -> Iterator[pa.RecordBatch]:
    """One row per shard: postings of whole texts."""
    from pyspark import TaskContext

    number = {w: term_number(w) for w in terms or ()}

    part = TaskContext.get().partitionId()
    rows: list[int] = []
    docs: list[int | None] = []
    crcs: list[int] = []
    starts: list[int] = [0]
    found: list[np.ndarray] = []
    places: list[np.ndarray] = []
    shard = row = 0

    def flush() -> pa.RecordBatch:
        nonlocal shard
        values = np.concatenate(found) if found else np.zeros(0, np.int64)
        where = np.concatenate(places) if places else np.zeros(0, np.int64)
        order = np.argsort(values, kind="stable")
        values, where = values[order], where[order]
        heads = np.flatnonzero(np.append(len(values) > 0, values[1:] != values[:-1]))
        out = pa.RecordBatch.from_pydict(
            {
                "shard": pa.array([(part << 32) + shard], pa.int64()),
                "row_ids": pa.array([rows], pa.list_(pa.int64())),
                "doc_ids": pa.array([docs], pa.list_(pa.int64())),
                "crcs": pa.array([crcs], pa.list_(pa.int64())),
                "starts": pa.array([starts], pa.list_(pa.int64())),
                "terms": pa.array([values[heads]], pa.list_(pa.int64())),
                "offsets": pa.array([np.append(heads, len(values))], pa.list_(pa.int64())),
                "positions": pa.array([where.astype(np.int32)], pa.list_(pa.int32())),
            }
        )
        shard += 1
        return out

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()).to_pylist()):
            words = words_of(text)
            if terms is None:
                for w in set(words).difference(number):
                    number[w] = term_number(w)
            ids = np.fromiter(map(number.get, words, repeat(0)), np.int64, len(words))
            where = np.flatnonzero(ids)
            found.append(ids[where])
            places.append(where + starts[-1])
            rows.append((part << 32) + row)
            docs.append(doc_id)
            crcs.append(zlib.crc32(b"" if text is None else text.encode("utf-8", "replace")))
            # a gap between texts: no phrase runs over the end of one
            starts.append(starts[-1] + len(words) + 1)
            row += 1
            if starts[-1] >= SHARD_WORDS:
                yield flush()
                rows, docs, crcs, starts, found, places = [], [], [], [0], [], []
                if terms is None and len(number) > 4 * SHARD_WORDS:
                    number.clear()
    if rows:
        yield flush()


def build_index(docs: DataFrame, terms: frozenset | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index of all rows of ``docs``. ``terms`` limits it to the
    words that queries use (a bounded set of bytes)."""
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return stored(bounded_batches(rows).mapInArrow(lean(lambda batches: _index_rows(batches, terms)), INDEX_SCHEMA), "index")


# --- search inside a shard -------------------------------------------------


class Shard:
    """Postings of one index row."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        column = lambda name: batch.column(batch.schema.get_field_index(name))[i].values.to_numpy(zero_copy_only=False)
        self.row_ids, self.crcs, self.starts = column("row_ids"), column("crcs"), column("starts")
        self.doc_ids = batch.column(batch.schema.get_field_index("doc_ids"))[i].as_py()
        self.terms, self.offsets, self.positions = column("terms"), column("offsets"), column("positions")

    def n_words(self) -> np.ndarray:
        return np.diff(self.starts) - 1

    def doc_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, positions, side="right") - 1

    def slots(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and length of each term's postings; length 0 if it has none."""
        at = np.searchsorted(self.terms, terms)
        known = at < len(self.terms)
        known[known] = self.terms[at[known]] == terms[known]
        at = np.where(known, at, 0)
        if not len(self.terms):
            return at, np.zeros(len(at), np.int64)
        return at, np.where(known, self.offsets[at + 1] - self.offsets[at], 0)

    def postings(self, slot: int) -> np.ndarray:
        return self.positions[self.offsets[slot] : self.offsets[slot + 1]]

    def phrase_starts(self, slots: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Starts of a phrase: offset-adjusted postings, the rarest first."""
        order = np.argsort(lengths, kind="stable")
        starts = self.postings(slots[order[0]]).astype(np.int64) - order[0]
        for k in order[1:]:
            if not len(starts):
                return starts
            others = self.postings(slots[k])
            at = np.searchsorted(others, starts + k)
            at[at == len(others)] = 0
            starts = starts[others[at] == starts + k]
        return starts

    def near(self, slots: np.ndarray, lengths: np.ndarray, slop: int) -> Iterator[tuple[int, int]]:
        """(first, last) position of every minimal stretch of at most ``slop``
        words that holds all terms (no shorter one inside it does), each once.
        The rarest term's postings only tell where to look."""
        order = np.argsort(lengths, kind="stable")
        seen = set()
        lists = [self.postings(slots[k]).astype(np.int64) for k in order]
        for p in lists[0]:
            doc = np.searchsorted(self.starts, p, side="right")
            lo, hi = max(int(p) - slop + 1, int(self.starts[doc - 1])), min(int(p) + slop - 1, int(self.starts[doc]) - 2)
            inside = [x[np.searchsorted(x, lo) : np.searchsorted(x, hi, side="right")] for x in lists]
            if any(not len(x) for x in inside):
                continue
            for start in np.unique(np.concatenate(inside)):
                if start > p or start > min(int(x[-1]) for x in inside):
                    break
                last = max(int(x[np.searchsorted(x, start)]) for x in inside)
                first = min(int(x[np.searchsorted(x, last, side="right") - 1]) for x in inside)
                if last - first < slop and (first, last) not in seen:
                    seen.add((first, last))
                    yield first, last


class Queries:
    """A bounded block of items: distinct windows of term numbers."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.items = [i for i, _ in items]
        number: dict[tuple, int] = {}
        self.of: list[list[int]] = []  # window -> items
        for k, (_, words) in enumerate(items):
            ids = [term_number(w) for w in words]
            width = min(window, len(ids))
            for a in range(len(ids) - width + 1 if width else 0):
                w = number.setdefault(tuple(ids[a : a + width]), len(number))
                if w == len(self.of):
                    self.of.append([])
                if not self.of[w] or self.of[w][-1] != k:
                    self.of[w].append(k)
        self.windows = [np.array(w, np.int64) for w in number]
        self.flat = np.concatenate(self.windows) if self.windows else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum([len(w) for w in self.windows])]).astype(np.int64)

    def matches(self, shard: Shard) -> Iterator[tuple[int, np.ndarray]]:
        """(window, starts) of every window that occurs in the shard."""
        if not len(self.flat) or not len(shard.terms):
            return
        slots, lengths = shard.slots(self.flat)
        least = np.minimum.reduceat(lengths, self.bounds[:-1])
        for w in np.flatnonzero(least):  # windows with a term that the shard lacks fall out here
            a, b = self.bounds[w], self.bounds[w + 1]
            starts = shard.phrase_starts(slots[a:b], lengths[a:b])
            if len(starts):
                yield int(w), starts


def _covered(shard: Shard, queries: Queries) -> Iterator[pa.RecordBatch]:
    """Per document of a shard: words, hit words, items; hit positions."""
    size = int(shard.starts[-1]) + 1
    edges = np.zeros(size + 1, np.int32)
    pairs = []
    for w, starts in queries.matches(shard):
        length = len(queries.windows[w])
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + length, -1)
        docs = np.unique(shard.doc_of(starts))
        pairs += [(d, k) for k in queries.of[w] for d in docs.tolist()]
    hit = np.cumsum(edges[:-1]) > 0
    items: dict[int, set] = {}
    for d, k in pairs:
        items.setdefault(d, set()).add(queries.items[k])
    before = np.concatenate([[0], np.cumsum(hit)])
    n_hit = before[shard.starts[1:]] - before[shard.starts[:-1]]
    n_docs = len(shard.row_ids)
    found = [sorted(items.get(d, ())) for d in range(n_docs)]
    hits = [
        (np.flatnonzero(hit[shard.starts[d] : shard.starts[d + 1]])).tolist() if n_hit[d] else [] for d in range(n_docs)
    ]
    yield pa.RecordBatch.from_pydict(
        {
            "row_id": pa.array(shard.row_ids, pa.int64()),
            "doc_id": pa.array(shard.doc_ids, pa.int64()),
            "text_crc32": pa.array(shard.crcs, pa.int64()),
            "n_words": pa.array(shard.n_words(), pa.int64()),
            "n_hit": pa.array(n_hit, pa.int64()),
            "n_items": pa.array([len(x) for x in found], pa.int64()),
            "items": pa.array(found, pa.list_(pa.string())),
            "hits": pa.array(hits, pa.list_(pa.int64())),
        }
    )


def _per_shard(index: DataFrame, block: list, prepare, work, schema: str) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(block)  # one bounded block of items

    def run(batches):
        queries = prepare(sent.value)
        for batch in batches:
            for i in range(batch.num_rows):
                yield from work(Shard(batch, i), queries)

    return bounded_batches(index).mapInArrow(lean(run), schema)


# --- items -----------------------------------------------------------------


def _item_rows(batches, window: int, most: int) -> Iterator[pa.RecordBatch]:
    """Items as words; an item of more than ``most`` in pieces that hold each of its windows."""
    step = max(1, most - window + 1)
    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()).to_pylist()
        for item_id, text in zip(batch.column(0).to_pylist(), texts):
            words = [w.decode("utf-8", "replace") for w in words_of(text)]
            starts = range(0, len(words) - window + 1, step) if len(words) > most else [0]
            for k in starts:
                piece = words[k : k + step + window - 1] if len(words) > most else words
                yield pa.RecordBatch.from_pydict(
                    {"item_id": pa.array([item_id], pa.string()), "words": pa.array([piece], pa.list_(pa.string()))}
                )


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> Iterator[list]:
    """Items, or pieces of long ones, as word lists, in blocks of at most ``BLOCK_WORDS`` words, one
    block at a time; an empty block if there is no item."""
    most = max(BLOCK_WORDS, window)
    rows = items.select(F.col(id_col).cast("string"), F.col(text_col).cast("string"))
    rows = rows.mapInArrow(lambda batches: _item_rows(batches, window, most), ITEM_SCHEMA)
    block, size, any_block = [], 0, False
    for r in stored(rows.filter(F.size("words") > 0), "items").toLocalIterator():
        words = [w.encode("utf-8", "replace") for w in r["words"]]
        if size and size + len(words) > most:
            yield block
            block, size, any_block = [], 0, True
        block.append(("" if r["item_id"] is None else r["item_id"], words))
        size += len(words)
    if block or not any_block:
        yield block


# --- operators ---------------------------------------------------------------


def phrase_hits(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row of ``docs``: ``row_id`` (a number of the row), ``doc_id``,
    ``text_crc32``, ``n_words``, ``n_hit``, ``n_items``, ``items`` (sorted ids), ``hits``
    (positions of the words hit).

    A window is ``window`` consecutive words of an item; a shorter item is
    one window; an item without words has none. Null texts have no words,
    are never hit and keep their row; null or repeated document ids and
    repeated rows keep a row each; a null item id counts as an empty one, and
    items that share an id count once. Empty tables give empty hits.
    """
    blocks = item_blocks(items, window=window)
    first, second = next(blocks), next(blocks, None)
    prepare = lambda block: Queries(block, window)
    if second is None:
        index = build_index(docs, frozenset(w for _, words in first for w in words))
        return _per_shard(index, first, prepare, _covered, HIT_SCHEMA)
    # the index, and with it the numbers of the rows, is stored once for all blocks
    index, found = build_index(docs), None
    for block in chain([first, second], blocks):
        hits = _per_shard(index, block, prepare, _covered, HIT_SCHEMA).filter("n_hit > 0")
        hits = stored(hits.select("row_id", "items", "hits"), "block-hits")
        found = hits if found is None else found.unionByName(hits)
    found = stored(
        found.groupBy("row_id").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        ),
        "all-hits",
    )  # lists within one document
    rows = _per_shard(index, [], prepare, _covered, HIT_SCHEMA).select("row_id", "doc_id", "text_crc32", "n_words")
    none = F.array().cast("array<string>"), F.array().cast("array<long>")
    out = rows.join(found, "row_id", "left").select(
        "row_id", "doc_id", "text_crc32", "n_words", F.coalesce("items", none[0]).alias("items"), F.coalesce("hits", none[1]).alias("hits")
    )
    return out.select(
        "row_id", "doc_id", "text_crc32", "n_words", F.size("hits").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), "items", "hits",
    )


def phrase_matches(index: DataFrame, phrases: list[tuple[str, str]]) -> DataFrame:
    """Exact occurrences of whole phrases, (id, text) each, in a stored index:
    ``row_id, doc_id, item_id, start, length``; ``start`` counts words of the text."""

    def work(shard: Shard, queries: Queries):
        for w, starts in queries.matches(shard):
            docs = shard.doc_of(starts)
            for k in queries.of[w]:
                yield _match_rows(shard, docs, starts, [queries.items[k]] * len(starts), [len(queries.windows[w])] * len(starts))

    block = [(i, words_of(t)) for i, t in phrases]
    return _per_shard(index, block, lambda b: Queries(b, 1 << 62), work, MATCH_SCHEMA)


def proximity_matches(index: DataFrame, queries: list[tuple[str, str]], slop: int) -> DataFrame:
    """Every minimal stretch of at most ``slop`` words that holds all words of a
    query, in any order, whatever documents share its shard."""

    def work(shard: Shard, block):
        for item, words in block:
            terms = np.array(sorted({term_number(w) for w in words}), np.int64)
            slots, lengths = shard.slots(terms)
            if not len(terms) or not lengths.all():
                continue
            spans = list(shard.near(slots, lengths, slop))
            if spans:
                starts = np.array([a for a, _ in spans], np.int64)
                yield _match_rows(shard, shard.doc_of(starts), starts, [item] * len(spans), [b - a + 1 for a, b in spans])

    return _per_shard(index, [(i, words_of(t)) for i, t in queries], list, work, MATCH_SCHEMA)


def _match_rows(shard: Shard, docs, starts, items, lengths) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "row_id": pa.array(shard.row_ids[docs], pa.int64()),
            "doc_id": pa.array([shard.doc_ids[d] for d in docs], pa.int64()),
            "item_id": pa.array(items, pa.string()),
            "start": pa.array(starts - shard.starts[docs], pa.int64()),
            "length": pa.array(lengths, pa.int32()),
        }
    )


def decontamination_report(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """:func:`phrase_hits` with the digest of the items: ``doc_id, n_words,
    n_hit, n_items, items_sha256, contaminated``."""
    return phrase_hits(docs, items, window).select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )



def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the rows that hold a window of an item. The rows to
    drop are stored first, so that Spark joins them by their measured size. ``docs`` may have columns of any name."""
    hits = phrase_hits(docs, items, window).filter("n_hit > 0")
    _id, _crc = unused("_id", docs.columns), unused("_crc", docs.columns)
    gone = stored(hits.select(F.col("doc_id").alias(_id), F.col("text_crc32").alias(_crc)).distinct(), "contaminated")
    crc = F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col(_id)) & (crc == F.col(_crc)), "left_anti")

"""Similarity join of documents on word n-gram sets, by prefix trees.

A document is the set of its distinct n-grams of words. Two documents link
when the Jaccard similarity of their sets reaches a threshold; the result
is each document's connected component.

1. Blocks of documents list their n-grams as packed hashes, dealt by ranges;
   each range sums the document frequencies and answers every block in its own order.
   Rare n-grams come first in the global order. Equal sets form one class,
   represented by one row.
2. A link needs a common n-gram among the rarest of both sets (the prefix).
   An n-gram of one document only joins nothing, so just prefix n-grams of
   two or more documents become rows: n-gram, document, place in the order, size.
3. Hub round: for each n-gram, all its documents are paired with the one that
   has it earliest, its hub: in a group of near copies the plainest one. Verified links
   give components, so a group needs as many pairs as members, not their square.
4. Rest round: only n-grams whose documents stand in different components are
   left; their pairs across components are formed (groups in bounded
   blocks, every pair of blocks) and verified.

Pairs are kept only if sizes and places allow the similarity. Verification is a prefix-tree
join: the sets to compare with one document are stored as a tree of sequences in the
global order, frequent first; a walk carries the overlap along shared paths
and prunes every subtree whose remaining length cannot reach the bound.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.config import drop_folder, write_scratch
from pulsegrid.llm.common import Vocabulary, bounded_batches, lean, mix64, stored, text_bytes, trim, unused
from pulsegrid.llm.components import connected_components
from pulsegrid.llm.packed import pack, pack_sorted, range_of, unpack, unpack_sorted

BLOCK_WORDS = 600_000
RANGE_KEYS = 1_500_000
GROUP = 2_000  # rows of an n-gram formed into pairs at once; sets in one tree
PAIRS_AT_ONCE = 250_000
SHIFT = np.uint64(16)  # hashes of n-grams keep 48 bits

BLOCKS = (
    "block long, words_n long, doc_ids array<long>, counts array<int>, sizes array<long>, "
    "digests array<binary>, crcs array<long>, seq binary, words binary"
)
KEYS = "part int, block long, keys binary, counts binary"
ANSWERS = "block long, part int, df binary"
ROWS = "token long, uid long, n int, pos int, tokens binary"
PAIRS = "a long, b long"
LINKS = "a long, b long"


# --- sets --------------------------------------------------------------------


def ngram_sets(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of all documents of a block, sorted within each, and
    their number per document. ``hashes``: of all words, documents one after
    another; a document with fewer words than ``width`` is one n-gram of all."""
    starts = np.concatenate([[0], np.cumsum(counts)])
    runs = np.maximum(counts - width + 1, (counts > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(counts)), runs)
    place = starts[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(runs) - runs, runs))
    size = np.minimum(counts, width)[doc]
    out = np.zeros(len(doc), np.uint64)
    for k in range(width):
        live = size > k
        step = mix64(out[live] * np.uint64(0x9E3779B97F4A7C15) + hashes[place[live] + k] + size[live].astype(np.uint64))
        out[live] = step
    out >>= SHIFT
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    first = np.ones(len(out), bool)
    first[1:] = (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])
    return out[first], np.bincount(doc[first], minlength=len(counts))


def _block_rows(batches, width: int) -> Iterator[pa.RecordBatch]:
    import xxhash
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    made = 0

    def close(ids, crcs, counts, seqs, vocab) -> pa.RecordBatch:
        nonlocal made
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in vocab), np.uint64, len(vocab))
        seq = np.concatenate(seqs)
        tokens, sizes = ngram_sets(words[seq] if len(seq) else np.zeros(0, np.uint64), np.array(counts, np.int64), width)
        ends = np.cumsum(sizes)
        data = tokens.astype("<u8").tobytes()
        digests = [xxhash.xxh3_128_digest(data[8 * (e - n) : 8 * e]) if n else None for e, n in zip(ends.tolist(), sizes.tolist())]
        made += 1
        return pa.RecordBatch.from_pydict(
            {
                "block": pa.array([(part << 40) + (made << 24)], pa.int64()),
                "words_n": pa.array([len(seq)], pa.int64()),
                "doc_ids": pa.array([ids], pa.list_(pa.int64())),
                "counts": pa.array([counts], pa.list_(pa.int32())),
                "sizes": pa.array([sizes], pa.list_(pa.int64())),
                "digests": pa.array([digests], pa.list_(pa.binary())),
                "crcs": pa.array([crcs], pa.list_(pa.int64())),
                "seq": pa.array([pack(seq)], pa.binary()),
                "words": pa.array([pack(words)], pa.binary()),
            }
        )

    ids, crcs, counts, seqs, vocab, size = [], [], [], [], Vocabulary(), 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_string()).to_pylist()):
            words = text_bytes(text).split()
            seqs.append(np.fromiter(map(vocab.__getitem__, words), np.uint32, len(words)))
            ids.append(doc_id)
            crcs.append(zlib.crc32((text or "").encode("utf-8", "replace")))
            counts.append(len(words))
            size += len(words) + 1
            if size >= BLOCK_WORDS:
                yield close(ids, crcs, counts, seqs, vocab)
                ids, crcs, counts, seqs, vocab, size = [], [], [], [], Vocabulary(), 0
    if ids:
        yield close(ids, crcs, counts, seqs, vocab)


def _open(seq: bytes, words: bytes, counts, width: int) -> tuple[np.ndarray, np.ndarray]:
    index, table = unpack(seq, np.uint32), unpack(words, np.uint64)
    hashes = table[index] if len(index) else np.zeros(0, np.uint64)
    return ngram_sets(hashes, np.asarray(counts, np.int64), width)


def _range(keys: np.ndarray, parts: int) -> np.ndarray:
    return range_of(keys << SHIFT, parts)


def _key_rows(batches, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            tokens, _ = _open(row["seq"], row["words"], row["counts"], width)
            keys, counts = np.unique(tokens, return_counts=True)
            cuts = np.searchsorted(_range(keys, parts), np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[p], cuts[p + 1]
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": pa.array([p], pa.int32()),
                        "block": pa.array([row["block"]], pa.int64()),
                        "keys": pa.array([pack_sorted(keys[a:b])], pa.binary()),
                        "counts": pa.array([pack(counts[a:b].astype(np.uint32))], pa.binary()),
                    }
                )


def _frequencies(key, rows: pd.DataFrame) -> pd.DataFrame:
    lists = [unpack_sorted(k) for k in rows["keys"]]
    keys, index = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.concatenate([unpack(c, np.uint32) for c in rows["counts"]])
    df = np.minimum(np.bincount(index, counts, len(keys)), 2**32 - 1).astype(np.uint32)
    cuts = np.cumsum([len(k) for k in lists])[:-1]
    trim()
    return pd.DataFrame(
        {"block": rows["block"], "part": int(key[0]), "df": [pack(df[i]) for i in np.split(index, cuts)]}
    )


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """A set that overlaps enough shares one of its first so many n-grams."""
    return n - (percent * n + 99) // 100 + 1


def _prefix_rows(blocks: pd.DataFrame, answers: pd.DataFrame, width: int, percent: int) -> pd.DataFrame:
    """Prefix rows, and the set, of each class representative of a block that has any."""
    trim()
    none = pd.DataFrame({c.split()[0]: [] for c in ROWS.split(", ")})
    chosen = answers[answers["part"] < 0]
    if not len(blocks) or not len(chosen):
        return none
    block = int(blocks["block"].iloc[0])
    tokens, sizes = _open(blocks["seq"].iloc[0], blocks["words"].iloc[0], blocks["counts"].iloc[0], width)
    if not len(tokens):
        return none
    keys, index = np.unique(tokens, return_inverse=True)
    df = np.concatenate([unpack(x, np.uint32) for x in answers[answers["part"] >= 0].sort_values("part")["df"]])[index]
    doc = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((tokens, df, doc))  # the global order: rare first
    tokens, df = tokens[order], df[order]
    starts = np.cumsum(sizes) - sizes
    pos = np.arange(len(tokens)) - starts[doc]
    rep = np.zeros(len(sizes), bool)
    rep[np.asarray(chosen["reps"].iloc[0], np.int64)] = True
    shared = df > 1
    hit = np.flatnonzero(shared & rep[doc] & (pos < prefix_length(sizes, percent)[doc]))
    out = pd.DataFrame(
        {"token": tokens[hit].astype(np.int64), "uid": block + doc[hit], "n": sizes[doc[hit]], "pos": pos[hit], "tokens": None}
    )
    sets = []
    for d in np.unique(doc[hit]).tolist():
        own = slice(starts[d], starts[d] + sizes[d])
        # frequent first: near copies then share long paths
        frequent = tokens[own][shared[own]][::-1].astype("<u8")
        sets.append((-1, block + d, int(sizes[d]), -1, frequent.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()))
    return pd.concat([out, pd.DataFrame(sets, columns=out.columns)]) if sets else out


# --- the tree --------------------------------------------------------------------


def unpack_set(data: bytes) -> np.ndarray:
    six = np.frombuffer(data, np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), np.uint8)
    out[:, :6] = six
    return out.view("<u8").reshape(-1)


def least_overlap(n: int, m: int, percent: int) -> int:
    """Least intersection of sets of ``n`` and ``m`` at the threshold."""
    return -(-percent * (n + m) // (100 + percent))


class PrefixTree:
    """Sets as sequences in the global order, sorted, so that sets with a
    common path stand together; a node of the tree is a depth of a set that it
    does not share with the set before it."""

    def __init__(self, sets: list[tuple[int, int, bytes]]):
        """``sets``: id, size, sequence of shared n-grams."""
        big_endian = lambda s: unpack_set(s).astype(">u8").tobytes()
        rows = sorted(((big_endian(s), u, n) for u, n, s in sets))
        self.ids = [u for _, u, _ in rows]
        self.sizes = [n for _, _, n in rows]
        self.paths = [np.frombuffer(p, ">u8").astype(np.uint64) for p, _, _ in rows]
        self.shared = [0] * len(rows)  # length of the path shared with the set before
        for k in range(1, len(rows)):
            a, b = self.paths[k - 1], self.paths[k]
            n = min(len(a), len(b))
            differ = np.flatnonzero(a[:n] != b[:n])
            self.shared[k] = int(differ[0]) if len(differ) else n

    def join(self, own: np.ndarray, size: int, percent: int) -> Iterator[int]:
        """Ids of the sets that reach the similarity with a set of ``size``
        whose shared n-grams are ``own``."""
        members = np.sort(own)
        overlap = np.zeros(1, np.int64)  # along the current path: overlap up to each depth
        pruned = None  # depth of a node whose subtree cannot reach the bound
        for k, path in enumerate(self.paths):
            shared = self.shared[k]
            if pruned is not None:
                if shared >= pruned:
                    continue
                pruned = None
            known = min(shared, len(overlap) - 1)
            rest = path[known:]
            at = np.searchsorted(members, rest)
            at[at == len(members)] = 0
            found = members[at] == rest if len(members) else np.zeros(len(rest), bool)
            overlap = np.concatenate([overlap[: known + 1], overlap[known] + np.cumsum(found)])
            need = least_overlap(size, self.sizes[k], percent)
            if overlap[-1] >= need:
                yield self.ids[k]
            elif len(path):
                # whatever follows below a node, a partner of the least fitting size needs this much
                least = least_overlap(size, -(-percent * size // 100), percent)
                depth = np.arange(len(overlap))
                # sets below hold at most so many n-grams in all, hence so many after the node
                most = 100 * size // percent
                hopeless = np.flatnonzero(overlap + np.minimum(size - overlap, most - depth) < least)
                if len(hopeless):
                    pruned = int(hopeless[0])


def _verify_rows(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (a, salt, kind): the set of a document, then the sets to
    compare with it, ``GROUP`` of them in a tree at a time."""
    own, size, key, waiting = None, 0, None, []

    def flush():
        if waiting and own is not None:
            found = list(PrefixTree(waiting).join(own, size, percent))
            yield pa.RecordBatch.from_pydict(
                {"a": pa.array([key[0]] * len(found), pa.int64()), "b": pa.array(found, pa.int64())}
            )
        waiting.clear()

    for batch in batches:
        for a, salt, uid, n, tokens in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, salt) != key:
                yield from flush()
                key, own = (a, salt), None
            if uid == a:
                own, size = unpack_set(tokens), n
            else:
                waiting.append((uid, n, tokens))
                if len(waiting) >= GROUP:
                    yield from flush()
    yield from flush()


def verified(pairs: DataFrame, sets: DataFrame, percent: int, label: str) -> DataFrame:
    """The pairs (a, b) that link. A document with many partners is dealt to
    several tasks."""
    pairs = stored(pairs.select("a", "b").distinct(), f"{label}-pairs")
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("salts"))
    dealt = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    others = dealt.select("a", "salt", F.col("b").alias("uid"))
    own = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("uid"))
    rows = others.unionByName(own).join(sets, "uid").select("a", "salt", "uid", "n", "tokens")
    dealt = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", (F.col("uid") != F.col("a")))
    return stored(dealt.mapInArrow(lean(lambda b: _verify_rows(b, percent)), LINKS), f"{label}-links")


def _pairs_of(rows: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs across components of whole groups, rows sorted by (token, i, j, n);
    in pieces of bounded size."""
    n, pos, uid, comp, block = (rows[c] for c in ("n", "pos", "uid", "comp", "block"))
    new = np.ones(len(n), bool)
    new[1:] = (
        (rows["token"][1:] != rows["token"][:-1]) | (rows["i"][1:] != rows["i"][:-1]) | (rows["j"][1:] != rows["j"][:-1])
    )
    group = np.cumsum(new)
    # a partner stands further on in the group and is not too much larger
    wide = np.int64(1) << np.int64(31)
    ends = np.searchsorted(group * wide + n, group * wide + 100 * n // percent, side="right")
    counts = ends - np.arange(len(n)) - 1
    at = 0
    while at < len(n):
        upto = max(at + 1, int(np.searchsorted(np.cumsum(counts[at:]), PAIRS_AT_ONCE, side="right")) + at)
        c = counts[at:upto]
        x = np.repeat(np.arange(at, upto), c)
        y = np.arange(int(c.sum())) - np.repeat(np.cumsum(c) - c, c) + x + 1
        need = -(-percent * (n[x] + n[y]) // (100 + percent))
        fits = (np.minimum(n[x] - pos[x], n[y] - pos[y]) >= need) & (comp[x] != comp[y])
        # between two blocks only pairs of one row of each
        fits &= (rows["i"][x] == rows["j"][x]) | (block[x] != block[y])
        a, b = uid[x[fits]], uid[y[fits]]
        if len(a):
            yield np.minimum(a, b), np.maximum(a, b)
        at = upto


def _pair_rows(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a sorted partition; a group is handled when its last row is there."""
    waiting: list[pa.RecordBatch] = []

    def handle(table: pa.Table):
        rows = {c: table.column(c).to_numpy().astype(np.int64) for c in table.column_names}
        for a, b in _pairs_of(rows, percent):
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        table = pa.Table.from_batches(waiting)
        last = np.ones(table.num_rows, bool)
        for c in ("token", "i", "j"):
            values = table.column(c).to_numpy()
            last &= values == values[-1]
        whole = int(np.flatnonzero(last)[0])
        if whole:
            yield from handle(table.slice(0, whole))
            waiting = table.slice(whole).to_batches()
    if waiting:
        yield from handle(pa.Table.from_batches(waiting))


def _hub_pairs(prefixes: DataFrame, percent: int) -> DataFrame:
    hubs = prefixes.groupBy("token").agg(
        F.min(F.struct("pos", "uid", "n")).alias("hub"), F.count(F.lit(1)).alias("rows")
    ).filter("rows > 1").select("token", F.col("hub.uid").alias("h"), F.col("hub.n").alias("hn"), F.col("hub.pos").alias("hp"))
    hubs = stored(hubs, "join-hubs")  # an aggregate by the key that is joined at once would keep a hot n-gram in one task
    need = f"ceil({percent} * (n + hn) / {100 + percent}D)"
    fits = f"uid <> h and 100 * least(n, hn) >= {percent} * greatest(n, hn) and least(n - pos, hn - hp) >= {need}"
    return prefixes.join(hubs, "token").filter(fits).select(F.col("h").alias("a"), F.col("uid").alias("b"))


def feasible(prefixes: DataFrame, percent: int) -> DataFrame:
    """Prefix rows without those whose place is too late for any partner that
    the n-gram's documents allow: even the smallest of them needs more than what is
    left of the set."""
    least = prefixes.groupBy("token").agg(F.min("n").alias("ln"), F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    need = f"ceil({percent} * (n + greatest(ln, ceil({percent} * n / 100D))) / {100 + percent}D)"
    least = stored(least.drop("rows"), "join-least")
    return prefixes.join(least, "token").filter(f"n - pos >= {need}").drop("ln")


def _rest_pairs(prefixes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    placed = prefixes.join(roots.withColumnRenamed("node", "uid"), "uid", "left").withColumn("comp", F.coalesce("root", "uid"))
    placed = stored(placed.select("token", "uid", "n", "pos", "comp"), "join-placed")
    groups = (
        placed.groupBy("token")
        .agg(F.count(F.lit(1)).alias("rows"), F.min("comp").alias("least"), F.max("comp").alias("most"))
        .filter("least <> most").select("token", F.ceil(F.col("rows") / GROUP).cast("int").alias("blocks"))
    )
    groups = stored(groups, "join-groups")
    rows = placed.join(groups, "token").withColumn("block", F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int"))
    # block i meets every block: as the first of (i, j), j >= i, and the second of (j, i), j < i
    meets = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, F.col("block")).alias("i"), F.greatest(j, F.col("block")).alias("j")),
    )
    rows = rows.withColumn("meet", F.explode(meets)).select("token", F.col("meet.i").alias("i"), F.col("meet.j").alias("j"), "uid", "n", "pos", "comp", "block")

    dealt = rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "n", "uid")
    return dealt.mapInArrow(lean(lambda b: _pair_rows(b, percent)), PAIRS)


# --- operator --------------------------------------------------------------------


def similar_documents(
    docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``uid, doc_id, text_crc32, n_shingles, class_uid, component_id, component``
    for every row; ``component`` numbers the component, ids aside.

    Words are runs of anything but ASCII white space, A-Z lowered. A document's set are its distinct
    runs of ``width`` words, or the whole sequence if it has fewer. Documents link when
    100 times the intersection is at least ``percent`` times the union.
    ``component_id`` is the least id reachable by links, a document's own
    included; ``class_uid`` names the row that stands for all rows with an equal set.
    A text without words, or null, has an empty set and links with nothing.
    A null id is greater than any; a component of null ids only has none. Rows
    that repeat are rows of one class. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    blocks, folder = write_scratch(bounded_batches(rows).mapInArrow(lean(lambda b: _block_rows(b, width)), BLOCKS), "join-blocks")
    every = blocks.select(
        "block", F.posexplode(F.arrays_zip("doc_ids", "crcs", "sizes", "digests")).alias("at", "d")
    ).select(
        (F.col("block") + F.col("at")).alias("uid"), F.col("d.doc_ids").alias("doc_id"),
        F.col("d.crcs").alias("text_crc32"),
        F.col("d.sizes").alias("n_shingles"), F.col("d.digests").alias("digest"),
    )
    every = stored(every, "join-documents")
    classes = every.filter("digest is not null").groupBy("digest").agg(
        F.min("uid").alias("class_uid"), F.min("doc_id").alias("least_id")
    )
    classes = stored(classes, "join-classes")
    size = blocks.agg(F.sum("words_n")).first()[0] or 0
    parts = int(-(-size // RANGE_KEYS) or 1)
    keys = blocks.select("block", "counts", "seq", "words").mapInArrow(lean(lambda b: _key_rows(b, width, parts)), KEYS)
    answers = keys.groupBy("part").applyInPandas(_frequencies, ANSWERS)
    low = F.lit((1 << 24) - 1)
    reps = classes.select(
        (F.col("class_uid") - F.col("class_uid").bitwiseAND(low)).alias("block"), F.col("class_uid").bitwiseAND(low).alias("at")
    ).groupBy("block").agg(F.collect_list("at").alias("reps"))  # within one block
    none = F.lit(None)
    answers = answers.withColumn("reps", none.cast("array<long>")).unionByName(
        reps.select("block", F.lit(-1).alias("part"), none.cast("binary").alias("df"), "reps")
    )

    def prefix(b: pd.DataFrame, a: pd.DataFrame) -> pd.DataFrame:
        return _prefix_rows(b, a, width, percent)

    found = blocks.select("block", "counts", "seq", "words").groupBy("block").cogroup(answers.groupBy("block"))
    found = stored(found.applyInPandas(prefix, ROWS), "join-rows")
    drop_folder(docs.sparkSession, folder)  # the largest table; nothing reads it from here on
    prefixes = found.filter("pos >= 0").select("token", "uid", "n", "pos")
    prefixes = stored(feasible(prefixes, percent), "join-prefixes")
    sets = found.filter("pos < 0").select("uid", "n", "tokens")
    links = verified(_hub_pairs(prefixes, percent), sets, percent, "join-hub")
    roots = connected_components(links)
    rest = verified(_rest_pairs(prefixes, roots, percent), sets, percent, "join-rest")
    if not rest.isEmpty():
        roots = connected_components(links.unionByName(rest))
    named = classes.join(roots, classes["class_uid"] == roots["node"], "left").withColumn("comp", F.coalesce("root", "class_uid"))
    named = stored(named.select("digest", "class_uid", "least_id", "comp"), "join-named")
    least = stored(named.groupBy("comp").agg(F.min("least_id").alias("component")), "join-least-ids")
    named = stored(named.join(least, "comp").select("digest", "class_uid", "comp", "component"), "join-components")
    return every.join(named, "digest", "left").select(
        "uid", "doc_id", "text_crc32", "n_shingles", F.coalesce("class_uid", "uid").alias("class_uid"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
        F.coalesce("comp", "uid").alias("component"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one row of each component: that of the least
    ``doc_id`` (null last). Texts without words all stay. The rows to drop are
    stored first, so that Spark joins them by their measured size."""
    rows = stored(similar_documents(docs, width, percent), "near-duplicates")
    order = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "uid")
    best = rows.groupBy("component").agg(F.min(order).alias("best")).select("component", F.col("best.uid").alias("best"))
    best = stored(best, "near-duplicate-best")
    _id, _crc = unused("_id", docs.columns), unused("_crc", docs.columns)
    marked = rows.join(best, "component").groupBy(F.col("doc_id").alias(_id), F.col("text_crc32").alias(_crc)).agg(
        F.max((F.col("uid") == F.col("best")).cast("int")).alias("stays"), F.count(F.lit(1)).alias("times"),
        F.max((F.col("n_shingles") == 0).cast("int")).alias("wordless"),
    )
    marked = stored(marked.filter("stays = 0 or (times > 1 and wordless = 0)"), "near-duplicate-rows")
    key = F.col("doc_id").cast("long").eqNullSafe(F.col(_id)) & (
        F.crc32(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col(_crc)
    )
    left = docs.join(marked.select(_id, _crc), key, "left_anti")
    again = marked.filter("stays = 1").select(_id, _crc)  # a row that stays, given several times
    if again.isEmpty():
        return left
    return left.unionByName(docs.join(again, key, "left_semi").dropDuplicates(["doc_id", "text"]))

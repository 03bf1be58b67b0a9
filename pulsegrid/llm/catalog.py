"""One query per operator, over the whole of its tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pulsegrid.llm.anchor_dedup import passage_digest
from pulsegrid.llm.common import read_documents
from pulsegrid.llm.cross_polytope import nearest_neighbours
from pulsegrid.llm.interpolated_lm import score_documents
from pulsegrid.llm.inverted_index import decontamination_report
from pulsegrid.llm.line_crf import score_documents as score_quality
from pulsegrid.llm.line_dedup import dedup_lines
from pulsegrid.llm.mixing import plan_mix
from pulsegrid.llm.ngram_join import similar_documents
from pulsegrid.llm.periodic_runs import runs_digest
from pulsegrid.llm.prefix_trie import conversation_trie
from pulsegrid.llm.sharding import shard_by_bytes
from pulsegrid.llm.token_files import token_digest
from pulsegrid.llm.toxic_segments import score_documents as score_toxicity

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deleted-interpolation score of every document."""
    return score_documents(read_documents(spark, sf_dir))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files and read back."""
    return token_digest(read_documents(spark, sf_dir), str(tokenizer_path()), end_id=1)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document from its maximum-scoring segments."""
    return score_toxicity(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of nearly equal bytes."""
    return shard_by_bytes(read_documents(spark, sf_dir), shards=24)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that earlier three-line windows hold."""
    return dedup_lines(read_documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents: words taken of each."""
    mixed = plan_mix(read_documents(spark, sf_dir))
    return mixed.selectExpr(
        "doc_id", "size", "source_size", "target", "size * copies as taken", "source", "rate", "copies"
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by Jaccard similarity of 4-word shingles."""
    return similar_documents(read_documents(spark, sf_dir), width=4, percent=85).select(
        "doc_id", "n_shingles", "component_id"
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth embedding among all."""
    return nearest_neighbours(read_documents(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document from the field over its lines."""
    return score_quality(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "labels"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents hit by 10-word windows of the benchmark."""
    return decontamination_report(read_documents(spark, sf_dir), read_documents(spark, sf_dir, "benchmark"))


def op11_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 50-word windows that earlier ones hold."""
    return passage_digest(read_documents(spark, sf_dir), width=50)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words of every document."""
    return runs_digest(read_documents(spark, sf_dir))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, rebuilt."""
    return conversation_trie(read_documents(spark, sf_dir, "conversations"))


LINE_DEDUP_SQL = r"""
with d as (
  select doc_id, string_split(text, chr(10)) as ls from documents
), l as (
  select doc_id, unnest(range(1, len(ls) + 1)) as i, unnest(ls) as line from d
), w as (
  select doc_id, i, line || chr(10) || lead(line) over o || chr(10) || lead(line, 2) over o as k
  from l window o as (partition by doc_id order by i)
), n as (
  select doc_id, i, row_number() over (partition by k order by doc_id, i) as nth from w
  where k is not null and trim(replace(k, chr(10), ''), concat(' ', chr(9), chr(13), chr(11), chr(12))) <> ''
), gone as (
  select distinct doc_id, i + unnest([0, 1, 2]) as i from n where nth > 1
), kept as (
  select l.doc_id, count(*) as n_lines, count(gone.i) as n_removed,
    coalesce(string_agg(line, chr(10) order by l.i) filter (where gone.i is null), '') as text
  from l left join gone on l.doc_id = gone.doc_id and l.i = gone.i group by l.doc_id
)
select d.doc_id, coalesce(n_lines, 0) as n_lines, coalesce(n_removed, 0) as n_removed, kept.text
from d left join kept on d.doc_id = kept.doc_id
"""

MIXING_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as size from documents
), s as (
  select source, cast(sum(size) as bigint) as source_size from d group by source
), w as (
  select *, (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight from s
), o as (
  select *, cast(coalesce(sum(3 * source_size) over before, 0) as bigint) as fixed,
    cast(sum(weight) over (order by source_size / weight desc, source desc nulls first
      rows between unbounded preceding and current row) as bigint) as share,
    row_number() over (order by source_size / weight, source nulls last) as nth
  from w window before as (order by source_size / weight, source nulls last
    rows between unbounded preceding and 1 preceding)
), l as (
  select max(((select sum(source_size) from s) - fixed)::double / share::double) as level
  from o where nth = (select min(nth) from o where
    ((select sum(source_size) from s) - fixed)::double / share::double * weight <= 3 * source_size)
), t as (
  select source, source_size,
    case when weight * level > 3 * source_size then (3 * source_size)::double else weight * level end as target
  from w, l
), r as (
  select *, case when source_size > 0 then target / source_size else 1.0 end as rate from t
), c as (
  select d.doc_id, d.size, r.source_size, r.target, r.source, r.rate,
    cast(floor(rate) as bigint) + case when
      cast('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), '')), 1, 13) as bigint)::double
        / 4503599627370496.0 < rate - floor(rate) then 1 else 0 end as copies
  from d join r on d.source is not distinct from r.source
)
select doc_id, size, source_size, target, size * copies as taken, source, rate, copies from c
"""

PASSAGE_SQL = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents
), w as (
  select r, doc_id, unnest(range(0, len(ws))) as i, unnest(ws) as word from d
), s as (
  select r, doc_id, i, word, string_agg(word, ' ') over p as passage, count(*) over p as n from w
  window p as (partition by r order by i rows between current row and 49 following)
), k as (
  select r, doc_id, i, md5(passage) as k from s where n = 50 and doc_id is not null
), l as (
  select k, min(doc_id) as least from k group by k
), hit as (
  select k.r, k.i from k join l on k.k = l.k where l.least < k.doc_id
), gone as (
  select w.r, w.i, max(hit.i) over (partition by w.r order by w.i rows between 49 preceding and current row) as last
  from w left join hit on w.r = hit.r and w.i = hit.i
), kept as (
  select w.r, count(*) filter (where last is not null) as n_removed,
    string_agg(word, ' ' order by w.i) filter (where last is null) as kept
  from w join gone on w.r = gone.r and w.i = gone.i group by w.r
)
select d.doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from d left join kept on d.r = kept.r
"""

TRIE_SQL = r"""
with recursive t as (
  select conv_id, turn, coalesce(text, '') as text,
    md5(length(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as digest
  from conversations where conv_id is not null
), own as (
  select conv_id, digest, strlen(text)::bigint as bytes, row_number() over (partition by conv_id order by turn nulls first, digest) as nth from t
), c as (
  select conv_id, count(*) as n, xor(list_reduce(list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::bigint),
    lambda crc, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7],
      lambda a, k: xor(a >> 1, 3988292384 * (a & 1)), xor(crc, x)), 4294967295::bigint), 4294967295) % 9 as h
  from own group by conv_id
), m as (
  select c.conv_id, c.h, least(c.h, coalesce(b.n, 0)) as head, c.conv_id - c.conv_id % 5 as base,
    least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) as n_turns
  from c left join c b on b.conv_id = c.conv_id - c.conv_id % 5
), rebuilt as (
  select m.conv_id, nth as depth, digest, bytes from m join own on own.conv_id = m.base where nth <= h
  union all select m.conv_id, head + nth - h, digest, bytes from m join own on own.conv_id = m.conv_id where nth > h
), p as (
  select conv_id, 0 as depth, '' as key, '' as parent, 0 as bytes from m
  union all select conv_id, depth, string_agg(digest, '') over o,
    coalesce(string_agg(digest, '') over (o rows between unbounded preceding and 1 preceding), ''), bytes
  from rebuilt window o as (partition by conv_id order by depth)
), node as (
  select p.depth, key, parent, min(p.conv_id) as conv_id, count(*) as n_convs, max(bytes) as bytes,
    count(*) filter (where depth = n_turns) as n_ends,
    sha256(coalesce(string_agg(p.conv_id::varchar, ',' order by p.conv_id) filter (where depth = n_turns), '')) as ends_sha256
  from p join m on p.conv_id = m.conv_id group by p.depth, key, parent
), above as (
  select p.depth, p.key, sum((n_convs - 1) * node.bytes) as saved, count(*) filter (where n_ends = n_convs) as leaves
  from node join p on p.conv_id = node.conv_id and p.depth <= node.depth group by p.depth, p.key
), kids as (
  select depth - 1 as depth, parent as key, count(*) as n_children from node where depth > 0 group by depth, parent
)
select node.conv_id, node.depth::bigint as depth, up.conv_id as parent_conv_id, node.n_convs, coalesce(n_children, 0) as n_children,
  leaves as n_leaves, saved::bigint as saved_tokens, node.ends_sha256
from node join above on above.depth = node.depth and above.key = node.key
  left join kids on kids.depth = node.depth and kids.key = node.key
  left join node up on up.depth = node.depth - 1 and up.key = node.parent
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scores": op1_lm_scores,
        "op2_token_files": op2_token_files,
        "op3_toxicity": op3_toxicity,
        "op4_sharding": op4_sharding,
        "op5_line_dedup": op5_line_dedup,
        "op6_mixing": op6_mixing,
        "op7_ngram_join": op7_ngram_join,
        "op8_neighbours": op8_neighbours,
        "op9_quality": op9_quality,
        "op10_decontamination": op10_decontamination,
        "op11_anchor_dedup": op11_anchor_dedup,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_line_dedup": LINE_DEDUP_SQL,
        "op6_mixing": MIXING_SQL,
        "op11_anchor_dedup": PASSAGE_SQL,
        "op13_prefix_trie": TRIE_SQL,
    }

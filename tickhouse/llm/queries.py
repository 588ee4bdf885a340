"""The registered queries of the training-data operators, and their SQL.

Each query applies one operator with production parameters to its whole
table and derives the returned columns from the operator's result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm import (
    chunk_dedup,
    gumbel,
    hilbert_pack,
    nbsvm,
    partenum,
    pii,
    pivot_simhash,
    ppm,
    prefix_trie,
    repetition,
    token_count,
    varbyte,
    whitening,
)
from tickhouse.llm.common import key_remainder, read_table, ship
from tickhouse.session import new_scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

TOKEN_LIMIT = 4096


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document by the piece model."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    counts = token_count.token_counts(read_table(spark, sf_dir), path)
    return token_count.over_limit(counts, TOKEN_LIMIT)


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lengths of every document under the corpus model."""
    return ppm.model_scores(read_table(spark, sf_dir), key_remainder("doc_id", 5) != 1)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans of every document, plain and disguised."""
    return pii.personal_data(read_table(spark, sf_dir))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed along the Hilbert curve."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return hilbert_pack.packed(read_table(spark, sf_dir), path)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate groups of all documents by chunk recipes."""
    return chunk_dedup.exact_dedup(read_table(spark, sf_dir))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition rules over every document."""
    return repetition.repetition_coverage(read_table(spark, sf_dir))


def op7_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document, decoded again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return gumbel.segmentations(read_table(spark, sf_dir), path).select(
        "doc_id",
        "sample",
        "n_tokens",
        F.crc32("ids").alias("ids_crc32"),
        "log_prob",
        "perturbed",
        "log_inclusion",
        F.col("decodes").alias("round_trip"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as token files in key order and read back."""
    folder = new_scratch_dir(spark, "token-files")
    path = public_tokenizers.path("word_bpe_49k.json")
    varbyte.write_tokens(read_table(spark, sf_dir), folder, path)
    return varbyte.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> nbsvm.Model:
    """Learned from labelled ``docs`` outside the held-out fold."""
    return nbsvm.fit(docs, read_table(spark, sf_dir, "labels"), key_remainder("doc_id", 4) != 2)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of every document."""
    docs = read_table(spark, sf_dir)
    scored = nbsvm.scores(docs, quality_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (key_remainder("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= F.lit(nbsvm.THRESHOLD)).cast("int").alias("predicted"),
    )


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and near-duplicate components of all documents."""
    return pivot_simhash.near_duplicates(read_table(spark, sf_dir))


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose word 4-gram sets are similar."""
    return partenum.jaccard_components(read_table(spark, sf_dir))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings of all rows."""
    return whitening.whitened(read_table(spark, sf_dir, "embeddings"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"))


def shipped(query: Query) -> Query:
    """The query, run after the package is with the Python workers."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: shipped(f)
    for f in (
        op1_token_counts,
        op2_language_model,
        op3_personal_data,
        op4_packing,
        op5_exact_dedup,
        op6_repetition,
        op7_sampled_pieces,
        op8_token_files,
        op9_quality,
        op10_simhash,
        op11_ngram_join,
        op12_whitening,
        op13_prefix_trie,
    )
}

#: DuckDB SQL where SQL can express the query; the others are tested against
#: brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op5_exact_dedup": """
with t as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') as norm
  from documents
)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, sha256(norm) as text_sha256
from t window w as (partition by norm)
""",
    "op11_ngram_join": r"""
with recursive words as (
  select doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then []
                      when len(w) < 4 then [array_to_string(w, ' ')]
                      else list_distinct(list_transform(range(1, len(w) - 2),
                             lambda i: array_to_string(w[i:i + 3], ' '))) end as s
  from words
), grams as (
  select doc_id, len(s) as n, unnest(s) as g from sets
), near as (
  select a.doc_id as a, b.doc_id as b
  from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))
), links as (
  select a, b from near union all select b, a from near
), reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on r.b = l.a
)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, r.component_id
from sets s join (select a, min(b) as component_id from reach group by a) r on s.doc_id = r.a
""",
    "op13_prefix_trie": """
with recursive turns as (
  select conv_id as c, turn, coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null
), own as (
  select *, row_number() over (
      partition by c order by turn nulls first,
      substr(sha256(length(role) || ':' || role || text), 1, 30)) as pos
  from turns
), crcs as (
  select c, c - c % 100 as base, list_reduce(
      list_concat([cast(4294967295 as bigint)],
                  list_transform(string_split(cast(c as varchar), ''), lambda x: cast(ascii(x) as bigint))),
      lambda s, b: list_reduce(list_concat([xor(s, b)], list_transform(range(8), lambda z: cast(0 as bigint))),
                               lambda r, z: xor(r >> 1, (r & 1) * 3988292384))) as inverted
  from (select distinct c from own)
), convs as (
  select c, base, xor(inverted, 4294967295) % 6 as h from crcs
), heads as (
  select v.c, v.h, v.base, coalesce(max(o.pos), 0) as k
  from convs v left join own o on o.c = v.base and o.pos <= v.h group by all
), rebuilt as (
  select v.c, o.pos as d, o.role, o.text from heads v join own o on o.c = v.base and o.pos <= v.h
  union all
  select v.c, o.pos - v.h + v.k, o.role, o.text from heads v join own o on o.c = v.c and o.pos > v.h
), lists as (
  select v.c, coalesce(list(sha256(length(role) || ':' || role || text) order by d) filter (d is not null), []) as ids,
         coalesce(list(length(text) order by d) filter (d is not null), []) as sizes
  from convs v left join rebuilt r on v.c = r.c group by v.c
), prefixes as (
  select c, d, ids[1:d] as node, d = len(ids) as ends, case when d = 0 then 0 else sizes[d] end as chars
  from (select *, unnest(range(0, len(ids) + 1)) as d from lists)
), nodes as (
  select node, d as depth, min(c) as conv_id, count(*) as n_convs, min(chars) as chars,
         sha256(coalesce(string_agg(cast(c as varchar), ',' order by c) filter (ends), '')) as ends_sha256
  from prefixes group by node, d
), children as (
  select node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by 1
), weighed as (
  select n.*, coalesce(k.n_children, 0) as n_children from nodes n left join children k using (node)
), subtrees as (
  select node[1:up] as node, sum((n_convs - 1) * chars) as saved_tokens, count(*) filter (n_children = 0) as n_leaves
  from (select *, unnest(range(0, depth + 1)) as up from weighed) group by 1
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, cast(n.n_children as bigint) as n_children,
       s.n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from weighed n join subtrees s using (node)
left join nodes p on p.node = n.node[1:n.depth - 1] and n.depth > 0 and p.depth = n.depth - 1
""",
}

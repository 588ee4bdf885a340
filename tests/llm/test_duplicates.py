"""Exact and near duplicates and the pipeline, against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import string

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tickhouse.llm import chunk_dedup, pivot_simhash, queries
from tickhouse.llm.common import read_table

SF_SMALL = "/root/testdata/sf0.001"
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def norm(text):
    return (text or "").translate(LOWER)


def smallest_first(key):
    return (key is not None, key or 0)


def plain_exact(collected):
    groups = collections.defaultdict(list)
    for k, t in collected:
        groups[norm(t)].append(k)
    rows = []
    for text, keys in groups.items():
        keep = max(keys, key=smallest_first)
        digest = hashlib.sha256(text.encode()).hexdigest()
        left = True
        for k in keys:
            rows.append((k, keep, len(keys), k == keep and left, digest))
            left = left and k != keep
    return collections.Counter(rows)


def weak(chunk):
    return F.char_length(chunk) % 3


@pytest.mark.parametrize("chunk_hash", [F.xxhash64, weak])
def test_exact_groups(docs, collected, chunk_hash):
    """A hash with many collisions gives the same groups."""
    rows = chunk_dedup.exact_groups(docs, chunk_hash=chunk_hash).collect()
    got = {(r.key, r.keep_id, r.group_size, r.kept, r.digest): r.copies for r in rows}
    expect = plain_exact(collected)
    kept = {x[:3] for x in expect if x[3]}
    assert {x[:3] for x in got if x[3]} == kept
    assert sum(got.values()) == len(collected)
    assert {(k, s, d) for _, k, s, _, d in got} == {(k, s, d) for _, k, s, _, d in expect}


def test_exact_rows(docs, collected, empty):
    got = chunk_dedup.exact_dedup(docs)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert collections.Counter(map(tuple, got.collect())) == plain_exact(collected)
    assert chunk_dedup.exact_dedup(empty).collect() == []


def test_chunks_are_the_text(docs):
    text = F.coalesce("text", F.lit(""))
    parts = docs.select(
        text.alias("t"), F.concat_ws("", chunk_dedup.chunks(text)).alias("u"),
        F.size(chunk_dedup.chunks(text)).alias("n"),
    )
    rows = parts.collect()
    assert all(r.t == r.u for r in rows) and max(r.n for r in rows) > 50


def test_distinct_documents_keep_all_columns(docs, collected, empty):
    got = chunk_dedup.distinct_documents(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    groups = {norm(t) for _, t in collected}
    assert len(rows) == len(groups) == len({norm(r.text) for r in rows})
    keys = collections.Counter(r.doc_id for r in rows)
    expect = collections.Counter(x[0] for x, n in plain_exact(collected).items() if x[3] for _ in range(n))
    assert keys == expect
    assert chunk_dedup.distinct_documents(empty).collect() == []


def test_exact_groups_hold_no_python(spark, docs):
    plan = chunk_dedup.exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- near duplicates --------------------------------------------------------


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def plain_components(prints, max_bits=2):
    """Smallest member of each fingerprint's component, by all pairs."""
    prints = sorted(set(prints))
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in prints}


def test_near_duplicates(docs, collected, empty):
    got = pivot_simhash.near_duplicates(docs).collect()
    prints = [plain_print(t) for _, t in collected]
    root = plain_components(prints)
    least = {}
    for (k, _), p in zip(collected, prints, strict=True):
        if k is not None:
            least[root[p]] = min(k, least.get(root[p], k))
    expect = collections.Counter(
        (k, f"{p:016x}", least.get(root[p])) for (k, _), p in zip(collected, prints, strict=True)
    )
    assert collections.Counter(map(tuple, got)) == expect
    assert pivot_simhash.near_duplicates(empty).collect() == []


def clustered(seed, n, centres, flips):
    """Fingerprints around a few centres, some within two bits of others."""
    r = random.Random(seed)
    middle = [r.getrandbits(64) for _ in range(centres)]
    out = set()
    for _ in range(n):
        x = r.choice(middle)
        for _ in range(r.randint(0, flips)):
            x ^= 1 << r.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize(("seed", "centres", "flips", "limit"), [(1, 40, 6, 1024), (2, 2, 5, 8), (3, 1, 4, 2)])
def test_links_lose_nothing(spark, monkeypatch, seed, centres, flips, limit):
    """Also where cells are far over the limit and come split."""
    prints = clustered(seed, 700, centres, flips)
    signed = [(pivot_simhash._signed(p),) for p in prints]
    monkeypatch.setattr(pivot_simhash.celled, "__defaults__", (2, limit))
    edges = pivot_simhash.links(spark.createDataFrame(signed, "bits long"))
    for u, v in edges.collect():
        assert u != v
    got = {u: r for u, r in pivot_simhash.components(edges).collect()}
    groups = collections.defaultdict(set)
    for p in prints:
        s = pivot_simhash._signed(p)
        groups[got.get(s, s)].add(p)
    expect = collections.defaultdict(set)
    for p, r in plain_components(prints).items():
        expect[r].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expect.values()))


def test_split_cells_are_bounded():
    for mask in pivot_simhash.cell_masks(pivot_simhash.ALL_BITS):
        free = pivot_simhash.ALL_BITS & ~mask
        for sub in pivot_simhash.cell_masks(free):
            assert (free & ~sub).bit_count() <= 11


def test_pivots_bound_the_distance():
    r = np.random.default_rng(2)
    values = r.integers(0, 1 << 64, 300, dtype=np.uint64)
    table = pivot_simhash.pivot_table(values).astype(int)
    real = np.bitwise_count(values[:, None] ^ values[None, :])
    gap = np.abs(table[:, None, :] - table[None, :, :]).max(axis=2)
    assert (gap <= real).all()


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star, "u long, v long")
    got = dict(map(tuple, pivot_simhash.components(edges).collect()))
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}


@pytest.mark.parametrize("one_of", [chunk_dedup.distinct_documents, pivot_simhash.representatives])
def test_nulls_in_different_columns_leave_one_row(spark, one_of):
    text = "one and the same text of a few words"
    rows = [(1, text, None, "x"), (1, text, "x", None), (1, text, None, "x"), (2, "another text", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [tuple(r) for r in one_of(docs).collect()]
    assert sorted(r[0] for r in got) == [1, 2] and set(got) <= set(rows)


def test_representatives(docs, collected, empty):
    got = pivot_simhash.representatives(docs)
    assert got.columns == docs.columns
    prints = {}
    for k, t in collected:
        prints.setdefault(plain_print(t), []).append(k)
    root = plain_components(prints)
    best = {}
    for p, keys in prints.items():
        best.setdefault(root[p], []).extend(keys)
    expect = collections.Counter(
        min(keys, key=lambda k: (k is None, k or 0)) for keys in best.values()
    )
    assert collections.Counter(r.doc_id for r in got.collect()) == expect
    assert pivot_simhash.representatives(empty).collect() == []


# --- pipeline ---------------------------------------------------------------


def test_pipeline_stage_by_stage(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_dedup", "near_dedup", "personal_data", "packing"]
    docs = read_table(spark, SF_SMALL)
    quality = {r.doc_id: r.quality for r in read_table(spark, SF_SMALL, "labels").collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_SMALL)
        assert after.columns == docs.columns and dict(after.dtypes) == dict(docs.dtypes), name
        rows = after.collect()
        kept.append(rows)
        docs = spark.createDataFrame(rows, after.schema)
    after_quality, exact, near, private = kept
    ids = {r.doc_id for r in after_quality}
    good = [k for k, q in quality.items() if q == 1]
    assert len(ids & set(good)) >= 0.95 * len(good)
    assert len(exact) == len({norm(r.text) for r in after_quality})
    assert len(near) == len(set(plain_components([plain_print(r.text) for r in exact]).values()))
    assert [r.n_chars for r in private] == [len(r.text) for r in private]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in private}


def test_pipeline_on_edge_cases(spark, docs, empty):
    for frame in (docs, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF_SMALL)
            assert out.columns == frame.columns
            frame = spark.createDataFrame(out.collect(), out.schema)
        corpus_pipeline.STAGES[-1][1](spark, frame, SF_SMALL).collect()


def test_registered_queries():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)

"""The prefix trie against rebuilt texts in plain Python, and against SQL."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tickhouse.llm import prefix_trie
from tickhouse.llm.queries import ORACLE_SQL

SCHEMA = "conv_id long, turn long, role string, text string, depth int, part int, owner string"


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:30]
            own[conv].append(((turn is not None, turn or 0, name), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 6
        base = conv - int(math.fmod(conv, 100))
        out[conv] = (*own.get(base, [])[:h], *turns[h:])
    return out


def brute(rows):
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(int)
    for conv, turns in sorted(rebuild(rows).items()):
        for d in range(len(turns) + 1):
            members[turns[:d]].append(conv)
        ends[turns].append(conv)
    saved, leaves = defaultdict(int), defaultdict(int)
    for node in members:
        children[node[:-1]] += bool(node)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
            leaves[node[:d]] += not children[node]
    return sorted(
        (
            (
                convs[0],
                len(node),
                members[node[:-1]][0] if node else None,
                len(convs),
                children[node],
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest(),
            )
            for node, convs in members.items()
        ),
        key=str,
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "o") for r in rows], SCHEMA).repartition(4)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    """Bases with variants that leave at any depth, copies, gaps, odd turns."""
    r = random.Random(11)
    out = []
    for base in (0, 100, 300, -200):
        script = [(f"r{i % 2}", f"line {base} {i} é" * r.randint(0, 3)) for i in range(9)]
        for conv in [base, *r.sample(range(base + 1, base + 100), 25)]:
            own = list(script)
            for _ in range(r.randint(0, 2)):
                own[r.randrange(9)] = ("user", f"other {r.randrange(3)}")
            out += [(conv, i, *t) for i, t in enumerate(own[: r.randint(1, 9)])]
    out += [(777, i, "user", "no base") for i in range(4)]
    out += [(901, None, None, None), (901, None, "a", None), (901, 3, None, "x"), (901, 3, "", "x")]
    out += [(None, 1, "user", "nobody"), (5, 1, "user", "one"), (5, 1, "user", "one")]
    return out


def test_equals_rebuilt_texts(spark, rows):
    got = prefix_trie.prefix_trie(frame(spark, rows))
    assert got.columns == [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256",
    ]
    assert result(got) == brute(rows)


def test_equals_sql(spark, rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    assert sorted(con.execute(ORACLE_SQL["op13_prefix_trie"]).fetchall(), key=str) == brute(rows)


def test_short_blocks_and_chunks_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 2)
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    assert result(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_one_long_conversation_and_many_equal_ones(spark):
    rows = [(200, i, "user", f"t{i % 7}") for i in range(3000)]
    rows += [(c, i, "user", f"t{i}") for c in range(1000, 1400) for i in range(7)]
    assert result(prefix_trie.prefix_trie(frame(spark, rows))) == brute(rows)


def test_clashing_products_cost_another_seed(spark, rows):
    seeds = []

    def poor(id1, id2, seed):
        seeds.append(seed)
        real = prefix_trie.elements(id1, id2, seed)
        return [e % 2 for e in real] if seed == 0 else real

    assert result(prefix_trie.prefix_trie(frame(spark, rows), poor)) == brute(rows)
    assert max(seeds) >= 1


def test_no_conversations(spark):
    assert prefix_trie.prefix_trie(frame(spark, [])).collect() == []
    assert prefix_trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []


def test_powers(spark):
    exponents = [0, 1, 2, 255, 256, 70_000, prefix_trie.P - 2, prefix_trie.P - 1, 1 << 40]
    for base in prefix_trie.bases(0)[:2]:
        got = (
            spark.createDataFrame([(n,) for n in exponents], "n long")
            .select(prefix_trie.power(base, F.col("n")))
            .collect()
        )
        assert [r[0] for r in got] == [pow(base, n, prefix_trie.P) for n in exponents]

"""The n-gram join against all pairs, and what its signatures promise."""

from __future__ import annotations

import random
import re
import tracemalloc
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickhouse.llm import partenum
from tickhouse.llm.common import buffer_of, text_slices
from tickhouse.llm.wordarrays import U

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lower)
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(4)), strict=False))


def brute(rows):
    """(key, size, component) per row, over all pairs of rows."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= 85 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        a = least.get(find(i))
        least[find(i)] = key if a is None else a if key is None else min(a, key)
    return sorted(
        ((k, len(sets[i]), least[find(i)]) for i, (k, _) in enumerate(rows)), key=str
    )


def edited(text, seed, share):
    r = random.Random(seed)
    words = text.split(" ")
    for at in r.sample(range(len(words)), max(1, int(len(words) * share))):
        words[at] = f"w{r.randrange(10**9)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def near_rows(words):
    """Copies of several sizes with few to many changed words, chains, shared passages."""
    r = random.Random(3)
    passage = " ".join(r.choices(words, k=40))
    out = []
    for n in (3, 4, 7, 10, 15, 40, 300, 2000):
        text = " ".join(r.choices(words, k=n))
        out.append(text)
        out += [edited(text, s, share) for s in range(2) for share in (0.005, 0.01, 0.02, 0.04)]
        out += [text.upper(), f"{text} end", f"{passage} {text}", f"{text} {passage}"]
        step = text
        for s in range(6):  # each close to the one before
            step = edited(step, 100 + s, 0.01)
            out.append(step)
    return list(enumerate(out))


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(4)


def test_equals_all_pairs(spark, near_rows):
    got = partenum.jaccard_components(frame(spark, near_rows))
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert result(got) == brute(near_rows)


def test_groups_over_several_cells_give_the_same(spark, words, monkeypatch):
    monkeypatch.setattr(partenum, "STARS", 1)
    r = random.Random(8)
    base = " ".join(r.choices(words, k=60))
    rows = list(enumerate([edited(base, s, 0.04) for s in range(60)]))
    cut = partenum.jaccard_components(frame(spark, rows), cell=7)
    assert result(cut) == brute(rows)


def test_cells_return_no_more_rows_than_they_have_members(spark, words, monkeypatch):
    """Many near copies under one signature: a forest of links, not their pairs."""
    made = []
    monkeypatch.setattr(partenum, "stored", lambda df, name: made.append((name, df.cache())) or df)
    r = random.Random(4)
    base = " ".join(r.choices(words, k=60))
    # of one leader each is too far, among each other many are not quite near enough
    rows = list(enumerate([edited(base, s, 0.06) for s in range(80)]))
    found = result(partenum.jaccard_components(frame(spark, rows)))
    assert found == brute(rows)
    members = {id(d): d.count() for n, d in made if n == "close-members"}
    assert len(members) == 1
    links = [d.count() for n, d in made if n == "links"]
    groups = [d for n, d in made if n == "open-groups"][-1]
    assert sum(members.values()) <= groups.count()
    assert links[-1] <= sum(members.values())


def test_cells_of_large_sets_are_cut(spark, words, monkeypatch):
    monkeypatch.setattr(partenum, "CELL_FEATURES", 500)
    r = random.Random(9)
    base = " ".join(r.choices(words, k=60))
    rows = list(enumerate([edited(base, s, 0.04) for s in range(40)]))
    assert result(partenum.jaccard_components(frame(spark, rows))) == brute(rows)


def test_nulls_empties_long_texts_ties_and_clashing_names(docs, collected):
    assert result(partenum.jaccard_components(docs)) == brute(collected)


def test_empty_table(empty):
    assert partenum.jaccard_components(empty).collect() == []


def test_a_name_that_two_sets_share_costs_another_seed(spark, near_rows, monkeypatch):
    real = partenum.set_names

    def clashing(values, first, seed=0):
        a, b = real(values, first, seed)
        return (np.where(a, a % U(5) + U(1), a), b) if seed == 0 else (a, b)

    monkeypatch.setattr(partenum, "set_names", clashing)
    few = near_rows[:60]
    assert result(partenum.jaccard_components(frame(spark, few))) == brute(few)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6))
def test_similar_sets_share_a_signature(size, seed):
    """Any two different sets that link share one, however close to the limit."""
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 1 << 63, size, dtype=np.int64).view(U))
    gone = int(r.integers(0, len(a) * 15 // 100 + 1))
    b = a[gone:]
    while 100 * len(b) >= 85 * len(a) and r.random() < 0.8:  # and some new features
        more = np.union1d(b, r.integers(0, 1 << 63, 1, dtype=np.int64).view(U))
        both = len(np.intersect1d(a, more))
        if 100 * both < 85 * (len(a) + len(more) - both):
            break
        b = more
    both = len(np.intersect1d(a, b))
    if len(a) == len(b) == both or 100 * both < 85 * (len(a) + len(b) - both):
        return
    bands = partenum.Bands()
    owner, found = partenum.set_signatures(
        np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), bands
    )
    assert set(found[owner == 0].tolist()) & set(found[owner == 1].tolist())


def test_thin_sets_meet_on_empty_choices():
    """Sets whose features fill too few partitions send their empty choices."""
    bands = partenum.Bands()
    k = bands.threshold(np.array([30]))
    values = np.arange(1, 4, dtype=U)
    owner, found = partenum.signatures(values, np.array([0, 3]), np.array([30]), k)
    assert len(found) == partenum.partitions(k)[0] * 3


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 300), st.integers(0, 60), st.integers(0, 10**6))
def test_sketches_never_exceed_the_difference(size, changed, seed):
    r = np.random.default_rng(seed)
    a = np.unique(r.integers(0, 1 << 63, size, dtype=np.int64).view(U))
    b = np.union1d(a[min(changed, len(a) - 1) :], r.integers(0, 1 << 63, changed).view(U))
    apart = len(np.setxor1d(a, b))
    for bits in (64, 256, 4096):
        x, y = partenum.sketch(a, bits), partenum.sketch(b, bits)
        assert np.bitwise_count(x ^ y).sum() <= apart
        assert (partenum.folded(partenum.sketch(a, bits * 4), len(x)) == x).all()


def test_unlike_texts_meet_rarely(words):
    """Signatures of unrelated texts of one size differ; shared passages meet in few."""
    r = random.Random(1)
    passage = " ".join(r.choices(words, k=30))
    texts = [f"{passage} {' '.join(r.choices(words, k=200))}".encode() for _ in range(40)]
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    values, first = partenum.shingle_sets(np.frombuffer(b"".join(texts), np.uint8), offsets)
    owner, found = partenum.set_signatures(values, first, partenum.Bands())
    _, counts = np.unique(found, return_counts=True)
    assert (counts > 1).sum() < len(found) / 200


def test_sets_are_made_in_little_memory():
    """Two workers share an executor's memory with the JVM: each makes its sets in small slices."""
    r = random.Random(3)
    texts = [" ".join(r.choice(["aa", "bcd", "efghi", "jk"]) + str(r.random()) for _ in range(500)) for _ in range(400)]
    column = pa.array(texts)
    assert column.nbytes > 4 << 20
    peak, sets = 0, []
    for at, n in text_slices(column, partenum.SLICE):
        tracemalloc.start()
        values, first = partenum.shingle_sets(*buffer_of(column.slice(at, n)))
        peak = max(peak, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        sets += [values[s:e].tolist() for s, e in zip(first, first[1:], strict=False)]
    assert peak < 100 << 20
    whole, first = partenum.shingle_sets(*buffer_of(column))
    assert sets == [whole[s:e].tolist() for s, e in zip(first, first[1:], strict=False)]

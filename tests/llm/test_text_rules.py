"""Language model, personal data, repetition rules and quality classifier."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import time
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickhouse.llm import nbsvm, pii, ppm, queries, repetition
from tickhouse.llm.common import key_remainder, read_table

SF_SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- partial matching -------------------------------------------------------


class PlainModel:
    """The same model with dictionaries, byte by byte."""

    def __init__(self, lines):
        self.follow = collections.defaultdict(collections.Counter)
        for line in lines:
            data = b"\xff" * ppm.ORDER + line + b"\xff"
            for i in range(ppm.ORDER, len(data)):
                for k in range(ppm.ORDER + 1):
                    self.follow[data[i - k : i]][data[i]] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = self.follow.get(context[ppm.ORDER - k :])
            if not seen:
                continue
            left = {s: c for s, c in seen.items() if s not in excluded}
            total = sum(left.values())
            if total:
                if symbol in left:
                    return p * (left[symbol] - 0.5) / total
                p *= 0.5 * len(left) / total
            excluded |= set(seen)
        return p / (256 - len(excluded))

    def score(self, line):
        data = b"\xff" * ppm.ORDER + line + b"\xff"
        return sum(
            math.log10(self.probability(data[i - ppm.ORDER : i], data[i]))
            for i in range(ppm.ORDER, len(data))
        )


def tokens(text):
    return (text or "").encode().lower().split()


def test_scores_equal_a_plain_model(docs, collected):
    train_when = key_remainder("doc_id", 5) != 1
    got = ppm.model_scores(docs, train_when, block_bytes=60_000).collect()
    held = [zlib.crc32(str("" if k is None else k).encode()) % 5 == 1 for k, _ in collected]
    learn = [tokens(t) for (k, t), h in zip(collected, held, strict=True) if not h]
    model = PlainModel([b" ".join(w) for w in learn])
    counts = collections.Counter(w for t in learn for w in [*t, b""])
    n, v = sum(counts.values()), len(counts)
    expect = collections.defaultdict(list)
    for (k, t), h in zip(collected, held, strict=True):
        own = [*tokens(t), b""]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in own)
        known = sum(counts[w] > 0 for w in own)
        line = b" ".join(own[:-1])
        expect[k].append((h, len(own), known, n, base, model.score(line) if len(line) < 9000 else None))
    assert len(got) == len(collected)
    for r in got:
        rows = expect[r.doc_id]
        assert any(
            (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[:4]
            and r.base_score == pytest.approx(e[4], rel=1e-9)
            and (e[5] is None or r.score == pytest.approx(e[5], rel=1e-9))
            for e in rows
        ), r


def test_probabilities_sum_to_one():
    model = PlainModel([b"the cat sat on the mat", b"the hat", b""])
    for context in (b"\xff" * ppm.ORDER, b"t the"[-ppm.ORDER :], b"zzzzz", b" the "[-ppm.ORDER :]):
        assert sum(model.probability(context, s) for s in range(256)) == pytest.approx(1)


def test_model_without_training_rows(docs, empty):
    rows = ppm.model_scores(docs.limit(5), F.lit(False)).collect()
    for r in rows:
        assert r.held_out and r.train_tokens == 0 and r.n_known == 0
    assert ppm.model_scores(empty, F.lit(True)).collect() == []


def test_model_beats_the_word_counts_on_held_out_text(spark):
    # the base gives any unknown word one small share without spelling it; with
    # little text to learn spelling from (sf0.01) that is cheaper
    rows = queries.op2_language_model(spark, "/root/testdata/sf0.1").where("held_out")
    rows = rows.agg(F.sum("score"), F.sum("base_score"))
    score, base = rows.first()
    assert score > base


# --- personal data ----------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                odd = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
                if not 13 <= len(digits) <= 19 or sum(odd) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("0123456789.+-() @aZé中"), max_size=60))
def test_base_spans_equal_plain_patterns(text):
    assert pii.find(text) == plain_spans(text)
    assert set(plain_spans(text)) <= set(pii.find_all(text))


def test_personal_data_rows(spark):
    docs = read_table(spark, SF)
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    found = 0
    for r in docs.collect():
        spans = plain_spans(r.text)
        found += len(spans)
        row = got[r.doc_id]
        text = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [
            sum(s[0] == k for s in spans) for k in pii.KINDS
        ]
        assert set(text.split(",")) - {""} <= set(row.spans.split(","))
    assert found > 20


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail john.doe [at] example [dot] com now", "email", "john.doe [at] example [dot] com"),
        ("mail john at example dot com now", "email", "john at example dot com"),
        ("ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ x", "email", "ｊｏｈｎ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
        ("jоhn@exаmple.com!", "email", "jоhn@exаmple.com"),
        ("j​ohn@ex.com", "email", "j​ohn@ex.com"),
        ("call plus one five five five one two three four five six seven", "phone",
         "plus one five five five one two three four five six seven"),
        ("pay four triple one" + " one" * 12 + " now", "card", "four triple one" + " one" * 12),
        ("ip one nine two dot one six eight dot one dot one fin", "ip",
         "one nine two dot one six eight dot one dot one"),
        ("١٩٢.١.١.١", "ip", "١٩٢.١.١.١"),
    ],
)
def test_disguises(text, kind, span):
    spans = [(k, text[s:e]) for k, s, e in pii.find_all(text)]
    assert (kind, span) in spans
    assert span not in pii.mask(text)


@pytest.mark.parametrize(
    "text",
    [
        "look at the dot com boom",
        "we met at one dot five",
        "one two three, testing",
        "at home (at least) [dot]",
        "version 1.2.3.256 and 12-34",
        "seven seas and nine lives at the end. dot dot dot",
    ],
)
def test_plain_prose_stays(text):
    assert pii.find_all(text) == [] and pii.mask(text) == text


DISGUISE_PARTS = [
    *pii.DIGIT_WORDS, "plus", "double", "triple", "dash", "hyphen", "point", "dot", "at", "Dot", "AT", "AT ", "one",
    "john", "example", "com", "ch", "the", "x", "1", "7", "192", "0199", "555", "@", ".", ",", "-", " - ", " , ", "[",
    "]", "(", ")", "{", ">", "+", "\n", "  ", "–", "\u200b", "ſ", "\u212a", "İ", "１", "٣", "．", "о", "é",
    " at ", " dot ", " [at] ", " (dot) ", "john at example.com", "one,four", "192 dot 168 dot 1 dot 10",
    "eight dot eight", " zero-one",
]


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(DISGUISE_PARTS), st.sampled_from([" ", " ", " ", ""])), max_size=24))
def test_shortcut_changes_nothing(parts):
    text = "".join(a + b for a, b in parts)
    assert pii.find_all(text) == pii.find_all(text, shortcut=False)


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("mail john at example.com now", "email", "john at example.com"),
        ("plus one,four,one,five,five,five,five,zero,one,nine,nine", "phone",
         "plus one,four,one,five,five,five,five,zero,one,nine,nine"),
        ("ring (plus one four one five five five five zero one nine nine)", "phone",
         "plus one four one five five five five zero one nine nine"),
        ("tel:plus 1 4 1 5 5 5 5 0 1 9 9", "phone", "plus 1 4 1 5 5 5 5 0 1 9 9"),
    ],
)
def test_plain_ascii_disguises_reach_the_transducers(text, kind, span):
    for other in (text, text + " – "):
        assert (kind, span) in [(k, other[s:e]) for k, s, e in pii.find_all(other)]


@pytest.mark.parametrize(
    ("text", "kind", "span"),
    [
        ("host 192 dot 168 dot 1 dot 10 is up", "ip", "192 dot 168 dot 1 dot 10"),
        ("dns eight dot eight dot eight dot eight.", "ip", "eight dot eight dot eight dot eight"),
        ("dns eight [dot] eight [dot] eight (dot) eight.", "ip", "eight [dot] eight [dot] eight (dot) eight"),
        ("dns 8.eight.8.eight", "ip", "8.eight.8.eight"),
        ("i have one 192 dot 168 dot one dot one zero", "ip", "192 dot 168 dot one dot one zero"),
        ("plus one four one five 555 0199", "phone", "plus one four one five 555 0199"),
        ("ring plus one (four one five) five five five 0199", "phone",
         "plus one (four one five) five five five 0199"),
        ("+1 415 555 double zero 12", "phone", "+1 415 555 double zero 12"),
        ("pay 4111 one one one one 1111,1111", "card", "4111 one one one one 1111,1111"),
    ],
)
def test_spelled_numbers(text, kind, span):
    assert (kind, span) in [(k, text[s:e]) for k, s, e in pii.find_all(text)]
    assert span not in pii.mask(text)


@pytest.mark.parametrize(
    "text",
    [
        "256 dot 168 dot 1 dot 10",
        "chapter one dot two dot three",
        "one, two, three, 44 and 555 dot",
        "version 2 point 5, then one more",
        "plus one for 555 0199",
    ],
)
def test_numbers_that_are_no_identifiers_stay(text):
    assert pii.find_all(text) == [] and pii.normalised(text) is None


def test_an_unconfirmed_run_breaks_no_other_disguise():
    text = "nine 9 ９.100.100.100"
    assert [(k, text[s:e]) for k, s, e in pii.find_all(text)] == [("ip", "９.100.100.100")]


@pytest.mark.parametrize(
    "span",
    [
        "jane at posteo dot ch", "jane at posteo dot it", "jane at posteo dot nl", "jane at posteo dot example",
        "jane dot doe at mail dot posteo dot museum", "jane@posteo dot ch", "jane at posteo.ch",
        "JANE AT POSTEO DOT CH", "jane at posteo dot xn--p1ai", "jane at posteo dot one", "jane at the-post dot my",
    ],
)
@pytest.mark.parametrize("around", ["{}", "mail {}, now", "look at the dot, {}.", "reach me at {} at noon"])
def test_worded_addresses_under_any_domain(span, around):
    text = around.format(span)
    assert ("email", span) in [(k, text[s:e]) for k, s, e in pii.find_all(text)]
    assert span not in pii.mask(text)


@pytest.mark.parametrize(
    "text",
    [
        "look at the dot product",
        "we met at noon.Then we left",
        "we met at noon.It was late",
        "see it at three dot five or at 3 dot five",
        "ring at example dot 7",
        "meet me at a dot b",
    ],
)
def test_sentences_with_at_stay(text):
    assert pii.find_all(text) == [] and pii.mask(text) == text


def test_the_later_of_two_addresses_that_meet():
    for text, span in [
        ("look at jane.doe@posteo.com", "jane.doe@posteo.com"),
        ("reach me at jane dot doe at posteo dot ch", "jane dot doe at posteo dot ch"),
        ("look at the dot jane at posteo dot ch", "the dot jane at posteo dot ch"),
    ]:
        assert [(k, text[s:e]) for k, s, e in pii.find_all(text)] == [("email", span)]


def test_long_dot_chains_end():
    text = "dot " * 200_000 + "@ jane at posteo dot ch" + " at" * 100_000 + " " * 200_000 + "x"
    assert "jane at posteo dot ch" in [text[s:e] for _, s, e in pii.find_all(text)]


def test_personal_data_cases(docs, collected, empty):
    rows = pii.personal_data(docs).collect()
    assert len(rows) == len(collected)
    none = hashlib.sha256(b"").hexdigest()
    assert all(r.base_sha256 == none and r.spans == "" for r in rows if r.doc_id in (27, 28))
    assert pii.personal_data(empty).collect() == []
    assert docs.select(pii.redacted(F.col("text")).alias("t")).where("t is null").count() == 1


# --- repetition -------------------------------------------------------------


def plain_repetition(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def inside(n):
        count = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        return {
            j
            for i in range(len(words) - n + 1)
            if count[tuple(words[i : i + n])] > 1
            for j in range(i, i + n)
        }

    chars = sum(map(len, words))
    seen, dup_lines, dup_chars = set(), 0, 0
    for line in text.split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own:
            if line in seen:
                dup_lines += 1
                dup_chars += sum(map(len, own))
            seen.add(line)
    repeat = len(inside(5))
    failed = len(words) < 10 or 100 * repeat > 20 * len(words)
    shares = {n: sum(len(words[j]) for j in inside(n)) / max(chars, 1) for n in repetition.NGRAM_LIMITS}
    kept = (
        not failed
        and dup_chars / max(chars, 1) <= repetition.LINE_LIMIT
        and all(s <= repetition.NGRAM_LIMITS[n] for n, s in shares.items())
    )
    symbols = sum(c in "#*$%&|<>" for c in text)
    return (len(words), chars, symbols, dup_lines, repeat, failed, kept)


def repetition_rows(column):
    got = repetition.measure(column)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return [tuple(x.item() for x in row) for row in zip(*(got[n] for n in names), strict=True)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t|#中\x1c\xa0"), max_size=120), max_size=6))
def test_repetition_equals_plain_counts(texts):
    assert repetition_rows(pa.array(texts, pa.string())) == [plain_repetition(t) for t in texts]


def test_repetition_rows(spark, docs, collected, empty):
    for frame, rows in ((docs, collected), (read_table(spark, SF_SMALL), None)):
        rows = rows or [(r.doc_id, r.text) for r in frame.collect()]
        got = repetition.repetition_coverage(frame)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
        expect = collections.Counter((k, *plain_repetition(t)) for k, t in rows)
        assert collections.Counter(map(tuple, got.select("doc_id", *names).collect())) == expect
    assert repetition.repetition_coverage(empty).collect() == []


# --- quality ----------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    rows = queries.op9_quality(spark, sf).join(read_table(spark, sf, "labels"), "doc_id").where("held_out")
    rows = rows.select("predicted", "quality").collect()
    assert len(rows) > 500
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.quality == 1]) > 0.99


def test_quality_ignores_held_out_labels(spark):
    docs, labels = read_table(spark, SF), read_table(spark, SF, "labels")
    train = key_remainder("doc_id", 4) != 2
    flipped = labels.withColumn("quality", F.when(train, F.col("quality")).otherwise(1 - F.col("quality")))
    a, b = nbsvm.fit(docs, labels, train), nbsvm.fit(docs, flipped, train)
    assert (a.weights == b.weights).all() and a[1:] == b[1:]


def test_quality_cases(docs, collected, empty):
    labels = docs.select("doc_id", (F.col("n_chars") % 2).alias("quality"))
    whole = nbsvm.fit(docs, labels, F.lit(True))
    rows = nbsvm.scores(docs, whole).collect()
    assert len(rows) == len(collected) and all(0 <= r.score <= 1 for r in rows)
    assert nbsvm.scores(empty, whole).collect() == []
    nothing = nbsvm.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in nbsvm.scores(docs, nothing).collect()} == {0.5}
    ones = nbsvm.fit(docs, labels.withColumn("quality", F.lit(1)), F.lit(True))
    assert {round(r.score, 6) > 0.9 for r in nbsvm.scores(docs, ones).collect()} == {True}
    kept = docs.where(nbsvm.accepted(F.col("text"), ones)).count()
    assert kept == len(collected)


def test_texts_are_scored_in_small_slices(spark):
    """Two workers share an executor's memory with the JVM."""

    class OfSmallSlices:
        def probabilities(self, column):
            return np.full(len(column), float(column.nbytes < 1.2 * (1 << 20)))

    texts = [(i, f"{i} " * 40_000) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    assert docs.where(nbsvm.accepted(F.col("text"), OfSmallSlices())).count() == 60
    assert {r.score for r in nbsvm.scores(docs, OfSmallSlices()).collect()} == {1.0}


def test_dual_coordinate_descent_separates():
    r = random.Random(3)
    rows, sign = [], []
    for _ in range(200):
        y = r.choice([-1.0, 1.0])
        rows.append(np.array([0 if y > 0 else 1, r.randint(2, 9)]))
        sign.append(y)
    values = [np.ones(2) for _ in rows]
    w = nbsvm.descend(rows, values, np.array(sign), np.full(len(rows), 1.0), 10)
    assert all(y * (w[x].sum() + w[10]) > 0.5 for x, y in zip(rows, sign, strict=True))


def test_repeats_keep_their_part_of_the_sample(spark, monkeypatch):
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 40))
    hot = spark.range(20_000).orderBy(place).first()["id"]  # its hash is under any share
    others = [(i, f"text {i} of {i % 7}") for i in range(30_000, 32_000)]
    rows = [(hot, "the hot text")] * 1000 + others
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    labels = spark.createDataFrame([(k, k % 2) for k in {k for k, _ in rows}], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(nbsvm, "fit_sample", lambda slots, label, ratio, cost: seen.append((slots, label)))
    for _ in range(2):
        nbsvm.fit(docs, labels, F.lit(True), sample=300)
    _, hot_slots, _ = nbsvm.indicators(pa.array(["the hot text"]), nbsvm.DIM)
    counts = [sum(np.array_equal(s, hot_slots) for s in slots) for slots, _ in seen]
    assert 250 <= len(seen[0][0]) <= 300
    assert counts[0] == counts[1] and 80 <= counts[0] <= 101
    for a, b in zip(seen[0][0], seen[1][0], strict=True):
        assert np.array_equal(a, b)
    # with room for all, every row is there
    nbsvm.fit(docs, labels, F.lit(True), sample=4000)
    assert len(seen[2][0]) == 3000 and sum(np.array_equal(s, hot_slots) for s in seen[2][0]) == 1000


# --- linear patterns, bounded samples ------------------------------------------


def test_base_spans_are_those_of_the_plain_patterns():
    r = random.Random(6)
    for _ in range(20_000):
        text = "".join(r.choices("a1.@-+ 9(_%", k=r.randint(0, 40)))
        plain = [
            (kind, m.start(), m.end())
            for kind, pattern, good in pii.PATTERNS
            for m in pattern.finditer(text)
            if good(m.group())
        ]
        assert pii.find(text) == plain, text


@pytest.mark.parametrize(
    "unit",
    ["1", "a", ".", " ", "at ", "a@", "1.", "a.", "+1", "-", "jane dot ", "(at) ", "1 ", "a@a."],
)
def test_long_unbroken_runs_take_linear_time(unit):
    """A quadratic scan of these would take minutes to hours."""
    text = f"x 1.2 b@c.de {unit * (300_000 // len(unit))} 1.2.3.4 j@k.lm"
    began = time.perf_counter()
    spans = pii.find_all(text)
    assert time.perf_counter() - began < 10
    assert ("email", 6, 12) in spans


def test_the_sample_is_bounded_in_bytes(spark):
    rows = [(i, f"{'word ' * 200}{i}", i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "row long, text string, label int")
    all_rows = nbsvm.sampled(frame, 1.0, 64, 100, 1 << 20)
    assert len(all_rows.label) == 60
    few = nbsvm.sampled(frame, 1.0, 64, 100, 10_100)
    assert len(few.label) == 10
    assert [few.row(i).tolist() for i in range(10)] and len(few.first) == 11


def test_weights_are_those_of_a_plain_support_vector_machine():
    """Dual coordinate descent against projected gradient steps on the whole dual."""
    r = np.random.default_rng(5)
    dim, n = 40, 120
    rows = [np.unique(r.integers(0, dim, 8)) for _ in range(n)]
    sign = np.where([row.min() < 3 or r.random() < 0.2 for row in rows], 1.0, -1.0)
    ratio = r.standard_normal(dim)
    values = nbsvm._Scaled(rows, ratio)
    cost = np.where(sign > 0, 0.7, 0.4)
    got = nbsvm.descend(rows, values, sign, cost, dim, epochs=3000)
    dense = np.zeros((n, dim + 1))
    for i, row in enumerate(rows):
        dense[i, row] = ratio[row] / np.sqrt(len(row))
    dense[:, dim] = 1.0
    gram = (dense * sign[:, None]) @ (dense * sign[:, None]).T
    dual, step = np.zeros(n), 1.0 / np.linalg.eigvalsh(gram)[-1]
    for _ in range(60_000):
        dual = np.clip(dual + step * (1 - gram @ dual), 0, cost)
    want = (dual * sign) @ dense

    def loss(w):
        return w @ w / 2 + (cost * np.maximum(0, 1 - sign * (dense @ w))).sum()

    assert loss(got) <= loss(want) * 1.001
    assert np.abs(dense @ got - dense @ want).max() < 0.05

"""Token counts, sampled segmentations and token files against the libraries."""

from __future__ import annotations

import collections
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from tickhouse.llm import common, gumbel, hilbert_pack, pretokens, token_count, varbyte
from tickhouse.llm.common import text_slices

PIECE = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = [
    "a", "B", "s", "'s", "'t", "'LL", " ", "  ", "\n", "\t", "1", "²", "½", ".", ",", "é", "É", "ß",
    "_", "-", "<|endoftext|>", "<|", "'re", "中", "́", "\xa0", "\x85", "İ", "ǅ", "ª", "µ", "!",
    "hello", "World", "\x00", "　", "▁", "<s>", "😀",
]


def random_texts(n):
    r = random.Random(4)
    return ["".join(r.choices(ALPHABET, k=r.randint(0, 24))) for _ in range(n)]


def test_token_counts_equal_the_library(docs, collected):
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    got = token_count.over_limit(token_count.token_counts(docs, PIECE), 4096).collect()
    expect = collections.Counter(
        (k, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096)
        for k, t in collected
    )
    assert collections.Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == expect


def test_token_counts_of_random_text():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    own = token_count.counter(PIECE)
    for text in random_texts(4000):
        assert own.count(text)[0] == len(sp.encode(text)), text


def test_whole_tokens_are_single_tokens():
    own = token_count.counter(PIECE)
    assert len(own.whole) > 30_000
    for piece in random.Random(1).sample(sorted(own.whole), 300):
        if piece.startswith("▁") and piece.strip("▁"):
            assert len(own.sp.encode(piece[1:])) == 1


def test_encoder_equals_the_library():
    texts = random_texts(6000)
    for path in (BYTES, WORDS):
        own = pretokens.Encoder(path)
        column, got = pa.array(texts), []
        for at, n in text_slices(column, 4000):
            ids, counts = own.encode(column.slice(at, n))
            got += np.split(ids, np.cumsum(counts)[:-1])
        library = tokenizers.Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
        assert [g.tolist() for g in got] == [e.ids for e in library]


def test_encoder_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE", 20)
    texts = random_texts(200)
    own, library = pretokens.Encoder(BYTES), tokenizers.Tokenizer.from_file(BYTES)
    for text in texts:
        ids, counts = own.encode(pa.array([text]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_variable_length_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 1001):
        values = (2.0 ** r.uniform(0, 32, n)).astype(np.uint32)
        control, data = varbyte.pack(values)
        assert len(control) == -(-n // 4)
        assert (varbyte.unpack(control, data, n) == values).all()
    control, data = varbyte.pack(np.array([0, 255, 256, 65536]))
    assert control.tolist() == [0b10_01_00_00] and len(data) == 7


def expected_ids(path, collected):
    library = tokenizers.Tokenizer.from_file(path)
    return [(k, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for k, t in collected]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, docs, collected, tmp_path):
    varbyte.write_tokens(docs, str(tmp_path / "f"), WORDS, file_ids=20_000)
    files = list((tmp_path / "f").glob("*.tvb"))
    assert len(files) > 2
    rows = varbyte.read_tokens(spark, str(tmp_path / "f")).orderBy("start").collect()
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys) and len(rows) == len(collected)
    start = 0
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    expect = collections.Counter((k, len(i), crc(i)) for k, i in expected_ids(WORDS, collected))
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expect
    counts = np.zeros(1 << 16, np.int64)
    for _, ids in expected_ids(WORDS, collected):
        np.add.at(counts, ids, 1)
    assert (np.diff(counts[varbyte.by_frequency(counts)]) <= 0).all()


def test_token_files_of_an_empty_table(spark, empty, tmp_path):
    varbyte.write_tokens(empty, str(tmp_path / "f"), WORDS)
    assert varbyte.read_tokens(spark, str(tmp_path / "f")).collect() == []


def test_hilbert_curve_visits_neighbours():
    for dims, bits in ((2, 4), (3, 2), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert_pack.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def check_packing(rows, expect, length=2048):
    by_sequence = collections.defaultdict(list)
    got = collections.Counter()
    pieces = collections.defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, r.length, r.ids_crc32))
    partial = 0
    for spans in by_sequence.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at and n > 0
            at += n
        assert at <= length
        partial += at < length
    # every id in exactly one piece, checked by the pieces' digests
    for key, ids in expect:
        cuts = pieces[(key, len(ids))]
        got[key] += 1
        starts = {s: (n, c) for s, n, c in cuts}
        at = 0
        while at < len(ids):
            n, c = starts[at]
            options = [(n2, c2) for s2, n2, c2 in cuts if s2 == at and c2 == crc(ids[at : at + n2])]
            assert options
            at += options[0][0]
    assert sum(r.length for r in rows) == sum(len(i) for _, i in expect)
    return partial


def test_packing(docs, collected):
    rows = hilbert_pack.packed(docs, BYTES, task_ids=20_000).collect()
    partial = check_packing(rows, expected_ids(BYTES, collected))
    assert partial <= 1 + sum(r.length for r in rows) // 20_000 + 1
    assert hilbert_pack.padded_length(0) == 1
    assert [hilbert_pack.padded_length(n) for n in (1, 2, 3, 1025, 2048)] == [1, 2, 4, 2048, 2048]


def test_packing_of_one_hot_text(spark, words):
    """A group of copies spreads over tasks instead of filling one."""
    rows = [(i, "the same words again and again" if i % 3 else f"text {i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    packed = hilbert_pack.packed(docs, BYTES, task_ids=2000)
    sizes = packed.groupBy(F.shiftright("sequence_id", 32).alias("t")).agg(F.sum("length").alias("n"))
    sizes = [r.n for r in sizes.collect()]
    assert len(sizes) > 4 and max(sizes) < 4 * sum(sizes) / len(sizes)


def test_packing_keeps_like_documents_together(spark):
    r = random.Random(8)
    kinds = [["alpha", "beta", "gamma"], ["uno", "dos", "tres"], ["eins", "zwei", "drei"]]
    rows = [(i, " ".join(r.choices(kinds[i % 3], k=60))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = hilbert_pack.packed(docs, BYTES).orderBy("sequence_id", "offset").collect()
    kind = [r.doc_id % 3 for r in order if r.start == 0]
    same = sum(a == b for a, b in zip(kind, kind[1:], strict=False))
    assert same > 0.9 * len(kind)


def all_segmentations(lattice, at=0):
    if at == len(lattice.points):
        return [((), 0.0)]
    slot = lattice.slot[at]
    return [
        ((n, *rest), float(lattice.log[slot, n - 1]) + log)
        for n in range(1, lattice.log.shape[1] + 1)
        if lattice.log[slot, n - 1] > -np.inf
        for rest, log in all_segmentations(lattice, at + n)
    ]


def test_samples_follow_the_lattice():
    own, text, n = gumbel.pieces(PIECE), "the 中cat", 12_000
    ways = all_segmentations(gumbel.Lattice([text], own))
    assert abs(sum(math.exp(p) for _, p in ways) - 1) < 1e-5
    lattice = gumbel.Lattice([text] * n, own)
    paths, values, threshold = gumbel.Sampler(lattice, np.arange(n) * 7919, 3).run(2)
    found = [[tuple(x[x > 0]) for x in p.reshape(n, -1)] for p in paths]
    assert all(a != b for a, b in zip(*found, strict=True))
    assert (values[0] > values[1]).all() and (values[1] > threshold).all()
    first, second = (collections.Counter(f) for f in found)
    for way, log in ways:
        p = math.exp(log)
        p2 = sum(math.exp(q) * p / (1 - math.exp(q)) for w, q in ways if w != way)
        assert abs(first[way] / n - p) < 0.02
        assert abs(second[way] / n - p2) < 0.02
    weight = np.zeros(n)
    for path in paths:
        log = gumbel.token_ids(lattice, path)[2]
        weight += np.exp(log - gumbel.log_inclusion(log, threshold))
    assert abs(weight.mean() - 1) < 0.02


def test_units_hold_real_edges_only():
    """A worker's memory of units goes by edges, not by the longest piece of the model."""
    own = gumbel.pieces(PIECE)
    text = "the cat\x07 中"
    lattice = gumbel.Lattice([text, "", text + " sat"], own)
    units = lattice.units
    assert np.isfinite(units.log[: units.edges]).all()
    count = np.diff(units.first[: units.used + 1])
    assert (count == np.isfinite(lattice.log).sum(axis=1)).all()
    last = units.first[1 : units.used + 1][count > 0] - 1
    assert np.allclose(units.running[last], 1, atol=1e-5)
    sampler = gumbel.Sampler(lattice, np.arange(3), 3)
    for path, edges in zip(sampler.run(3)[0], sampler.edges, strict=True):
        for found, again in zip(
            gumbel.token_ids(lattice, path, edges), gumbel.token_ids(lattice, path), strict=True
        ):
            assert (found == again).all()


def test_units_beyond_the_room_start_anew(monkeypatch):
    own = gumbel.Pieces(PIECE, gumbel.ALPHA)
    monkeypatch.setattr(gumbel, "REMEMBERED", 40)
    monkeypatch.setattr(gumbel, "EDGES", 60)
    plenty = gumbel.pieces(PIECE)
    for text in ("the cat sat", "on the mat", "and a long sentence of many other words", "the cat"):
        for few, many in zip(
            gumbel.Sampler(gumbel.Lattice([text], own), np.arange(1), 3).run(2)[0],
            gumbel.Sampler(gumbel.Lattice([text], plenty), np.arange(1), 3).run(2)[0],
            strict=True,
        ):
            assert (few == many).all()


def test_fewer_segmentations_than_samples():
    own = gumbel.pieces(PIECE)
    lattice = gumbel.Lattice(["", "is", "\x07"], own)
    ways = [len(all_segmentations(gumbel.Lattice([t], own))) for t in ("is", "\x07")]
    _, values, threshold = gumbel.Sampler(lattice, np.arange(3), 3).run(9)
    there = (values > -np.inf).sum(axis=0)
    assert there.tolist() == [1, min(9, ways[0]), min(9, ways[1])]
    assert threshold[0] == -np.inf


def test_segmentations_round_trip_and_do_not_depend_on_partitions(docs, collected):
    def digest(frame):
        rows = gumbel.decoded(gumbel.segmentations(frame, PIECE), PIECE, text="decoded").collect()
        return sorted(
            (-1 if r.doc_id is None else r.doc_id, r.sample, bytes(r.ids), r.log_prob, r.decoded)
            for r in rows
        )

    one = digest(docs)
    two = digest(docs.repartition(2, "n_chars"))
    assert [x[:3] for x in one] == [x[:3] for x in two]
    texts = collections.Counter((-1 if k is None else k, (t or "").replace("▁", " ")) for k, t in collected)
    assert collections.Counter((x[0], x[4]) for x in one if x[1] == 1) == texts
    sets = collections.defaultdict(list)
    for key, sample, ids, _, _ in one:
        sets[key].append((sample, ids))
    for pairs in sets.values():
        by_sample = dict(pairs)
        assert len(set(by_sample.values())) == len(by_sample)


def test_empty_tables(empty):
    assert token_count.token_counts(empty, PIECE).collect() == []
    assert gumbel.segmentations(empty, PIECE).collect() == []
    assert hilbert_pack.packed(empty, BYTES).collect() == []


def test_documents_are_encoded_in_small_slices(docs, monkeypatch):
    given = []
    monkeypatch.setattr(
        hilbert_pack, "map_texts", lambda *a: given.append(a[5] if len(a) > 5 else common.SLICE_BYTES)
    )
    hilbert_pack.encoded(docs, "no file")
    assert given == [1 << 20]

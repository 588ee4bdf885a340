"""Language-model scores by prediction by partial matching over bytes.

*Text*: words (A-Z lower-cased) joined by one blank, then an end symbol; so
the model gives the probability of the same event as the word-count base,
the sequence of words and the end.  Bytes 0xFF, which UTF-8 never holds,
stand for the end and fill the context before the first byte.

*Model*: a trie of contexts of up to ``ORDER`` bytes with the counts of the
bytes that follow.  A byte is coded by the longest context seen in training:
a byte seen c times there gets (c - 1/2) / T; otherwise the escape, half the
number of distinct bytes over T, is paid and the next shorter context tries,
*without the bytes that the longer one has excluded*; below the empty
context every byte not yet excluded is equally likely.  Code lengths are
pretrained, from all training texts, and add up per document.

*Distribution*: documents are dealt into blocks of about ``BLOCK_BYTES`` by
a hash.  A block lists its distinct (ORDER + 1)-grams and words with their
training counts, in one packed row per bucket.  An n-gram's bucket is a hash
of the three bytes before its last one, so a bucket holds every context of
three and more bytes it needs; what lies below follows from the counts of
three-byte strings, of which there are at most 2^24 (the only model data that
reach the driver and travel with the tasks).  Per bucket the lists are summed
as they stream by; then the sums meet the lists again and each block's list
goes back to it with code lengths and word counts.  A task holds one block
and its answers, or one bucket of the model; the lists grow with the corpus.

Cases: a null or empty text is the end symbol alone; rows for which
``train_when`` is not true are only scored; with no training rows every byte
costs 1/256; repeated rows train and are scored one by one; an empty table
gives no rows; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm import wordarrays as wa
from tickhouse.llm.common import BINARY, BOOL, DOUBLE, LONG, arrow_type, stored, text_slices

ORDER = 5  # an n-gram and a text's number share 64 bits, so 5 is the most
BLOCK_BYTES = 32 << 20
SLICE = 1 << 20
#: for parallelism: never fewer blocks and buckets than these, however small the table
MIN_BLOCKS, MIN_BUCKETS = 16, 64
#: bytes of the context that name the bucket, and of the strings counted for all
SHARED = 3
END = 0xFF


def joined(lines: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array: ORDER end symbols, text, ORDER end symbols,
    text, ..., end symbols; with the texts' begins and one more for what follows."""
    gap = bytes([END]) * ORDER
    data = np.frombuffer(gap + gap.join(lines) + gap, np.uint8)
    return data, ORDER + np.cumsum([0, *(len(x) + ORDER for x in lines)])


def coded_grams(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The (ORDER + 1)-gram that ends at each symbol to be coded, with the
    number of its text in the low 16 bits, ascending."""
    size = np.diff(begins) - ORDER + 1  # bytes and the end
    ends = np.cumsum(size)
    doc = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(doc)) + np.repeat(begins[:-1] - (ends - size), size)
    code = data[at - ORDER].astype(np.uint64)
    for back in range(ORDER - 1, -1, -1):
        code <<= np.uint64(8)
        code |= data[at - back]
    code <<= np.uint64(16)
    code |= doc.astype(np.uint64)
    code.sort()
    return code


def packed(codes: np.ndarray) -> bytes:
    """Ascending n-gram codes, byte plane by byte plane, compressed."""
    planes = codes.astype("<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.compress(planes.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u8")


def numbers(values: np.ndarray) -> bytes:
    return zstandard.compress(values.astype("<i8").tobytes(), 1)


def longs(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), "<i8")


def summed(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, ascending, with their summed counts."""
    names, where = np.unique(codes, return_inverse=True)
    return names, np.bincount(where, weights=counts, minlength=len(names)).astype(np.int64)


def suffixes(codes: np.ndarray, counts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The last n bytes of the n-grams, distinct, with their summed counts."""
    return summed(codes & np.uint64((1 << 8 * n) - 1), counts)


def gram_buckets(codes: np.ndarray, buckets: int) -> np.ndarray:
    context = (codes >> np.uint64(8)) & np.uint64((1 << 8 * SHARED) - 1)
    return (wa.mix(context + wa.U(1)) % wa.U(buckets)).astype(np.int64)


def word_buckets(words: list[bytes], buckets: int) -> np.ndarray:
    return np.array([zlib.crc32(w) % buckets for w in words], np.int64)


class Part:
    """Some texts of a block: their n-grams and distinct words."""

    def __init__(self, texts: list[bytes | None]):
        lines = [b" ".join((t or b"").lower().split()) for t in texts]
        self.n = len(lines)
        data, begins = joined(lines)
        keys = coded_grams(data, begins)
        grams = keys >> np.uint64(16)
        new = np.append(np.ones(min(len(grams), 1), bool), grams[1:] != grams[:-1])
        self.codes = grams[new]  # distinct n-grams
        self.gram = np.cumsum(new) - 1  # which of them, symbol by symbol
        self.gram_doc = (keys & np.uint64(0xFFFF)).astype(np.int64)
        # words lie between blanks and ends; an empty line has none
        blank = np.flatnonzero(data == 0x20)
        size = np.diff(begins) - ORDER
        full = size > 0
        start = np.sort(np.concatenate([begins[:-1][full], blank + 1]))
        end = np.sort(np.concatenate([(begins[:-1] + size)[full], blank]))
        self.word_doc = np.searchsorted(begins, start, side="right") - 1
        names, at, self.word = np.unique(
            wa.RangeHash(data)(start, end), return_index=True, return_inverse=True
        )
        raw = data.tobytes()
        self.words = [
            raw[s:e] for s, e in zip(start[at].tolist(), end[at].tolist(), strict=True)
        ]
        self.n_words = np.bincount(self.word_doc, minlength=self.n)


def parts_of(rows: pa.Table) -> Iterator[tuple[int, Part]]:
    """The block's texts in slices: number of the first row, and the part."""
    texts = rows["text"].combine_chunks()
    for at, n in text_slices(texts, SLICE, rows=1 << 16):
        yield at, Part(texts.slice(at, n).to_pylist())


def schema_of(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


#: a block's n-grams (ascending) and words (joined by blanks) of a bucket
LIST = schema_of(
    bucket=LONG, block=LONG, codes=BINARY, counts=BINARY, words=BINARY, word_counts=BINARY
)
#: a bucket's part of the model; ``low``: strings of SHARED bytes, to be summed over buckets
MODEL = schema_of(
    bucket=LONG, codes=BINARY, counts=BINARY, words=BINARY, word_counts=BINARY, tokens=LONG,
    kinds=LONG, low_codes=BINARY, low_counts=BINARY,
)
ANSWER = schema_of(block=LONG, codes=BINARY, lengths=BINARY, words=BINARY, word_counts=BINARY)
SCORES = schema_of(held_out=BOOL, n_tokens=LONG, n_known=LONG, base_score=DOUBLE, score=DOUBLE)


def arrow_schema(kinds: T.StructType) -> pa.Schema:
    return pa.schema([(f.name, arrow_type(f.dataType)) for f in kinds.fields])


def listed(
    block: int,
    codes: np.ndarray,
    counts: np.ndarray,
    words: list[bytes],
    word_counts: np.ndarray,
    buckets: int,
) -> pa.Table:
    """Lists of n-grams and words as one row per bucket."""
    rows = []
    of_gram, of_word = gram_buckets(codes, buckets), word_buckets(words, buckets)
    grams, terms = np.argsort(of_gram, kind="stable"), np.argsort(of_word, kind="stable")
    gram_cut = np.searchsorted(of_gram[grams], np.arange(buckets + 1))
    word_cut = np.searchsorted(of_word[terms], np.arange(buckets + 1))
    for b in range(buckets):
        g, w = grams[gram_cut[b] : gram_cut[b + 1]], terms[word_cut[b] : word_cut[b + 1]]
        if len(g) or len(w):
            rows.append(
                {
                    "bucket": b,
                    "block": block,
                    "codes": packed(codes[g]),
                    "counts": numbers(counts[g]),
                    "words": zstandard.compress(b" ".join([words[i] for i in w]), 1),
                    "word_counts": numbers(word_counts[w]),
                }
            )
    return pa.Table.from_pylist(rows, schema=arrow_schema(LIST))


def block_lists(rows: pa.Table, buckets: int) -> pa.Table:
    """The words and n-grams of a block with their counts in its training rows."""
    train = np.array(rows["train"].to_pylist(), bool)
    counted: Counter[bytes] = Counter()
    codes, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    for at, part in parts_of(rows):
        learn = train[at : at + part.n]
        weight = np.bincount(part.word, weights=learn[part.word_doc], minlength=len(part.words))
        counted.update(dict(zip(part.words, weight.astype(np.int64).tolist(), strict=True)))
        weight = np.bincount(part.gram, weights=learn[part.gram_doc], minlength=len(part.codes))
        codes, counts = summed(
            np.concatenate([codes, part.codes]), np.concatenate([counts, weight])
        )
    word_counts = np.array(list(counted.values()), np.int64)
    return listed(rows["block"][0].as_py(), codes, counts, list(counted), word_counts, buckets)


class Sums:
    """A bucket's n-grams and words, summed over the blocks' lists."""

    def __init__(self, bucket: int):
        self.bucket = bucket
        self.codes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.words: Counter[bytes] = Counter()

    def add(self, codes: bytes, counts: bytes, words: bytes, word_counts: bytes) -> None:
        new, n = unpacked(codes), longs(counts)
        learned = n > 0
        self.codes, self.counts = summed(
            np.concatenate([self.codes, new[learned]]), np.concatenate([self.counts, n[learned]])
        )
        names = zstandard.decompress(words).split()
        for name, count in zip(names, longs(word_counts).tolist(), strict=True):
            if count:
                self.words[name] += count

    def row(self) -> pa.RecordBatch:
        totals = np.array(list(self.words.values()), np.int64)
        low, low_counts = suffixes(self.codes, self.counts, SHARED)
        row = {
            "bucket": self.bucket,
            "codes": packed(self.codes),
            "counts": numbers(self.counts),
            "words": zstandard.compress(b" ".join(self.words), 1),
            "word_counts": numbers(totals),
            "tokens": int(totals.sum()),
            "kinds": len(totals),
            "low_codes": packed(low),
            "low_counts": numbers(low_counts),
        }
        return pa.RecordBatch.from_pylist([row], schema=arrow_schema(MODEL))


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Row by row, so that one row's payload is held at a time beside its batch."""
    for batch in batches:
        for i in range(len(batch)):
            yield tuple(column[i].as_py() for column in batch.columns)


def summed_lists(lists: DataFrame) -> DataFrame:
    """One row per bucket: the model's part of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Sums | None = None
        for bucket, *payload in rows_of(batches):
            if now is None or now.bucket != bucket:
                if now is not None:
                    yield now.row()
                now = Sums(bucket)
            now.add(*payload)
        if now is not None:
            yield now.row()

    return (
        lists.repartition("bucket")
        .sortWithinPartitions("bucket")
        .select("bucket", "codes", "counts", "words", "word_counts")
        .mapInArrow(run, MODEL)
    )


def low_counts(model: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all strings of SHARED bytes (at most 2^24), codes ascending."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for codes, counts in rows_of(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(unpacked(codes).astype(np.int64)), pa.array(longs(counts))],
                names=["code", "n"],
            )

    rows = (
        model.select("low_codes", "low_counts")
        .mapInArrow(run, "code long, n long")
        .groupBy("code")
        .agg(F.sum("n").alias("n"))
        .toPandas()
        .sort_values("code")
    )
    return rows["code"].to_numpy().astype(np.uint64), rows["n"].to_numpy().astype(np.int64)


class Trie:
    """Counts of a bucket's strings and totals of its contexts, by length."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, low: tuple[np.ndarray, np.ndarray]):
        grams = {ORDER + 1: (codes, counts), SHARED: low}
        for n in [*range(ORDER, SHARED, -1), *range(SHARED - 1, 0, -1)]:
            grams[n] = suffixes(*grams[n + 1], n)
        self.by_size = {n: {"code": c, "n": k} for n, (c, k) in grams.items()}
        self.by_size[0] = {"code": np.zeros(1, np.uint64), "n": np.zeros(1, np.int64)}
        for n in range(ORDER + 1):
            # of the contexts of n bytes: the followers' total, their number, and the total
            # that the same followers have behind the context without its first byte
            follow, own = grams[n + 1]
            shorter = np.zeros(len(follow), np.int64)
            if n:
                (shorter,) = self.get(n, follow & np.uint64((1 << 8 * n) - 1), "n")
            context, where = np.unique(follow >> np.uint64(8), return_inverse=True)
            facts = {"total": own, "distinct_followers": np.ones(len(follow)), "excluded": shorter}
            table = self.by_size[n]
            codes = np.union1d(table["code"], context)
            new = {"code": codes, "n": np.zeros(len(codes), np.int64)}
            new["n"][np.searchsorted(codes, table["code"])] = table["n"]
            at = np.searchsorted(codes, context)
            for name, weights in facts.items():
                new[name] = np.zeros(len(codes), np.int64)
                new[name][at] = np.bincount(where, weights=weights, minlength=len(context))
            self.by_size[n] = new

    def get(self, n: int, codes: np.ndarray, *names: str) -> list[np.ndarray]:
        table = self.by_size[n]
        known = table["code"]
        if not len(known):
            return [np.zeros(len(codes), np.int64) for _ in names]
        at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
        hit = known[at] == codes
        return [np.where(hit, table[name][at], 0) for name in names]

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each (ORDER+1)-gram after the others."""
        result = np.zeros(len(codes))
        open_ = np.ones(len(codes), bool)  # not yet coded
        longer = np.zeros((2, len(codes)), np.int64)  # excluded total and number of followers
        for k in range(ORDER, -1, -1):
            context = (codes >> np.uint64(8)) & np.uint64((1 << 8 * k) - 1)
            gram = codes & np.uint64((1 << 8 * (k + 1)) - 1)
            total, followers, out = self.get(k, context, "total", "distinct_followers", "excluded")
            (count,) = self.get(k + 1, gram, "n")
            left, kinds = total - longer[0], followers - longer[1]
            hit = open_ & (count > 0)
            escape = open_ & ~hit & (left > 0)
            result[hit] += np.log10((count[hit] - 0.5) / left[hit])
            result[escape] += np.log10(0.5 * kinds[escape] / left[escape])
            open_ &= ~hit
            longer = np.stack([out, followers])
        rest = 256 - longer[1]
        result[open_] -= np.log10(rest[open_])
        return result


def answered(lists: DataFrame, model: DataFrame, low: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Each block's lists with code lengths and counts of the whole corpus."""
    none = F.lit(None)
    asked = lists.select(
        "bucket", "block", "codes", none.cast("binary").alias("counts"), "words",
        none.cast("binary").alias("word_counts"),
    )
    known = model.select(
        "bucket", none.cast("long").alias("block"), "codes", "counts", "words", "word_counts"
    )
    both = (
        known.unionByName(asked)
        .repartition("bucket")
        .sortWithinPartitions("bucket", F.col("block").asc_nulls_first())  # the sums come first
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie: Trie | None = None
        counts: dict[bytes, int] = {}
        for _, block, codes, n, words, total in rows_of(batches):
            names = zstandard.decompress(words).split()
            if block is None:
                trie = Trie(unpacked(codes), longs(n), low)
                counts = dict(zip(names, longs(total).tolist(), strict=True))
                continue
            own = np.array([counts.get(w, 0) for w in names], np.int64)
            row = {
                "block": block,
                "codes": codes,
                "lengths": trie.log10(unpacked(codes)).astype("<f8").tobytes(),
                "words": words,
                "word_counts": numbers(own),
            }
            yield pa.RecordBatch.from_pylist([row], schema=arrow_schema(ANSWER))

    return both.mapInArrow(run, ANSWER)


def block_scores(rows: pa.Table, answers: pa.Table, tokens: int, kinds: int, ends: int) -> pa.Table:
    """The scores of a block's rows; ``ends``: how often the end was learned."""
    codes = np.concatenate([unpacked(x.as_py()) for x in answers["codes"]])
    lengths = np.concatenate([np.frombuffer(x.as_py(), "<f8") for x in answers["lengths"]])
    order = np.argsort(codes)
    codes, lengths = codes[order], lengths[order]
    counts: dict[bytes, int] = {}
    for words, own in zip(answers["words"], answers["word_counts"], strict=True):
        names = zstandard.decompress(words.as_py()).split()
        counts.update(zip(names, longs(own.as_py()).tolist(), strict=True))

    def share(c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (tokens + 0.5 * (kinds + 1)))

    columns: dict[str, list[np.ndarray]] = {f.name: [] for f in SCORES.fields[1:]}
    for _, part in parts_of(rows):
        n = part.n
        own = np.array([counts[w] for w in part.words], np.int64)
        known = np.bincount(part.word_doc, weights=(own > 0)[part.word], minlength=n)
        base = np.bincount(part.word_doc, weights=share(own)[part.word], minlength=n)
        columns["n_tokens"].append(part.n_words + 1)
        columns["n_known"].append(known.astype(np.int64) + (ends > 0))
        columns["base_score"].append(base + share(np.array(ends)))
        per_gram = lengths[np.searchsorted(codes, part.codes)]
        columns["score"].append(
            np.bincount(part.gram_doc, weights=per_gram[part.gram], minlength=n)
        )
    return pa.table(
        {
            "key": rows["key"],
            "held_out": pa.array([not t for t in rows["train"].to_pylist()]),
            **{name: pa.array(np.concatenate(values)) for name, values in columns.items()},
        }
    )


def model_scores(
    docs: DataFrame,
    train_when: Column,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = docs.select(
        F.col(key).alias("key"),
        F.col(text).cast("binary").alias("text"),
        F.coalesce(train_when, F.lit(False)).alias("train"),
    )
    size, ends = rows.agg(F.sum(F.octet_length("text")), F.count_if("train")).first()
    blocks = max(MIN_BLOCKS, -(-(size or 0) // block_bytes))
    buckets = max(MIN_BUCKETS, min(4 * blocks, 4096))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))

    def lists_of(block: pa.Table) -> pa.Table:
        return block_lists(block, buckets)

    lists = stored(dealt.groupBy("block").applyInArrow(lists_of, LIST), "lists")
    model = stored(summed_lists(lists), "model")
    tokens, kinds = model.agg(F.sum("tokens"), F.sum("kinds")).first()
    tokens, kinds = (tokens or 0) + ends, (kinds or 0) + (ends > 0)
    answers = answered(lists, model, low_counts(model))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), *SCORES.fields])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return block_scores(left, right, tokens, kinds, ends)

    return (
        dealt.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(score, schema)
        .select(
            F.col("key").alias(key),
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )

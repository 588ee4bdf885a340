"""Quality classifier: naive Bayes support vectors.

*Features* are indicators of hashed n-grams (``DIM`` slots): word unigrams
and bigrams, and uni-, bi- and trigrams of word shapes (letter case, digits,
symbols, length class, equal to the word before).  Each text's indicators are
divided by the root of their number, so long texts count like short ones.

*Ratios*: the log-count ratio of each slot between label 1 and label 0, from
all labelled training rows (a distributed count; ``DIM`` slots at most reach
the driver).

*Support vectors*: indicators scaled by the ratios, hinge loss, fitted by
dual coordinate descent on a bounded sample of labelled training rows
(``SAMPLE`` rows and ``SAMPLE_BYTES`` of text at most, chosen by a hash of key
and text; classes weighted to balance).
A fifth of the sample is held back to turn margins into probabilities by a
logistic fit.

*Scoring* is row-local: ``DIM`` weights travel with the tasks.

Cases: a null or empty text has no features and gets the score of the bias
alone; rows without a label or with a null label are not learned from; of
several labels of one key the lowest counts; without labels every score is
0.5, with one class only the smoothed share of it; repeated rows are learned
from and scored one by one; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickhouse.llm import wordarrays as wa
from tickhouse.llm.common import DOUBLE, buffer_of, fields, map_texts, stored, text_slices

DIM = 1 << 18
SAMPLE, SAMPLE_BYTES = 8192, 64 << 20
THRESHOLD = 0.7
ALPHA = 1.0
COST = 1.0
#: Bytes of text whose indicators are made at once: a worker takes some 80 bytes of memory for each.
SLICE = 1 << 20
EPOCHS = 12
SEED = 7

LOWER, UPPER, DIGIT, SYMBOL, HIGH = range(5)
CLASS = np.full(256, SYMBOL, np.uint8)
CLASS[ord("a") : ord("z") + 1] = LOWER
CLASS[ord("A") : ord("Z") + 1] = UPPER
CLASS[ord("0") : ord("9") + 1] = DIGIT
CLASS[128:] = HIGH


def shapes(data: np.ndarray, words: wa.Words, values: np.ndarray) -> np.ndarray:
    """A small number per word: what it looks like, not what it says."""
    kind = CLASS[data]

    def count(which: int) -> np.ndarray:
        total = np.zeros(len(data) + 1, np.int64)
        np.cumsum(kind == which, out=total[1:])
        return total[words.end] - total[words.start]

    length = words.end - words.start
    symbols = np.minimum(count(SYMBOL), 3)
    upper = count(UPPER)
    shout = np.where(upper == 0, 0, np.where(upper == length - symbols, 2, 1))
    again = np.zeros(len(length), np.int64)
    again[1:] = (values[1:] == values[:-1]) & (words.doc[1:] == words.doc[:-1])
    parts = [
        (kind[words.start], 5),
        (kind[words.end - 1], 5),
        (symbols, 4),
        (shout, 3),
        (np.searchsorted([2, 4, 8, 16, 32], length, side="right"), 6),
        ((count(DIGIT) > 0), 2),
        (again, 2),
    ]
    code = np.zeros(len(length), np.int64)
    for value, size in parts:
        code = code * size + value
    return code


def indicators(column: pa.Array, dim: int = DIM) -> tuple[np.ndarray, np.ndarray, int]:
    """(text number, slot) pairs, ascending and distinct, and the number of texts."""
    data, offsets = buffer_of(column)
    n = len(offsets) - 1
    words = wa.words_of(data, offsets)
    values = wa.RangeHash(data)(words.start, words.end)
    shape = wa.mix(shapes(data, words, values).astype(wa.U) + wa.U(1 << 40))
    found = []
    for number, (stream, longest) in enumerate(((values, 2), (shape, 3))):
        for size in range(1, longest + 1):
            keys, at = wa.windows(stream, words.doc, size)
            slot = wa.mix(keys + wa.U(1 + number * 8 + size)) % wa.U(dim)
            found.append(words.doc[at] * dim + slot.astype(np.int64))
    pairs = np.concatenate(found)
    pairs.sort()
    pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
    return pairs // dim, pairs % dim, n


class Model(NamedTuple):
    weights: np.ndarray  # of each slot, ratio included
    bias: float
    slope: float  # from margin to log odds
    offset: float

    def margins(self, column: pa.Array) -> np.ndarray:
        doc, slot, n = indicators(column, len(self.weights))
        number = np.bincount(doc, minlength=n)
        total = np.bincount(doc, weights=self.weights[slot], minlength=n)
        return total / np.sqrt(np.maximum(number, 1)) + self.bias

    def probabilities(self, column: pa.Array) -> np.ndarray:
        odds = self.slope * self.margins(column) + self.offset
        return 1.0 / (1.0 + np.exp(-np.clip(odds, -40, 40)))


def descend(
    rows: list[np.ndarray],
    values: Sequence[np.ndarray],
    sign: np.ndarray,
    cost: np.ndarray,
    dim: int,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> np.ndarray:
    """Hinge-loss weights (the last one is the bias) by dual coordinate descent."""
    weights = np.zeros(dim + 1)
    dual = np.zeros(len(rows))
    norm = np.array([values[i] @ values[i] + 1.0 for i in range(len(rows))])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            value = values[i]
            margin = sign[i] * (weights[rows[i]] @ value + weights[dim])
            new = min(max(dual[i] - (margin - 1.0) / norm[i], 0.0), cost[i])
            step = (new - dual[i]) * sign[i]
            if step:
                weights[rows[i]] += step * value
                weights[dim] += step
                dual[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return weights


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of log odds over margins (Newton, lightly regularised)."""
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    beta = np.array([1.0, 0.0])
    prior = np.array([1e-2, 1e-4])
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (p - label) + prior * beta
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag(prior)
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        beta -= step * min(1.0, 5.0 / max(size, 1e-9))
        if size < 1e-8:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def slot_counts(train: DataFrame, dim: int) -> np.ndarray:
    """Rows of each label that show each slot; slot ``dim`` counts all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, dim + 1), np.int64)
        for batch in batches:
            texts, labels = batch.column(0), batch.column(1).to_numpy()
            for at, n in text_slices(texts, SLICE):
                doc, slot, _ = indicators(texts.slice(at, n), dim)
                own = labels[at : at + n]
                for label in (0, 1):
                    counts[label, :dim] += np.bincount(slot[own[doc] == label], minlength=dim)
                    counts[label, dim] += (own == label).sum()
        slots = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(slots), pa.array(counts[0, slots]), pa.array(counts[1, slots])],
            names=["slot", "zeros", "ones"],
        )

    found = (
        train.select("text", "label")
        .mapInArrow(run, "slot long, zeros long, ones long")
        .groupBy("slot")
        .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
        .toPandas()
    )
    counts = np.zeros((2, dim + 1), np.int64)
    counts[0, found["slot"]] = found["zeros"]
    counts[1, found["slot"]] = found["ones"]
    return counts


class Sample(NamedTuple):
    """The slots of all sampled rows end to end; row i has [first[i], first[i + 1])."""

    slots: np.ndarray
    first: np.ndarray
    label: np.ndarray

    def row(self, i: int) -> np.ndarray:
        return self.slots[self.first[i] : self.first[i + 1]]


def sampled(train: DataFrame, share: float, dim: int, limit: int, limit_bytes: int) -> Sample:
    """About ``share`` of the rows, at most ``limit`` of them and ``limit_bytes`` of text.

    Rows are chosen in the order of their hash of key and text.  Of ``n``
    equal rows ``n * share`` are taken, rounded up or down by the hash, so
    repeats keep their part of the sample; each distinct row is collected once.
    """
    place = F.pmod("row", F.lit(1 << 40)) / F.lit(float(1 << 40))
    in_order = Window.orderBy("row", "label").rowsBetween(Window.unboundedPreceding, 0)
    chosen = (
        train.groupBy("row", "label")
        .agg(F.count("*").alias("copies"), F.max(F.octet_length("text")).alias("bytes"))
        .select(
            "row",
            "label",
            F.floor(F.col("copies") * F.lit(min(share, 1.0)) + place).alias("take"),
            "bytes",
        )
        .where("take >= 1")
        .orderBy("row", "label")
        .limit(limit)
        # a window over ``limit`` rows of four numbers
        .withColumn("held", F.sum("bytes").over(in_order))
        .where(F.col("held") <= F.lit(limit_bytes))
        .select("row", "label", "take")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for at, n in text_slices(texts, SLICE):
                doc, slot, _ = indicators(texts.slice(at, n), dim)
                cut = np.searchsorted(doc, np.arange(1, n))
                parts = [p.astype("<u4").tobytes() for p in np.split(slot, cut)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(parts, pa.binary()), *[batch.column(i).slice(at, n) for i in (1, 2, 3)]],
                    names=["slots", "label", "row", "take"],
                )

    rows = (
        # ``limit`` rows of three numbers at most
        train.join(F.broadcast(chosen), ["row", "label"])
        .groupBy("row", "label", "take")
        .agg(F.min("text").alias("text"))
        .select("text", "label", "row", "take")
        .mapInArrow(run, "slots binary, label int, row long, take long")
        .toArrow()
        .sort_by([("row", "ascending"), ("label", "ascending")])
    )
    names, labels, takes = (rows[c].to_numpy() for c in ("row", "label", "take"))
    # the repeats are dealt among the others
    order = sorted(
        (zlib.crc32(b"%d %d" % (name, nth)), i, nth)
        for i, (name, take) in enumerate(zip(names.tolist(), takes.tolist(), strict=True))
        for nth in range(min(take, limit))
    )[:limit]
    chosen_rows = np.array([i for _, i, _ in order], np.int64)
    column = rows["slots"].combine_chunks()
    sizes = np.array([len(column[i].as_buffer()) // 4 for i in chosen_rows.tolist()], np.int64)
    ends = np.append(0, np.cumsum(sizes))
    slots = np.empty(int(ends[-1]), np.uint32)  # one array: its memory goes back as a whole
    for at, i in enumerate(chosen_rows.tolist()):
        slots[ends[at] : ends[at + 1]] = np.frombuffer(column[i].as_buffer(), "<u4")
    return Sample(slots, ends, labels[chosen_rows].astype(np.int64))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_when: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    dim: int = DIM,
    sample: int = SAMPLE,
    sample_bytes: int = SAMPLE_BYTES,
    cost: float = COST,
) -> Model:
    """Learn from the labelled rows for which ``train_when`` (on the key) holds."""
    named = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .where("label in (0, 1)")
        .groupBy("key")
        .agg(F.min("label").alias("label"))
    )
    train = stored(
        docs.where(train_when)
        .select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
        # by a shuffle at every size: labels grow with the corpus
        .join(named.hint("merge"), "key")
        .select(
            "text",
            "label",
            F.xxhash64("key", "text").alias("row"),
        ),
        "labelled",
    )
    counts = slot_counts(train, dim)
    zeros, ones = counts[:, dim]
    if not zeros or not ones:
        share = (ones + 1.0) / (zeros + ones + 2.0)
        return Model(np.zeros(dim), 0.0, 0.0, float(np.log(share / (1 - share))))
    ratio = np.log((counts[1, :dim] + ALPHA) / (ones + 2 * ALPHA)) - np.log(
        (counts[0, :dim] + ALPHA) / (zeros + 2 * ALPHA)
    )
    chosen = sampled(train, sample / float(zeros + ones), dim, sample, sample_bytes)
    rows = [chosen.row(i) for i in range(len(chosen.label))]
    return fit_sample(rows, chosen.label, ratio, cost)


class _Scaled(Sequence):
    """The values of each row's slots, made when they are needed."""

    def __init__(self, rows: list[np.ndarray], ratio: np.ndarray):
        self.rows, self.ratio = rows, ratio

    def __len__(self) -> int:
        return len(self.rows)

    def __getitem__(self, i: int) -> np.ndarray:
        return self.ratio[self.rows[i]] / np.sqrt(max(len(self.rows[i]), 1))


def fit_sample(slots: list[np.ndarray], label: np.ndarray, ratio: np.ndarray, cost: float) -> Model:
    dim = len(ratio)
    values = _Scaled(slots, ratio)
    back = np.arange(len(slots)) % 5 == 4
    if len(set(label[~back])) < 2 or len(set(label[back])) < 2:
        back = np.zeros(len(slots), bool)  # too few rows to hold any back
    use = np.flatnonzero(~back)
    ones = max(int(label[use].sum()), 1)
    zeros = max(len(use) - ones, 1)
    costs = np.where(label[use] == 1, cost * len(use) / (2 * ones), cost * len(use) / (2 * zeros))
    used = [slots[i] for i in use]
    weights = descend(used, _Scaled(used, ratio), 2.0 * label[use] - 1, costs, dim)
    rest = np.flatnonzero(back) if back.any() else use
    margin = np.array([weights[slots[i]] @ values[i] + weights[dim] for i in rest])
    slope, offset = logistic(margin, label[rest].astype(float))
    return Model((weights[:dim] * ratio).astype(np.float32), float(weights[dim]), slope, offset)


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key and ``score`` (probability of label 1)."""
    return map_texts(
        docs, lambda c: {"score": model.probabilities(c)}, fields(score=DOUBLE), key, text, SLICE
    )


def accepted(text: Column, model: Model, threshold: float = THRESHOLD) -> Column:
    """Whether a text's score reaches ``threshold``; for filtering whole rows."""

    @F.arrow_udf("boolean")
    def run(texts: pa.Array) -> pa.Array:
        parts = [
            model.probabilities(texts.slice(at, n)) >= threshold
            for at, n in text_slices(texts, SLICE)
        ]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))

    return run(text)

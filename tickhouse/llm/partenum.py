"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct shingles of ``SHINGLE`` words (as 64-bit
hashes).  Two documents link when ``100 * intersection >= PERCENT * union``.

1. Equal sets form a *class* (two 64-bit sums over the set; should the first
   ever fail to tell two sets apart, the second shows it and all is done with
   another seed).  Only classes are compared.
2. Sizes fall into bands such that a set can only link with sets of its own
   band and the next or previous one.  Each set takes part in two instances:
   its own band's and the next band's, so any two that can link share one,
   and in it differ in at most k features, k following from the band's end.
3. In an instance the feature domain is cut into n1 partitions and each of
   those into ``PARTS``.  Of two sets that differ in at most k features, at
   most k // ``PARTS - 1`` partitions hold ``SKIP + 1`` differences or more;
   in any other one, some ``PARTS - SKIP`` of its parts agree wholly.  Every
   such choice of parts gives one signature: a hash of the features in them.
   A choice without features says nothing and is left out, which is safe
   where enough partitions of a set are filled; the few sets where it is not
   send their empty choices too, and so meet each other.
4. Classes under one signature make a group; groups of the same classes are
   kept once.  *First round*: every member is compared with one leader of its
   group, and links merge classes.  Groups that lie in one component are
   done.  *Second round*: in cells of bounded size, members of different
   components are compared by parity sketches whose distance never exceeds the
   sets' true difference.  The members with a partner that the sketches allow
   get their sets, and their cell compares these, closest sketches first, and
   returns a spanning forest of the links: pairs that earlier links have
   joined need no look, and a cell never returns more rows than it has members.

Verification is always by the sets themselves; sketches only rule out pairs
that cannot link.  No group is held by one task beyond a cell, copies are
never paired, and a signature shared by very many documents costs each of
them one row.

Cases: a null or empty text, or one without words, has no set and is its own
component; fewer words than a shingle make one shingle of the whole sequence;
repeated rows share their component; a null key never names a component
unless no other key is in it; an empty table gives no rows; further columns
are not read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickhouse.llm.common import BINARY, LONG, buffer_of, fields, map_texts, stored, text_slices
from tickhouse.llm.pivot_simhash import components
from tickhouse.llm.wordarrays import RangeHash, U, mix, per_doc, windows, words_of

SHINGLE, PERCENT = 4, 85
PARTS, SKIP = 3, 1
#: Signatures that clash make a group of classes that need not be similar, which costs a
#: comparison and changes no result.
SIGNATURE_BITS = 48
#: Bits of a sketch for each difference allowed.
FINE = 16
#: Rounds in which each group is compared with a leader.
STARS = 1
#: Bytes of text whose sets are made at once: a worker takes some 60 bytes of memory for each.
SLICE = 1 << 20
#: Members of a block in the last round, and features of their sets; a cell holds two blocks.
CELL, CELL_FEATURES = 2048, 1 << 21


# --- sets --------------------------------------------------------------------


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending; text i has [first[i], first[i + 1])."""
    n = len(offsets) - 1
    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    words = words_of(data, offsets)
    if not len(words.start):
        return np.zeros(0, U), np.zeros(n + 1, np.int64)
    hashes = RangeHash(data)(words.start, words.end)
    count = np.diff(words.first)
    found, docs = [], []
    for size in range(1, shingle + 1):
        whole = count >= shingle if size == shingle else count == size
        pick = whole[words.doc]
        if pick.any():
            doc = words.doc[pick]
            value, at = windows(hashes[pick], doc, size)
            found.append(value)
            docs.append(doc[at])
    value, doc = np.concatenate(found), np.concatenate(docs)
    order = np.lexsort((value, doc))
    value, doc = value[order], doc[order]
    new = np.append(True, (value[1:] != value[:-1]) | (doc[1:] != doc[:-1]))
    value, doc = value[new], doc[new]
    return value, np.append(0, np.cumsum(per_doc(doc, n)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum modulo 2^64 of each text's values."""
    total = np.append(U(0), np.cumsum(values, dtype=U))
    return total[first[1:]] - total[first[:-1]]


def set_names(values: np.ndarray, first: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of each set; empty sets have the names (0, 0)."""
    a = mix(_sums(mix(values ^ mix(np.array([2 * seed + 1], U))), first))
    b = mix(_sums(mix(values ^ mix(np.array([2 * seed + 2], U))), first))
    filled = np.diff(first) > 0
    return np.where(filled, a, U(0)), np.where(filled, b, U(0))


# --- bands and signatures -----------------------------------------------------


class Bands:
    """Size bands; a set links only with its own and neighbouring bands."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.ends = [0]

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """Number of the band of each size, from 1."""
        self.reach(int(sizes.max(initial=1)))
        return np.searchsorted(np.array(self.ends), sizes)

    def reach(self, size: int) -> None:
        while self.ends[-1] < size:
            self.ends.append((self.ends[-1] + 1) * 100 // self.percent)

    def difference(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The most features in which linked sets of these sizes differ."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def threshold(self, band: np.ndarray) -> np.ndarray:
        """The most features in which linked sets of an instance differ."""
        while len(self.ends) <= int(band.max(initial=0)):
            self.reach(self.ends[-1] + 1)
        end = np.array(self.ends)[band]
        return self.difference(end, end)


def partitions(k: np.ndarray) -> np.ndarray:
    """First-level partitions of an instance with threshold k: one more than can be spoiled, and
    a spare one, as single partitions may lack features."""
    return k // (SKIP + 1) + 2


def signatures(
    values: np.ndarray, first: np.ndarray, instance: np.ndarray, k: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of each set in its instance with threshold k > 0."""
    n1 = partitions(k)
    doc = np.repeat(np.arange(len(k)), np.diff(first))
    spread = mix(values ^ U(0x5DEECE66D))
    part = ((spread >> U(32)) * n1[doc].astype(U) >> U(32)).astype(np.int64)
    piece = ((spread & U(0xFFFFFFFF)) * U(PARTS) >> U(32)).astype(np.int64)
    begin = np.append(0, np.cumsum(n1))
    cell = (begin[doc] + part) * PARTS + piece
    held = np.bincount(cell, minlength=int(begin[-1]) * PARTS).reshape(-1, PARTS) > 0
    total = np.zeros(int(begin[-1]) * PARTS, U)
    np.add.at(total, cell, mix(values ^ U(0xB5026F5AA)))
    total = total.reshape(-1, PARTS)
    owner = np.repeat(np.arange(len(k)), n1)
    number = np.arange(len(owner)) - begin[owner]
    # every choice of PARTS - SKIP parts has a feature
    solid = held.sum(axis=1) > SKIP
    thin = per_doc(owner[solid], len(k)) <= k // (SKIP + 1)
    names = mix(
        mix(instance[owner].astype(U) * U(0x2545F4914F6CDD1D) + number.astype(U)) + U(PARTS)
    )
    owners, found = [], []
    for choice, left_out in enumerate(itertools.combinations(range(PARTS), SKIP)):
        rest = [p for p in range(PARTS) if p not in left_out]
        some = held[:, rest].any(axis=1) | thin[owner]
        sums = total[:, rest].sum(axis=1, dtype=U)
        owners.append(owner[some])
        found.append(mix(sums[some] ^ mix(names[some] + U(choice))))
    return np.concatenate(owners), np.concatenate(found)


def set_signatures(
    values: np.ndarray, first: np.ndarray, bands: Bands
) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of all sets in both their instances."""
    sizes = np.diff(first)
    owners, found = [], []
    for step in (0, 1):
        instance = bands.of(sizes) + step
        k = bands.threshold(instance)
        use = np.flatnonzero((sizes > 0) & (k > 0))  # with k = 0 only equal sets link
        if not len(use):
            continue
        picked = np.concatenate([values[first[i] : first[i + 1]] for i in use.tolist()])
        edges = np.append(0, np.cumsum(sizes[use]))
        owner, signature = signatures(picked, edges, instance[use], k[use])
        owners.append(use[owner])
        found.append(signature)
    if not owners:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(owners), np.concatenate(found)


# --- passes over the texts --------------------------------------------------------


def prints(docs: DataFrame, seed: int, key: str, text: str, shingle: int) -> DataFrame:
    """(key, cls, cls2, size): names and sizes of all sets."""

    def work(column: pa.Array) -> dict[str, object]:
        values, first = shingle_sets(*buffer_of(column), shingle)
        a, b = set_names(values, first, seed)
        return {"cls": a.view(np.int64), "cls2": b.view(np.int64), "size": np.diff(first)}

    return map_texts(docs, work, fields(cls=LONG, cls2=LONG, size=LONG), key, text, SLICE)


def signature_rows(docs: DataFrame, seed: int, text: str, shingle: int, percent: int) -> DataFrame:
    """(sig, cls): signatures of all sets, of equal ones once for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        done: set[int] = set()
        for batch in batches:
            for at, n in text_slices(batch.column(0), SLICE):
                values, first = shingle_sets(*buffer_of(batch.column(0).slice(at, n)), shingle)
                names = set_names(values, first, seed)[0].view(np.int64)
                fresh = []
                for i, name in enumerate(names.tolist()):
                    if name not in done and first[i + 1] > first[i]:
                        done.add(name)
                        fresh.append(i)
                if not fresh:
                    continue
                sizes = np.diff(first)[fresh]
                values = np.concatenate([values[first[i] : first[i + 1]] for i in fresh])
                owner, sig = set_signatures(values, np.append(0, np.cumsum(sizes)), bands)
                # rows of a class together, and names of fewer bytes: both shrink the shuffle
                order = np.argsort(owner, kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names[fresh][owner[order]]),
                        pa.array((sig[order] >> U(64 - SIGNATURE_BITS)).view(np.int64)),
                    ],
                    names=["cls", "sig"],
                )

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(
        run, fields(cls=LONG, sig=LONG)
    )


def shared(rows: DataFrame) -> DataFrame:
    """The (sig, cls) rows of signatures that two or more classes have."""
    dealt = rows.repartition("sig").sortWithinPartitions("sig", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the last row of a batch waits until it is known whether the next shares its signature
        sig, cls, shares = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in batches:
            if not len(batch):
                continue
            sig = np.append(sig, batch.column("sig").to_numpy())
            cls = np.append(cls, batch.column("cls").to_numpy())
            new = np.append(True, (sig[1:] != sig[:-1]) | (cls[1:] != cls[:-1]))
            sig, cls = sig[new], cls[new]
            same = sig[1:] == sig[:-1]
            keep = np.append(shares, same)
            keep[:-1] |= same
            shares = bool(keep[-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(sig[:-1][keep[:-1]]), pa.array(cls[:-1][keep[:-1]])],
                names=["sig", "cls"],
            )
            sig, cls = sig[-1:], cls[-1:]
        if shares:
            yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(cls)], names=["sig", "cls"])

    return dealt.mapInArrow(run, fields(sig=LONG, cls=LONG))


def distinct_groups(rows: DataFrame) -> DataFrame:
    """One signature of each distinct list of classes."""
    lists = rows.groupBy("sig").agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("cls")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(1), "cls")).alias("b"),
    )
    chosen = lists.groupBy("n", "a", "b").agg(F.min("sig").alias("sig"))
    return rows.join(chosen.select("sig", "n"), "sig")


# --- sketches and verification ------------------------------------------------------


def sketch_bits(size: int, bands: Bands, each: int) -> int:
    """Bits of a set's sketch: a power of two, at least ``each`` for a difference allowed."""
    k = int(bands.difference(np.array(size), np.array(size)))
    return 64 << (each * k // 64).bit_length()


def sketch(values: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the number of features on each of ``bits`` places, as 64-bit words.

    Differing places are never more than differing features; halves of a
    sketch combined by exclusive or are the sketch of half the bits.
    """
    place = (mix(values ^ U(0x9E6C63D0A)) & U(bits - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(words: np.ndarray, length: int) -> np.ndarray:
    while words.shape[-1] > length:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def _needed_sets(
    docs: DataFrame, named: DataFrame, needed: DataFrame, seed: int, key: str, text: str, shingle: int, percent: int
) -> DataFrame:
    """(cls, size, sketch, shingles) of the needed classes, read again from one document each."""
    one = named.join(needed, "cls").groupBy("cls").agg(F.min("key").alias("least")).select("least")
    # stored, so that Spark knows its size before it plans: texts are shuffled only beyond the
    # size it broadcasts
    one = stored(one.distinct(), "needed-keys")
    source = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    texts = source.join(one, F.col("key").eqNullSafe(F.col("least")), "semi").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        for batch in batches:
            for at, n in text_slices(batch.column(0), SLICE):
                values, first = shingle_sets(*buffer_of(batch.column(0).slice(at, n)), shingle)
                names = set_names(values, first, seed)[0].view(np.int64)
                sets = [values[s:e] for s, e in itertools.pairwise(first.tolist())]
                sizes = np.diff(first)
                fine = [
                    sketch(v, sketch_bits(s, bands, FINE))
                    for v, s in zip(sets, sizes.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(names),
                        pa.array(sizes),
                        *[
                            pa.array([v.tobytes() for v in each], pa.binary())
                            for each in (fine, sets)
                        ],
                    ],
                    names=["cls", "size", "sketch", "shingles"],
                )

    sets = texts.mapInArrow(run, fields(cls=LONG, size=LONG, sketch=BINARY, shingles=BINARY))
    # rows that share a key bring further sets along, which harms nothing
    return sets.where("size > 0").dropDuplicates(["cls"])


EDGES = fields(u=LONG, v=LONG)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets link."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def verified(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) that link: sketches first, then the sets."""

    def filtered(rows: DataFrame, sets: DataFrame, column: str, check) -> DataFrame:
        for side in ("u", "v"):
            rows = rows.join(
                sets.select(
                    F.col("cls").alias(side),
                    F.col("size").alias(f"size_{side}"),
                    F.col(column).alias(f"data_{side}"),
                ),
                side,
            )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                a, b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
                left, right = batch.column(4), batch.column(5)
                keep = [
                    check(
                        m, n, np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                    )
                    for m, n, x, y in zip(a, b, left, right, strict=True)
                ]
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

        return rows.select("u", "v", "size_u", "size_v", "data_u", "data_v").mapInArrow(run, EDGES)

    def possible(m: int, n: int, x: np.ndarray, y: np.ndarray) -> bool:
        if 100 * min(m, n) < percent * max(m, n):
            return False
        length = min(len(x), len(y))
        apart = np.bitwise_count(folded(x, length) ^ folded(y, length)).sum()
        return int(apart) <= (m + n) * (100 - percent) // (100 + percent)

    def links(m: int, n: int, x: np.ndarray, y: np.ndarray) -> bool:
        return linked(x, y, percent)

    left = stored(filtered(edges, sets, "sketch", possible), "possible-links")
    # only the sets of these pairs travel; Spark broadcasts the list of them where it is small
    named = stored(
        left.select(F.explode(F.array("u", "v")).alias("cls")).distinct(), "possible-classes"
    )
    few = stored(sets.select("cls", "size", "shingles").join(named, "cls", "semi"), "possible-sets")
    return filtered(left, few, "shingles", links)


# --- rounds ------------------------------------------------------------------------


def _labels(classes: DataFrame, edges: DataFrame) -> DataFrame:
    """(cls, label): the smallest class each class reaches."""
    roots = components(edges).withColumnRenamed("u", "cls")
    return classes.join(roots, "cls", "left").select(
        "cls", "size", F.coalesce("root", "cls").alias("label")
    )


def _open_groups(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """(sig, cls, n, total, label, leads) of the groups in more than one component.

    The leader of a group is its member of the smallest hash.
    """
    order = F.xxhash64("cls")  # of one long: a bijection, so leaders are unique
    labelled = groups.join(labels, "cls")
    open_ = (
        labelled.groupBy("sig")
        .agg(
            F.min(order).alias("first"),
            F.min("label").alias("a"),
            F.max("label").alias("b"),
            F.sum("size").alias("total"),
        )
        .where("a != b")
    )
    return labelled.join(open_.select("sig", "first", "total"), "sig").select(
        "sig", "cls", "n", "total", "label", (order == F.col("first")).alias("leads")
    )


def _stars(marked: DataFrame) -> DataFrame:
    """The members of other components than their group's leader's, with it, once."""
    leads = marked.where("leads").select("sig", F.col("cls").alias("u"), F.col("label").alias("l"))
    return (
        marked.where("not leads")
        .select("sig", F.col("cls").alias("v"), "label")
        .join(leads, "sig")
        .where("label != l")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        .distinct()
    )


def _cells(marked: DataFrame, cell: int = CELL) -> DataFrame:
    """(sig, low, high, cls, label): open groups in cells of two blocks of members.

    A group of up to ``cell`` members and ``CELL_FEATURES`` features is one
    cell; of a larger one any two blocks of its members meet in one cell.
    """
    blocks = F.greatest(
        F.ceil(F.col("n") / F.lit(cell)), F.ceil(F.col("total") / F.lit(CELL_FEATURES))
    )
    rows = marked.withColumn("blocks", blocks.cast("long"))
    block = F.pmod(F.xxhash64(F.lit(7), "cls"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return rows.withColumn("block", block).withColumn("other", other).select(
        "sig",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "cls",
        "label",
    )


CELL_KEYS = ["sig", "low", "high"]
MEMBERS = fields(sig=LONG, low=LONG, high=LONG, cls=LONG, label=LONG)


def _possible(
    label: np.ndarray, size: np.ndarray, words: list[np.ndarray], percent: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Each member and its later partners that sketches allow, the closest first.

    Sizes ascend.  ``label`` may change meanwhile: equal ones are passed over.
    """
    lengths = np.array([len(w) for w in words])  # ascend with the sizes
    for length in np.unique(lengths):  # pairs whose shorter sketch has this length
        at = np.flatnonzero(lengths >= length)
        table = np.stack([folded(words[i], int(length)) for i in at.tolist()])
        for j in np.flatnonzero(lengths == length).tolist():
            # rows of the table are members from at[0] on; sizes in reach are the next ones
            end = int(np.searchsorted(size, int(size[j]) * 100 // percent, side="right"))
            rest = j + 1 + np.flatnonzero(label[j + 1 : end] != label[j])
            if not len(rest):
                continue
            most = (size[j] + size[rest]) * (100 - percent) // (100 + percent)
            apart = np.bitwise_count(table[rest - at[0]] ^ table[j - at[0]]).sum(axis=1)
            near = apart <= most
            if near.any():
                yield j, rest[near][np.argsort(apart[near], kind="stable")]


def _map_cells(rows: DataFrame, solve, schema) -> DataFrame:  # noqa: ANN001
    """``solve`` on the rows of each cell, ordered by size."""
    dealt = rows.repartition(*CELL_KEYS).sortWithinPartitions(*CELL_KEYS, "size", "cls")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the cell that is not yet complete
        name: tuple | None = None
        for batch in batches:
            if not len(batch):
                continue
            columns = [batch.column(i).to_numpy() for i in range(len(CELL_KEYS))]
            new = np.any([c[1:] != c[:-1] for c in columns], axis=0)
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(batch)]
            for s, e in itertools.pairwise(edges):
                this = tuple(c[s] for c in columns)
                if held and this != name:
                    yield solve(pa.Table.from_batches(held).combine_chunks())
                    held = []
                name = this
                held.append(batch.slice(s, e - s))
        if held:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return dealt.mapInArrow(run, schema)


def _words(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), "<u8") for chunk in column.chunks for x in chunk]


def _close_members(cells: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``cells`` with a partner there, of another component, that sketches allow."""

    def solve(part: pa.Table) -> pa.RecordBatch:
        label, size = part["label"].to_numpy(), part["size"].to_numpy()
        close = np.zeros(len(label), bool)
        for j, partners in _possible(label, size, _words(part["sketch"]), percent):
            close[j] = True
            close[partners] = True
        kept = part.select(MEMBERS.names).filter(pa.array(close)).combine_chunks()
        return pa.RecordBatch.from_arrays(
            [pa.array(kept[c].to_numpy()) for c in MEMBERS.names], names=MEMBERS.names
        )

    rows = cells.join(sets.select("cls", "size", "sketch"), "cls")
    return _map_cells(rows.select(*MEMBERS.names, "size", "sketch"), solve, MEMBERS)


def _cell_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(u, v): in each cell a spanning forest of the links between components."""

    def solve(part: pa.Table) -> pa.RecordBatch:
        cls, size = part["cls"].to_numpy(), part["size"].to_numpy()
        label = part["label"].to_numpy().copy()
        shingles = _words(part["shingles"])
        us, vs = [], []
        for j, partners in _possible(label, size, _words(part["sketch"]), percent):
            for i in partners.tolist():
                if label[i] != label[j] and linked(shingles[j], shingles[i], percent):
                    label[label == label[i]] = label[j]
                    us.append(j)
                    vs.append(i)
        a, b = cls[us], cls[vs]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=EDGES.names
        )

    rows = members.join(sets.select("cls", "size", "sketch", "shingles"), "cls")
    return _map_cells(
        rows.select(*MEMBERS.names, "size", "sketch", "shingles"), solve, EDGES
    ).distinct()


def class_labels(groups: DataFrame, sets: DataFrame, percent: int, cell: int = CELL) -> DataFrame:
    """(cls, size, label) of all classes that share a signature with another."""
    classes = sets.select("cls", "size")
    links = sets.sparkSession.createDataFrame([], EDGES)
    labels = classes.withColumn("label", F.col("cls"))
    for _ in range(STARS):
        marked = stored(_open_groups(groups, labels), "open-groups")
        if marked.isEmpty():
            return labels
        links = links.unionByName(stored(verified(_stars(marked), sets, percent), "links"))
        labels = stored(_labels(classes, links), "labels")
        groups = marked.where("not leads").select("sig", "cls", "n")  # leaders are done
    marked = stored(_open_groups(groups, labels), "open-groups")
    if marked.isEmpty():
        return labels
    members = stored(_close_members(_cells(marked, cell), sets, percent), "close-members")
    links = links.unionByName(stored(_cell_links(members, sets, percent), "links"))
    return stored(_labels(classes, links), "labels")


def jaccard_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    cell: int = CELL,
) -> DataFrame:
    """One row per document: key, n_shingles, component_id (smallest key reachable)."""
    for seed in itertools.count():
        named = stored(
            prints(docs, seed, key, text, shingle).withColumnRenamed(key, "key"), "set-names"
        )
        sure = named.where("size > 0").groupBy("cls").agg(
            F.min("cls2").alias("a"), F.max("cls2").alias("b")
        )
        if sure.where("a != b").isEmpty():
            break
    filled = named.where("size > 0")
    groups = stored(shared(signature_rows(docs, seed, text, shingle, percent)), "signatures")
    groups = stored(distinct_groups(groups), "groups")
    needed = stored(groups.select("cls").distinct(), "needed")
    sets = stored(
        _needed_sets(docs, filled, needed, seed, key, text, shingle, percent), "needed-sets"
    )
    labels = class_labels(groups, sets, percent, cell).select("cls", "label")
    least = filled.groupBy("cls").agg(F.min("key").alias("least"))
    rooted = least.join(labels, "cls", "left").select(
        "cls", "least", F.coalesce("label", "cls").alias("label")
    )
    names = rooted.groupBy("label").agg(F.min("least").alias("component_id"))
    named_classes = rooted.join(names, "label").select("cls", "component_id")
    # one row per class; adaptive execution splits the side of a class with very many copies
    linked = filled.join(named_classes, "cls").select(
        F.col("key").alias(key), F.col("size").alias("n_shingles"), "component_id"
    )
    alone = named.where("size = 0").select(
        F.col("key").alias(key),
        F.col("size").alias("n_shingles"),
        F.col("key").cast(linked.schema["component_id"].dataType).alias("component_id"),
    )
    return linked.unionByName(alone)

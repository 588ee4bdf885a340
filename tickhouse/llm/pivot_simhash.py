"""SimHash near-duplicates with pivot distance tables.

*Fingerprint*: 64 bits; a bit is set if it is set in over half of the XXH64
hashes (seed 42) of the text's shingles of ``SHINGLE`` words, repeats
included.  Fingerprints link at ``MAX_BITS`` or fewer differing bits.

*Links between distinct fingerprints*, without all pairs:

1. Equal fingerprints are merged first, so copies are never paired.
2. The 64 bits fall into five bands.  Two bits can touch at most two bands,
   so a link agrees on at least three: each fingerprint goes into ten cells,
   one per choice of three bands.  Cells of more than ``CELL`` members are
   counted beforehand and each is split by the same argument on the bits it
   leaves free (five sub-bands, three of them equal); what then remains free
   is at most 11 bits, so a split cell can hold 2048 fingerprints at most
   however large the table is.
3. Inside a cell every fingerprint has its row of the pivot table, the
   Hamming distances to ``PIVOTS`` reference fingerprints.  By the triangle
   inequality two linked fingerprints differ by at most ``MAX_BITS`` in
   every coordinate: members are ordered by the first coordinate and only
   compared while it allows, pairs whose maximum coordinate difference is
   larger are discarded, and the survivors are verified bit by bit.
4. A task returns a spanning forest of the links it has verified, so the
   number of edges follows the number of fingerprints, not that of links.

*Components*: alternating large-star and small-star steps over the edges,
each written to the shared checkpoint folder.

Cases: a null or empty text, or one without words, has fingerprint zero and
is linked like any other; fewer words than a shingle make one shingle of the
whole sequence; repeated rows share their component; a null key never names
a component unless no other key is in it; an empty table gives no rows;
further columns are not read, ``representatives`` returns them untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm.common import LONG, fields, map_texts, row_hash, stored, texts_of

SHINGLE, MAX_BITS, SEED = 3, 2, 42
PIVOTS = 16
CELL = 1024
BANDS = 5


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    words = text.encode().lower().split()  # bytes: lower-cases A-Z, cuts at the same white space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = list(accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(line[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :], strict=False)], "<u8"
    )
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
        axis=0, dtype=np.int64
    )
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """One row per document: key, ``bits`` (the fingerprint as a signed long)."""

    def work(column: pa.Array) -> dict[str, object]:
        return {"bits": [_signed(fingerprint(t, shingle)) for t in texts_of(column)]}

    return map_texts(docs, work, fields(bits=LONG), key, text)


# --- candidate cells -------------------------------------------------------


def band_masks(free: int, bands: int = BANDS) -> list[int]:
    """The bits of ``free`` in ``bands`` nearly equal runs."""
    bits = [b for b in range(64) if free >> b & 1]
    edges = [round(i * len(bits) / bands) for i in range(bands + 1)]
    return [sum(1 << b for b in bits[s:e]) for s, e in zip(edges, edges[1:], strict=False)]


def cell_masks(free: int, max_bits: int = MAX_BITS) -> list[int]:
    """Masks of which any two fingerprints within ``max_bits`` agree on one."""
    bands = band_masks(free)
    return [sum(kept) for kept in combinations(bands, BANDS - max_bits)]


ALL_BITS = (1 << 64) - 1


def _cells(bits: Column, masks: list[tuple[int, int]]) -> Column:
    """array of (cell kind, masked bits)."""
    return F.array(
        *[
            F.struct(
                F.lit(number).alias("kind"),
                bits.bitwiseAND(F.lit(_signed(mask)).cast("long")).alias("cell"),
            )
            for number, mask in masks
        ]
    )


def celled(distinct: DataFrame, max_bits: int = MAX_BITS, limit: int = CELL) -> DataFrame:
    """(kind, cell, bits) rows; cells over ``limit`` members come split."""
    first = list(enumerate(cell_masks(ALL_BITS, max_bits)))
    level = distinct.select("bits", F.explode(_cells(F.col("bits"), first)).alias("c")).select(
        "bits", "c.kind", "c.cell"
    )
    sizes = level.groupBy("kind", "cell").agg(F.count("*").alias("n")).where("n > 1")
    joined = level.join(sizes, ["kind", "cell"])
    small = joined.where(F.col("n") <= limit).select("kind", "cell", "bits")
    # a large cell keeps its own agreed bits and adds those of three sub-bands
    split = F.lit(None).cast("array<struct<kind:int,cell:bigint>>")
    for number, mask in reversed(first):
        finer = [
            (len(first) * (1 + number) + i, mask | sub)
            for i, sub in enumerate(cell_masks(ALL_BITS & ~mask, max_bits))
        ]
        split = F.when(F.col("kind") == number, _cells(F.col("bits"), finer)).otherwise(split)
    large = (
        joined.where(F.col("n") > limit)
        .select("bits", F.explode(split).alias("c"))
        .select("c.kind", "c.cell", "bits")
    )
    return small.unionByName(large)


# --- links -----------------------------------------------------------------


def pivot_table(values: np.ndarray, pivots: int = PIVOTS) -> np.ndarray:
    """Hamming distances of each fingerprint to fixed reference fingerprints."""
    reference = np.random.default_rng(SEED).integers(0, 1 << 64, pivots, dtype=np.uint64)
    return np.bitwise_count(values[:, None] ^ reference[None, :])


def links_in_cells(
    cells: np.ndarray, values: np.ndarray, max_bits: int = MAX_BITS, pivots: int = PIVOTS
) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between members of the same cell.

    ``cells``: a number per member, equal for members of one cell.
    """
    table = pivot_table(values, pivots).astype(np.int8)
    order = np.lexsort((table[:, 0], cells))
    cells, values, table = cells[order], values[order], table[order]
    left = np.arange(len(values) - 1)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    step = 1
    while len(left):
        left = left[left + step < len(values)]
        right = left + step
        # in this order, once the cell or the first coordinate is out of reach it stays so
        left = left[
            (cells[left] == cells[right]) & (table[right, 0] - table[left, 0] <= max_bits)
        ]
        right = left + step
        near = np.abs(table[left] - table[right]).max(axis=1, initial=0) <= max_bits
        a, b = left[near], right[near]
        sure = np.bitwise_count(values[a] ^ values[b]) <= max_bits
        found.append((a[sure], b[sure]))
        step += 1
    if not found:
        return values[:0], values[:0]
    a = np.concatenate([x for x, _ in found])
    b = np.concatenate([y for _, y in found])
    names, at = np.unique(values, return_inverse=True)
    a, b = at[a], at[b]
    root = np.arange(len(names))
    while True:  # smallest member of each component, by hooking and pointer jumping
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    member = np.flatnonzero(root != np.arange(len(names)))
    return names[member], names[root[member]]


EDGES = T.StructType([T.StructField("u", T.LongType()), T.StructField("v", T.LongType())])


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect exactly what the links connect."""
    dealt = (
        celled(distinct, max_bits).repartition("kind", "cell").sortWithinPartitions("kind", "cell")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(rows: pa.Table) -> pa.RecordBatch:
            kind = rows["kind"].to_numpy()
            cell = rows["cell"].to_numpy()
            new = np.append(True, (kind[1:] != kind[:-1]) | (cell[1:] != cell[:-1]))
            u, v = links_in_cells(
                np.cumsum(new), rows["bits"].to_numpy().view(np.uint64), max_bits
            )
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
            )

        rest: pa.Table | None = None  # the last cell of a batch may go on in the next
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            kind, cell = rows["kind"].to_numpy(), rows["cell"].to_numpy()
            done = np.flatnonzero((kind != kind[-1]) | (cell != cell[-1])) if len(kind) else []
            at = int(done[-1]) + 1 if len(done) else 0
            if at:
                yield solve(rows.slice(0, at))
            rest = rows.slice(at)
        if rest is not None and len(rest):
            yield solve(rest)

    return dealt.select("kind", "cell", "bits").mapInArrow(run, EDGES).distinct()


# --- components ------------------------------------------------------------


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step on edges (u, v) with v < u."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.where("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m")
    )
    moved = near.join(least, "u")
    if large:  # larger neighbours go to the smallest
        out = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # the node and its smaller neighbours go to the smallest
        out = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(u, root): for every node of an edge but the roots, the smallest node it reaches."""
    now = stored(
        edges.where("u != v").select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
        ).distinct(),
        "edges",
    )
    check = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    state = now.agg(*check).first()
    while state[0]:
        now = stored(_star(_star(now, large=True), large=False), "edges")
        before, state = state, now.agg(*check).first()
        if state == before:
            break
    return now.select("u", F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: key, fingerprint (hex), component_id (smallest key reachable)."""
    prints = stored(fingerprints(docs, key, text, shingle).withColumnRenamed(key, "key"), "fingerprints")
    named = component_ids(prints, max_bits)
    return prints.join(named, "bits", "left").select(
        F.col("key").alias(key),
        F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def component_ids(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(bits, root, component_id) for each distinct fingerprint of (key, bits)."""
    least = stored(prints.groupBy("bits").agg(F.min("key").alias("least")), "distinct")
    roots = components(links(least.select("bits"), max_bits))
    rooted = least.join(roots, least["bits"] == roots["u"], "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(names, "root").select("bits", "root", "component_id")


def representatives(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One document of each component, with all its columns: the smallest key.

    Null keys come last.  Where several rows carry the key, the one with the
    smallest hash of all columns stays; equal rows become one.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    own = F.struct(
        F.col(key).isNull().alias("none"),
        F.col(key).alias("key"),
        row_hash(columns).alias("tag"),
    )
    prints = stored(
        fingerprints(docs.select(own.alias("own"), F.col(text).alias("text")), "own", "text", shingle),
        "fingerprints",
    )
    classes = component_ids(prints.select(F.col("own.key").alias("key"), "bits"), max_bits)
    stay = (
        prints.groupBy("bits", "own")
        .agg(F.count("*").alias("copies"))
        .groupBy("bits")
        .agg(F.min(F.struct("own", "copies")).alias("best"))
        .join(classes, "bits")
        .groupBy("root")
        .agg(F.min("best").alias("best"))
        .select("best.own", "best.copies")
    )
    rows = docs.select(F.struct(*columns).alias("row"), own.alias("own"))
    found = rows.join(stay, "own").select("row", "own", "copies")
    single = found.where("copies = 1").select("row.*")
    return single.unionByName(found.where("copies > 1").dropDuplicates(["own"]).select("row.*"))

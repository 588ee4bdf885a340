"""Sequence packing along a space-filling curve.

1. Each document is encoded whole and closed by the end id.  Its vector is
   the sum of fixed random directions of its ids (a hash of the id gives the
   direction), divided by its length: ``DIMS`` numbers.  Quantised to
   ``BITS`` bits each they give a cell of a grid, whose place on the Hilbert
   curve is the document's key: documents with like vectors get keys close
   by.
2. Documents are range-sorted by key, ties by a hash of the document, so
   that a group of equal texts of any size spreads over tasks.
3. Each task cuts its run of the curve into sequences of ``LENGTH`` ids, so
   every document is packed with its neighbours on the curve.  A sequence is
   full but for the last of each task, which is padded to a power of two;
   the number of tasks follows the number of ids (``TASK_IDS`` each), so
   padding stays below one sequence per ``TASK_IDS`` ids.

Encoding happens once: keys, counts and ids go to a table in the shared
checkpoint folder, from which the sort samples and reads.

Cases: a null or empty text is the end id alone; texts of any length are cut
over as many sequences as they need; ties and repeated rows are packed one
after another; an empty table gives no pieces; further columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.llm import wordarrays as wa
from tickhouse.llm.common import BINARY, LONG, fields, map_texts, stored
from tickhouse.llm.pretokens import encoder

LENGTH = 2048
END_ID = 1
DIMS, BITS = 4, 8
TASK_IDS = 1 << 22
#: Bytes of text encoded at once, which a worker's memory follows.
SLICE = 1 << 20
#: vectors are averages of unit-variance directions; beyond this they are clipped
SPREAD = 0.5


def directions(ids: int, dims: int = DIMS) -> np.ndarray:
    """A fixed random direction of each id, uniform in [-1.7, 1.7) per dimension."""
    slot = np.arange(ids * dims, dtype=wa.U).reshape(ids, dims)
    unit = (wa.mix(slot * wa.STEP + wa.U(99)) >> wa.U(11)).astype("f8") / (1 << 53)
    return (2 * unit - 1) * np.sqrt(3.0)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place on the Hilbert curve of each cell (rows of coordinates below 2^bits).

    The published transposed form: undo the excess work of each bit from the
    top, Gray-code the coordinates, then interleave their bits.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[:, i] & q) != 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, i]) & low)
            x[:, 0] ^= np.where(high, low, swap)
            x[:, i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[:, i] ^= x[:, i - 1]
    turn = np.zeros(len(x), np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[:, dims - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn[:, None]
    key = np.zeros(len(x), np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[:, i] >> b) & 1)
    return key


def curve_keys(ids: np.ndarray, counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The curve key of each document of ``counts`` ids."""
    ends = np.cumsum(counts)
    sums = np.zeros((len(counts), table.shape[1]))
    some = counts > 0
    if some.any():
        for i in range(table.shape[1]):
            sums[some, i] = np.add.reduceat(table[ids, i], (ends - counts)[some])
    vector = sums / np.maximum(counts, 1)[:, None]
    cells = np.floor((np.clip(vector / SPREAD, -1, 1) + 1) / 2 * ((1 << BITS) - 1) + 0.5)
    return hilbert_keys(cells)


def encoded(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """One row per document: key, curve key, number of ids and the ids (16-bit, with the end id)."""

    def work(column: pa.Array) -> dict[str, object]:
        own = encoder(tokenizer_path)
        ids, counts = own.encode(column)
        table = _table(own.library.get_vocab_size())
        curve = curve_keys(ids, counts, table)
        raw, tail = ids.astype("<u2").tobytes(), np.uint16(end_id).astype("<u2").tobytes()
        ends = (2 * np.cumsum(counts)).tolist()
        starts = [0, *ends]
        return {
            "curve": curve,
            "tokens": counts + 1,
            "ids": [raw[s:e] + tail for s, e in zip(starts, ends, strict=False)],
        }

    return map_texts(docs, work, fields(curve=LONG, tokens=LONG, ids=BINARY), key, text, SLICE)


_tables: dict[int, np.ndarray] = {}


def _table(size: int) -> np.ndarray:
    if size not in _tables:
        _tables[size] = directions(size)
    return _tables[size]


def padded_length(filled: int, length: int = LENGTH) -> int:
    """What a sequence of ``filled`` ids is padded to: the next power of two, at most ``length``."""
    return min(length, 1 << max(filled - 1, 0).bit_length())


def pieces(
    counts: np.ndarray, length: int = LENGTH, filled: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cuts a run of non-empty documents where sequences of ``length`` end.

    ``filled``: ids the first sequence already holds.  Returns for each piece
    its document, start in it, length, and place counted from the first
    sequence's begin.
    """
    ends = filled + np.cumsum(counts)
    begins = ends - counts
    total = int(ends[-1]) if len(ends) else filled
    cuts = np.union1d(np.arange(-(-filled // length) * length, total, length), begins)
    stops = np.append(cuts[1:], total)[: len(cuts)]
    doc = np.searchsorted(ends, cuts, side="right")
    return doc, cuts - begins[doc], stops - cuts, cuts


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    end_id: int = END_ID,
    task_ids: int = TASK_IDS,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``sequence_id`` numbers the sequences of a task in its low 32 bits;
    ``padded_length`` tells what a sequence is padded to.
    """
    table = stored(encoded(docs, tokenizer_path, key, text, end_id), "packing")
    total = table.agg(F.sum("tokens")).first()[0] or 0
    run = (
        table.select(F.col(key).alias("key"), "curve", "tokens", "ids")
        .withColumn("tie", F.xxhash64("key", "ids"))
        .repartitionByRange(max(1, -(-total // task_ids)), "curve", "tie")
        .sortWithinPartitions("curve", "tie")
        .select("key", "tokens", "ids", F.spark_partition_id().alias("task"))
    )
    schema = T.StructType(
        [
            T.StructField(key, run.schema["key"].dataType),
            *fields(
                start=LONG,
                length=LONG,
                ids_crc32=LONG,
                doc_tokens=LONG,
                sequence_id=LONG,
                offset=LONG,
            ).fields,
        ]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0  # ids of the task already packed
        for batch in batches:
            if not len(batch):
                continue
            counts = batch.column(1).to_numpy()
            filled = done % length  # of the sequence that the batch before left open
            doc, start, size, place = pieces(counts, length, filled)
            ids = batch.column(2)
            crc = [
                zlib.crc32(np.frombuffer(ids[d].as_buffer(), "<u2")[s : s + n].astype("<u4"))
                for d, s, n in zip(doc.tolist(), start.tolist(), size.tolist(), strict=True)
            ]
            task = batch.column(3)[0].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(doc)),
                    pa.array(start),
                    pa.array(size),
                    pa.array(crc, pa.int64()),
                    pa.array(counts[doc]),
                    pa.array((task << 32) | (done - filled + place) // length),
                    pa.array(place % length),
                ],
                names=schema.names,
            )
            done += int(counts.sum())

    return run.mapInArrow(pack, schema)

"""Token ids in binary files: frequency ranks in byte-aligned variable length.

*Coding*: ids are replaced by their rank in the corpus (the most frequent id
is 0), so most ids take one byte.  A rank takes 1 to 4 data bytes, little
endian; its length minus one is two bits of a control byte, four ids to a
control byte.  Control and data bytes lie apart, so a decoder finds all
lengths by looking control bytes up in a table, all places by a running sum,
and all values by gathers: no loop over ids.

*Files*: documents are written in ascending key order (nulls first, ties by a
hash of the ids).  A range sort gives each task a run of documents and each
task writes one file of about ``FILE_IDS`` ids, block by block (a block: an
Arrow batch of documents).  A file is written under a temporary name and
moved, so a lost or repeated task leaves no half file and a repeat writes
the same bytes.  The driver adds ``index`` with the rank table and the
number of ids before each file; it holds one entry per file and per id of
the vocabulary.  Files are written by tasks through the file system that
pyarrow finds for the folder's address, and read by Spark's binary reader.

Block: four unsigned 64-bit numbers (documents, ids, control bytes, data
bytes), keys (signed 64 bit), null flags (a byte each), ids per document
(unsigned 32 bit), control bytes, data bytes; all little endian.

Cases: a null or empty text is the end id alone; texts of any length stay
whole in one block; repeated rows and equal keys are written one after
another; an empty table gives an index without files and no rows; keys must
be integers; further columns are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickhouse.llm.common import BINARY, LONG, fields, map_texts, stored
from tickhouse.llm.pretokens import encoder

END_ID = 1
FILE_IDS = 1 << 22
SUFFIX = ".tvb"
HEAD = "<4Q"

#: the four lengths of a control byte
LENGTHS = np.array([[((c >> 2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.int64)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of unsigned 32-bit values."""
    values = values.astype(np.uint32)
    extra = (values >= 1 << 8).astype(np.int64) + (values >= 1 << 16) + (values >= 1 << 24)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = extra
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    ends = np.cumsum(extra + 1)
    place = ends - extra - 1
    data = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    for byte in range(4):
        has = extra >= byte
        data[place[has] + byte] = (values[has] >> np.uint32(8 * byte)).astype(np.uint8)
    return control, data


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n values behind control and data bytes."""
    length = LENGTHS[control].ravel()[:n]
    place = np.cumsum(length) - length
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.uint32)
    values = padded[place]
    for byte in range(1, 4):
        more = np.flatnonzero(length > byte)
        values[more] |= padded[place[more] + byte] << np.uint32(8 * byte)
    return values


def file_system(address: str) -> tuple[fs.FileSystem, str]:
    if address.startswith("file:") and not address.startswith("file://"):
        address = "file://" + address[len("file:") :]
    return fs.FileSystem.from_uri(address)


def write_file(address: str, parts: list[bytes] | Iterator[bytes]) -> int:
    """Writes a file under a temporary name and moves it; the number of bytes."""
    system, path = file_system(address)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    temporary, size = f"{path}.{uuid.uuid4().hex}", 0
    with system.open_output_stream(temporary) as out:
        for part in parts:
            out.write(part)
            size += len(part)
    system.move(temporary, path)
    return size


def token_table(
    docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID
) -> DataFrame:
    """One row per document: key, number of ids and the ids (16 bit, with the end id)."""

    def work(column: pa.Array) -> dict[str, object]:
        ids, counts = encoder(tokenizer_path).encode(column)
        raw, tail = ids.astype("<u2").tobytes(), np.uint16(end_id).astype("<u2").tobytes()
        ends = (2 * np.cumsum(counts)).tolist()
        return {
            "n": counts + 1,
            "ids": [raw[s:e] + tail for s, e in zip([0, *ends], ends, strict=False)],
        }

    return map_texts(docs, work, fields(n=LONG, ids=BINARY), key, text)


def frequencies(table: DataFrame) -> np.ndarray:
    """How often each id occurs in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                counts += np.bincount(np.frombuffer(ids.as_buffer(), "<u2"), minlength=1 << 16)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(seen), pa.array(counts[seen])], names=["id", "n"]
        )

    rows = (
        table.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n")).collect()
    )
    counts = np.zeros(1 << 16, np.int64)
    for i, n in rows:
        counts[i] = n
    return counts


def by_frequency(counts: np.ndarray) -> np.ndarray:
    """Ids in the order of their ranks: the most frequent first, ties by id."""
    return np.argsort(-counts, kind="stable")


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    file_ids: int = FILE_IDS,
) -> None:
    """Encodes all documents and writes them, in key order, into ``folder``."""
    table = stored(token_table(docs, tokenizer_path, key, text, end_id), "token-ids").withColumnRenamed(
        key, "key"
    )
    counts = frequencies(table)
    order = by_frequency(counts)
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(len(order))
    total = int(counts.sum())
    files = max(1, -(-total // file_ids))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task: list[int] = []
        sums = [0, 0]

        def blocks() -> Iterator[bytes]:
            for batch in batches:
                if not len(batch):
                    continue
                task.append(batch.column(2)[0].as_py())
                keys, ids = batch.column(0), batch.column(1)
                own = [np.frombuffer(x.as_buffer(), "<u2") for x in ids]
                sizes = np.array([len(x) for x in own], "<u4")
                control, data = pack(rank[np.concatenate(own)])
                null = np.array(keys.is_null().to_pylist(), np.uint8)
                sums[0] += len(batch)
                sums[1] += int(sizes.sum())
                yield struct.pack(HEAD, len(batch), int(sizes.sum()), len(control), len(data))
                yield keys.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
                yield null.tobytes() + sizes.tobytes()
                yield control.tobytes()
                yield data.tobytes()

        stream = blocks()
        first = next(stream, None)
        if first is None:
            return
        name = f"part-{task[0]:06d}{SUFFIX}"

        def parts() -> Iterator[bytes]:
            yield first
            yield from stream

        size = write_file(f"{folder}/{name}", parts())
        yield pa.RecordBatch.from_arrays(
            [pa.array([x]) for x in (task[0], name, sums[0], sums[1], size)],
            names=["task", "name", "docs", "ids", "bytes"],
        )

    written = (
        table.withColumn("tie", F.xxhash64("ids"))
        .repartitionByRange(files, F.col("key").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("key").asc_nulls_first(), "tie")
        .select(F.col("key").cast("long").alias("key"), "ids", F.spark_partition_id().alias("task"))
        .mapInArrow(write, "task long, name string, docs long, ids long, bytes long")
        .collect()
    )
    before, entries = 0, []
    for row in sorted(written, key=lambda r: r["task"]):  # by number: names need not sort like it
        entries.append({**row.asDict(), "before": before})
        before += row["ids"]
    index = {"files": entries, "ids": order[counts[order] > 0].tolist()}
    write_file(f"{folder}/index.json", [json.dumps(index).encode()])


def read_blocks(content: bytes, order: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(keys, ids per document, ids) of each block of a file."""
    at = 0
    while at < len(content):
        docs, n, controls, size = struct.unpack_from(HEAD, content, at)
        at += struct.calcsize(HEAD)
        parts = []
        for kind, count in (("<i8", docs), ("u1", docs), ("<u4", docs), ("u1", controls), ("u1", size)):
            parts.append(np.frombuffer(content, kind, count, at))
            at += parts[-1].nbytes
        keys, null, sizes, control, data = parts
        yield (
            [None if z else k for k, z in zip(keys.tolist(), null.tolist(), strict=True)],
            sizes.astype(np.int64),
            order[unpack(control, data, n)],
        )


def read_tokens(spark: SparkSession, folder: str, key: str = "doc_id") -> DataFrame:
    """One row per document of the files: key, start, n_tokens, ids_crc32, ids (32 bit)."""
    system, path = file_system(folder)
    with system.open_input_stream(f"{path}/index.json") as f:
        index = json.loads(f.read())
    before = {e["name"]: e["before"] for e in index["files"]}
    order = np.array(index["ids"], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                start = before[name.as_py().rsplit("/", 1)[1]]
                for keys, sizes, ids in read_blocks(content.as_py(), order):
                    ends = np.cumsum(sizes)
                    raw = ids.astype("<u4").tobytes()
                    own = [
                        raw[4 * s : 4 * e]
                        for s, e in zip((ends - sizes).tolist(), ends.tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.int64()),
                            pa.array(start + ends - sizes),
                            pa.array(sizes),
                            pa.array([zlib.crc32(x) for x in own], pa.int64()),
                            pa.array(own, pa.binary()),
                        ],
                        names=[key, "start", "n_tokens", "ids_crc32", "ids"],
                    )
                    start += int(ends[-1])

    schema = f"`{key}` long, start long, n_tokens long, ids_crc32 long, ids binary"
    if not before:
        return spark.createDataFrame([], schema)
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", f"*{SUFFIX}")
        .load(folder)
        .select("path", "content")
        .mapInArrow(run, schema)
    )

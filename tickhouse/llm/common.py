"""Shared pieces of the training-data operators.

Conventions every operator of this subpackage keeps:

* only the named key and text columns are read, so further columns of the
  input, whatever their names, neither clash nor appear in the result;
* a null text counts as the empty text, a null key stays null;
* repeated rows are separate rows and all get their result;
* an empty table gives an empty result of the same schema;
* texts are never cut: work inside a task goes in slices of whole texts of
  about ``SLICE_BYTES``, so memory follows the longest text, not the table.
"""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickhouse.session import new_scratch_dir

SLICE_BYTES = 4 << 20


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application.

    Needed where they cannot import it by themselves, such as in a session
    that was not started with ``--py-files``.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*.py")):
            out.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared checkpoint folder and read back.

    Cuts the lineage: what follows can be recomputed from files that
    survive a lost executor.
    """
    path = new_scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_remainder(key: str | Column, divisor: int) -> Column:
    """crc32 of the key as text modulo ``divisor``; a null key counts as ''."""
    col = F.col(key) if isinstance(key, str) else key
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)


def row_hash(columns: list[Column]) -> Column:
    """Hash of a row that also tells which columns are null (xxhash64 skips nulls)."""
    return F.xxhash64(*columns, *[c.isNull() for c in columns])


def text_slices(
    column: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 20
) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of whole texts, about ``limit`` bytes and at most ``rows`` texts each."""
    n = len(column)
    if n == 0:
        return
    ends = np.cumsum(
        np.nan_to_num(
            pc.binary_length(column).to_numpy(zero_copy_only=False).astype("f8")
        )
    )
    start = 0
    while start < n:
        base = ends[start - 1] if start else 0.0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        stop = min(stop, start + rows)
        yield start, stop - start
        start = stop


def texts_of(column: pa.Array) -> list[str]:
    return [t if t is not None else "" for t in column.to_pylist()]


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and n + 1 offsets into it."""
    column = pc.fill_null(column, "").cast(pa.large_binary())
    column = pa.concat_arrays([column])  # offsets from 0
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[
        column.offset : column.offset + len(column) + 1
    ]
    data = column.buffers()[2]
    if data is None or data.size == 0:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def map_texts(
    df: DataFrame,
    work: Callable[[pa.Array], dict[str, object]],
    results: T.StructType,
    key: str = "doc_id",
    text: str = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """One result row per input row: the key, then what ``work`` gives.

    ``work`` gets a slice of the text column, of about ``limit`` bytes, and
    returns one sequence per field of ``results``.  No shuffle; runs where the rows are read.
    """
    source = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([T.StructField(key, source.schema["key"].dataType), *results.fields])
    types = {f.name: arrow_type(f.dataType) for f in results.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, column = batch.column(0), batch.column(1)
            for at, n in text_slices(column, limit):
                out = work(column.slice(at, n))
                arrays = [pa.array(out[name], type=kind) for name, kind in types.items()]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, n), *arrays], names=[key, *types]
                )

    return source.mapInArrow(run, schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    return {
        T.LongType(): pa.int64(),
        T.IntegerType(): pa.int32(),
        T.DoubleType(): pa.float64(),
        T.BooleanType(): pa.bool_(),
        T.StringType(): pa.string(),
        T.BinaryType(): pa.binary(),
    }[kind]


def fields(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


LONG, DOUBLE, BOOL, STRING, BINARY = (
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.StringType(),
    T.BinaryType(),
)

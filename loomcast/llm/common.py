"""What the operators of this subpackage share: scratch tables, row keys, text slices of Arrow batches."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share (``spark.checkpoint.dir``).

    Where that setting is absent, local masters (tests) use a temporary folder of this machine; any other master raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        found = spark.sparkContext.getCheckpointDir()
        if found is None:
            if not re.fullmatch(r"local(\[[^-]*\])?", spark.sparkContext.master):
                raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loomcast-"))
            found = spark.sparkContext.getCheckpointDir()
        base = found
    return f"{base.rstrip('/')}/loomcast/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there, and lost executors cost nothing."""
    path = scratch(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    read._scratch = path
    return read


def discard(*tables: DataFrame) -> None:
    """Deletes the files of :func:`stored` tables that nothing reads any more. The others stay until the folder is cleared."""
    for table in tables:
        delete(table.sparkSession, table._scratch)


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def split_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def parts_of(df: DataFrame, each: int = 64 << 20) -> int:
    """Partitions for a shuffle of ``df``: as many as its files' bytes make parts of ``each``, and the session's number at least.

    The planner's estimate costs no scan; where it has none (rows that are not in files), the session's number stays.
    """
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(split_count(df.sparkSession), min(size // each, 100_000) if size < 1 << 60 else 0)


def give_back() -> None:
    """Returns to the system what Arrow and the allocator hold free. Spark reuses Python workers: what one task has freed would add up with the next one's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another allocator


#: Bytes of text that a Python worker handles at a time, and so the bound of its scratch arrays. A longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string or binary array and its n + 1 offsets, without copies; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def runs_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """(first row, end row) of runs of rows cut at ``offsets`` that hold about ``most`` bytes together."""
    n, row = len(offsets) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        end = min(end, n)
        yield row, end
        row = end


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows that hold about ``most`` bytes together."""
    data, offsets = text_bytes(column)
    for row, end in runs_of(offsets, most):
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length)."""
    lengths = lengths.astype(np.int64)
    ends = np.cumsum(lengths)
    out = np.repeat(starts.astype(np.int64) - (ends - lengths), lengths)
    out += np.arange(len(out), dtype=np.int64)
    return out


def order_within(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by group (0, 1, ...), then value (uint64). One sort of both in 64 bits; the rare ties that cut off bits leave send it the long way."""
    if not len(group):
        return np.zeros(0, np.int64)
    bits = int(group.max()).bit_length()
    if bits > 24:
        return np.lexsort((value, group))
    key = group.astype(np.uint64) << np.uint64(64 - bits) if bits else np.zeros(len(group), np.uint64)
    key |= value >> np.uint64(bits)
    order = np.argsort(key)
    if bits:
        key, value_ = key[order], value[order]
        if ((key[1:] == key[:-1]) & (value_[1:] < value_[:-1])).any():
            return np.lexsort((value, group))
    return order


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary array over ``data`` (uint8) cut at ``offsets``."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def map_text(df: DataFrame, function, added: dict[str, str], text: str = "text", keep: list[str] | None = None, most: int = SLICE_BYTES) -> DataFrame:
    """Append columns that ``function(bytes, offsets)`` makes of whole texts, a slice of rows at a time.

    ``added``: name and SQL type of each column, in the order of the arrays returned. ``keep``: the columns passed on
    (all, if not given); one of an added column's name gives way to it. Narrow: no shuffle, memory bounded by a slice.
    """
    from pyspark.sql import types as T

    keep = [c for c in (df.columns if keep is None else keep) if c not in added]
    fields = {f.name: f for f in df.schema.fields}
    schema = T.StructType([fields[c] for c in keep])
    for name, kind in added.items():
        schema.add(name, T._parse_datatype_string(kind))
    names = [*keep, *added]
    wanted = [*keep, *([] if text in keep else [text])]

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            kept = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            for first, end, data, offsets in slices(column, most):
                made = function(data, offsets)
                yield pa.RecordBatch.from_arrays([*(c.slice(first, end - first) for c in kept), *made], names=names)
                del made
                give_back()

    return df.select(*wanted).mapInArrow(run, schema)

"""What several corpus operators share: reading, whole texts, packed arrays, size-checked choices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20  # text bytes that one task handles at a time
BATCH_BYTES = 4 << 20  # bytes of an Arrow batch


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_BYTES``, unless the session has another bound than Spark's usual 64 MB."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == f"{64 << 20}b":
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and whole texts under fixed names; a null text counts as empty, all other columns are left behind."""
    bounded_batches(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[list[int], list[bytes]]]:
    """Ids and UTF-8 texts in runs of about ``limit`` bytes; a longer text is a run of its own."""
    ids: list[int] = []
    held: list[bytes] = []
    size = 0
    for batch in batches:
        for i, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
            if held and size + len(text) > limit:
                yield ids, held
                ids, held, size = [], [], 0
            ids.append(i)
            held.append(text)
            size += len(text)
    if held:
        yield ids, held


def pack(values: np.ndarray) -> bytes:
    """An integer array as one zstandard frame, its bytes transposed so that equal high bytes meet."""
    width = values.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, width).T.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).reshape(-1).view(dtype)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start .. start + length - 1`` of every run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)


def without_ids(df: DataFrame, ids: DataFrame, id_col: str = "doc_id", rows: int = 1_000_000) -> DataFrame:
    """``df`` less the rows whose id is among ``ids``; rows without an id stay. Only few ids (8 MB) are broadcast."""
    ids = ids.select(F.col(ids.columns[0]).alias("_gone")).distinct()
    few = ids.limit(rows + 1).count() <= rows
    return df.join(F.broadcast(ids) if few else ids, df[id_col] == F.col("_gone"), "left_anti")

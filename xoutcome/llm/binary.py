"""Token ids in a binary file format: fixed-size blocks of ids, bits transposed to planes, each plane compressed.

Format. The store is a folder of Parquet files whose rows are chunks: ``shard`` (documents in ascending id order run
through the shards in order), ``chunk`` (number within the shard), ``n_ids``, ``plane_bytes`` (the compressed size of
each plane, so that single planes can be read), ``payload`` (the planes' zstandard frames, highest bit first), and
the chunk index: ``doc_ids``, ``doc_starts`` and ``doc_lengths`` of the documents that begin in the chunk, counted
from the shard's first id, and ``open_start``, the start of the document that runs into it. Every chunk but a shard's last holds ``CHUNK_IDS`` ids.

Spark's writer commits the files, so a lost executor leaves no half-written chunk behind.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from xoutcome.llm.common import column_bytes, shuffle_partitions, texts
from xoutcome.llm.words import encoder, vocabulary_path
from xoutcome.session import fresh_path

CHUNK_IDS = 1 << 16
CHUNKS = ("shard int, chunk int, n_ids int, plane_bytes array<int>, payload binary, doc_ids array<long>, "
          "doc_starts array<long>, doc_lengths array<long>, open_start long")
FIELDS = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("plane_bytes", pa.list_(pa.int32())),
                    ("payload", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("doc_starts", pa.list_(pa.int64())),
                    ("doc_lengths", pa.list_(pa.int64())), ("open_start", pa.int64())])


def to_planes(ids: np.ndarray) -> list[bytes]:
    """The bit planes of 32-bit ids from the highest set bit of the block down to bit 0, each one compressed."""
    top = int(ids.max()).bit_length() if len(ids) else 0
    low = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    press = zstandard.ZstdCompressor(level=1).compress
    bits = [np.unpackbits(np.ascontiguousarray(low[:, i])).reshape(-1, 8).T for i in range(-(-top // 8))]
    return [press(np.packbits(bits[b // 8][7 - b % 8]).tobytes()) for b in range(top - 1, -1, -1)]


def from_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block again."""
    ids = np.zeros(n, np.uint32)
    open_ = zstandard.ZstdDecompressor().decompress
    for plane in planes:
        ids <<= 1
        ids |= np.unpackbits(np.frombuffer(open_(plane), np.uint8), count=n)
    return ids


def write_ids(df: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              vocabulary: str | None = None, chunk_ids: int = CHUNK_IDS, shards: int | None = None) -> None:
    """Encode whole texts, append ``end_id`` to each, and write them in ascending id order.

    A range shuffle by id makes the shards; each is encoded and cut into chunks as a stream. A null text is empty
    (the end id only), rows without an id come first, repeated ids stay repeated.
    """
    vocabulary = vocabulary or vocabulary_path()
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, code = TaskContext.get().partitionId(), encoder(vocabulary)
        chunk = at = 0
        held = bytearray()
        begun: list[tuple] = []
        last: tuple = (None, 0, 0)

        def cut(size: int) -> pa.RecordBatch:
            nonlocal chunk, last
            ids = np.frombuffer(bytes(held[:4 * size]), "<u4")
            del held[:4 * size]
            stop = chunk * chunk_ids + size
            mine = [d for d in begun if d[1] < stop]
            begun[:] = [d for d in begun if d[1] >= stop]
            planes = to_planes(ids)
            runs_on = last[1] + last[2] > chunk * chunk_ids
            row = (shard, chunk, size, [len(p) for p in planes], b"".join(planes), *([d[k] for d in mine] for k in range(3)),
                   last[1] if runs_on else None)
            last = mine[-1] if mine else last
            chunk += 1
            return pa.RecordBatch.from_pylist([dict(zip(FIELDS.names, row))], schema=FIELDS)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                ids = code.text(text) + end
                begun.append((doc_id, at, len(ids) // 4))
                at += len(ids) // 4
                held += ids
                while len(held) >= 4 * chunk_ids:
                    yield cut(chunk_ids)
        if held:
            yield cut(len(held) // 4)

    spark = df.sparkSession
    ordered = texts(df, id_col, text_col).repartitionByRange(shards or shuffle_partitions(spark), "doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, CHUNKS).write.option("compression", "uncompressed").parquet(path)


PIECES = pa.schema([("shard", pa.int32()), ("at", pa.int64()), ("chunk", pa.int32()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()),
                    ("crc", pa.int64()), ("ids", pa.binary())])


def read_ids(spark: SparkSession, path: str, chunk_ids: int = CHUNK_IDS, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document from the files; ``start`` counts all ids before it.

    Chunks are read on their own; only a document that runs over several chunks is put together from pieces.
    Without ``with_ids`` the column ``ids`` is left out, and documents inside one chunk send a checksum only.
    """
    chunks = spark.read.schema(CHUNKS).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sizes = np.cumsum([0, *r["plane_bytes"]])
                ids = from_planes([r["payload"][a:b] for a, b in zip(sizes[:-1], sizes[1:])], r["n_ids"]).astype("<u4")
                first, rows = r["chunk"] * chunk_ids, []
                if r["open_start"] is not None:
                    head = r["doc_starts"][0] - first if r["doc_starts"] else len(ids)
                    rows.append((r["shard"], r["open_start"], r["chunk"], None, None, None, ids[:head].tobytes()))
                for doc, start, n in zip(r["doc_ids"], r["doc_starts"], r["doc_lengths"]):
                    mine = ids[start - first:start - first + n].tobytes()
                    whole = len(mine) == 4 * n
                    rows.append((r["shard"], start, r["chunk"], doc, n, zlib.crc32(mine) if whole else None,
                                 mine if with_ids or not whole else None))
                yield pa.RecordBatch.from_pylist([dict(zip(PIECES.names, x)) for x in rows], schema=PIECES)

    pieces = chunks.mapInArrow(run, "shard int, at long, chunk int, doc_id long, n_tokens long, crc long, ids binary")
    parts = F.array_sort(F.collect_list(F.when(F.col("ids").isNotNull(), F.struct("chunk", "ids"))))
    whole = pieces.groupBy("shard", "at").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("crc").alias("crc"), parts.alias("parts"))
    ids = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    sums = chunks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = sums.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("before"))
    return whole.join(before, "shard").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens",
        F.coalesce("crc", F.crc32(ids)).alias("ids_crc32"), *([ids.alias("ids")] if with_ids else []))


def round_trip(df: DataFrame, end_id: int = 2) -> DataFrame:
    """Write the ids of all documents and read their places and checksums back from the files."""
    path = fresh_path(df.sparkSession, "token-ids")
    write_ids(df, path, end_id)
    return read_ids(df.sparkSession, path, with_ids=False)

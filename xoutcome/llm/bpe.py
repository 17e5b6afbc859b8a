"""BPE encoding and decoding through a table of distinct words.

Three steps, each one Spark shuffle of packed arrays at most:

1. ``word_lists`` and ``word_numbers`` cut texts into words. A block of documents has a list of its distinct words
   and, for each document, the positions' word numbers. Both come from a read of their own, which costs less than
   storing the numbers; a block's name is a digest of its texts, so that rows in another order are noticed.
2. ``encode_words`` brings the word lists of all blocks together by word hash, so that each distinct word is
   encoded once in the whole corpus, and returns to each block the ids of its words.
3. ``join_ids`` joins them back by position. ``decode`` joins ids to the vocabulary's pieces.

A frequent word has one entry per block, however often it occurs, and a bucket of words grows with the number of
distinct words only. Null texts are empty texts: no ids. Repeated rows stay repeated. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import blocks, pack, ragged, shuffle_partitions, texts, unpack
from xoutcome.llm.words import encoder, vocabulary_path

BLOCK_BYTES = 8 << 20
PARTS_KEPT = 20_000  # parts of words that a worker remembers; few come again, as each distinct word is encoded once
NO_ID = -(1 << 63)  # stands for a null id inside packed rows
NUMBERED = "block string, doc_ids array<long>, n_words array<long>, payload binary, buckets binary"
ENCODED = "block string, bucket int, payload binary"
IDS = "doc_id long, n_tokens long, ids binary, decoded binary"


def _block(held: list[bytes]) -> tuple[str, list[bytes], list[int], np.ndarray]:
    """Name (a digest of the texts), distinct words by falling frequency, words per text, word numbers of a block."""
    name = hashlib.blake2b(digest_size=16)
    numbers: dict[bytes, int] = {}
    add, counts, codes = numbers.setdefault, [], []
    for text in held:
        name.update(len(text).to_bytes(8, "little") + text)
        words = text.split()
        counts.append(len(words))
        codes += [add(w, len(numbers)) for w in words]
    flat = np.array(codes, np.int64)
    order = np.argsort(-np.bincount(flat, minlength=len(numbers)), kind="stable")
    rank = np.empty(len(numbers), np.uint32)
    rank[order] = np.arange(len(numbers), dtype=np.uint32)
    words = list(numbers)
    return name.hexdigest(), [words[i] for i in order.tolist()], counts, rank[flat]


def word_lists(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, bucket, payload): the distinct words of every block, by bucket of the word's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6).compress
        for _, held in blocks(batches, block_bytes):
            block, words, _, _ = _block(held)
            by: dict[int, list[bytes]] = {}
            for w in words:
                by.setdefault(zlib.crc32(w) % buckets, []).append(w)
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(by)), pa.array(list(by), pa.int32()),
                                              pa.array([press(b"\n".join(v)) for v in by.values()], pa.binary())],
                                             names=["block", "bucket", "payload"])
    return docs.mapInArrow(run, ENCODED)


def word_numbers(docs: DataFrame, buckets: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: its documents, their numbers of words, and the places of their words in the block's ids.

    Words are counted as ``encode_words`` returns them: bucket by bucket, each bucket in the order of its list.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in blocks(batches, block_bytes):
            block, words, counts, codes = _block(held)
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.uint32, len(words))
            yield pa.RecordBatch.from_arrays([
                pa.array([block]), pa.array([[NO_ID if i is None else i for i in ids]], pa.list_(pa.int64())), pa.array([counts], pa.list_(pa.int64())),
                pa.array([pack(codes)], pa.binary()), pa.array([pack(bucket)], pa.binary())],
                names=["block", "doc_ids", "n_words", "payload", "buckets"])
    return docs.mapInArrow(run, NUMBERED)


def encode_words(words: DataFrame, path: str) -> DataFrame:
    """For each block and bucket the ids of its words: lengths, then ids. A distinct word is encoded once."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        code = encoder(path, PARTS_KEPT)
        ids: dict[bytes, bytes] = {}
        out = []
        for data in group["payload"]:
            mine = zstandard.ZstdDecompressor().decompress(data).split(b"\n")
            for w in mine:
                if w not in ids:
                    ids[w] = code.word(w)
            found = [ids[w] for w in mine]
            lengths = np.fromiter((len(x) // 4 for x in found), np.uint32, len(found))
            flat = np.frombuffer(b"".join(found), "<u4")
            flat = flat.astype(np.uint16) if not len(flat) or flat.max() < 1 << 16 else flat
            sizes = pack(lengths)
            out.append(np.array([len(sizes), flat.itemsize], "<u4").tobytes() + sizes + pack(flat))
        return pd.DataFrame({"block": group["block"], "bucket": group["bucket"], "payload": out})
    return words.groupBy("bucket").applyInPandas(run, ENCODED)


def decode(ids: np.ndarray, pieces: np.ndarray) -> bytes:
    """The text of ids: the id-to-piece join, pieces set apart by one space as the library does without a decoder."""
    return b" ".join(pieces[ids].tolist())


def join_ids(numbered: DataFrame, encoded: DataFrame, path: str, decoded: bool = True) -> DataFrame:
    """The ids of each document, its words' ids joined back by position, and the text that they decode to."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        lengths, flats = [], []
        for data in right.drop_duplicates("bucket").sort_values("bucket")["payload"]:
            size, width = np.frombuffer(data[:8], "<u4").tolist()
            lengths.append(unpack(data[8:8 + size], np.uint32))
            flats.append(unpack(data[8 + size:], np.uint16 if width == 2 else np.uint32).astype("<u4"))
        by_bucket = np.concatenate(lengths).astype(np.int64) if lengths else np.empty(0, np.int64)
        flat = np.concatenate(flats) if flats else np.empty(0, "<u4")
        pieces = encoder(path, PARTS_KEPT).pieces() if decoded else None
        rows = []
        for doc_ids, counts, payload, buckets in zip(left["doc_ids"], left["n_words"], left["payload"], left["buckets"]):
            order = np.argsort(unpack(buckets, np.uint32), kind="stable")
            if len(order) != len(by_bucket):
                raise RuntimeError("the rows came in another order on a second read; pass a stored table")
            length, start = np.empty_like(by_bucket), np.empty_like(by_bucket)
            length[order], start[order] = by_bucket, np.cumsum(by_bucket) - by_bucket
            codes, at = unpack(payload, np.uint32), 0
            for doc_id, n in zip(doc_ids, counts):
                mine = codes[at:at + n]
                at += n
                ids = flat[ragged(start[mine], length[mine])]
                rows.append((None if doc_id == NO_ID else int(doc_id), len(ids), ids.tobytes(), decode(ids, pieces) if decoded else None))
        out = {name: [r[k] for r in rows] for k, name in enumerate(("doc_id", "n_tokens", "ids", "decoded"))}
        return pd.DataFrame(out | {"doc_id": pd.array(out["doc_id"], "Int64")})
    return numbered.groupBy("block").cogroup(encoded.groupBy("block")).applyInPandas(run, IDS)


def bpe(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, decoded: bool = True,
        buckets: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Ids (little-endian unsigned 32-bit) and decoded text (UTF-8) of every row.

    ``buckets`` is the number of parts of the word table; the default is the session's number of shuffle partitions.
    Smaller blocks (``block_bytes`` of text) take less memory in a task and list a word in more blocks; ids are the same.
    """
    path, buckets, docs = path or vocabulary_path(), buckets or shuffle_partitions(df.sparkSession), texts(df, id_col, text_col)
    return join_ids(word_numbers(docs, buckets, block_bytes), encode_words(word_lists(docs, buckets, block_bytes), path), path, decoded)


def digests(df: DataFrame, **limits) -> DataFrame:
    """The digest columns of the registered query."""
    return bpe(df, **limits).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))

"""Removal of repeated byte strings by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. The corpus is too large for one
suffix array, and need not have one: equal strings have equal anchors (``winnow``), so that only runs of windows with
a common anchor can hold them.

1. ``run_table``: every text's runs, each with its anchor's hash and a hash of the run's bytes.
2. Anchors met once are done. Where all runs of an anchor have equal bytes, all their windows are repeated.
3. Of the other anchors each distinct run is taken once, with its bytes, and suffix arrays over buckets of whole
   anchors tell which windows of a run that occurs once are found in another run.
4. An anchor with more than ``HOT_BYTES`` of distinct runs would not fit a bucket; its windows are counted one by one
   by their distance from the anchor and their hash, with partial sums.
5. Each text loses what its repeated windows cover.

Equality of whole runs is judged under equal 64-bit anchors by another 64-bit hash, all else by bytes. Null texts are
empty. Rows are told apart by a 64-bit hash of id and text, so that unlike texts under one id, or without one, are judged
each for itself; rows that repeat both count as two texts. Other columns are left behind. An empty table gives no rows.
``length`` and ``gram`` are parameters of all steps; ``rewritten`` can leave runs of few words alone.

With ``passage_words`` texts are also told by the passages of so many words that stand elsewhere too, most of which are
shorter than ``LENGTH``. All strings of 2 * words - 1 bytes, the least that so many words have, are compared. A repeated
string of ``LENGTH`` bytes is made of repeated shorter ones, so that it can only be in the spans that these cover: the
long strings are then looked for in those spans alone, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm import winnow
from xoutcome.llm.common import column_bytes, ragged, texts
from xoutcome.llm.suffixes import repeated
from xoutcome.session import stored

LENGTH = winnow.LENGTH
PASSAGE_WORDS = 51
BUCKET_BYTES = 1 << 20
HOT_BYTES = 8 << 20
BROADCAST_IDS = 1_000_000
RUN = "key long, first long, last long, distance int, anchor long, content long"


def _batched(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def run_table(docs: DataFrame, length: int = LENGTH, gram: int = winnow.GRAM) -> DataFrame:
    """All runs: first and last window start, distance of the anchor from the first one, hashes of anchor and bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(batches):
            keys = np.array(batch.column(0).to_pylist(), np.int64)
            for data, number, shift, first, last, at, anchor in winnow.runs(column_bytes(batch.column(1)), length, gram):
                view = memoryview(data)
                content = np.array([xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (last + length).tolist())],
                                   np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (keys[number], first + shift, last + shift, (at - first).astype(np.int32), anchor, content)],
                    names=["key", "first", "last", "distance", "anchor", "content"])
    return docs.mapInArrow(run, RUN)


def with_bytes(members: DataFrame, docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The members with the bytes that their windows cover; texts are read once, and only of ids that occur."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(batches, 200):
            rows = []
            for text, key, items in zip(column_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows += [(m["bucket"], m["anchor"], key, m["first"], m["distance"], m["n"], text[m["first"]:m["last"] + length]) for m in items]
            yield pa.RecordBatch.from_pylist([dict(zip(_MEMBER.names, r)) for r in rows], schema=_MEMBER)
    by_text = members.groupBy("key").agg(F.collect_list(F.struct("bucket", "anchor", "first", "last", "distance", "n")).alias("items"))
    by_text = stored(by_text, "members")
    few = by_text.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # 8 MB of ids at most; else shuffled
    ids = by_text.select("key")
    own = docs.join(F.broadcast(ids) if few else ids, "key", "left_semi").dropDuplicates(["key"])
    return own.join(by_text, "key").select("text", "key", "items").mapInArrow(
        run, "bucket long, anchor long, key long, first long, distance int, n long, data binary")


_MEMBER = pa.schema([("bucket", pa.int64()), ("anchor", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("distance", pa.int32()),
                     ("n", pa.int64()), ("data", pa.binary())])


def _spans(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive numbers."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])]


def by_suffix_arrays(members: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, first, last) of the repeated windows of members that occur once, from one suffix array per bucket."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, first, n, starts in zip(group["key"], group["first"], group["n"], repeated(group["data"].tolist(), length)):
            if n == 1 and len(starts):
                out += [(key, first + a, first + b) for a, b in zip(*_spans(starts))]
        return pd.DataFrame(out, columns=["key", "first", "last"]).astype("int64")
    return members.select("bucket", "key", "first", "n", "data").groupBy("bucket").applyInPandas(run, "key long, first long, last long")


def by_window_counts(members: DataFrame, length: int = LENGTH) -> DataFrame:
    """The same for anchors with too many distinct runs: every window is counted by distance and hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(batches, 200):
            anchor, key, first, distance = (np.array(batch.column(i).to_pylist(), np.int64) for i in range(4))
            data = batch.column(4).to_pylist()
            sizes = np.array([len(d) - length + 1 for d in data], np.int64)
            start = ragged(np.zeros(len(sizes), np.int64), sizes)
            own = np.repeat(np.arange(len(sizes)), sizes)
            hashes = np.array([xxhash.xxh3_64_intdigest(d[i:i + length]) for d, n in zip(data, sizes.tolist()) for i in range(n)], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                anchor[own], distance[own] - start, hashes.view(np.int64), key[own], first[own] + start)],
                names=["anchor", "distance", "window", "key", "first"])
    windows = members.select("anchor", "key", "first", "distance", "data").mapInArrow(
        run, "anchor long, distance long, window long, key long, first long")
    same = ["anchor", "distance", "window"]
    return windows.join(windows.groupBy(*same).count().where("count > 1"), same).select("key", "first", F.col("first").alias("last"))


def repeated_windows(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, hot_bytes: int = HOT_BYTES, length: int = LENGTH,
                     gram: int = winnow.GRAM) -> DataFrame:
    """(key, first, last) of window starts whose string starts elsewhere too; spans of one text may be many."""
    table = stored(run_table(docs, length, gram), "runs")
    shared = table.groupBy("anchor").agg(F.count(F.lit(1)).alias("times"), (F.min("content") != F.max("content")).alias("open")).where("times > 1")
    shared = stored(shared, "anchors")  # as a table, so that Spark may split the join's large partitions
    met = stored(table.join(shared.select("anchor", "open"), "anchor"), "shared-runs")
    span = ["key", "first", "last"]
    decided = met.where("not open").select(span)
    unsure = met.where("open").drop("open")
    # Of equal runs of an anchor one goes on; of all of them the windows are repeated.
    contents = stored(unsure.groupBy("anchor", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "first", "last", "distance")).alias("one")).select("anchor", "content", "n", "one.*"), "contents")
    equal = unsure.join(contents.where("n > 1").select("anchor", "content"), ["anchor", "content"]).select(span)
    size = (F.col("last") - F.col("first") + length).alias("size")
    sizes = stored(contents.groupBy("anchor").agg(F.sum(size).alias("bytes"), F.min("n").alias("least")).where("least = 1"), "anchors")
    total, most = sizes.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.max("bytes"), F.lit(0))).first()
    buckets = max(1, -(-total // bucket_bytes))
    hot = F.col("bytes") > hot_bytes
    members = stored(with_bytes(contents.join(sizes, "anchor").withColumn("bucket", F.when(hot, F.lit(-1).cast("long")).otherwise(
        F.pmod(F.xxhash64("anchor"), F.lit(buckets)))), docs, length), "members")
    found = by_suffix_arrays(members.where("bucket >= 0"), length)
    if most > hot_bytes:
        found = found.union(by_window_counts(members.where("bucket = -1"), length))
    return decided.union(equal).union(found)


def _key(id_col: str, text_col: str):
    return F.xxhash64(F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))


def window_lists(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """First and last window starts of each row of a list column; a null list has none."""
    column = column.fill_null([]) if column.null_count else column
    first, last = (x.to_numpy(zero_copy_only=False) for x in column.flatten().flatten())
    ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
    return [(first[a:b], last[a:b]) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def covered(windows: tuple[np.ndarray, np.ndarray], length: int) -> list[tuple[int, int]]:
    """Begin and end of the maximal runs of bytes that the windows cover."""
    first, last = windows
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(last[order] + length)
    new = np.flatnonzero(first[1:] > end[:-1])
    return list(zip(first[np.concatenate([[0], new + 1])].tolist(), end[np.concatenate([new, [len(end) - 1]])].tolist()))


def cut(text: bytes, windows: tuple[np.ndarray, np.ndarray], length: int = LENGTH, least_words: int = 0) -> tuple[bytes, int, int]:
    """The text without what the windows cover, the number of bytes gone, and of their maximal runs; a run stays if it
    holds fewer than ``least_words`` words."""
    runs = covered(windows, length)
    if least_words:
        runs = [r for r in runs if len(text[r[0]:r[1]].split()) >= least_words]
    parts, at = [], 0
    for first, last in runs:
        parts.append(text[at:first])
        at = last
    parts.append(text[at:])
    return b"".join(parts), sum(b - a for a, b in runs), len(runs)


def _by_key(windows: DataFrame) -> DataFrame:
    return windows.groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("windows"))


def passages(docs: DataFrame, words: int, least: int) -> DataFrame:
    """(key, n_passages, n_passage_bytes, parts) of the texts with repeated strings of 2 * words - 1 bytes.

    A passage is a maximal run of bytes that those strings cover, with ``words`` words or more. ``parts`` are the runs of
    ``least`` bytes or more, whatever their words. Rows that repeat are there repeatedly.
    """
    length = 2 * words - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(batches, 200):
            rows = []
            for text, key, windows in zip(column_bytes(batch.column(0)), batch.column(1).to_pylist(), window_lists(batch.column(2))):
                runs = covered(windows, length)
                sizes = [b - a for a, b in runs if len(text[a:b].split()) >= words]
                rows.append({"key": key, "n_passages": len(sizes), "n_passage_bytes": sum(sizes),
                             "parts": [{"first": a, "data": text[a:b]} for a, b in runs if b - a >= least]})
            yield pa.RecordBatch.from_pylist(rows, schema=_PASSAGES)
    found = stored(_by_key(repeated_windows(docs, length=length, gram=length // 4)), "short-windows")
    few = found.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS  # 8 MB of ids at most; else shuffled
    own = docs.join(F.broadcast(found.select("key")), "key", "left_semi") if few else docs
    return own.join(found, "key").select("text", "key", "windows").mapInArrow(
        run, "key long, n_passages long, n_passage_bytes long, parts array<struct<first: long, data: binary>>")


_PASSAGES = pa.schema([("key", pa.int64()), ("n_passages", pa.int64()), ("n_passage_bytes", pa.int64()),
                       ("parts", pa.list_(pa.struct([("first", pa.int64()), ("data", pa.binary())])))])


def _windows_and_passages(docs: DataFrame, words: int, **limits) -> DataFrame:
    """(key, windows, n_passages, n_passage_bytes): the repeated windows of ``length``, looked for in the passages' parts."""
    length = limits.get("length", LENGTH)
    if length < 2 * words - 1:
        raise ValueError("strings shorter than the passages are not all inside them")
    found = stored(passages(docs, words, length), "passages")
    parts = found.select(F.col("key").alias("text_key"), F.explode("parts").alias("part")).select(
        "text_key", F.col("part.first").alias("begin"), F.col("part.data").alias("text")).withColumn("key", F.xxhash64("text_key", "begin"))
    places = parts.select("key", "text_key", "begin").distinct()
    windows = _by_key(repeated_windows(parts.select("key", "text"), **limits).join(places, "key").select(
        F.col("text_key").alias("key"), (F.col("first") + F.col("begin")).alias("first"), (F.col("last") + F.col("begin")).alias("last")))
    return found.select("key", "n_passages", "n_passage_bytes").distinct().join(windows, "key", "left")


def _with_windows(df: DataFrame, id_col: str, text_col: str, passage_words: int = 0, **limits) -> DataFrame:
    docs = texts(df, id_col, text_col).select(_key("doc_id", "text").alias("key"), "text")
    windows = stored(_windows_and_passages(docs, passage_words, **limits) if passage_words else _by_key(repeated_windows(docs, **limits)), "windows")
    return df.select(F.struct("*").alias("row"), _key(id_col, text_col).alias("key")).join(windows, "key", "left").drop("key")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", passage_words: int = 0, **limits) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept) per row; ``kept`` has the remaining bytes one after the other.

    With ``passage_words`` also n_passages and n_passage_bytes: the passages of so many words or more that stand elsewhere
    too, and their bytes. They tell of the text and take nothing out of it.
    """
    more = ["n_passages", "n_passage_bytes"] if passage_words else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(batches):
            texts_ = column_bytes(batch.column(1))
            rows = [cut(t, w, limits.get("length", LENGTH)) for t, w in zip(texts_, window_lists(batch.column(2)))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(map(len, texts_), pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.int64()), pa.array([r[0] for r in rows], pa.binary()),
                *(batch.column(3 + k) for k in range(len(more)))],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", *more])
    own = texts(df, id_col, text_col)
    return _with_windows(own, "doc_id", "text", passage_words, **limits).select(
        "row.doc_id", "row.text", "windows", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in more)).mapInArrow(
        run, ", ".join(["doc_id long, n_bytes long, n_removed long, n_spans long, kept binary", *(f"{c} long" for c in more)]))


def rewritten(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars", least_words: int = 0,
              **limits) -> DataFrame:
    """All rows and columns, with what stays of each text in the text column and its code points in ``chars_col``.

    Repeated runs of fewer than ``least_words`` words stay.

    Where a cut goes through a character, what is left of the character goes too.
    """
    names, schema = df.columns, df.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _batched(batches):
            columns = dict(zip(names, batch.columns))
            kept = [None if t is None else cut(t, w, limits.get("length", LENGTH), least_words)[0].decode("utf-8", "ignore")
                    for t, w in zip(column_bytes(columns[text_col]), window_lists(batch.column(len(names))))]
            columns[text_col] = pa.array(kept, columns[text_col].type)
            if chars_col in columns:
                columns[chars_col] = pa.array([len(t or "") for t in kept], columns[chars_col].type)
            yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)
    return _with_windows(df, id_col, text_col, **limits).select("row.*", "windows").mapInArrow(run, schema)


def digests(df: DataFrame) -> DataFrame:
    """The digest columns of the registered query, and the repeated passages of more than 50 words."""
    return remove_repeats(df, passage_words=PASSAGE_WORDS).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "n_passages", "n_passage_bytes")

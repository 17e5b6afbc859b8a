"""Ranked lexical search, term at a time with a limited number of accumulators.

Items (queries) are taken in blocks of ``ITEM_BYTES`` of text, whose terms are the vocabulary of a block. For each:

1. ``postings``: every block of documents becomes one row with its documents' ids and lengths and, term by term, the
   documents that hold a term with its occurrences; terms that no item asks for only count towards the lengths.
2. Numbers of documents and terms, and documents per term, by sums inside tasks and then over them.
3. ``ranked``: in a block of documents an item's terms are met from the rarest on. A document met for the first time
   gets an accumulator as long as the bounds of the terms still to come - per term its weight times its largest share in
   the block - reach the ``k``-th best score: of the partial scores in the block, or of the whole scores that the task
   has from earlier blocks. Beyond that no accumulator is made, and the present ones are updated to their exact scores.
   A task keeps ``k`` documents an item, and the best of all tasks meet in a top-k by item.

A document that is refused an accumulator can't reach the k-th score, not even tie with it, so results are exact. No
term's list is shuffled or gathered: however frequent a term is, a task holds only one block of documents.

A score is a sum of 64-bit integers as the contract of the registered query states; ``share`` has the formula. Null and
empty texts and texts without terms are no documents; items without terms find nothing. Repeated rows are documents each
and rank next to each other. Documents without an id rank after others of equal score. Repeated rows of items are
one item; unlike texts under one item id are ranked each for itself. Empty tables give no rows. Other columns are left
behind. Term numbers of a document times all documents times 25 must stay below 2^63.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import blocks, pack, texts, unpack
from xoutcome.operators.rank import top_rows
from xoutcome.session import stored

BEST = 20
ITEM_BYTES = 4 << 20
BLOCK_BYTES = 16 << 20
NO_ID = (1 << 63) - 1  # sorts after all ids
_KEPT = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_TABLE = bytes(c if c in _KEPT else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    """Runs of digits, letters and whatever is not ASCII, A-Z lower-cased."""
    return text.translate(_TABLE).split()


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def share(tf: np.ndarray, length: np.ndarray, n: int, total: int) -> np.ndarray:
    """What a term's occurrences in a document of ``length`` terms are worth before its weight."""
    m = 100 - 25 + (25 * length * n) // total
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """One row per block of documents: ids, lengths, and (term, document, occurrences) by term, packed."""
    held = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})  # ITEM_BYTES of text at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = held.value.get
        for ids, texts_ in blocks(batches, BLOCK_BYTES):
            own, lengths, codes, hits = [], [], [], []
            for i, text in zip(ids, texts_):
                found = terms(text)
                if found:
                    known = [c for c in map(place, found) if c is not None]
                    own.append(NO_ID if i is None else i)
                    lengths.append(len(found))
                    codes += known
                    hits.append(len(known))
            if not own:
                continue
            keys = np.array(codes, np.int64) * len(own) + np.repeat(np.arange(len(own)), hits)
            keys, times = np.unique(keys, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([pack(x)], pa.binary()) for x in (
                np.array(own, "<i8"), np.array(lengths, "<i8"), (keys // len(own)).astype("<u4"), (keys % len(own)).astype("<u4"),
                times.astype("<u4"))], names=["ids", "lengths", "term", "doc", "tf"])
    return docs.mapInArrow(run, "ids binary, lengths binary, term binary, doc binary, tf binary")


def _read(batches: Iterator[pa.RecordBatch], kinds: tuple[str, ...]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield [unpack(batch.column(j)[k].as_py(), kind) for j, kind in enumerate(kinds)]


def counts(posted: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents, terms with repeats, and documents per term of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = total = 0
        df = np.zeros(0, np.int64)
        for lengths, term in _read(batches, ("<i8", "<u4")):
            n, total = n + len(lengths), total + int(lengths.sum())
            more = np.bincount(term, minlength=len(df))
            more[:len(df)] += df
            df = more
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, -2, *at.tolist()], pa.int64()), pa.array([n, total, *df[at].tolist()], pa.int64())], names=["term", "n"])
    rows = posted.select("lengths", "term").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in rows.collect()}  # one row per term of the items' block
    return found.pop(-1, 0), found.pop(-2, 0), found


class Block:
    """The postings of one block of documents, with the share of each posting and the largest share of each term."""

    def __init__(self, ids, lengths, term, doc, tf, n: int, total: int):
        self.ids, self.doc = ids, doc.astype(np.int64)
        self.share = share(tf.astype(np.int64), lengths[self.doc], n, total) if len(doc) else np.empty(0, np.int64)
        first = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.empty(0, np.int64)
        self.spans = dict(zip(term[first].tolist(), zip(first.tolist(), np.append(first[1:], len(term)).tolist())))
        self.largest = dict(zip(term[first].tolist(), np.maximum.reduceat(self.share, first).tolist())) if len(first) else {}

    def scores(self, wanted: list[tuple[int, int]], reach: int, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and exact scores of the documents with an accumulator, and how many were refused one.

        ``wanted`` are the terms with their weights, rarest first; ``reach`` is a score that k documents have already.
        """
        wanted = [(t, w) for t, w in wanted if t in self.spans]
        bounds = np.cumsum([w * self.largest[t] for t, w in reversed(wanted)])[::-1].tolist()
        total, has = np.zeros(len(self.ids), np.int64), np.zeros(len(self.ids), bool)
        making, made, refused = True, 0, 0
        for (t, w), rest in zip(wanted, bounds):
            a, b = self.spans[t]
            doc, add = self.doc[a:b], w * self.share[a:b]
            if making and made >= k and rest >= reach:
                reach = max(reach, int(np.partition(total, -k)[-k]))
            making = making and rest >= reach
            if making:
                has[doc] = True
                made = int(has.sum()) if made < k else made
            else:
                old = has[doc]
                refused += len(old) - int(old.sum())
                doc, add = doc[old], add[old]
            total[doc] += add
        at = np.flatnonzero(has & (total > 0) & (total >= reach))
        return self.ids[at], total[at], refused


def ranked(posted: DataFrame, items: list[tuple], vocabulary: list[bytes], item_type: str, k: int = BEST) -> DataFrame:
    """(item_id, item, doc_id, score): the best k documents of each item in every task."""
    n, total, df = counts(posted)
    place = {t: i for i, t in enumerate(vocabulary)}
    asked = []
    for item_id, text in items:
        times: dict[int, int] = {}
        for t in terms(text.encode()):
            times[place[t]] = times.get(place[t], 0) + 1
        met = sorted((t for t in times if t in df), key=lambda t: (df[t], t))
        asked.append((item_id, [(t, times[t] * weight(n, df[t])) for t in met]))
    held = posted.sparkSession.sparkContext.broadcast(asked)  # ITEM_BYTES of text at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in held.value]
        for parts in _read(batches, ("<i8", "<i8", "<u4", "<u4", "<u4")):
            block = Block(*parts, n, total)
            for i, (_, wanted) in enumerate(held.value):
                ids, scores = best[i]
                new_ids, new_scores, _ = block.scores(wanted, int(scores[-1]) if len(scores) == k else 0, k)
                if len(new_ids):
                    ids, scores = np.concatenate([ids, new_ids]), np.concatenate([scores, new_scores])
                    order = np.lexsort((ids, -scores))[:k]
                    best[i] = ids[order], scores[order]
        sizes = [len(ids) for ids, _ in best]
        names = [x for (item_id, _), size in zip(held.value, sizes) for x in [item_id] * size]
        if names:
            yield pa.RecordBatch.from_arrays([
                pa.array(names), pa.array(np.repeat(np.arange(len(best)), sizes), pa.int64()),
                pa.array(np.concatenate([ids for ids, _ in best]), pa.int64()), pa.array(np.concatenate([s for _, s in best]), pa.int64())],
                names=["item_id", "item", "doc_id", "score"])
    return posted.mapInArrow(run, f"item_id {item_type}, item long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text: str = "text", item_bytes: int = ITEM_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of each item with the highest scores above 0.

    Items without an id are passed over.
    """
    docs = texts(documents, id_col, text_col)
    asked = stored(items.where(F.col(f"`{item_col}`").isNotNull()).select(
        F.col(f"`{item_col}`").alias("item_id"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text")).distinct(), "items")
    item_type = dict(asked.dtypes)["item_id"]
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // item_bytes))
    found = None
    for part in range(parts):
        own = [(r["item_id"], r["text"]) for r in asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()]
        vocabulary = sorted({t for _, text in own for t in terms(text.encode())})
        posted = stored(postings(docs, vocabulary), "postings")
        best = top_rows(ranked(posted, own, vocabulary, item_type, k), ["item"], [F.desc("score"), F.col("doc_id")], k, "rank")
        best = best.select("item_id", "rank", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "score")
        found = best if found is None else found.union(best)
    return found


_TERMS = "regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLE = f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
words AS (SELECT row, doc_id, unnest({_TERMS.format(text="text")}) AS term FROM d),
size AS (SELECT row, count(*) AS n FROM words GROUP BY row),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM size),
asked AS (SELECT item_id, term, count(*) AS times FROM (
  SELECT item_id, unnest({_TERMS.format(text="text")}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
tf AS (SELECT row, doc_id, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, total GROUP BY term, docs),
part AS (SELECT row, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // terms)) AS share
  FROM tf JOIN size USING (row), total),
score AS (SELECT item_id, row, doc_id, CAST(sum(times * w * share) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN part USING (term) GROUP BY item_id, row, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY rank <= {BEST}"""

"""Groups of spelling variants: one-edit neighbours by dynamic programming over sorted word lists.

1. ``word_counts``: the words of all texts with their occurrences, summed inside tasks before the shuffle.
2. ``near_words``: two words one edit apart, the shorter of m code points, share their first or their last m // 2 code
   points, whatever the edit. So each word stands in a list by its start and in one by its reversed end, once with the
   words of its length and the next, once with those of its length and the one before. Inside a task the lists are
   sorted, and equal starts of neighbours (their adjacent longest common prefixes) make a range of the list. A range has
   one band of the edit matrix for each asking word - the three cells beside the diagonal - which is made from the band
   of the range around it by one character and serves all words of the range. A range whose band exceeds one edit is not
   entered. A pair is told by one list only: by the one of starts if it can, else by the one of ends.
3. ``variants``: each word's form is its near word of largest count, if that is ``ratio`` times its own; chains of forms
   are followed to their end by doubling, so that a chain of n forms takes log2(n) joins.

A list of more than ``TILE`` words is cut by hash into parts, and each pair of parts is a task of its own, so that no
task grows with a list; all pairs are still found.

``noisy_words`` is the word rule of the registered query. Null and empty texts have no words; a word may be of any
length. Repeated rows count each. Rows without an id are hashed as if their id were an empty text. Ties of count go to
the least word in code-point order. An empty table gives no rows. Other columns are left behind.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import column_bytes, ragged, texts
from xoutcome.session import stored

LEAST = 7
RATIO = 10
TILE = 20_000
SLOT_ROWS = 200_000
HELD_BYTES = 32 << 20
RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST)
EVERY = 31


def noisy_words(doc_id: int | None, text: str) -> Counter:
    """The lower-cased letter runs of a text; one in 31, by crc32 of id and run, loses a letter."""
    seed = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    seed = zlib.crc32(b":", seed)
    out: Counter = Counter()
    for run, n in Counter(RUN.findall(text)).items():
        h = zlib.crc32(run.encode(), seed)
        if not h % EVERY:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < LEAST:
                continue
        out[run] += n
    return out


def word_counts(docs: DataFrame, words: Callable[[int | None, str], Counter] = noisy_words, least_n: int = 2) -> DataFrame:
    """(word, n) of all words met ``least_n`` times or more; ``words`` gets texts with A-Z lower-cased."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        size = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), column_bytes(batch.column(1))):
                for word, n in words(doc_id, text.lower().decode("utf-8", "replace")).items():
                    known = held.get(word)
                    if known is None:
                        size += 100 + len(word)
                        held[word] = n
                    else:
                        held[word] = known + n
                if size > HELD_BYTES:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()
    return docs.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _extended(grid: np.ndarray, asking: np.ndarray, lcp: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (asking, other) of a sorted grid of code points that are one edit apart; asking rows have m code points.

    ``lcp`` has the common prefix of each row with the one before. Ranges of depth d begin where it is below d.
    """
    depth = m // 2
    begin = np.flatnonzero(lcp < depth)
    of = np.searchsorted(begin, asking, "right") - 1
    some = np.diff(np.append(begin, len(grid)))[of] > 1
    q, node = asking[some], of[some]
    # Cells of the band for the range's prefix of d code points: against d - 1, d and d + 1 of the asking word.
    before, here, after = np.ones(len(q), np.uint8), np.zeros(len(q), np.uint8), np.ones(len(q), np.uint8)
    for d in range(depth, m):
        inner = np.flatnonzero(lcp < d + 1)
        first = np.searchsorted(inner, begin)
        inside = np.diff(np.append(first, len(inner)))[node]
        rep = np.repeat(np.arange(len(q)), inside)
        node = ragged(first[node], inside)
        c = grid[inner[node], d]
        q, before, here, after = q[rep], before[rep], here[rep], after[rep]
        before = np.minimum(before + (c != grid[q, d - 1]), here + 1) if d else here + np.uint8(1)
        straight = np.minimum(np.minimum(here + (c != grid[q, d]), after + 1), before + 1)
        after = np.minimum(after + (c != grid[q, d + 1]), straight + 1) if d + 1 < m else np.full(len(q), 2)
        alive = np.flatnonzero((before < 2) | (straight < 2) | (after < 2))
        q, node, begin = q[alive], node[alive], inner
        before, here, after = (np.minimum(x[alive], 2).astype(np.uint8) for x in (before, straight, after))
    inside = np.diff(np.append(begin, len(grid)))[node]
    rep = np.repeat(np.arange(len(q)), inside)
    row = ragged(begin[node], inside)
    q, before, here = q[rep], before[rep], here[rep]
    c = grid[row, m]
    longer = np.minimum(before + (c != grid[q, m - 1]), here + 1)
    near = np.where(c == 0, here, longer) == 1
    return q[near], row[near]


def _pairs(words: np.ndarray, asks: np.ndarray, m: int, ends: bool, chunk: int = 50_000) -> tuple[np.ndarray, np.ndarray]:
    """Places (asking, other) in ``words`` (of m or m + 1 code points, reversed if ``ends``) that are one edit apart."""
    order = np.argsort(words, kind="stable")
    grid = np.ascontiguousarray(words[order].astype(f"<U{m + 1}")).view(np.uint32).reshape(-1, m + 1)
    unlike = grid[1:] != grid[:-1]
    lcp = np.concatenate([[-1], np.where(unlike.any(axis=1), unlike.argmax(axis=1), m + 1)])
    asking = np.flatnonzero(asks[order])
    found = [_extended(grid, asking[at:at + chunk], lcp, m) for at in range(0, len(asking), chunk)]
    a, b = (np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(2))
    if ends and len(a):
        size = m // 2
        tail = np.arange(size)
        b_size = np.where(grid[b, m] == 0, m, m + 1)
        told = (grid[a][:, m - size:m] == grid[b[:, None], b_size[:, None] - size + tail]).all(axis=1)
        a, b = a[~told], b[~told]
    return order[a], order[b]


def _told(group: pd.DataFrame) -> pd.DataFrame:
    """(word, near, best_n, best): each word's number of near words in the lists of a group, and the best of them."""
    out = []
    for (ends, m), part in group.groupby(["ends", "m"], sort=False):
        text, n = part["text"].to_numpy().astype(str), part["n"].to_numpy()
        a, b = _pairs(text, part["asks"].to_numpy(), int(m), bool(ends))
        listed = part["listed"].to_numpy()[b]
        a, b = a[listed], b[listed]
        if not len(a):
            continue
        longer = np.char.str_len(text[b]) > m  # these do not ask in this list
        a, b = np.concatenate([a, b[longer]]), np.concatenate([b, a[longer]])
        names = np.array([t[::-1] for t in text.tolist()]) if ends else text
        place = np.empty(len(names), np.int64)
        place[np.argsort(names, kind="stable")] = np.arange(len(names))
        order = np.lexsort((place[b], -n[b], a))
        a, b = a[order], b[order]
        first = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
        out += zip(names[a[first]].tolist(), np.diff(np.append(first, len(a))).tolist(), n[b[first]].tolist(), names[b[first]].tolist())
    columns = list(zip(*out)) or [()] * 4
    return pd.DataFrame({k: pd.Series(v, dtype=t) for k, v, t in zip(("word", "near", "best_n", "best"), columns, (object, "int64", "int64", object))})


def near_words(words: DataFrame, least: int = LEAST, tile: int = TILE, slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have others at one edit; words have ``least`` code points."""
    size = F.length("word")
    rows = words.select("word", "n", F.explode(F.array(
        F.struct(size.alias("m"), F.lit(True).alias("asks")), F.struct((size - 1).alias("m"), F.lit(False).alias("asks")))).alias("of")).select(
        "word", "n", "of.*").where(F.col("m") >= least).withColumn("ends", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn(
        "text", F.when(F.col("ends") == 1, F.reverse("word")).otherwise(F.col("word"))).drop("word")
    rows = stored(rows.withColumn("list", F.xxhash64("ends", "m", F.expr("substring(text, 1, m div 2)"))), "lists")
    sizes = stored(rows.groupBy("list").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > tile), "long-lists")
    slots = max(1, -(-rows.count() // slot_rows))
    plain = ["ends", "m", "asks", F.lit(True).alias("listed"), "text", "n"]
    if sizes.isEmpty():
        dealt = rows.select(F.pmod("list", F.lit(slots)).alias("slot"), *plain)
    else:
        cut = rows.join(sizes, "list", "left").withColumn("parts", F.ceil(F.coalesce(F.col("size") / tile, F.lit(1.0))).cast("int"))
        cut = cut.withColumn("own", F.pmod(F.xxhash64("text"), F.col("parts")).cast("int"))
        usual = cut.where("size is null").select(F.pmod("list", F.lit(slots)).alias("slot"), *plain)
        # Task (i, j): words of part i ask those of part j.
        tiles = cut.where("size is not null").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        of = lambda i, j: F.xxhash64("list", i, j).alias("slot")
        asking = tiles.where("asks or own = other").select(of("own", "other"), "ends", "m", "asks", F.expr("own = other").alias("listed"), "text", "n")
        asked = tiles.where("own <> other").select(of("other", "own"), "ends", "m", F.lit(False).alias("asks"), F.lit(True).alias("listed"), "text", "n")
        dealt = usual.union(asking).union(asked)
    told = dealt.groupBy("slot").applyInPandas(_told, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return told.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b")).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: the end of the chain, by pointer doubling. Counts rise along a chain."""
    links = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = links.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = stored(links.join(further, F.col("root") == F.col("at"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        links = step.drop("moved")
        if step.where("moved").isEmpty():
            return links


def variants(words: DataFrame, ratio: int = RATIO, **limits) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``words`` (word, n), which is read twice."""
    near = near_words(words, **limits)
    held = F.col("best_n") >= ratio * F.col("n")
    table = stored(words.join(near, "word", "left").select(
        "word", F.when(held, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, F.col("best_n")).alias("form_n")), "forms")
    roots = _roots(table.where("form is not null"))
    return table.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The variants of the words of all texts of ``df``."""
    return variants(stored(word_counts(texts(df, id_col, text_col)), "words"))

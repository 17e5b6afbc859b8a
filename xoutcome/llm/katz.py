"""Katz backoff language model of any order: Good-Turing discounted n-grams that back off to the next shorter ones.

    P(w | h) = d(c) * c / c(h)              if the n-gram h w was seen c > 0 times in training,
             = alpha(h) * P(w | h')         if only h was,    P(w | h') otherwise; h' is h without its first word;
    P(w)     = (c(w) + 1) / (N + V + 1),    one class of unknown words included.

``d`` is the Good-Turing discount r* / r up to ``K`` with Katz's correction, 1 above it (where counts of counts give
none between 0 and 1, (r - 1/2) / r); each order has its own. ``alpha(h)`` makes the probabilities after h sum to
exactly 1; a history whose counts leave no mass has one added to its total. End tokens stand before the first word.
``order`` is a parameter; the registered query scores with bigrams, ``ORDER``.

Tables, all partitioned by hash and passed on as packed arrays:

1. distinct words of each block of documents, by word: one number and one training count for each word of the corpus;
2. training n-grams of each block, by history: counts of counts, which fix the discounts;
3. all positions of each block, by history: in a partition stand all n-grams of its histories, so that backoff weights
   and the probability of each position follow there; sums per document go back to the block.

Steps 2 and 3 are taken for bigrams, trigrams and so on up to ``order``. Below ``order`` step 3 returns the probabilities
of the block's n-grams, which the next longer ones back off to. Histories of several words go by a 63-bit hash.

A history with more than 1 / (2 * partitions) of the training tokens is dealt by n-gram instead; there are at most
2 * partitions of these, and the sums of their parts come with step 2.

Tokens are runs without ASCII white space after lower-casing A-Z, then one end. Null and empty texts have the end
only. Without training documents every probability is 1. Repeated rows are scored alike, rows without an id are
never trained on. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import blocks, pack, shuffle_partitions, texts, unpack
from xoutcome.llm.shingles import mixed
from xoutcome.session import stored

K = 5
ORDER = 2
HELD_OUT = 2
FOLDS = 7
BLOCK_BYTES = 8 << 20
END = b""  # no word is empty
NO_ID = -(1 << 63)  # stands for a null id inside packed rows
WORDS = "block string, bucket int, payload binary"
COUNTED = "block string, bucket int, payload binary, tokens long, kinds long"
NUMBERED = "block string, doc_ids array<long>, train binary, n_tokens array<long>, payload binary, buckets binary"
PAIRS = "block string, bucket int, payload binary"


def is_train(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS != HELD_OUT


def many(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers in one value, each as narrow as it may be."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        kind = next(t for t in ("u1", "<u2", "<u4", "<u8") if top <= np.iinfo(t).max)
        data = pack(a.astype(kind))
        out += [np.dtype(kind).itemsize.to_bytes(4, "little"), len(data).to_bytes(4, "little"), data]
    return b"".join(out)


def apart(data: bytes) -> list[np.ndarray]:
    out, at = [], 4
    for _ in range(int.from_bytes(data[:4], "little")):
        width, size = int.from_bytes(data[at:at + 4], "little"), int.from_bytes(data[at + 4:at + 8], "little")
        out.append(unpack(data[at + 8:at + 8 + size], f"<u{width}").astype(np.int64))
        at += 8 + size
    return out


def _block(ids: list, held: list[bytes]) -> tuple[str, list[bytes], np.ndarray, list[int], np.ndarray]:
    """Name, distinct words by falling frequency, training counts, tokens per text and word numbers of a block."""
    import hashlib
    name = hashlib.blake2b(repr(ids).encode(), digest_size=16)
    numbers: dict[bytes, int] = {}
    add, counts, codes = numbers.setdefault, [], []
    for text in held:
        name.update(len(text).to_bytes(8, "little") + text)
        words = text.lower().split()
        words.append(END)
        counts.append(len(words))
        codes += [add(w, len(numbers)) for w in words]
    flat = np.array(codes, np.int64)
    order = np.argsort(-np.bincount(flat, minlength=len(numbers)), kind="stable")
    rank = np.empty(len(numbers), np.int64)
    rank[order] = np.arange(len(numbers))
    words, flat = list(numbers), rank[flat]
    train = np.repeat([is_train(i) for i in ids], counts)
    return name.hexdigest(), [words[i] for i in order.tolist()], np.bincount(flat[train], minlength=len(words)), counts, flat


def word_lists(docs: DataFrame, buckets: int) -> DataFrame:
    """The distinct words and their training counts of every block, by bucket of the word's hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=6).compress
        for ids, held in blocks(batches, BLOCK_BYTES):
            block, words, train, _, _ = _block(ids, held)
            by: dict[int, list[int]] = {}
            for i, w in enumerate(words):
                by.setdefault(zlib.crc32(w) % buckets, []).append(i)
            rows = []
            for at in by.values():
                counts = many(train[at])
                rows.append(len(counts).to_bytes(4, "little") + counts + press(b"\n".join([words[i] for i in at])))
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(by)), pa.array(list(by), pa.int32()), pa.array(rows, pa.binary())],
                                             names=["block", "bucket", "payload"])
    return docs.mapInArrow(run, WORDS)


def count_words(lists: DataFrame, buckets: int) -> DataFrame:
    """For each block and bucket its words' numbers and training counts; a bucket's first row has the bucket's sums."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        bucket = int(group["bucket"].iat[0])
        index: dict[bytes, int] = {}
        lists_, counts = [], []
        for data in group["payload"]:
            size = int.from_bytes(data[:4], "little")
            counts.append(apart(data[4:4 + size])[0])
            words = zstandard.ZstdDecompressor().decompress(data[4 + size:]).split(b"\n")
            lists_.append(np.array([index.setdefault(w, len(index)) for w in words], np.int64))
        total = np.bincount(np.concatenate(lists_), np.concatenate(counts), len(index)).astype(np.int64)
        order = np.argsort(-total, kind="stable")
        number = np.empty(len(index), np.int64)
        number[order] = np.arange(len(index)) * buckets + bucket
        first = np.arange(len(group)) == 0
        return pd.DataFrame({"block": group["block"], "bucket": group["bucket"], "payload": [many(number[x], total[x]) for x in lists_],
                             "tokens": np.where(first, total.sum(), 0), "kinds": np.where(first, (total > 0).sum(), 0)})
    return lists.groupBy("bucket").applyInPandas(run, COUNTED)


def word_numbers(docs: DataFrame, buckets: int) -> DataFrame:
    """One row per block: documents, which of them train, tokens per document, word numbers, the words' buckets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, held in blocks(batches, BLOCK_BYTES):
            block, words, _, counts, codes = _block(ids, held)
            bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
            yield pa.RecordBatch.from_arrays([
                pa.array([block]), pa.array([[NO_ID if i is None else i for i in ids]], pa.list_(pa.int64())),
                pa.array([bytes(map(is_train, ids))], pa.binary()),
                pa.array([counts], pa.list_(pa.int64())), pa.array([many(codes)], pa.binary()), pa.array([many(bucket)], pa.binary())],
                names=["block", "doc_ids", "train", "n_tokens", "payload", "buckets"])
    return docs.mapInArrow(run, NUMBERED)


def _tokens(left: pd.DataFrame, right: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, Iterator[np.ndarray], np.ndarray, np.ndarray]:
    """Of the documents of a block: word number and training count of each token, the words one, two and more places before
    it, document of each token, train. ``right`` has words (level 1) and probabilities of n-grams (level n)."""
    parts = [apart(data) for data in right[right["level"] == 1].drop_duplicates("bucket").sort_values("bucket")["payload"]]
    number, count = (np.concatenate([p[k] for p in parts]) for k in range(2))
    one = left.iloc[0]
    order = np.argsort(apart(one["buckets"])[0], kind="stable")
    if len(order) != len(number):
        raise RuntimeError("the rows came in another order on a second read; pass a stored table")
    own_number, own_count = np.empty_like(number), np.empty_like(count)
    own_number[order], own_count[order] = number, count
    codes, lengths = apart(one["payload"])[0], np.asarray(one["n_tokens"], np.int64)
    word = own_number[codes]
    ends = np.cumsum(lengths) - 1

    def earlier() -> Iterator[np.ndarray]:
        now = word
        while True:
            now = np.roll(now, 1)
            if len(word):
                now[np.concatenate([[0], ends[:-1] + 1])] = word[ends[0]]
            yield now
    train = np.frombuffer(one["train"], np.uint8).astype(bool)
    return word, own_count[codes], earlier(), np.repeat(np.arange(len(lengths)), lengths), train


def _history(before: Iterator[np.ndarray], words: int) -> np.ndarray:
    """One number for the last ``words`` words: the word's own, or a hash of several."""
    held = list(islice(before, words))
    if words == 1:
        return held[0]
    key = held[0].astype(np.uint64)
    for h in held[1:]:
        key = mixed(key) + h.astype(np.uint64)
    return (mixed(key) >> np.uint64(1)).astype(np.int64)


def _placed(left: pd.DataFrame, right: pd.DataFrame, hots: list[np.ndarray], buckets: int) -> tuple[np.ndarray, ...]:
    """Word, history, code of P(w | h'), document of each token, train, and the words' counts; ``hots`` has the hot
    histories of bigrams, trigrams and so on, the last of the n-grams that are asked for."""
    word, count, before, doc, train = _tokens(left, right)
    size = len(hots)
    held = list(islice(before, size))
    code = count
    if size > 1:  # what step 3 returned of the n-grams shorter by one, in the order in which they were dealt
        shorter = _history(iter(held), size - 1)
        bucket = _dealt(shorter, word, hots[-2], buckets)
        order = np.lexsort((word, shorter, bucket))
        parts = [apart(data)[0] for data in right[right["level"] == size].sort_values("bucket")["payload"]]
        code = np.empty_like(word)
        code[order] = np.concatenate(parts)[np.cumsum(_new(shorter[order], word[order])) - 1] if len(word) else word
    return word, _history(iter(held), size), code, doc, train, count


def _new(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """For sorted n-grams whether one differs from that before it."""
    return np.concatenate([[True], (word[1:] != word[:-1]) | (history[1:] != history[:-1])])[:len(word)]


def _lower(code: np.ndarray, total: int, level: int) -> np.ndarray:
    """P(w | h') by its code: the word's count for bigrams, the number itself for longer n-grams."""
    return (code + 1) / total if level == 2 else np.ascontiguousarray(code, np.int64).view(np.float64)


def _dealt(history: np.ndarray, word: np.ndarray, hot: np.ndarray, buckets: int) -> np.ndarray:
    key = history.astype(np.uint64)
    spread = np.isin(history, hot)
    key[spread] = mixed(key[spread]) + word[spread].astype(np.uint64)
    return (mixed(key) >> np.uint64(33)).astype(np.int64) % buckets


def _by_bucket(bucket: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, np.int64)
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        yield (int(bucket[a]), *(c[a:b] for c in columns))


def hot_histories(numbered: DataFrame, returned: DataFrame, hot_words: np.ndarray, words: int, least: float) -> dict[int, int]:
    """Histories of several words that stand before more than ``least`` training tokens; only hot words can make one up."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k in range(len(left)):
            _, _, before, doc, train = _tokens(left.iloc[k:k + 1], right)
            held = list(islice(before, words))
            use = train[doc] & np.logical_and.reduce([np.isin(h, hot_words) for h in held])
            out.append(_history(iter([h[use] for h in held]), words))
        history, n = np.unique(np.concatenate(out), return_counts=True)
        return pd.DataFrame({"history": history, "n": n})
    found = numbered.groupBy("block").cogroup(returned.groupBy("block")).applyInPandas(run, "history long, n long")
    # At most 2 * buckets histories can have that share of all tokens.
    return {r["history"]: r["n"] for r in found.groupBy("history").agg(F.sum("n").alias("n")).where(F.col("n") > least).collect()}


def training_pairs(numbered: DataFrame, returned: DataFrame, hots: list[np.ndarray], buckets: int) -> DataFrame:
    """Each block's distinct training n-grams with counts, by history."""
    hot = hots[-1]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for k in range(len(left)):  # equal blocks (repeated rows) count each
            word, before, code, doc, train, _ = _placed(left.iloc[k:k + 1], right, hots, buckets)
            use = train[doc]
            word, code, before = word[use], code[use], before[use]
            bucket = _dealt(before, word, hot, buckets)
            order = np.lexsort((word, before, bucket))
            word, code, before, bucket = word[order], code[order], before[order], bucket[order]
            new = np.flatnonzero(_new(before, word))
            times = np.diff(np.append(new, len(word)))
            for b, h, w, n, c in _by_bucket(bucket[new], before[new], word[new], times, code[new]):
                out.append((left["block"].iat[k], b, many(np.diff(h, prepend=0), w, n, c[np.isin(h, hot)])))
        return pd.DataFrame(out, columns=["block", "bucket", "payload"])
    return numbered.groupBy("block").cogroup(returned.groupBy("block")).applyInPandas(run, PAIRS)


def pair_sums(pairs: DataFrame, hot: np.ndarray, total: int, level: int) -> DataFrame:
    """(history, r, times, mass): how many n-grams were seen r times (K + 1: that often or more, -1: exactly K + 1
    times) over all histories (history -1) and after each hot one, and the shorter n-grams' mass of the latter's successors."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for data in group["payload"]:
            h, w, n, c = apart(data)
            h = np.cumsum(h)
            full = np.zeros(len(h), np.int64)
            full[np.isin(h, hot)] = c
            parts.append((h, w, n, full))
        h, w, n, c = (np.concatenate([p[k] for p in parts]) for k in range(4))
        order = np.lexsort((w, h))
        h, w, n, c = h[order], w[order], n[order], c[order]
        new = np.flatnonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (h[1:] != h[:-1])]))
        times, h, c = np.add.reduceat(n, new), h[new], c[new]
        r = np.minimum(times, K + 1)
        out = [(-1, i + 1, int(x), 0.0, 0) for i, x in enumerate(np.bincount(r, minlength=K + 2)[1:])]
        out.append((-1, -1, int((times == K + 1).sum()), 0.0, 0))
        for one in np.intersect1d(h, hot):
            at = h == one
            for i in range(1, K + 2):
                of = at & (r == i)
                out.append((int(one), i, int(of.sum()), float(_lower(c[of], total, level).sum()), int(times[of].sum())))
        return pd.DataFrame(out, columns=["history", "r", "times", "mass", "tokens"])
    return pairs.select("bucket", "payload").groupBy("bucket").applyInPandas(
        run, "history long, r int, times long, mass double, tokens long").groupBy("history", "r").agg(
        F.sum("times").alias("times"), F.sum("mass").alias("mass"), F.sum("tokens").alias("tokens"))


def discounts(times: dict[int, int], exactly: int) -> np.ndarray:
    """d(0 .. K + 1); ``times[r]`` n-grams were seen r <= K times, ``exactly`` of them K + 1 times."""
    n = {**times, K + 1: exactly}
    d = np.ones(K + 2)
    tail = (K + 1) * n.get(K + 1, 0) / n[1] if n.get(1) else 1.0
    for r in range(1, K + 1):
        value = ((r + 1) * n.get(r + 1, 0) / (r * n[r]) - tail) / (1 - tail) if n.get(r) and tail != 1 else -1.0
        d[r] = value if 0 < value < 1 else (r - 0.5) / r
    return d


def _backoff(seen: np.ndarray, mass: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor, alpha) of histories from the discounted counts, the mass of the seen words when backed off, and the total."""
    full = seen >= total * (1 - 1e-12)
    divisor = np.where(full, total + 1.0, total)
    return divisor, (1 - seen / np.maximum(divisor, 1.0)) / (1 - mass)


def positions(numbered: DataFrame, returned: DataFrame, hots: list[np.ndarray], buckets: int, total: int, last: bool) -> DataFrame:
    """All positions of a block by history; at the last order one row per block (bucket below 0) with what its documents know."""
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        one = left.iloc[0]
        word, before, code, doc, train, count = _placed(left, right, hots, buckets)
        docs = len(train)
        known = np.bincount(doc[count > 0], minlength=docs)
        base = np.bincount(doc, np.log10((count + 1) / total), docs)
        block = one["block"]
        own = -1 - zlib.crc32(block.encode()) % buckets
        for _ in range(len(left) if last else 0):  # equal blocks are scored once and told as often as they are
            out.append((block, own, np.asarray(one["n_tokens"], "<i8").tobytes() + known.astype("<i8").tobytes() + base.astype("<f8").tobytes()
                        + np.asarray(one["doc_ids"], "<i8").tobytes()))
        bucket = _dealt(before, word, hots[-1], buckets)
        order = np.lexsort((word, before, bucket))
        word, code, before, doc, bucket = (x[order] for x in (word, code, before, doc, bucket))
        for b, h, w, c, d in _by_bucket(bucket, before, word, code, doc):
            at = np.unique(w, return_index=True)[1] if len(hots) == 1 else np.flatnonzero(_new(h, w))
            out.append((block, b, many(np.diff(h, prepend=0), w, c[at], d, train.astype(np.int64) * len(left))))
        return pd.DataFrame(out, columns=["block", "bucket", "payload"])
    return numbered.groupBy("block").cogroup(returned.groupBy("block")).applyInPandas(run, PAIRS)


def scored(placed: DataFrame, hot: dict[int, tuple[float, float, float]], d: np.ndarray, total: int, level: int, last: bool) -> DataFrame:
    """For each block and bucket the sums of log10 P per document, or P of its distinct n-grams below the last order; rows
    below 0 pass through.

    ``hot`` has discounted counts, backed-off mass and total of the histories that are dealt by n-gram.
    """
    names = np.array(sorted(hot), np.int64)

    def run(group: pd.DataFrame) -> pd.DataFrame:
        if group["bucket"].iat[0] < 0:
            return group[["block", "bucket", "payload"]]
        parts, sizes = [], []
        for data in group["payload"]:
            h, w, c, doc, train = apart(data)
            h = np.cumsum(h)
            at = np.unique(w, return_inverse=True)[1] if level == 2 else np.cumsum(_new(h, w)) - 1
            parts.append((h, w, c[at], doc + sum(sizes), train[doc]))
            sizes.append(len(train))
        h, w, c, doc, times = (np.concatenate([p[k] for p in parts]) for k in range(5))
        order = np.lexsort((w, h))
        h, w, c, doc, times = (x[order] for x in (h, w, c, doc, times))
        pair = _new(h, w)
        new = np.flatnonzero(pair)
        seen, ph, lower = np.add.reduceat(times, new), h[new], _lower(c[new], total, level)
        cut = np.flatnonzero(np.concatenate([[True], ph[1:] != ph[:-1]]))
        less = d[np.minimum(seen, K + 1)] * seen
        sums = [np.add.reduceat(x, cut).astype(float) for x in (less, np.where(seen > 0, lower, 0.0), seen)]
        for i, one in enumerate(ph[cut]):
            if len(names) and one in hot:
                for k in range(3):
                    sums[k][i] = hot[one][k]
        divisor, alpha = _backoff(*sums)
        of = np.cumsum(np.concatenate([[True], ph[1:] != ph[:-1]])) - 1
        p = np.where(seen > 0, less / np.maximum(divisor[of], 1.0), np.where(sums[2][of] > 0, alpha[of], 1.0) * lower)
        if not last:
            back = np.empty(len(pair))
            back[order] = p[np.cumsum(pair) - 1]
            ends = np.cumsum([len(x[0]) for x in parts])
            return pd.DataFrame({"block": group["block"], "bucket": group["bucket"], "payload": [
                many(back[b - len(x[0]):b][_new(x[0], x[1])].view(np.int64)) for x, b in zip(parts, ends)]})
        log = np.log10(p)[np.cumsum(pair) - 1]
        by_doc = np.bincount(doc, log, sum(sizes))
        edges = np.cumsum([0, *sizes])
        return pd.DataFrame({"block": group["block"], "bucket": group["bucket"],
                             "payload": [by_doc[a:b].astype("<f8").tobytes() for a, b in zip(edges[:-1], edges[1:])]})
    return placed.groupBy("bucket").applyInPandas(run, PAIRS)


def gathered(parts: DataFrame, total_tokens: int) -> DataFrame:
    """One row per document from its block's sums, added in the order of the buckets."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("bucket")
        own, sums = group[group["bucket"] < 0], group[group["bucket"] >= 0]
        out = []
        for data in own["payload"]:
            table = np.frombuffer(data, "<i8").reshape(4, -1)
            score = np.zeros(table.shape[1])
            for part in sums["payload"]:
                score = score + np.frombuffer(part, "<f8")
            ids = [None if x == NO_ID else int(x) for x in table[3]]
            out.append(pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "n_tokens": table[0], "n_known": table[1],
                                     "base_score": table[2].view("<f8"), "score": score}))
        return pd.concat(out)
    return parts.groupBy("block").applyInPandas(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double").select(
        "doc_id", F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS)) == HELD_OUT, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", F.lit(total_tokens).cast("long").alias("train_tokens"), "base_score", "score")


def language_model_scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row, by n-grams up to ``order`` words."""
    if order < 2:
        raise ValueError("backoff needs an order of 2 or more")
    docs, buckets = texts(df, id_col, text_col), shuffle_partitions(df.sparkSession)
    counted = stored(count_words(word_lists(docs, buckets), buckets), "words")
    tokens, kinds = (int(x or 0) for x in counted.agg(F.sum("tokens"), F.sum("kinds")).first())
    total = tokens + kinds + 1

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[int, int]] = set()
            for number, count in map(apart, batch.column(0).to_pylist()):
                large = 2 * buckets * count > tokens
                found |= set(zip(number[large].tolist(), count[large].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(2)], names=["history", "n"])
    # At most 2 * buckets words can have that share of all tokens.
    often = {r["history"]: r["n"] for r in counted.select("payload").mapInArrow(frequent, "history long, n long").distinct().collect()}
    # Stored, as several steps read it: the texts are cut into words twice in all, not three times.
    numbered, words = stored(word_numbers(docs, buckets), "numbers"), counted.select("block", "bucket", "payload", F.lit(1).alias("level"))
    returned, hots, hot_words = words, [], np.array(sorted(often), np.int64)
    for level in range(2, order + 1):
        if level > 2:
            often = hot_histories(numbered, words, hot_words, level - 1, tokens / (2 * buckets))
        hots = [*hots, np.array(sorted(often), np.int64)]
        rows = pair_sums(training_pairs(numbered, returned, hots, buckets), hots[-1], total, level).collect()  # K + 2 rows a hot history
        d = discounts({r["r"]: r["times"] for r in rows if r["history"] == -1 and 0 < r["r"] <= K},
                      sum(r["times"] for r in rows if r["history"] == -1 and r["r"] == -1))
        sums = {int(h): (sum(d[r["r"]] * r["tokens"] for r in rows if r["history"] == h), sum(r["mass"] for r in rows if r["history"] == h), float(n))
                for h, n in often.items()}
        last = level == order
        parts = scored(positions(numbered, returned, hots, buckets, total, last), sums, d, total, level, last)
        if not last:
            returned = words.unionByName(stored(parts, "probabilities").withColumn("level", F.lit(level)))
    return gathered(parts, tokens)

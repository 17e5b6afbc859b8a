"""Fingerprints by consistent weighted sampling of weighted terms.

The terms of a text are its words as they are, weighted by their numbers of occurrences. For a term with weight w, with
r and c from Gamma(2, 1) and b from U(0, 1), all drawn by hashing the term:

    t = floor(ln w / r + b),   ln a = ln c - r * (t - b + 1)

The sample is the term of least ``a`` together with its ``t``; two texts have the same sample with a chance of their
generalised Jaccard similarity sum(min) / sum(max). A fingerprint has ``SAMPLES`` samples of the whole text, each with
r, c and b of its own for every term, so that a term is picked in proportion to its weight in each of them. The share
of equal samples estimates the similarity with a standard error of sqrt(J * (1 - J) / SAMPLES), 0.0625 at most. As
``a`` follows from term and ``t``, it names the sample, which enters the fingerprint as 16 bits (0: no term at all).

All expressions are Spark's own. One range-like shuffle brings neighbouring documents together; edited texts, terms
and samples all work in its partitions. Null texts are empty; empty texts have a fingerprint of zeros, and two of
them a likeness of 1. Rows are ordered by id, null first, then by text. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xoutcome.llm.common import shuffle_partitions, texts
from xoutcome.llm.native import words
from xoutcome.session import stored

SAMPLES = 64
BITS = 16
_PER_LONG = 64 // BITS
_LONGS = SAMPLES // _PER_LONG
_IN_ROW = 8  # samples of a term that one row makes
_STEP = 0x9E3779B97F4A7C15
PARTS = 4  # blocks per shuffle partition


def _uniforms(at: Column, number: int) -> tuple[Column, Column]:
    """Two numbers in (0, 1) by hashing ``at``, a hash of the term, together with the number of the draw."""
    bits = F.xxhash64(at.bitwiseXOR(F.lit(_signed((number + 1) * _STEP))))
    return tuple((half.cast("double") + 0.5) * F.lit(2.0 ** -32) for half in (
        F.shiftrightunsigned(bits, 32), bits.bitwiseAND(F.lit(0xFFFFFFFF))))


def _signed(number: int) -> int:
    """The low 64 bits as a signed number."""
    return ((number + (1 << 63)) & ((1 << 64) - 1)) - (1 << 63)


def log_a(log_weight: Column, at: Column, sample: int) -> Column:
    (u1, u2), (u3, u4), (b, _) = (_uniforms(at, 3 * sample + i) for i in range(3))
    r, c = -F.log(u1 * u2), -F.log(u3 * u4)
    return F.log(c) - r * (F.floor(log_weight / r + b) - b + 1)


def sampled(rows: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """The fingerprints of the text columns ``names``, in fixed-width aggregates over the rows' own partitioning.

    A term is handled once for each ``_IN_ROW`` samples: one aggregate for all samples would be a method too large for
    the compiler, and each row more costs a search for its group. Term and row are hashed once, and each draw hashes
    that one number.
    """
    picked = rows.select(*keys, F.posexplode(F.array(*names)).alias("which", "text")).select(
        *keys, "which", F.explode_outer(words(F.col("text"))).alias("word")).where("word is not null")
    terms = picked.groupBy(*keys, "which", F.xxhash64("word").alias("term")).agg(F.count(F.lit(1)).alias("w"))
    dealt = terms.select(*keys, "which", "term", F.log(F.col("w").cast("double")).alias("log_w"),
                         F.explode(F.array(*map(F.lit, range(SAMPLES // _IN_ROW)))).alias("at"))
    dealt = dealt.select(*keys, "which", "log_w", "at", F.xxhash64("term", "at").alias("hash"))
    least = dealt.groupBy(*keys, "which", "at").agg(
        *[F.min(log_a(F.col("log_w"), F.col("hash"), i)).alias(f"a{i}") for i in range(_IN_ROW)])
    codes = [F.lit(1) + F.pmod(F.xxhash64(f"a{i}"), F.lit((1 << BITS) - 1)) for i in range(_IN_ROW)]
    placed = least.select(*keys, "which", "at", *[reduce(Column.bitwiseOR, [
        F.shiftleft(c, (_PER_LONG - 1 - i) * BITS) for i, c in enumerate(codes[j * _PER_LONG:(j + 1) * _PER_LONG])]).alias(f"code{j}")
        for j in range(_IN_ROW // _PER_LONG)])
    longs = placed.groupBy(*keys).agg(*[
        F.bit_or(F.when((F.col("which") == k) & (F.col("at") == i * _PER_LONG // _IN_ROW), F.col(f"code{i % (_IN_ROW // _PER_LONG)}"))).alias(f"l{k}_{i}")
        for k in range(len(names)) for i in range(_LONGS)])
    width = 16
    return longs.select(*keys, *[F.concat(*[F.lpad(F.hex(F.coalesce(f"l{k}_{i}", F.lit(0).cast("long"))), width, "0") for i in range(_LONGS)]).alias(
        f"fp_{n}") for k, n in enumerate(names)])


def likeness(x: Column, y: Column) -> Column:
    """The share of equal samples of two fingerprints; 1 for two empty ones."""
    digits = BITS // 4
    empty = "0" * digits

    def samples(test: Callable[[Column, Column], Column]) -> Column:
        return F.size(F.filter(F.sequence(F.lit(0), F.lit(SAMPLES - 1)), lambda i: test(
            F.substring(x, i * digits + 1, F.lit(digits)), F.substring(y, i * digits + 1, F.lit(digits)))))
    filled = samples(lambda a, b: (a != empty) | (b != empty))
    equal = samples(lambda a, b: (a == b) & (a != empty))
    return F.when(filled == 0, 1.0).otherwise(equal / F.greatest(filled, F.lit(1)))


def _block(bounds: list) -> Column:
    """How many of the ascending bounds are below the id, looked up in two steps; null ids are in block 0."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    groups = [bounds[i:i + step] for i in range(0, len(bounds), step)]
    heads = F.array(*[F.lit(g[0]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b < F.col("doc_id")))
    inside = F.filter(F.get(F.array(*[F.array(*map(F.lit, g)) for g in groups]), group - 1), lambda b: b < F.col("doc_id"))
    return F.when(group > 0, (group - 1) * step + F.size(inside)).otherwise(0)


def with_next(rows: DataFrame, column: str, order: list, loose: DataFrame | None = None) -> DataFrame:
    """``next``: the column's value in the row after, in the order of blocks and inside them; the first after the last.

    Rows are partitioned by block; of other blocks only the first row is looked at. ``loose`` has the same rows not
    yet partitioned, from which the first rows come by partial minima, without a shuffle of all.
    """
    inside = Window.partitionBy("block").orderBy(*order)
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("o1"), F.col("tie").alias("o2"), F.col(column).alias("v")))
    heads = stored((rows if loose is None else loose).groupBy("block").agg(first.alias("head")).select("block", F.col("head.v").alias("head")), "heads")
    chain = heads.select("block").select("block", F.coalesce(
        F.lead("block").over(Window.orderBy("block")), F.min("block").over(Window.partitionBy())).alias("after"))
    after = chain.join(heads.select(F.col("block").alias("after"), "head"), "after").select("block", "head")
    return rows.withColumn("next", F.lead(column).over(inside)).withColumn("has", F.lead(F.lit(1)).over(inside)).join(
        after, "block", "left").withColumn("next", F.when(F.col("has") == 1, F.col("next")).otherwise(F.col("head"))).drop("has", "head")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next document.
    """
    docs = texts(df, id_col, text_col)
    parts = PARTS * shuffle_partitions(df.sparkSession)
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts)).first()[0]  # parts - 1 numbers
    # Never null, or else the join below filters one of its sides before the shuffle and the texts are shuffled twice.
    block = F.coalesce(_block(sorted(set(cuts or []))), F.lit(0)).cast("long")
    blocked = docs.withColumn("block", block).withColumn("tie", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), "tie"]
    rows = with_next(blocked.repartition(parts, "block"), "text", order, blocked)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next"), F.lit(1), half)))
    rows = rows.withColumn("row", F.row_number().over(Window.partitionBy("block").orderBy(*order)))
    keys = ["block", "row"]
    told = rows.select(*keys, "doc_id", "tie", n.cast("long").alias("n_chars"), F.unhex(F.sha2("edited", 256)).alias("edited_sha256"))
    none = F.lit("0" * (SAMPLES * BITS // 4))
    made = stored(told.join(sampled(rows.select(*keys, "text", "edited"), keys, ["text", "edited"]), keys, "left").select(
        *keys, "doc_id", "tie", "n_chars", "edited_sha256", F.unhex(F.coalesce("fp_text", none)).alias("fingerprint"),
        F.unhex(F.coalesce("fp_edited", none)).alias("edited_fingerprint")), "fingerprints")  # bytes: half as large as their digits
    return with_next(made, "fingerprint", order).select(
        "doc_id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"),
        *[F.hex(c).alias(c) for c in ("fingerprint", "edited_fingerprint", "next")]).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"))

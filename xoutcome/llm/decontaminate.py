"""Benchmark items inside documents: size-partitioned MinHash containment search, then exact containment.

A short item inside a long document has a tiny Jaccard similarity, so that minima of the document say nothing. The
search therefore looks up minima of the smaller set in the larger one: of each item, under ``functions`` hash
functions, the shingle with the least value. A document with 75 % of an item's shingles lacks one such minimum with
a chance of 1/4 at most, and all of them with 4^-functions. Items are partitioned by size (powers of two); a class
sets how many functions are needed for a chance of ``MISS`` (a set of few shingles has few different minima), and how
many shingles a document must have at least to be looked at for it.

Candidates are confirmed on the shingles' texts. All expressions are Spark's own. Null texts are empty; items and
documents without words match nothing; repeated items with one id count as one item with all their shingles. Other
columns are ignored. An empty benchmark marks no document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xoutcome.llm.common import texts
from xoutcome.llm.native import lowered, shingle_hashes, shingle_texts, words
from xoutcome.session import stored

SHINGLE_WORDS = 5
PERCENT = 75
MISS = 1e-9
BROADCAST_ROWS = 500_000


def with_words(df: DataFrame, *more: str) -> DataFrame:
    """The words as a column of their own: an expression inside a lambda would be split anew for every shingle.

    For the same reason shingles are exploded with ``explode_outer``: for ``explode`` Spark infers a filter on the
    array, and pushing that down puts the split back into the lambda.
    """
    return df.select("doc_id", words(lowered(F.col("text"))).alias("w"), *more)


def _functions(size_class: int) -> int:
    """Hash functions for items of 2^size_class shingles or more, but fewer than twice as many."""
    lacking = 1 - PERCENT / 100 if size_class else 0.0  # one shingle must be there
    return 1 if not lacking else math.ceil(math.log(MISS) / math.log(lacking))


def item_sets(items: DataFrame) -> DataFrame:
    """(item_id, shingles, size): the distinct shingles of every item by text."""
    return with_words(items).select(F.col("doc_id").alias("item_id"), F.explode_outer(shingle_texts(F.col("w"), SHINGLE_WORDS)).alias("s")).where("item_id is not null and s is not null").groupBy("item_id").agg(
        F.array_sort(F.collect_set("s")).alias("shingles")).withColumn("size", F.size("shingles"))


def minima(items: DataFrame) -> DataFrame:
    """(hash, item_id, need): each item's minima as document shingles are hashed, and the shingles a document needs."""
    parts = []
    hashed = with_words(items).select(
        F.col("doc_id").alias("item_id"), F.explode_outer(shingle_hashes(F.col("w"), SHINGLE_WORDS)).alias("hash")).where(
        "item_id is not null and hash is not null").distinct()
    sizes = hashed.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    size_class = F.floor(F.log2("size")).cast("int")
    hashed = stored(hashed.join(sizes.withColumn("size_class", size_class), "item_id"), "item-hashes")
    for row in hashed.groupBy("size_class").count().orderBy("size_class").collect():  # one row per power of two
        own = hashed.where(F.col("size_class") == row["size_class"])
        functions = range(_functions(row["size_class"]))
        least = [F.min(F.struct(F.xxhash64("hash", F.lit(i)).alias("v"), "hash")).alias(f"m{i}") for i in functions]
        parts.append(own.groupBy("item_id", "size").agg(*least).select(
            "item_id", F.ceil(F.col("size") * PERCENT / 100).cast("int").alias("need"),
            F.explode(F.array_distinct(F.array(*[F.col(f"m{i}.hash") for i in functions]))).alias("hash")))
    if not parts:
        return hashed.select("hash", "item_id", F.lit(0).alias("need"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select("hash", "item_id", "need")


def _small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, marked for broadcast if it has ``rows`` rows at most."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def contained_items(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, common, size) of all pairs with 100 * common >= 75 * size."""
    docs, items = texts(documents, id_col, text_col), texts(items, item_id_col, item_text_col)
    look_up = stored(minima(items), "minima")
    rows = with_words(docs).select("doc_id", shingle_hashes(F.col("w"), SHINGLE_WORDS).alias("hashes")).select("doc_id", F.size("hashes").alias("n"), F.explode_outer("hashes").alias("hash"))
    found = rows.join(_small(look_up), "hash").where("n >= need").select("doc_id", "item_id").where("doc_id is not null").distinct()
    pairs = stored(found.groupBy("doc_id").agg(F.collect_set("item_id").alias("ids")), "candidates")
    own = with_words(docs.join(_small(pairs), "doc_id"), "ids").select(
        "doc_id", F.array_distinct(shingle_texts(F.col("w"), SHINGLE_WORDS)).alias("have"), "ids")
    asked = stored(item_sets(items), "items")
    held = stored(own, "candidate-texts").select("doc_id", "have", F.explode("ids").alias("item_id"))
    return held.join(asked, "item_id").select(
        "doc_id", "item_id", F.size(F.array_intersect("shingles", "have")).cast("long").alias("common"),
        F.col("size").cast("long").alias("size")).where(f"100 * common >= {PERCENT} * size").groupBy("doc_id", "item_id", "size").agg(
        F.max("common").alias("common"))


def contamination(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, items, n_items, best_containment, contaminated) of every row; ``items`` in ascending order."""
    found = contained_items(documents, items, id_col, text_col).groupBy("doc_id").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max(F.col("common") / F.col("size")).alias("best"))
    none: Column = F.array().cast("array<bigint>")
    return documents.select(F.col(f"`{id_col}`").cast("long").alias("doc_id")).join(found, "doc_id", "left").select(
        "doc_id", F.coalesce("items", none).alias("items"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("best", F.lit(0.0)).alias("best_containment"), F.col("items").isNotNull().alias("contaminated"))


_SETS = """SELECT DISTINCT {id}, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS s FROM (
  SELECT {id}, w, unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - 4, 1) + 1 END)) AS i FROM (
    SELECT {id}, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM {table}))"""

ORACLE = f"""WITH d AS ({_SETS.format(id='doc_id', table='documents')}), b AS ({_SETS.format(id='item_id', table='benchmark')}),
sizes AS (SELECT item_id, count(*) AS size FROM b GROUP BY item_id),
pairs AS (SELECT d.doc_id, b.item_id, count(*) AS common FROM d JOIN b USING (s) GROUP BY d.doc_id, b.item_id),
hits AS (SELECT doc_id, list_sort(list(item_id)) AS items, max(common / size) AS best FROM pairs JOIN sizes USING (item_id)
  WHERE 100 * common >= {PERCENT} * size GROUP BY doc_id)
SELECT doc_id, coalesce(items, CAST([] AS BIGINT[])) AS items, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
  coalesce(best, 0.0::DOUBLE) AS best_containment, items IS NOT NULL AS contaminated
FROM documents LEFT JOIN hits USING (doc_id)"""

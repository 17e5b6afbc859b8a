"""Ordered work inside keys of any size.

A window over a key puts all rows of the key into one task. Where a key holds more than ``max_rows`` rows, all rows are
dealt out by ranges of (key, order) instead, which Spark cuts from samples, sorted inside their range, cut into pieces of
``max_rows`` rows and stored with the number of their piece. Windows run per key and piece, and what the pieces before owe a
piece comes from a table with one row per key and piece. Where the cuts fall changes speed only, never results. Order columns may be of any type and hold nulls, which
come first in rising order, as in Spark's windows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xoutcome.session import stored

MAX_ROWS = 5_000_000
RANGE_ROWS = 250_000  # rows of a range that holds many pieces; there are no more tasks than that, however short the pieces
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20
PIECE = "_piece"


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` where it is proven to have at most ``max_rows`` rows and ``BROADCAST_BYTES``, else leave it to a shuffle join.

    The rows are fetched once (at most ``max_rows + 1``), so the plan that follows does not compute them again.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows or rows.nbytes > BROADCAST_BYTES:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on equal keys where null equals null; the right side's keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    matches = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, matches, how).drop(*[f"_r_{k}" for k in keys])


def with_chunks(
    df: DataFrame, keys: list[str], split_on: list[str], max_rows: int | None = MAX_ROWS, ties: list[str] = (),
) -> tuple[DataFrame, list[str]]:
    """Deal the rows out by ranges of the keys and the order columns ``split_on``, if a key has too many for one task.

    Returns the frame and the names of the piece columns, none where no key is oversized. Pieces rise with the order, and
    inside equal places with the columns ``ties``, and hold at most ``max_rows`` rows. Beforehand there is one count of rows by key.
    """
    if max_rows is None:
        return df, []
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if keys else df.agg(F.count(F.lit(1)).alias("_n"))
    most, total = sizes.agg(F.max("_n"), F.sum("_n")).first()
    if most is None or most <= max_rows:
        return df, []
    spark = df.sparkSession
    enough = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_ROWS))
    parts = min(-(-2 * total // max_rows), enough)
    places = [F.asc_nulls_first(c) for c in dict.fromkeys([*keys, *split_on])]
    dealt = df.repartitionByRange(parts, *places).sortWithinPartitions(*places, *[F.asc_nulls_first(c) for c in ties])
    # The id holds the range's number above the row's own place in it; a piece is named by the id of its first row.
    cut = dealt.withColumn(PIECE, F.monotonically_increasing_id())
    cut = cut.withColumn(PIECE, F.col(PIECE) - F.pmod(F.col(PIECE).bitwiseAND((1 << 33) - 1), F.lit(max_rows).cast("long")))
    return stored(cut, "pieces"), [PIECE]


def directed(columns: list[str], descending: bool) -> list[Column]:
    """Sort expressions that put nulls where Spark puts them for the direction."""
    return [F.desc(c) if descending else F.asc(c) for c in columns]


def running_sum(
    df: DataFrame, value: Column, keys: list[str], order: list[str], out: str,
    descending: bool = False, split_on: list[str] | None = None, max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Sum of ``value`` from the first row of the key up to this row, in a unique order."""
    df = df.withColumn("_v", value)
    df, chunks = with_chunks(df, keys, split_on or order, max_rows)
    local = Window.partitionBy(*keys, *chunks).orderBy(*directed(order, descending))
    result = df.withColumn(out, F.sum("_v").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    if chunks:
        totals = df.groupBy(*keys, *chunks).agg(F.sum("_v").alias("_t"))
        before = (Window.partitionBy(*keys).orderBy(*directed(chunks, descending))
                  .rowsBetween(Window.unboundedPreceding, -1))
        carry = totals.select(*keys, *chunks, F.sum("_t").over(before).alias("_before"))
        carry = carry.filter(F.col("_before").isNotNull())  # rows of oversized keys only
        result = null_safe_join(result, carry, keys + chunks)
        result = result.withColumn(out, F.col(out) + F.coalesce(F.col("_before"), F.lit(0))).drop("_before")
    return result.drop("_v", *chunks)


def next_and_previous(
    df: DataFrame, value: str, keys: list[str], order: list[str], descending: bool = False,
    split_on: list[str] | None = None, max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Add ``_next`` and ``_prev``: the nearest non-null ``value`` at or after, and at or before, each row.

    Looking ahead runs over the reversed order with a growing frame: a frame that ends at the last row
    would be scanned again for each row.
    """
    df, chunks = with_chunks(df, keys, split_on or order, max_rows)
    part = Window.partitionBy(*keys, *chunks)
    back = part.orderBy(*directed(order, not descending)).rowsBetween(Window.unboundedPreceding, 0)
    forth = part.orderBy(*directed(order, descending)).rowsBetween(Window.unboundedPreceding, 0)
    result = df.withColumns({
        "_next": F.last(value, ignorenulls=True).over(back),
        "_prev": F.last(value, ignorenulls=True).over(forth),
    })
    if chunks:
        place = F.when(F.col(value).isNotNull(), F.struct(*order))
        low, high = F.min_by(value, place), F.max_by(value, place)
        ends = df.groupBy(*keys, *chunks).agg(
            (high if descending else low).alias("_first"), (low if descending else high).alias("_last")
        )
        by_key = Window.partitionBy(*keys)
        after = by_key.orderBy(*directed(chunks, not descending)).rowsBetween(Window.unboundedPreceding, -1)
        before = by_key.orderBy(*directed(chunks, descending)).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(
            *keys, *chunks,
            F.last("_first", ignorenulls=True).over(after).alias("_from_after"),
            F.last("_last", ignorenulls=True).over(before).alias("_from_before"),
        ).filter("_from_after IS NOT NULL OR _from_before IS NOT NULL")
        result = null_safe_join(result, carry, keys + chunks)
        result = result.withColumns({
            "_next": F.coalesce("_next", "_from_after"), "_prev": F.coalesce("_prev", "_from_before"),
        }).drop("_from_after", "_from_before")
    return result.drop(*chunks)

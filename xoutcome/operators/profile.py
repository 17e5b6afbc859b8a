"""Missing values and distributions, each in as few passes as there are groupings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xoutcome.operators.hot import bounded_broadcast, null_safe_join


def null_patterns(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """(by, _nulls, _n): which columns are null together, as an array of their places, and in how many rows.

    One group-by over all rows; all profiles of nulls below read this small table alone.
    """
    places = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(i)) for i, c in enumerate(columns)]), lambda i: i.isNotNull())
    return df.groupBy(*by, places.alias("_nulls")).agg(F.count(F.lit(1)).alias("_n"))


def _named(places: Column, columns: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in columns]), places + 1)


def null_counts(df: DataFrame, columns: list[str], by: list[str] = ()) -> DataFrame:
    """Nulls per column, and per group where given."""
    each = null_patterns(df, columns, by).select(*by, "_n", "_nulls", F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))).alias("_c"))
    return each.groupBy(*by, _named(F.col("_c"), columns).alias("column_name")).agg(
        F.sum(F.when(F.array_contains("_nulls", F.col("_c")), F.col("_n")).otherwise(0)).alias("nulls"))


def null_counts_by_game_type(df: DataFrame, columns: list[str], regular: str = "R",
                             column: str = "game_type") -> DataFrame:
    """Nulls per column in regular and in other games."""
    is_regular = F.coalesce(F.col(column) == regular, F.lit(False))
    long = null_counts(df.withColumn("_regular", is_regular), columns, ["_regular"])
    return long.groupBy("column_name").agg(
        F.sum(F.when(F.col("_regular"), F.col("nulls")).otherwise(0)).alias("regular"),
        F.sum(F.when(~F.col("_regular"), F.col("nulls")).otherwise(0)).alias("other"))


def missing_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column and whether it has a null."""
    return null_counts(df, columns).select("column_name", (F.col("nulls") > 0).alias("has_nulls"))


def missing_by_event(df: DataFrame, columns: list[str], event: str = "bat_event") -> DataFrame:
    """Nulls per column and event class (A14), pairs without a null left out."""
    known = df.filter(F.col(event).isNotNull())
    return null_counts(known, columns, [event]).filter(F.col("nulls") > 0)


def _pairs(df: DataFrame, columns: list[str], ordered: bool) -> DataFrame:
    """(_a, _b, both, only_a, only_b, rows): for each pair of columns, rows with a null in both, in one, and all rows."""
    places = F.sequence(F.lit(0), F.lit(len(columns) - 1))
    pairs = null_patterns(df, columns).select("_n", "_nulls", F.explode(places).alias("_a")).select(
        "_n", "_nulls", "_a", F.explode(places).alias("_b")).where("_a < _b" if ordered else "_a <> _b")
    a, b = F.array_contains("_nulls", F.col("_a")), F.array_contains("_nulls", F.col("_b"))
    count = lambda c: F.sum(F.when(c, F.col("_n")).otherwise(0))
    return pairs.groupBy("_a", "_b").agg(count(a & b).alias("both"), count(a & ~b).alias("only_a"), count(b & ~a).alias("only_b"), F.sum("_n").alias("rows"))


def missing_pair_difference(df: DataFrame, columns: list[str]) -> DataFrame:
    """For each pair of columns, rows where the first is null and the second is not."""
    return _pairs(df, columns, False).select(
        _named(F.col("_a"), columns).alias("column_a"), _named(F.col("_b"), columns).alias("column_b"), F.col("only_a").alias("only_a_null"))


def nullity_correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Correlation of the null flags of each pair of columns (A16); null for a constant flag."""
    n, a, b = F.col("rows").cast("double"), (F.col("both") + F.col("only_a")).cast("double"), (F.col("both") + F.col("only_b")).cast("double")
    spread = F.sqrt(a * (n - a)) * F.sqrt(b * (n - b))
    return _pairs(df, columns, True).select(
        _named(F.col("_a"), columns).alias("column_a"), _named(F.col("_b"), columns).alias("column_b"),
        F.when(spread > 0, (n * F.col("both") - a * b) / spread).alias("correlation"))


def is_continuous(df: DataFrame, column: str, limit: int = 20) -> bool:
    """Whether the column has more than ``limit`` different values."""
    return df.filter(F.col(column).isNotNull()).select(column).distinct().limit(limit + 1).count() > limit


def histogram(df: DataFrame, column: str, bins: int = 10) -> DataFrame:
    """Counts in equal bins ``(low, high]`` over whole-number limits.

    The first bin leaves its lower edge out. Columns with few different values are counted per value.
    """
    if not is_continuous(df, column):
        counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("low"))
        return counts.agg(F.count(F.lit(1)).alias("n")).select("low", F.col("low").alias("high"), "n")
    lowest, highest = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    low, high = math.floor(lowest), math.ceil(highest)
    edges = [float(round(low + i * (high - low) / bins, 2)) for i in range(bins + 1)]
    value = F.col(column)
    wide = df.agg(*[
        F.count_if((value > a) & (value <= b)).alias(f"b{i}") for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ])
    rows = F.array(*[
        F.struct(F.lit(a).alias("low"), F.lit(b).alias("high"), F.col(f"b{i}").alias("n"))
        for i, (a, b) in enumerate(zip(edges, edges[1:]))
    ])
    return wide.select(F.inline(rows))


def histogram_by(df: DataFrame, group: str, column: str, bins: int = 10) -> DataFrame:
    """Histogram of each group over the limits of the group (A17), empty bins included."""
    known = df.filter(F.col(column).isNotNull())
    low, high = F.floor(F.min(column)), F.ceil(F.max(column))
    edges = known.groupBy(group).agg(low.alias("_low"), ((high - low) / bins).alias("_width")).select(
        group,
        F.transform(F.sequence(F.lit(0), F.lit(bins)), lambda i: F.round(F.col("_low") + i * F.col("_width"), 2))
        .alias("_edges"))
    edges = bounded_broadcast(edges)
    placed = null_safe_join(known.select(group, F.col(column).alias("_value")), edges, [group])
    place = F.size(F.filter("_edges", lambda e: e < F.col("_value")))
    counts = placed.groupBy(group, place.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    frame = edges.select(group, F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "_edges").select(
        group, "bin", F.element_at("_edges", F.col("bin")).alias("low"),
        F.element_at("_edges", F.col("bin") + 1).alias("high"))
    return null_safe_join(frame, counts, [group, "bin"]).select(
        group, "low", "high", F.coalesce("_n", F.lit(0)).alias("n"))

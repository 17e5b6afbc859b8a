"""Sorted heads and the season choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sort_by_day(df: DataFrame, keys: list[str], day: str = "game_date") -> DataFrame:
    """Rows in date order (T1). Only for a sink: windows carry their own order."""
    return df.orderBy(day, *keys)


SALTS = 64


def top_rows(df: DataFrame, keys: list[str], order: list[Column], n: int, place: str = "place") -> DataFrame:
    """The first ``n`` rows of each key with their place.

    Each task keeps its own best rows before the shuffle (Spark does so for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000). With few keys and many tasks even those are
    many rows for one task, so groups of tasks meet first and only their best rows meet after that.
    """
    some = df.withColumn("_salt", F.spark_partition_id() % SALTS)
    for group in ([*keys, "_salt"], keys):
        number = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        some = some.withColumn(place, number).filter(F.col(place) <= n)
    return some.drop("_salt")


GROUP_LIMIT = 1_000  # Spark keeps a task's best rows before a shuffle up to this many
BINS = 4_096


def _candidates(long: DataFrame, n: int) -> DataFrame:
    """Rows that can be among the ``n`` of highest membership of their cluster, by counts of rows in bins of it.

    A bin of memberships stays if fewer than ``n`` rows stand in the bins above it. Counts are summed inside tasks
    first, so that a shuffle carries ``BINS`` numbers a cluster and task, and then little more than ``n`` rows a cluster.
    """
    rows = long.withColumn("_bin", F.floor(F.least(F.greatest("membership", F.lit(0.0)), F.lit(1.0)) * BINS).cast("int"))
    counts = rows.groupBy("cluster", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    above = F.sum("_n").over(Window.partitionBy("cluster").orderBy(F.desc("_bin")).rowsBetween(Window.unboundedPreceding, -1))
    wanted = counts.withColumn("_above", above).where(F.coalesce("_above", F.lit(0)) < n).select("cluster", "_bin")
    return rows.join(wanted, ["cluster", "_bin"], "left_semi").drop("_bin")


def top_n_per_cluster(df: DataFrame, clusters: list[str], key: list[str], n: int = 500) -> DataFrame:
    """The ``n`` rows with the highest membership of each cluster."""
    others = [c for c in df.columns if c not in clusters]
    long = df.unpivot(others, clusters, "cluster", "membership").filter(F.col("membership").isNotNull())
    if n > GROUP_LIMIT:
        long = _candidates(long, n)
    return top_rows(long, ["cluster"], [F.desc("membership"), *map(F.col, key)], n)


def head_of_null_rows(df: DataFrame, column: str, key: list[str], n: int = 20) -> DataFrame:
    """The first rows without a value of ``column``."""
    return df.filter(F.col(column).isNull()).orderBy(*key).limit(n)


def latest_season(df: DataFrame, min_games: int = 1000, year: str = "game_year", game: str = "game_pk") -> DataFrame:
    """The last season with enough different games, as one row (T4)."""
    games = df.filter(F.col(year).isNotNull()).groupBy(year).agg(F.count_distinct(game).alias("_games"))
    return games.filter(F.col("_games") >= min_games).agg(F.max(year).alias("season"))


def temporal_split(df: DataFrame, min_games: int = 1000, year: str = "game_year",
                   game: str = "game_pk") -> tuple[DataFrame, DataFrame]:
    """Earlier seasons to train on and the latest full season to test on.

    The season is one number, read once, so both sides prune on a literal.
    """
    season = latest_season(df, min_games, year, game).first()[0]
    if season is None:
        raise ValueError(f"no season has {min_games} games")
    return df.filter(F.col(year) < season), df.filter(F.col(year) == season)

"""Entity-day tables to model features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.functions import values as V
from xoutcome.operators.filters import drop_feature_columns, drop_null_rows, filter_playable
from xoutcome.operators.joins import matchup_feature_join
from xoutcome.operators.windows import (
    DAY, calendar_fill, depth_features, explode_aligned, next_day_view, pitcher_cluster_rolls,
    rolling_weighted_ratio)


def cast_types(df: DataFrame, ints: list[str], floats: list[str]) -> DataFrame:
    """Counts as int, measures as double (X26); other columns keep their type."""
    return df.withColumns({
        **{c: F.col(c).cast("int") for c in ints if c in df.columns},
        **{c: F.col(c).cast("double") for c in floats if c in df.columns},
    })


def filled_days(df: DataFrame, entity: str, target: str = S.TARGET) -> DataFrame:
    """A filled calendar with play flag and calendar parts."""
    days = df.select(target, "bb", "k", "pa", entity, F.col(DAY).cast("date").alias(DAY))
    days = days.withColumn("play", V.play_flag(F.col("pa")))
    days = calendar_fill(days, entity).withColumns(V.calendar_parts(F.col(DAY)))
    return cast_types(days, ["k", "bb", "pa", "play"], [target])


def rate_per_pa(df: DataFrame) -> DataFrame:
    """Strikeout and walk rates."""
    played = F.col("next_play" if "next_play" in df.columns else "play")
    return df.withColumns({
        "k_per_pa": V.strikeout_rate(F.col("k"), F.col("pa"), played),
        "bb_per_pa": V.walk_rate(F.col("bb"), F.col("pa"), played),
    })


def _roll_and_lag(df: DataFrame, entity: str, depth: int, windows: dict[int, int], today: bool,
                  target: str) -> DataFrame:
    lagged = ["bb_per_pa", "k_per_pa", "play", target]
    return depth_features(df, entity, depth, windows, today, [target, "k_per_pa", "bb_per_pa"], lagged)


def batter_features(df: DataFrame, depth: int = 15, target: str = S.TARGET) -> DataFrame:
    """Features for the next day's target of each batter."""
    days = filled_days(df, "batter", target)
    days = rate_per_pa(next_day_view(days, "batter", target))
    windows = {n: n // 5 + 1 for n in range(5, depth + 1, 5)}
    rows = _roll_and_lag(days, "batter", depth, windows, True, target)
    return drop_feature_columns(filter_playable(rows))


def pitcher_features(df: DataFrame, depth: int = 22, bin_size: int = 7, target: str = S.TARGET,
                     exclude_same_day: bool = False) -> DataFrame:
    """Features for the same day's target of each pitcher.

    The counts and rates of the day itself stay by default; ``exclude_same_day`` leaves them out.
    """
    days = rate_per_pa(filled_days(df, "pitcher", target))
    windows = {n: n // bin_size for n in range(bin_size, depth + 1, bin_size)}
    rows = _roll_and_lag(days, "pitcher", depth, windows, False, target)
    out = drop_feature_columns(filter_playable(rows))
    return out.drop("k", "bb", "k_per_pa", "bb_per_pa") if exclude_same_day else out


def matchup_features(matchups: DataFrame, at_bats: DataFrame, hard: list[str], soft: list[str],
                     weights: list[str] | None = None, depth: int = 30, pitcher_min: int = 3, batter_min: int = 10,
                     target: str = S.TARGET, spread: list[str] = ()) -> DataFrame:
    """Features of both sides for each matchup and day, with ``pa`` as the weight.

    ``at_bats`` holds one row per segment with its target and cluster columns. ``spread`` names further columns of
    ``matchups`` that are rolled like the soft clusters, as their daily maxima and minima (W5).
    """
    pitcher_side = pitcher_cluster_rolls(matchups, hard, [*soft, *spread], depth, pitcher_min)
    batter_side = rolling_weighted_ratio(at_bats, weights or [*soft, *hard], target, depth, batter_min)
    rows = drop_null_rows(matchups.select("pitcher", "batter", DAY, target, "pa"))
    return matchup_feature_join(rows, pitcher_side, batter_side).filter(F.col("pa") != 0)


def at_bats_from_lists(matchups: DataFrame, columns: list[str]) -> DataFrame:
    """At-bats of a table that holds them as lists."""
    rows = explode_aligned(matchups, [f"{c}_list" for c in columns], ["batter", DAY])
    return rows.withColumnsRenamed({f"{c}_list": c for c in columns})

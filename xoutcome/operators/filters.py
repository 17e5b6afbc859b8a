"""Row filters and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.functions.values import any_null, is_one_of
from xoutcome.operators.hot import bounded_broadcast, null_safe_join


def remove_empty(df: DataFrame, day: str = "game_date") -> DataFrame:
    """Rows with a date (F1)."""
    return df.filter(F.col(day).isNotNull())


def remove_header_rows(df: DataFrame, day: str = "game_date", header: str | None = None) -> DataFrame:
    """Rows that are not a repeated header line (F2); needs the raw text column."""
    return df.filter(~F.col(day).eqNullSafe(header or day))


def filter_game_type(df: DataFrame, games: tuple[str, ...] = ("R",), column: str = "game_type") -> DataFrame:
    """Rows of the listed game types."""
    return df.filter(F.col(column).isin(list(games)))


def drop_advisory(df: DataFrame, event: str = "events", value: str = "game_advisory") -> DataFrame:
    """Rows that are not an advisory; null events stay."""
    return df.filter(~F.col(event).eqNullSafe(value))


def project_keep(df: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """The kept event columns, plus ``extra`` ones that are present."""
    return df.select(*S.KEEP, *[c for c in extra if c in df.columns and c not in S.KEEP])


def drop_after_simplify(df: DataFrame) -> DataFrame:
    """Without the columns that the event class replaces."""
    return df.drop("description", "type")


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without a null in the listed columns, all by default.

    One condition per column: a single condition over many computed columns makes the optimizer list
    every mix of column and expression when it infers constraints.
    """
    return df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns or df.columns]))


def terminal_event_flag(event: Column) -> Column:
    """True where an event ends a segment (F8)."""
    return is_one_of(event, S.TERMINAL_EVENTS)


def drop_no_throw(df: DataFrame, event: str = "events") -> DataFrame:
    """Rows whose event has a throw; null events stay."""
    return df.filter(~is_one_of(F.col(event), S.NO_THROW_EVENTS))


def filter_playable(df: DataFrame) -> DataFrame:
    """Complete rows with a play on the day the target is from."""
    flag = "next_play" if "next_play" in df.columns else "pa"
    return drop_null_rows(df).filter(F.col(flag) != 0)


def feature_columns_to_drop(columns: list[str]) -> list[str]:
    return [c for c in columns if ("days_off" in c or "play" in c) and c != "next_play"]


def drop_feature_columns(df: DataFrame) -> DataFrame:
    """Without helper features, ``next_play`` excepted."""
    return df.drop(*feature_columns_to_drop(df.columns))


def group_size_filter(df: DataFrame, keys: list[str], n: int, strict: bool = False) -> DataFrame:
    """Rows of groups with at least ``n`` rows, more than ``n`` if strict.

    Counts combine before the shuffle and only qualifying keys come back, so a large group never
    meets in one task as it would in a window.
    """
    size = F.col("_n") > n if strict else F.col("_n") >= n
    kept = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(size).select(*keys)
    return null_safe_join(df, bounded_broadcast(kept), keys, "left_semi")


def entity_season_select(
    df: DataFrame, pairs: DataFrame, role: str = "pitcher", year: str = "game_year"
) -> DataFrame:
    """Rows of the listed (entity, year) pairs; a repeated pair repeats its rows."""
    wanted = pairs.toDF(role, year)
    return df.join(bounded_broadcast(wanted), [role, year])


def split_complete_rows(df: DataFrame, columns: list[str] = S.METRICS) -> tuple[DataFrame, DataFrame]:
    """Rows complete in ``columns``, and the others."""
    return df.filter(~any_null(columns)), df.filter(any_null(columns))


def feature_target_split(
    df: DataFrame, target: str, keys: list[str], weight: str = "pa"
) -> tuple[list[str], str, str]:
    """Names of the features, the target and the weight of a prepared table."""
    features = [c for c in df.columns if c != target and c not in keys]
    return features, target, weight


def focus_matchup(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Cluster columns and the named ones of a matchup table (F16)."""
    named = ["game_date", "batter", "pitcher", "bb", "events", "pa", target, f"{target}_list"]
    return df.select(*[c for c in df.columns if "cluster" in c], *[c for c in named if c in df.columns])


def cluster_feature_columns(columns: list[str]) -> list[str]:
    """Names that hold ``cluster``."""
    return [c for c in columns if "cluster" in c]


def non_id_columns(columns: list[str], ids: tuple[str, ...] = ("pitcher", "game_year", "pitch_type")) -> list[str]:
    """Names outside the id set."""
    return [c for c in columns if c not in ids]


def rename_family(df: DataFrame, columns: list[str], suffix: str, replaces: str = "") -> DataFrame:
    """Columns with ``suffix`` added, in place of ``replaces`` where that is given."""
    names = {c: (c.replace(replaces, suffix) if replaces else c + suffix) for c in columns}
    return df.withColumnsRenamed(names)


def filter_category_year(
    df: DataFrame, category: str, year: int | None = None, day: str = "game_date", event: str | None = None
) -> DataFrame:
    """Rows with a value of ``category``, of one year and one event where given."""
    tests = [F.col(category).isNotNull()]
    if year is not None:
        tests.append(F.year(day) == year)
    if event is not None:
        tests.append(F.col("events") == event)
    return df.filter(reduce(lambda a, b: a & b, tests))

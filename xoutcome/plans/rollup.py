"""Clean events to entity-day tables (P5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.functions.values import hard_assign
from xoutcome.operators.aggregates import (
    day_keys, entity_day_rollup, event_indicators, group_spread_and_list, segment_rollup)
from xoutcome.operators.filters import drop_null_rows
from xoutcome.operators.hot import MAX_ROWS
from xoutcome.operators.windows import segment_ids


def segments(events: DataFrame, columns: list[str] | None = None, game: str = "game_pk",
             order: list[str] = S.EVENT_ORDER, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """One row per segment with its counts (W1, A1, X20); newest row first, so the deciding one leads."""
    order = [c for c in order if c != game]
    numbered = segment_ids(events, [game], order, max_rows=max_rows)
    columns = [c for c in (columns or events.columns) if c != game]
    rows = segment_rollup(numbered, [game, "segment_id"], order, columns=columns)
    return rows.withColumns(event_indicators(F.col("events")))


def with_hard_clusters(df: DataFrame, soft: list[str]) -> DataFrame:
    """Add ``cluster_i`` from the soft columns."""
    return df.select("*", *hard_assign(soft))


def day_table(rows: DataFrame, mode: str, soft: list[str] = (), hard: list[str] = (), attributes: list[str] = (),
              target: str = S.TARGET) -> DataFrame:
    """Entity-day table of a role; ``both`` also has the spread of the soft clusters."""
    teams = [c for c in ("home_team", "away_team") if c in rows.columns]
    spread = soft if mode == "both" else []
    return entity_day_rollup(rows, mode, hard, [*attributes, *soft], teams, target, spread)


def matchup_lists(rows: DataFrame, soft: list[str], hard: list[str], target: str = S.TARGET,
                  order: list[str] = ("game_pk", "segment_id"), max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Cluster and target lists per matchup and day (A3)."""
    return group_spread_and_list(rows, day_keys("both"), list(order), soft, [*soft, *hard, target], max_rows)


def at_bats(rows: DataFrame, soft: list[str], hard: list[str], target: str = S.TARGET) -> DataFrame:
    """The rows those lists would unroll to again: one per segment, complete ones only."""
    return drop_null_rows(rows.select("batter", "game_date", *soft, *hard, target))

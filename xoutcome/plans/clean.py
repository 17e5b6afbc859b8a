"""Raw events to clean events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.functions import text, values
from xoutcome.operators import filters
from xoutcome.operators.aggregates import impute_target
from xoutcome.operators.hot import MAX_ROWS
from xoutcome.operators.windows import fill_backward_forward


def fill_events(df: DataFrame) -> DataFrame:
    """A null event takes the description."""
    return df.withColumn("events", F.coalesce("events", "description"))


def fill_constants(df: DataFrame, fills: dict) -> DataFrame:
    """Nulls become constants."""
    return df.na.fill(fills)


def split_game_date(df: DataFrame) -> DataFrame:
    """Year, month and day from the text, and a real date."""
    day = F.col("game_date")
    return df.withColumns({
        "game_year": text.date_part(day, "year").try_cast("int"),
        "game_month": text.date_part(day, "month").try_cast("int"),
        "game_day": text.date_part(day, "day").try_cast("int"),
        "game_date": text.parse_date(day),
    })


def with_spin_vector(df: DataFrame, rate: str = "release_spin_rate", axis: str = "spin_axis") -> DataFrame:
    """Add ``spin_x`` and ``spin_z``."""
    x, z = values.spin_vector(F.col(rate), F.col(axis))
    return df.withColumns({"spin_x": x, "spin_z": z})


def zero_target_on_strikeout(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Strikeouts have a target of 0."""
    out = values.is_one_of(F.col("events"), S.STRIKEOUT_EVENTS)
    return df.withColumn(target, F.when(out, 0.0).otherwise(F.col(target)))


def clean_events(raw: DataFrame, order: list[str] = S.EVENT_ORDER, keep_derived: bool = False,
                 prefer_same_day: bool = False, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Typed regular-season events with filled metrics and targets.

    Filters come first and read raw columns only, so they reach the scan. Target medians come from the
    raw rows, all game types included.
    """
    df = raw.transform(filters.remove_empty).transform(filters.remove_header_rows)
    df = df.transform(filters.filter_game_type).transform(fill_events).transform(filters.drop_advisory)
    extra = ["at_bat_number"]
    if keep_derived:
        df = df.withColumn("batter_name", text.actor_name(F.col("des"), F.col("events")))
        extra += ["batter_name", "game_month", "game_day"]
    df = df.transform(split_game_date).transform(lambda d: filters.project_keep(d, tuple(extra)))
    df = df.withColumn("bat_event", values.classify_event(F.col("events")))
    df = df.transform(filters.drop_after_simplify).transform(with_spin_vector)
    df = fill_backward_forward(df, S.METRICS, ["pitcher"], order, True, prefer_same_day, max_rows=max_rows)
    df = zero_target_on_strikeout(df)
    return impute_target(df, stats_from=raw, max_rows=max_rows)

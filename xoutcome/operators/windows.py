"""Windows over ordered events and over the days of an entity.

The day windows take one row per entity and day, so a partition is bounded by the calendar whatever
the number of events behind it. Event windows use ``operators.hot``, which cuts keys of any size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.functions import values as V
from xoutcome.operators.aggregates import daily_sum, weighted_mean_by_cluster
from xoutcome.operators.filters import drop_null_rows, terminal_event_flag
from xoutcome.operators.hot import MAX_ROWS, next_and_previous, running_sum

DAY = "game_date"
_D = "_day_number"


def segment_ids(df: DataFrame, keys: list[str], order: list[str], event: str = "events", descending: bool = True,
                out: str = "segment_id", split_on: list[str] | None = None,
                max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Running count of segment-ending events, newest row first, inside each game.

    Rows before the first such event form segment 0.
    """
    flag = terminal_event_flag(F.col(event)).cast("int")
    return running_sum(df, flag, keys, order, out, descending, split_on or order, max_rows)


def fill_backward_forward(df: DataFrame, columns: list[str], by: list[str], order: list[str],
                          descending: bool = True, prefer_same_day: bool = False, day: str = DAY,
                          split_on: list[str] | None = None, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Rows null in any of ``columns`` take all of them from the next complete row, else the one before.

    The columns travel as one struct, so there is one window per direction for all of them.
    """
    held = df.withColumn("_held", F.when(~V.any_null(columns), F.struct(*columns)))
    picks = []
    if prefer_same_day:
        held = next_and_previous(held, "_held", [*by, day], order, descending, split_on or order, max_rows)
        held = held.withColumnsRenamed({"_next": "_day_next", "_prev": "_day_prev"})
        picks = ["_day_next", "_day_prev"]
    held = next_and_previous(held, "_held", by, order, descending, split_on or order, max_rows)
    held = held.withColumn("_held", F.coalesce(*picks, "_next", "_prev"))
    return held.select(*[F.col(f"_held.{c}").alias(c) if c in columns else F.col(c) for c in df.columns])


def calendar_fill(df: DataFrame, entity: str | list[str], day: str = DAY) -> DataFrame:
    """One row per entity and day from its first to its last; keys filled, other columns 0 on new days.

    Each row is repeated up to the day before the next one, so no calendar is joined.
    """
    keys = [entity] if isinstance(entity, str) else list(entity)
    following = F.lead(day).over(Window.partitionBy(*keys).orderBy(day))
    last = F.coalesce(F.date_sub(following, 1), F.col(day))
    spread = df.withColumns({"_of": F.col(day), "_to": last})
    spread = spread.withColumn(day, F.explode(F.sequence(day, "_to")))
    first = F.col(day) == F.col("_of")
    rest = [c for c in df.columns if c not in [*keys, day]]
    zero = {f.name: F.lit(0).cast(f.dataType) for f in df.schema.fields if f.name in rest}
    return spread.select(*[
        F.when(first, F.coalesce(F.col(c), zero[c])).otherwise(zero[c]).alias(c) if c in rest else F.col(c)
        for c in df.columns
    ])


def day_window(entity: str | list[str], day: str = _D):
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(day)


def days_before(entity, n: int, day: str = _D):
    """The ``n`` days before this one: ``[t - n, t)``."""
    return day_window(entity, day).rangeBetween(-n, -1)


def days_up_to(entity, n: int, day: str = _D):
    """The last ``n`` days, this one included: ``(t - n, t]``."""
    return day_window(entity, day).rangeBetween(-(n - 1), 0)


def with_day_number(df: DataFrame, day: str = DAY) -> DataFrame:
    """Add the integer day that both range frames and lags are ordered by."""
    return df.withColumn(_D, F.unix_date(day))


def rolled(value: Column, frame, needed: int, how=F.sum) -> Column:
    """Aggregate over a frame, null where the frame has fewer than ``needed`` values."""
    return F.when(F.count(value).over(frame) >= needed, how(value).over(frame))


def _cluster_sums(df: DataFrame, hard: list[str], soft: list[str], n: int, entity: str) -> DataFrame:
    days = with_day_number(daily_sum(df, [entity, DAY], [*hard, *soft, "pa", "bb"]))
    frame = days_before(entity, n)
    return days.select(
        entity, DAY, F.count(F.lit(1)).over(frame).alias("_days"), F.sum(F.col("pa") + F.col("bb")).over(frame).alias("_base"),
        *[F.sum(c).over(frame).alias(f"_{c}") for c in hard], *[F.avg(c).over(frame).alias(f"{c}_roll") for c in soft])


def _rates(hard: list[str]) -> list[Column]:
    return [F.try_divide(F.col(f"_{c}"), F.col("_base")).alias(f"{c}_roll_per_pa") for c in hard]


def _cluster_rolls(df: DataFrame, hard: list[str], soft: list[str], n: int, needed: int, entity: str) -> DataFrame:
    sums = _cluster_sums(df, hard, soft, n, entity)
    # Every daily sum has a value, so a row lacks one of its features only where it lacks all of them.
    kept = sums.filter(F.col("_days") >= needed)
    kept = kept.filter(F.col("_base") != 0) if hard else kept
    return kept.select(entity, DAY, *_rates(hard), *[f"{c}_roll" for c in soft])


def hard_per_pa(df: DataFrame, hard: list[str], n: int = 30, entity: str = "pitcher") -> DataFrame:
    """Use of each hard cluster per appearance over the days before, of every day; null where there was none."""
    return _cluster_sums(df, hard, [], n, entity).select(entity, DAY, *_rates(hard))


def rolling_hard(df: DataFrame, hard: list[str], n: int = 30, needed: int = 3, entity: str = "pitcher") -> DataFrame:
    """``hard_per_pa`` of the days that have such rates, from ``needed`` days on."""
    return _cluster_rolls(df, hard, [], n, needed, entity)


def rolling_soft(df: DataFrame, soft: list[str], n: int = 30, needed: int = 3, entity: str = "pitcher") -> DataFrame:
    """Mean daily sum of each soft cluster over the days before."""
    return _cluster_rolls(df, [], soft, n, needed, entity)


def pitcher_cluster_rolls(df: DataFrame, hard: list[str], soft: list[str], n: int = 30, needed: int = 3,
                          entity: str = "pitcher") -> DataFrame:
    """W4 and W5 together: one rollup and one window for both feature sets of an entity."""
    return _cluster_rolls(df, hard, soft, n, needed, entity)


def rolling_weighted_ratio(df: DataFrame, weights: list[str], value: str, n: int = 30, needed: int = 10,
                           entity: str = "batter", names: dict[str, str] | None = None) -> DataFrame:
    """Weighted mean of ``value`` per cluster over the days before, by sums of both parts.

    Rows without any weight in the frame are dropped, single clusters without weight get 0.
    """
    names = names or {w: f"{w}_estimated" for w in weights}
    known = df.filter(F.col(value).isNotNull())
    days = with_day_number(weighted_mean_by_cluster(known, [entity, DAY], value, weights))
    days = days.withColumn("_any", sum((F.col(w) for w in weights[1:]), F.col(weights[0])))
    frame = days_before(entity, n)
    sums = days.select(
        entity, DAY, F.count(F.lit(1)).over(frame).alias("_days"), F.sum("_any").over(frame).alias("_total"),
        *[F.sum(F.col(f"{w}_agg") * F.col(w)).over(frame).alias(f"_x_{w}") for w in weights],
        *[F.sum(w).over(frame).alias(f"_w_{w}") for w in weights])
    kept = sums.filter((F.col("_days") >= needed) & (F.col("_total") != 0))
    return kept.select(entity, DAY, *[
        V.clean_ratio(F.col(f"_x_{w}"), F.col(f"_w_{w}")).alias(names[w]) for w in weights])


def rolling_rate(value: str, frame, needed: int, play: str = "play") -> Column:
    """Sum of ``value`` per played day of the frame."""
    return F.try_divide(rolled(F.col(value), frame, needed), rolled(F.col(play), frame, needed))


def rolling_rate_weighted(value: str, frame, needed: int, weight: str = "pa", walks: str = "bb") -> Column:
    """Weighted mean of ``value`` over the frame (W8); walk rates also weigh the walks."""
    top = rolled(F.col(value) * F.col(weight), frame, needed)
    base = rolled(F.col(weight), frame, needed)
    below = base + rolled(F.col(walks), frame, needed) if "bb" in value else base
    return F.when(base != 0, F.try_divide(top, below))


def lag_features(columns: list[str], n: int, window) -> list[Column]:
    """The values of the ``n`` rows before, nearest first."""
    return [F.lag(c, i).over(window).alias(f"{c}_{i}") for c in columns for i in range(1, n + 1)]


def shift_target(columns: dict[str, str], window) -> dict[str, Column]:
    """The values of the following row under new names."""
    return {new: F.lead(old, 1).over(window) for new, old in columns.items()}


def depth_features(df: DataFrame, entity: str, lags: int, windows: dict[int, int], today: bool,
                   roll: list[str], lagged: list[str], weight: str = "pa", walks: str = "bb") -> DataFrame:
    """Rolling rates at each window length, then lags (W11), all as window columns of one frame.

    Takes a filled calendar without nulls. ``today``: the windows end with this day (next-day targets)
    or with the day before. Sums that several rates share are made once.
    """
    sums = {}
    for n, needed in windows.items():
        frame = days_up_to(entity, n) if today else days_before(entity, n)
        enough = F.count(F.lit(1)).over(frame) >= needed
        parts = {"play": F.col("play"), weight: F.col(weight), walks: F.col(walks)}
        parts |= {v: F.col(v) for v in roll}
        parts |= {f"w_{v}": F.col(v) * F.col(weight) for v in roll}
        sums[f"_enough_{n}"] = enough
        sums |= {f"_{name}_{n}": F.sum(c).over(frame) for name, c in parts.items()}
    rolled_up = with_day_number(df).select(
        *df.columns, *[c.alias(name) for name, c in sums.items()],
        *lag_features(lagged, lags, day_window(entity)))
    rates = []
    for value in roll:
        for n in windows:
            enough = F.col(f"_enough_{n}")
            base = F.col(f"_{weight}_{n}")
            below = base + F.col(f"_{walks}_{n}") if "bb" in value else base
            plain = F.try_divide(F.col(f"_{value}_{n}"), F.col(f"_play_{n}"))
            weighted = F.when(base != 0, F.try_divide(F.col(f"_w_{value}_{n}"), below))
            rates.append(F.when(enough, plain).alias(f"{value}_mean_{n}"))
            rates.append(F.when(enough, weighted).alias(f"{value}_mean_weighted_{n}"))
    lag_names = [f"{c}_{i}" for c in lagged for i in range(1, lags + 1)]
    return rolled_up.select(*df.columns, *rates, *lag_names)


def explode_aligned(df: DataFrame, lists: list[str], keep: list[str]) -> DataFrame:
    """List columns unrolled in step; rows with a null are dropped."""
    rows = df.select(*keep, F.explode(F.arrays_zip(*lists)).alias("_row"))
    return drop_null_rows(rows.select(*keep, *[F.col(f"_row.{c}").alias(c) for c in lists]))


def next_day_view(df: DataFrame, entity: str, target: str = S.TARGET) -> DataFrame:
    """Add the next day's target, play flag and calendar parts; the last day of an entity goes."""
    dated = with_day_number(df)
    shifted = shift_target(
        {f"next_{target}": target, "next_play": "play", "day_of_week": "day_of_week", "month": "month",
         "year": "year"}, day_window(entity))
    return drop_null_rows(dated.withColumns(shifted).drop(_D))

"""Group aggregates: segment and day rollups, medians and imputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from xoutcome import schema as S
from xoutcome.functions.values import clean_ratio, is_one_of
from xoutcome.operators.hot import MAX_ROWS, bounded_broadcast, null_safe_join, running_sum, with_chunks
from xoutcome.session import stored

ROLES = {"batter": ["batter"], "pitcher": ["pitcher"], "both": ["pitcher", "batter"]}


def segment_rollup(
    df: DataFrame, keys: list[str], order: list[str], descending: bool = True,
    columns: list[str] | None = None, count: str = "pitch_count",
) -> DataFrame:
    """First non-null value of each column per segment, in order, and the number of rows (A1)."""
    columns = [c for c in (columns or df.columns) if c not in keys]
    pick = F.max_by if descending else F.min_by
    place = F.struct(*order)
    firsts = [pick(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*firsts, F.count(F.lit(1)).alias(count))


def day_keys(mode: str) -> list[str]:
    if mode not in ROLES:
        raise ValueError(f"mode must be one of {sorted(ROLES)}, not {mode!r}")
    return ["game_date", *ROLES[mode]]


def event_indicators(event: Column) -> dict[str, Column]:
    """Strikeout, walk and appearance counts of one segment."""
    return {
        "k": is_one_of(event, S.STRIKEOUT_EVENTS).cast("int"),
        "bb": is_one_of(event, S.WALK_EVENTS).cast("int"),
        "pa": F.lit(1),
    }


def entity_day_rollup(
    segments: DataFrame, mode: str, hard: list[str] = (), soft: list[str] = (),
    carry: list[str] = (), target: str = S.TARGET, spread: list[str] = (),
) -> DataFrame:
    """One row per entity and day (A2): sums of counts and hard clusters, means of the target and soft columns.

    ``carry`` columns (constant within a day) keep their smallest value; ``spread`` ones add their limits.
    Partial sums are made before the shuffle, so a day of any size is one small row per map task.
    """
    keys = day_keys(mode)
    sums = [F.sum(c).alias(c) for c in ["bb", "k", "pitch_count", "pa", *hard] if c in segments.columns]
    means = [F.avg(c).alias(c) for c in [target, *soft]]
    spreads = [f(c).alias(f"{c}_{f.__name__}") for c in spread for f in (F.max, F.min)]
    return segments.groupBy(*keys).agg(*sums, *means, *spreads, *[F.min(c).alias(c) for c in carry])


def group_spread_and_list(
    df: DataFrame, keys: list[str], order: list[str], spread: list[str], lists: list[str],
    max_rows: int | None = MAX_ROWS,
) -> DataFrame:
    """Largest and smallest value, and the values in order, per group (A3).

    A group too long for one array comes as several rows, ``list_part`` 0, 1, ... in order, each with a
    run of its list and the spread of the whole group. Other groups have the one part 0.
    """
    df, chunks = with_chunks(df, keys, order, max_rows, lists)
    rows = F.array_sort(F.collect_list(F.struct(*order, *[F.col(c).alias(f"_l_{c}") for c in lists])))
    spreads = [f(c).alias(f"{c}_{f.__name__}") for c in spread for f in (F.max, F.min)]
    parts = df.groupBy(*keys, *chunks).agg(rows.alias("_rows"), *spreads)
    if chunks:
        # The order of a chunk among its group's chunks, counted on the one-row-per-chunk table.
        chunk_rows = df.groupBy(*keys, *chunks).agg(F.lit(1).alias("_one"))
        numbered = running_sum(chunk_rows, F.lit(1), keys, chunks, "_part", max_rows=None)
        parts = null_safe_join(parts, numbered.select(*keys, *chunks, "_part"), keys + chunks)
        parts = parts.withColumn("list_part", (F.col("_part") - 1).cast("int"))
        if spread:
            own = [F.max(f"{c}_max").alias(f"{c}_max") for c in spread]
            own += [F.min(f"{c}_min").alias(f"{c}_min") for c in spread]
            whole = df.groupBy(*keys, *chunks).agg(*spreads).groupBy(*keys).agg(*own)
            parts = null_safe_join(parts.drop(*[f"{c}_{f}" for c in spread for f in ("max", "min")]), whole, keys)
    else:
        parts = parts.withColumn("list_part", F.lit(0))
    return parts.select(
        *keys, "list_part", *[f"{c}_{f}" for c in spread for f in ("max", "min")],
        *[F.col("_rows").getField(f"_l_{c}").alias(f"{c}_list") for c in lists],
    )


def weighted_mean_by_cluster(
    df: DataFrame, keys: list[str], value: str, weights: list[str], suffix: str = "_agg"
) -> DataFrame:
    """Weighted mean of ``value`` and the weight sum, for each weight column.

    Magnitudes only, as all inputs are rates; a zero weight sum gives 0.
    """
    x = F.abs(F.col(value))
    sums = [F.sum(F.abs(F.col(w))) for w in weights]
    means = [
        clean_ratio(F.sum(x * F.abs(F.col(w))), total).alias(f"{w}{suffix}") for w, total in zip(weights, sums)
    ]
    return df.groupBy(*keys).agg(*means, *[total.alias(w) for w, total in zip(weights, sums)])


def daily_sum(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Sums per key and day (A5); a day of nulls sums to 0."""
    return df.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in columns])


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """How often each value occurs per group, written once: what every median reads instead of the rows."""
    known = df.filter(F.col(value).isNotNull())
    return stored(known.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n")), "value-counts")


def median_of_counts(counts: DataFrame, groups: list[str], value: str, out: str = "median",
                     max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Exact median per group of a table of value counts.

    A running count finds the middle, so no group's values meet in one task, however many there are.
    """
    upto = running_sum(counts, F.col("_n"), groups, [value], "_upto", max_rows=max_rows)
    totals = counts.groupBy(*groups).agg(F.sum("_n").alias("_total"))
    placed = null_safe_join(upto, totals, groups)
    low = F.min(F.when(F.col("_upto") >= F.ceil(F.col("_total") / 2), F.col(value)))
    high = F.min(F.when(F.col("_upto") > F.floor(F.col("_total") / 2), F.col(value)))
    return placed.groupBy(*groups).agg(((low + high) / 2).alias(out))


def exact_median(df: DataFrame, groups: list[str], value: str, out: str = "median",
                 max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Exact median per group, nulls skipped."""
    return median_of_counts(value_counts(df, groups, value), groups, value, out, max_rows)


def median_table(df: DataFrame, category: str, events: list[str] | None = None, by: list[str] = (),
                 event: str = "events", out: str = "median", max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Median of ``category`` per event, and per ``by`` columns where given."""
    rows = df.filter(F.col(event).isin(list(events))) if events is not None else df
    return exact_median(rows, [event, *by], category, out, max_rows)


def impute_median(df: DataFrame, category: str, events: list[str] | None = None, by: list[str] = (),
                  stats_from: DataFrame | None = None, event: str = "events",
                  max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Null values of ``category`` become the median of their event (A7), per ``by`` columns where given."""
    source = stats_from if stats_from is not None else df
    medians = median_table(source, category, events, by, event, "_median", max_rows)
    joined = df.join(bounded_broadcast(medians), [event, *by], "left")
    return joined.select(*[
        F.coalesce(category, "_median").alias(c) if c == category else c for c in df.columns
    ])


def impute_target(df: DataFrame, stats_from: DataFrame | None = None, target: str = S.TARGET,
                  event: str = "events", kind: str = "bb_type", by_type: list[str] = S.BY_TYPE_EVENTS,
                  max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Null targets become medians: per event, and per (kind, event) for the ``by_type`` events.

    Both tables come from one count of ``stats_from``, by default ``df`` itself; pass the raw table for
    medians of all rows.
    """
    counts = value_counts(stats_from if stats_from is not None else df, [event, kind], target)
    typed = F.col(event).isin(list(by_type))
    per_event = counts.filter(~typed).groupBy(event, target).agg(F.sum("_n").alias("_n"))
    per_event = median_of_counts(per_event, [event], target, "_m_event", max_rows)
    per_kind = median_of_counts(counts.filter(typed), [event, kind], target, "_m_kind", max_rows)
    joined = (df.join(bounded_broadcast(per_event), event, "left")
              .join(bounded_broadcast(per_kind), [event, kind], "left"))
    return joined.select(*[
        F.coalesce(target, "_m_event", "_m_kind").alias(c) if c == target else c for c in df.columns
    ])


def distinct_counts(df: DataFrame, keys: list[str], column: str, out: str) -> DataFrame:
    """Number of different values per group (A10)."""
    return df.groupBy(*keys).agg(F.count_distinct(column).alias(out))


def members_by_type(df: DataFrame, kind: str = "pitch_type", member: str = "pitcher") -> DataFrame:
    """Pairs (type, member), one row each (A11); a list per type could not be bounded."""
    return df.select(kind, member).distinct()


def types_by_member(df: DataFrame, kind: str = "pitch_type", member: str = "pitcher") -> DataFrame:
    """The set of types of each member in order, and their number (A11). There are only a few types."""
    kinds = F.array_sort(F.collect_set(kind))
    return df.groupBy(member).agg(kinds.alias("types"), F.count_distinct(kind).alias("type_count"))


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Different values of each column, as text."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).distinct()

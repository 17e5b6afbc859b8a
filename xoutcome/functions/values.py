"""Numeric and conditional expressions."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from xoutcome import schema as S


def is_one_of(c: Column, values: list[str]) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(c.isin(list(values)), F.lit(False))


def classify_event(event: Column) -> Column:
    """Class of an event name, null for an unknown one."""
    pairs = [(name, group) for group, names in S.EVENT_CLASSES.items() for name in names]
    mapping = F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs)])
    return F.try_element_at(mapping, event)


def spin_vector(rate: Column, axis: Column) -> tuple[Column, Column]:
    """Spin rate along the two ground axes."""
    angle = F.radians(axis)
    return rate * F.sin(angle), rate * F.cos(angle)


def occupied(runner: Column) -> Column:
    """1 where a base holds a runner id."""
    return (F.coalesce(runner, F.lit(0)) != 0).cast("int")


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def null_all_if_any_null(columns: list[str]) -> list[Column]:
    """All listed columns null where one of them is."""
    hole = any_null(columns)
    return [F.when(~hole, F.col(c)).alias(c) for c in columns]


def clean_ratio(top: Column, bottom: Column) -> Column:
    """Quotient that is 0 where it has no finite value."""
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def hard_assign(columns: list[str], prefix: str = "cluster") -> list[Column]:
    """One-hot columns of the row maximum; ties set several ones, an all-null row none."""
    top = F.greatest(*columns) if len(columns) > 1 else F.col(columns[0])
    return [
        F.coalesce((F.col(c) == top).cast("int"), F.lit(0)).alias(f"{prefix}_{i}")
        for i, c in enumerate(columns)
    ]


def play_flag(pa: Column) -> Column:
    """1 on a day with a plate appearance."""
    return F.coalesce((pa > 0).cast("int"), F.lit(0))


def calendar_parts(day: Column) -> dict[str, Column]:
    """Weekday (Sunday 0), month and year."""
    return {"day_of_week": F.dayofweek(day) - 1, "month": F.month(day), "year": F.year(day)}


def strikeout_rate(k: Column, pa: Column, played: Column) -> Column:
    """k per plate appearance on rows that count, else 0."""
    return F.when(F.coalesce(played != 0, F.lit(True)), clean_ratio(k, pa)).otherwise(0.0)


def walk_rate(bb: Column, pa: Column, played: Column) -> Column:
    """bb per plate appearance or walk on rows that count, else 0."""
    return F.when(F.coalesce(played != 0, F.lit(True)), clean_ratio(bb, pa + bb)).otherwise(0.0)


def abs_all(columns: list[str]) -> dict[str, Column]:
    """Absolute values under the columns' own names."""
    return {c: F.abs(F.col(c)) for c in columns}


def weight_target(target: str = "xba", weight: str = "pa") -> dict[str, Column]:
    """Target times weight, and the weight beside it."""
    return {"weighted_target": F.col(target) * F.col(weight), "weighted_pa": F.col(weight)}

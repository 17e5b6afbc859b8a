"""Text expressions: actor names out of play descriptions, dates, list columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from xoutcome import schema as S

def _any_of(words: list[str]) -> str:
    """A pattern of the words as they stand, longer ones first."""
    return "|".join(f"\\Q{w}\\E" for w in sorted(words, key=len, reverse=True))


def extract_actor(text: Column, words: list[str] = S.ACTION_WORDS) -> Column:
    """Text before the first action word."""
    return F.split(text, _any_of(words), 2)[0]


def after_last_base(text: Column, marks: list[str] = S.BASE_MARKS) -> Column:
    """Text after the last mention of a base."""
    return F.element_at(F.split(text, _any_of(marks), -1), -1)


def after_challenge(text: Column, marks: list[str] = S.CHALLENGE_MARKS) -> Column:
    """Text after the outcome of a challenge."""
    return F.element_at(F.split(text, _any_of(marks), -1), -1)


def null_if_long(text: Column, limit: int = S.NAME_LIMIT) -> Column:
    """Null where the text is too long for a name."""
    return F.when(F.length(text) <= limit, text)


def null_for_events(text: Column, event: Column, events: list[str] = S.UNNAMED_ACTOR_EVENTS) -> Column:
    """Null for plays that name no actor (X10); a null event keeps the text."""
    return F.when(F.coalesce(event.isin(events), F.lit(False)), F.lit(None)).otherwise(text)


def actor_name(description: Column, event: Column) -> Column:
    """Actor of a play (X11)."""
    text = F.coalesce(description, F.lit("blank"))
    return null_for_events(null_if_long(after_challenge(after_last_base(extract_actor(text)))), event)


def orient_name(name: Column) -> Column:
    """``'Last, First'`` to ``'First Last'``; null where there is no comma."""
    parts = F.split(name, ",")
    return F.when(F.size(parts) >= 2, F.concat_ws(" ", F.trim(parts[1]), F.trim(parts[0])))


def date_part(text: Column, part: str) -> Column:
    """Year, month or day of a ``'YYYY-MM-DD'`` text, as text."""
    position = {"year": 1, "month": 2, "day": 3}[part.lower()]
    return F.split_part(text, F.lit("-"), F.lit(position))


def parse_date(text: Column) -> Column:
    """Date of a text, null where it is not a date."""
    return F.try_to_date(text, "yyyy-MM-dd")


def parse_list(text: Column) -> Column:
    """``'[0.1, nan]'`` to an array of doubles; ``nan`` becomes null."""
    items = F.split(F.regexp_replace(text, r"[\[\] ]", ""), ",")
    return F.transform(items, lambda v: F.nullif(v, F.lit("nan")).try_cast("double"))

"""Column expressions used across operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for a missing value: fixed values.
NULL_TEXTS = ["", "nan", "NaN", "None"]
TRUE_TEXTS = ["true", "t", "1", "yes", "y"]
FALSE_TEXTS = ["false", "f", "0", "no", "n"]
BLANK_METADATA = ["", "nan", "<na>", "none"]
#: What an action of the downloader means for the stored status.
STATUS_OF_ACTION = {"downloaded": "success", "existing": "success", "empty": "empty", "existing_empty": "empty", "failed": "failed", "skipped": "skipped"}


def null_like(c: Column) -> Column:
    """Trimmed text, null where it stands for a missing value."""
    text = F.trim(c)
    return F.when(~text.isin(NULL_TEXTS), text)


def ticker_of(c: Column) -> Column:
    return F.upper(F.trim(c))


def composite_id(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def number(c: Column, kind: str = "double") -> Column:
    return c.try_cast(kind)


def first_alias(fields: Column, names: list[str], kind: str = "double") -> Column:
    """The first of the names that holds a number, from a map of texts."""
    return F.coalesce(*[F.try_element_at(fields, F.lit(n)).try_cast(kind) for n in names])


def parse_instant(c: Column) -> Column:
    """ISO-8601 text of mixed forms, as an instant in the session's zone (UTC); null if unparsable."""
    return F.try_to_timestamp(c)


def iso_utc(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def guarded_ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is null or 0."""
    return F.try_divide(a, b)


def weekday(date: Column) -> Column:
    """0 (Sunday) to 6."""
    return (F.dayofweek(date) - 1).cast("long")


def next_month(date: Column) -> Column:
    return F.add_months(F.trunc(date, "MM"), 1)


def short_text(c: Column, n: int = 2000) -> Column:
    return F.substring(c, 1, n)


def parse_boolean(c: Column) -> Column:
    """Tolerant boolean; unknown texts give null."""
    text = F.lower(F.trim(c.cast("string")))
    return F.when(text.isin(TRUE_TEXTS), True).when(text.isin(FALSE_TEXTS), False)


def status_of(action: Column) -> Column:
    """Stored status of an action; null for an unknown one."""
    table = F.create_map(*[F.lit(x) for pair in STATUS_OF_ACTION.items() for x in pair])
    return F.try_element_at(table, action)


def failure_action(error: Column) -> Column:
    """A download error: a 404 that says not found is skipped, anything else failed; null without an error."""
    text = F.lower(error)
    gone = text.contains("404") & text.contains("not found")
    return F.when(error.isNull(), None).when(gone, "skipped").otherwise("failed")


def market_time(instant: Column, zone: str) -> Column:
    return F.from_utc_timestamp(instant, zone)


def any_pattern(c: Column, patterns: list[str]) -> Column:
    return F.coalesce(c.rlike("|".join(f"(?:{p})" for p in patterns)), F.lit(False)) if patterns else F.lit(False)


def any_literal(c: Column, words: list[str]) -> Column:
    """Whether one of the words is a substring, ignoring case."""
    low = F.lower(c)
    hits = [F.coalesce(low.contains(w.lower()), F.lit(False)) for w in words]
    return F.greatest(*hits) if len(hits) > 1 else hits[0] if hits else F.lit(False)

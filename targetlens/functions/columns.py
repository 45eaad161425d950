"""Column helpers: name resolution, lenient casts, guarded arithmetic."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_column(
    df: DataFrame, aliases: Iterable[str], default: str | None = None
) -> str | None:
    """First column of ``df`` (in table order) whose trimmed lower-case name is an alias."""
    wanted = {a.lower() for a in aliases}
    return next((c for c in df.columns if c.strip().lower() in wanted), default)


def first_alias(df: DataFrame, aliases: Sequence[str]) -> str | None:
    """Column matching the earliest alias; the alias order decides, not the table order."""
    by_name = {c.strip().lower(): c for c in df.columns}
    return next((by_name[a.lower()] for a in aliases if a.lower() in by_name), None)


def col(name: str) -> Column:
    """Reference a column whose name may contain dots."""
    return F.col(f"`{name}`")


def number(value: Column | str) -> Column:
    """Lenient double: text that is no number becomes NULL, and so does NaN."""
    text = F.col(value) if isinstance(value, str) else value
    parsed = text.try_cast("double")
    return F.when(~F.isnan(parsed), parsed)


def truthy(value: Column | str) -> Column:
    """1.0/0.0 from a textual flag; other numbers keep their value, the rest is 0."""
    raw = F.col(value) if isinstance(value, str) else value
    text = F.lower(F.trim(raw.cast("string")))
    return (
        F.when(text.isin("1", "true", "yes", "y"), F.lit(1.0))
        .when(text.isin("0", "false", "no", "n"), F.lit(0.0))
        .otherwise(F.coalesce(number(text), F.lit(0.0)))
    )


def is_true(value: Column | str) -> Column:
    """Boolean reading of a significance flag (TRUE / 1 / YES)."""
    raw = F.col(value) if isinstance(value, str) else value
    return F.coalesce(F.upper(F.trim(raw.cast("string"))).isin("TRUE", "1", "YES"), F.lit(False))


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL on a zero denominator."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def clip(value: Column, low: float, high: float) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def yes(condition: Column) -> Column:
    """NULL-safe predicate."""
    return F.coalesce(condition, F.lit(False))


def total(columns: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def lenient_date(text: Column | str) -> Column:
    """First y-m-d (or y/m/d) in the text, else the first four digits as 1 January."""
    raw = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    full = r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})"
    part = lambda i: F.regexp_extract(raw, full, i)
    iso = F.concat_ws("-", part(1), F.lpad(part(2), 2, "0"), F.lpad(part(3), 2, "0"))
    year = F.regexp_extract(raw, r"(\d{4})", 1)
    return F.when(raw.rlike(full), iso.try_cast("date")).when(
        year != "", F.concat(year, F.lit("-01-01")).try_cast("date")
    )


def safe_name(value: Column | str, fallback: Column) -> Column:
    """File-safe name: runs of other characters become ``_``, ends trimmed.

    A name of over 80 characters keeps its first 63 and the first 16 digits of the hash of the
    whole, so that different long names stay different.
    """
    raw = F.col(value) if isinstance(value, str) else value
    cleaned = F.btrim(F.regexp_replace(F.coalesce(raw, fallback), r"[^A-Za-z0-9_.-]+", "_"), F.lit("._"))
    short = lambda name: F.concat_ws("_", F.substring(name, 1, 63), F.substring(F.sha2(name, 256), 1, 16))
    # as elements of arrays, so that a long text is cleaned once and not once per use
    named = F.transform(F.array(cleaned), lambda c: F.when(c == "", fallback).otherwise(c))
    return F.transform(named, lambda n: F.when(F.char_length(n) <= 80, n).otherwise(short(n)))[0]


def split_ids(value: Column | str) -> Column:
    """Array of the valid four-character structure ids in a separated list, upper-cased."""
    raw = F.col(value) if isinstance(value, str) else value
    parts = F.split(F.coalesce(raw, F.lit("")), r"[,;|\s]+")
    valid = F.filter(parts, lambda p: p.rlike(r"^[0-9][A-Za-z0-9]{3}$"))
    return F.transform(valid, lambda p: F.upper(p))

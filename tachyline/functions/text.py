"""Expressions on texts: event spans, times in names, rebasing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NUMBER = r"(-?[0-9]+(?:\.[0-9]+)?)"
SPAN = rf"\[Event ([0-9]+)[^\]]*?start={NUMBER}[^\]]*?end={NUMBER}[^\]]*\]"


def event_spans(text: Column) -> Column:
    """``[Event n … start=a … end=b …]`` marks as an array of (number, start_s, end_s)."""
    part = lambda k: F.regexp_extract_all(text, F.lit(SPAN), F.lit(k))
    return F.zip_with(
        F.zip_with(part(1), part(2), lambda a, b: F.struct(a.cast("long").alias("number"), b.cast("double").alias("start_s"))), part(3), lambda x, c: F.struct(x["number"].alias("number"), x["start_s"].alias("start_s"), c.cast("double").alias("end_s"))
    )


def rebase(value: Column, start: Column) -> Column:
    """A time relative to a segment's start; times before it stay as they are."""
    return F.when(value >= start, value - start).otherwise(value)


def rebase_map(values: Column, start: Column, suffix: str = "_s") -> Column:
    """A map of numbers with those whose key ends in ``suffix`` rebased."""
    return F.transform_values(values, lambda k, v: F.when(F.endswith(k, F.lit(suffix)), rebase(v, start)).otherwise(v))


def timestamp_in(path: Column) -> Column:
    """The time in a file name: ``YYYY-MM-DD-HH-MM-SS``, ``YYYYMMDD_HHMMSS`` or ``YYYYMMDDHHMMSS``; null without."""
    name = F.substring_index(path, "/", -1)
    digits = F.regexp_replace(F.regexp_extract(name, r"((?:19|20)[0-9]{2}-?[01][0-9]-?[0-3][0-9][-_T]?[0-2][0-9]-?[0-5][0-9]-?[0-5][0-9])", 1), "[^0-9]", "")
    return F.try_to_timestamp(F.when(F.length(digits) == 14, digits), F.lit("yyyyMMddHHmmss"))


def date_in(path: Column) -> Column:
    """The date of the nearest folder that begins with one, else of the file name; null without."""
    folders = F.reverse(F.slice(F.split(path, "/"), 1, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0))))
    dated = F.filter(folders, lambda x: F.regexp_extract(x, r"((?:19|20)[0-9]{2}-?[01][0-9]-?[0-3][0-9])", 1) != "")
    found = F.coalesce(F.get(dated, F.lit(0)), F.substring_index(path, "/", -1))
    digits = F.regexp_replace(F.regexp_extract(found, r"((?:19|20)[0-9]{2}-?[01][0-9]-?[0-3][0-9])", 1), "-", "")
    return F.to_date(F.try_to_timestamp(F.when(F.length(digits) == 8, digits), F.lit("yyyyMMdd")))

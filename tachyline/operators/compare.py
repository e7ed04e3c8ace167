"""Base against target: KPI cells, verdicts, release gate, highlights, sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def parse_cell(text: Column) -> Column:
    """A KPI cell as struct(number, lower_bound, total, bad): ``12.5(250/20)``, ``>300(300/0)``, ``N/A``, wide brackets."""
    plain = F.translate(F.trim(text), "（）／＞，", "()/>,")
    plain = F.regexp_replace(plain, r"[,\s]", "")
    number = F.regexp_extract(plain, r"^>?(-?[0-9]+(?:\.[0-9]+)?)", 1).try_cast("double")
    part = lambda k: F.regexp_extract(plain, r"\(([0-9]+(?:\.[0-9]+)?)/([0-9]+(?:\.[0-9]+)?)\)", k).try_cast("double")
    return F.struct(number.alias("number"), F.startswith(plain, F.lit(">")).alias("lower_bound"), part(1).alias("total"), part(2).alias("bad"))


def join_sides(base: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys of both sides with ``base_*`` and ``target_*`` values."""
    left = base.select(*keys, *(F.col(v).alias(f"base_{v}") for v in values))
    right = target.select(*keys, *(F.col(v).alias(f"target_{v}") for v in values))
    return left.join(right, list(keys), "full")


def verdict(base: Column, base_bad: Column, target: Column, target_bad: Column) -> Column:
    """Which side is better: no bad case beats any; then the larger value; then fewer bad cases."""
    missing = F.when(base.isNull() & target.isNull(), "missing").when(base.isNull(), "base_missing").when(target.isNull(), "target_missing")
    return F.coalesce(
        missing,
        F.when((base_bad == 0) & (target_bad == 0), "equal").when(target_bad == 0, "target").when(base_bad == 0, "base"),
        F.when(target > base, "target").when(target < base, "base"),
        F.when(target_bad < base_bad, "target").when(target_bad > base_bad, "base").otherwise("equal"),
    )


def gate(total: Column, bad: Column, value: Column, lower_bound: Column, threshold: Column) -> Column:
    """Release gate: no_threshold, invalid, insufficient (no cases), pass or fail.

    With counts the rate decides, and no bad case passes. A bare number is held against the threshold; one that is
    only a lower bound can pass but not fail.
    """
    counted = F.when(total == 0, "insufficient").when(bad == 0, "pass").when(total / bad >= threshold, "pass").otherwise("fail")
    bare = F.when(value.isNull(), "invalid").when(value >= threshold, "pass").when(lower_bound, "invalid").otherwise("fail")
    return F.when(threshold.isNull(), "no_threshold").when(total.isNotNull() & bad.isNotNull(), counted).otherwise(bare)


def highlight(base: Column, base_bad: Column, target: Column, target_bad: Column, base_ok: Column, target_ok: Column) -> Column:
    """``up``: the base fails and the target is at least 4 times and 5 more, or 10 more, or without bad cases; ``down``: the mirror."""
    ahead = lambda a, b, clean: ((a >= 4 * b) & (a - b >= 5)) | (a - b >= 10) | clean
    up = ~base_ok & ahead(target, base, (target_bad == 0) & (base_bad > 0))
    down = ~target_ok & ahead(base, target, (base_bad == 0) & (target_bad > 0))
    return F.when(F.coalesce(up, F.lit(False)), "up").when(F.coalesce(down, F.lit(False)), "down").otherwise("")


def first_of(values: DataFrame, wanted: DataFrame, keys: Sequence[Sequence[str]], value: str) -> DataFrame:
    """``wanted`` with ``value`` under the first of several key tuples that finds one."""
    out, found = wanted, []
    for k, key in enumerate(keys):
        own = values.select(*key, F.col(value).alias(f"__v{k}")).dropDuplicates(list(key))
        out = out.join(own, list(key), "left")
        found.append(F.col(f"__v{k}"))
    return out.withColumn(value, F.coalesce(*found)).drop(*(f"__v{k}" for k in range(len(keys))))


def latest_group(rows: DataFrame, group: str) -> DataFrame:
    """The rows of the latest group."""
    return rows.join(F.broadcast(rows.agg(F.max(group).alias(group))), group)  # one row


def rename_layout(rows: DataFrame, names: dict[str, Sequence[str]]) -> DataFrame:
    """Columns under their standard names: the first alias of each that is there; those without one are null."""
    have = {c.strip().lower(): c for c in rows.columns}
    pick = lambda aliases: next((have[a.lower()] for a in aliases if a.lower() in have), None)
    return rows.select(*((F.col(f"`{found}`") if (found := pick([name, *aliases])) else F.lit(None).cast("string")).alias(name) for name, aliases in names.items()))

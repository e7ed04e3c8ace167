"""Figures and tables of a report: means of a measurement, what wasn't counted, synchrony, adaptive histograms, shapes of a
signal, display names; and the files they go to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import finite
from . import automata as M, segments as G, windows as W


def measurement_mean(values: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """keys, mean_value, n over the finite values; keys without one have a null mean."""
    good = F.when(finite(F.col(value)), F.col(value))
    return values.groupBy(*keys).agg(F.avg(good).alias("mean_value"), F.count(good).alias("n"))


def max_severity(events: DataFrame, keys: Sequence[str], severity: str = "severity") -> DataFrame:
    """keys, severity: the worst of the events to 3 places; 0 where all are null."""
    return events.groupBy(*keys).agg(F.round(F.coalesce(F.max(severity), F.lit(0.0)), 3).alias("severity"))


def counted(results: DataFrame, keys: Sequence[str], status: str = "status") -> DataFrame:
    """keys, counting: ``none`` if every recording was skipped or failed, ``partly`` if some were, else ``all``."""
    left_out = F.coalesce(F.col(status).isin("SKIPPED", "ERROR"), F.lit(False))
    return results.groupBy(*keys).agg(F.bool_and(left_out).alias("__none"), F.bool_or(left_out).alias("__some")).select(*keys, F.when(F.col("__none"), "none").when(F.col("__some"), "partly").otherwise("all").alias("counting"))


def sync_summary(matches: DataFrame, keys: Sequence[str], a: str, b: str, limit: float) -> DataFrame:
    """keys, matched, exceeded (apart by more than ``limit``, rounding allowed for), max_lag, of pairs of times; ``b`` null is no match."""
    lag = F.abs(F.col(a) - F.col(b)).cast("double")
    slack = F.greatest(F.lit(1e-9), 4 * 2.220446049250313e-16 * F.greatest(F.abs(F.col(a)), F.abs(F.col(b))))
    return matches.groupBy(*keys).agg(F.count(lag).alias("matched"), F.count_if(lag > limit + slack).alias("exceeded"), F.max(lag).alias("max_lag"))


def ordered_distinct(rows: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """keys, values: each distinct value once, in the order in which they first come."""
    first = rows.groupBy(*keys, value).agg(F.min(order).alias("__at"))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("__at", F.col(value).alias("v")))), lambda x: x["v"])
    return first.groupBy(*keys).agg(listed.alias("values"))


def bin_width(upper: Column) -> Column:
    """Width of a histogram's bins by the end of its axis."""
    return F.when(upper <= 12, 0.5).when(upper <= 35, 1.0).when(upper <= 80, 2.0).otherwise(5.0)


def adaptive_histogram(values: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """keys, bin (lower end), n, with bins as wide as the largest value of the keys calls for; values below 0 and null are left out."""
    good = values.where(F.col(value) >= 0)
    widths = good.groupBy(*keys).agg(bin_width(F.max(value) + 1).alias("__w"))
    return good.join(widths, list(keys)).groupBy(*keys, (F.floor(F.col(value) / F.col("__w")) * F.col("__w")).alias("bin")).agg(F.count("*").alias("n"))


def finite_stats(values: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    """keys, span, rms, abs_peak (0 without a finite value), low and high (null then), and p95."""
    x = F.when(finite(F.col(value)), F.col(value))
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return values.groupBy(*keys).agg(zero(F.max(x) - F.min(x)).alias("span"), zero(F.sqrt(F.avg(x * x))).alias("rms"), zero(F.max(F.abs(x))).alias("abs_peak"), F.min(x).alias("low"), F.max(x).alias("high"), zero(F.percentile(x, F.lit(0.95))).alias("p95"))


def detrend(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``value`` less its least-squares line over the sample numbers of the keys; less its mean under three samples."""
    whole = Window.partitionBy(*keys)
    df = df.withColumn("__x", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - F.lit(1.0))
    x = F.when(F.col(value).isNotNull(), F.col("__x"))
    line = F.when(F.count(value).over(whole) >= 3, F.regr_slope(F.col(value), x).over(whole) * F.col("__x") + F.regr_intercept(F.col(value), x).over(whole)).otherwise(F.avg(value).over(whole))
    return df.withColumn(name, F.col(value) - line).drop("__x")


def zero_crossings(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], epsilon: float = 0.04) -> DataFrame:
    """keys, crossings: changes of sign among the samples beyond ``epsilon`` of 0."""
    beyond = df.withColumn("__v", F.when(F.abs(value) > epsilon, F.col(value)).otherwise(0.0))
    found = W.sign_flips(beyond, "__v", keys, order).withColumnRenamed("flips", "crossings")
    return df.select(*keys).distinct().join(found, list(keys), "left").na.fill(0, ["crossings"])


def turn_count(df: DataFrame, value: str, prominence: float, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """keys, turns: turning points of the mean over 7 samples, with steps of a twelfth of ``prominence`` or less taken as level,
    that are ``prominence`` apart (``automata.turning_points``). Without 8 known values there are none; unknown ones
    are the median.
    """
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(*order)
    rows = W.box_mean(df.select(*keys, *order, value), value, 7, keys, order, "__y")
    rows = rows.withColumn("__y", F.when(~F.isnan("__y"), F.col("__y")))
    rows = rows.withColumn("__known", F.count("__y").over(whole)).withColumn("__y", F.coalesce("__y", F.median("__y").over(whole)))
    step, level = F.lead("__y").over(w) - F.col("__y"), max(prominence / 12, 1e-6)
    rows = rows.withColumn("__step", F.when(step > level, 1).when(step < -level, -1))
    rows = rows.withColumn("__way", F.last("__step", True).over(w)).withColumn("__centre", F.median("__y").over(whole))
    # The last sample begins no step; it repeats the way of the one before and turns nothing.
    turns = rows.where("__known >= 8").withColumn("__before", F.lag("__way").over(w)).where("__way <> __before")
    named = turns.withColumnsRenamed({"__y": "y", "__centre": "centre"})
    found = M.scan(named, list(keys), list(order), ["y", "centre"], M.turning_points("y", prominence, "centre"), "turns long")
    return df.select(*keys).distinct().join(found, list(keys), "left").na.fill(0, ["turns"])


def pulse_count(df: DataFrame, value: str, prominence: float, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """keys, pulses: runs over the 10th percentile by 35 % of the way to the 90th (or a quarter of ``prominence``), gaps of one
    sample closed, that rise ``prominence`` over it."""
    whole, w = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(*order)
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.9))).over(whole)
    rows = df.withColumn("__p", p).withColumn("__over", F.col(value) > F.col("__p")[0] + F.greatest((F.col("__p")[1] - F.col("__p")[0]) * 0.35, F.lit(prominence * 0.25)))
    rows = rows.withColumn("__run", F.coalesce("__over", F.lit(False)) | F.coalesce(F.lag("__over").over(w) & F.lead("__over").over(w), F.lit(False)))
    runs = G.islands(rows, "__run", keys, order, order[0], aggs=[(F.max(value) - F.min(F.col("__p")[0])).alias("__rise")])
    found = runs.groupBy(*keys).agg(F.count_if(F.col("__rise") >= prominence).alias("pulses"))
    return df.select(*keys).distinct().join(found, list(keys), "left").na.fill(0, ["pulses"])


def display_names(rows: DataFrame, names: dict[str, str], retired: Sequence[str] = (), metric: str = "metric") -> DataFrame:
    """``rows`` without retired metrics, with ``display_name``: the metric itself where it has none. The names are constants."""
    kept = rows.where(~F.col(metric).isin(list(retired))) if retired else rows
    shown = F.coalesce(*(F.when(F.col(metric) == k, F.lit(v)) for k, v in names.items()), F.col(metric)) if names else F.col(metric)
    return kept.withColumn("display_name", shown)


def column_or(df: DataFrame, name: str, default: object = None, kind: str = "double") -> Column:
    """A column, or a default where the frame has none; without a default the column must exist."""
    if name in df.columns:
        return F.col(f"`{name}`")
    if default is None:
        raise KeyError(f"column {name!r} is missing")
    return F.lit(default).cast(kind)


def write_results(results: DataFrame, path: str) -> None:
    """Results as CSV with header, a folder for each metric."""
    results.write.mode("overwrite").partitionBy("metric").option("header", True).option("nullValue", "").csv(path)


def write_events(results: DataFrame, events: DataFrame, keys: Sequence[str], path: str) -> None:
    """Results with their events, worst first, as JSON lines, a folder for each metric."""
    listed = events.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("severity", "start_us", "end_us")), False).alias("events"))
    results.join(listed, list(keys), "left").write.mode("overwrite").partitionBy("metric").json(path)

"""Time windows: means, slopes, jerk, high-pass, derivatives, sign flips, amplitudes, extremes.

Time is integer microseconds in the frames, so both ends are exact and inclusive; the frames are range frames
of one sorted partition per recording. Null samples are left out, as the sums and counts ignore them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window, functions as F

US = 1_000_000


def micros(seconds: str = "t") -> Column:
    return F.round(F.col(seconds) * US).cast("long")


def centred(keys: Sequence[str], time: str, width: int):
    return Window.partitionBy(*keys).orderBy(time).rangeBetween(-(width // 2), width // 2)


def time_mean(df: DataFrame, value: str, width: int, keys: Sequence[str], time: str, name: str) -> DataFrame:
    """Mean over [t - width/2, t + width/2]."""
    return df.withColumn(name, F.avg(value).over(centred(keys, time, width)))


def box_mean(df: DataFrame, value: str, size: int, keys: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Mean over ``size`` samples (an odd number) around each; the first and last value go on beyond the ends."""
    w = Window.partitionBy(*keys).orderBy(*order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    reach = range(1, size // 2 + 1)
    before = [F.when(F.lag(F.lit(1), k).over(w) == 1, F.lag(value, k).over(w)).otherwise(F.first(value).over(w)) for k in reversed(reach)]
    after = [F.when(F.lead(F.lit(1), k).over(w) == 1, F.lead(value, k).over(w)).otherwise(F.last(value).over(whole)) for k in reach]
    return df.withColumn(name, reduce(add, [*before, F.col(value), *after]) / size)


def time_slope(df: DataFrame, value: str, width: int, keys: Sequence[str], time: str, name: str, unit: float = US, origin: str | None = None) -> DataFrame:
    """Least-squares slope per ``unit`` of time over the centred window: null under 3 samples or half the width.

    The origin is the recording's first sample unless column ``origin`` tells another, which keeps the products small. The slope is
    a covariance by a covariance, both by the same updates as in SQL: equal slopes at several times come out with the same last bits.
    """
    w = centred(keys, time, width)
    origin = F.min(time).over(Window.partitionBy(*keys)) if origin is None else F.col(origin)
    df = df.withColumn("__x", (F.col(time) - origin) / unit).withColumn("__in", F.when(F.col(value).isNotNull(), F.col(time)))
    good = (F.count(value).over(w) >= 3) & (F.max("__in").over(w) - F.min("__in").over(w) >= width // 2)
    x = F.when(F.col(value).isNotNull(), F.col("__x"))
    return df.withColumn(name, F.when(good, F.try_divide(F.covar_pop(x, value).over(w), F.covar_pop(x, x).over(w)))).drop("__x", "__in")


def jerk(df: DataFrame, acceleration: str, keys: Sequence[str], time: str, width: int = 300_000, name: str = "jerk", origin: str | None = None) -> DataFrame:
    """Slope of the windowed mean."""
    return time_slope(time_mean(df, acceleration, width, keys, time, "__mean"), "__mean", width, keys, time, name, origin=origin).drop("__mean")


def highpass(df: DataFrame, value: str, short: int, long: int, keys: Sequence[str], time: str, name: str) -> DataFrame:
    """Mean over ``short`` less mean over ``long``."""
    return df.withColumn(name, F.avg(value).over(centred(keys, time, short)) - F.avg(value).over(centred(keys, time, long)))


def derivative(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str], time: str, name: str, unit: float = US) -> DataFrame:
    """Backward difference by time; 0 where time stands still; the first row has the second's."""
    w = Window.partitionBy(*keys).orderBy(*order)
    dt = (F.col(time) - F.lag(time).over(w)) / unit
    d = F.when(dt <= 1e-9, 0.0).otherwise((F.col(value) - F.lag(value).over(w)) / dt)
    df = df.withColumn("__d", d)
    return df.withColumn(name, F.coalesce(F.col("__d"), F.when(F.lag(time).over(w).isNull(), F.lead("__d").over(w)))).drop("__d")


def trailing_rate(df: DataFrame, value: str, width: int, keys: Sequence[str], order: Sequence[str], time: str, name: str, unit: float = US) -> DataFrame:
    """Difference of the trailing mean, which needs every sample of its window."""
    w = Window.partitionBy(*keys).orderBy(time).rangeBetween(-width, 0)
    whole = F.count(value).over(w) == F.count("*").over(w)
    return derivative(df.withColumn("__m", F.when(whole, F.avg(value).over(w))), "__m", keys, order, time, name, unit).drop("__m")


def sign_flips(df: DataFrame, value: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """keys, flips: changes of sign between successive samples that aren't 0."""
    w = Window.partitionBy(*keys).orderBy(*order)
    signs = df.where(F.col(value) != 0).withColumn("__s", F.signum(value))
    return signs.withColumn("__f", (F.col("__s") != F.lag("__s").over(w)).cast("long")).groupBy(*keys).agg(F.coalesce(F.sum("__f"), F.lit(0)).alias("flips"))


def forward_amplitude(df: DataFrame, value: str, width: int, keys: Sequence[str], time: str) -> DataFrame:
    """keys, amplitude: the largest max - min within [t, t + width]."""
    w = Window.partitionBy(*keys).orderBy(time).rangeBetween(0, width)
    return df.withColumn("__a", F.max(value).over(w) - F.min(value).over(w)).groupBy(*keys).agg(F.max("__a").alias("amplitude"))


def extremes(df: DataFrame, value: str, keys: Sequence[str], time: str) -> DataFrame:
    """keys, min_value, min_t, max_value, max_t; the first of equal values, nulls and NaN left out."""
    good = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    least, most = F.min(F.struct(F.col(value), F.col(time))), F.min(F.struct((-F.col(value)).alias("v"), F.col(time)))
    out = good.groupBy(*keys).agg(least.alias("a"), most.alias("b"))
    return out.select(*keys, F.col(f"a.{value}").alias("min_value"), F.col(f"a.{time}").alias("min_t"), (-F.col("b.v")).alias("max_value"), F.col(f"b.{time}").alias("max_t"))


def distribution(df: DataFrame, value: str, keys: Sequence[str], low: float, high: float) -> DataFrame:
    """Count, min, p10, median, mean, p90, max, and count and share within [low, high]. Percentiles are exact and linear."""
    p = F.percentile(value, F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    inside = F.count_if((F.col(value) >= low) & (F.col(value) <= high))
    out = df.groupBy(*keys).agg(F.count(value).alias("n"), F.min(value).alias("min_value"), p.alias("p"), F.avg(value).alias("mean_value"), F.max(value).alias("max_value"), inside.alias("in_band"))
    return out.select(*keys, "n", "min_value", F.col("p")[0].alias("p10"), F.col("p")[1].alias("median_value"), "mean_value", F.col("p")[2].alias("p90"), "max_value", "in_band", (F.col("in_band") / F.col("n")).alias("band_share"))


def histogram(df: DataFrame, value: str, width: float) -> DataFrame:
    """bin (lower end), n."""
    return df.where(F.col(value).isNotNull()).groupBy((F.floor(F.col(value) / width) * width).alias("bin")).agg(F.count("*").alias("n"))

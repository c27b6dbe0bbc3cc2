"""Rain, control series and results over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import hyetograph


def rain_blocks(events: DataFrame, stop_minutes: float, start_minutes: float = 0.0) -> DataFrame:
    """scenario, k, minute, mm_day: block rain of events (scenario, mm_h, duration_h, start_h); the end stamp stands twice.

    An event that ends behind the stop time is an error.
    """
    begin, end = F.col("start_h") * 60, (F.col("start_h") + F.col("duration_h")) * 60
    rate = F.when(end > stop_minutes, F.raise_error(F.lit("event ends behind the stop time"))).otherwise(F.col("mm_h") * 24)
    step = lambda m, r: F.struct(m.cast("double").alias("minute"), r.cast("double").alias("mm_day"))
    lead = F.when(begin > start_minutes, F.array(step(F.lit(start_minutes), F.lit(0.0)))).otherwise(F.array().cast("array<struct<minute:double,mm_day:double>>"))
    rows = F.concat(lead, F.array(step(begin, rate), step(end, rate), step(end, F.lit(0.0)), step(F.lit(stop_minutes), F.lit(0.0))))
    return events.select("scenario", F.posexplode(rows).alias("k", "r")).select("scenario", "k", "r.minute", "r.mm_day")


def hyetographs(events: DataFrame, step_minutes: int) -> DataFrame:
    """scenario, minute, mm_h: triangular rain of events (scenario, peak, duration)."""
    m = events.select("scenario", "peak", "duration", F.explode(F.sequence(F.lit(0), F.col("duration").cast("int"), F.lit(step_minutes))).alias("minute"))
    half = F.col("duration") / 2
    return m.select("scenario", "minute", F.greatest(F.lit(0.0), F.col("peak") * (1 - F.abs(F.col("minute") - half) / half)).alias("mm_h"))


def control_series(spark: SparkSession, start: str, hours: int, mean: float, swing: float, period: float) -> DataFrame:
    """time, value: an hourly sinusoid."""
    t = F.col("id")
    return spark.range(hours + 1).select((F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=t.cast("int"))).alias("time"), (F.lit(mean) + F.lit(swing) * F.sin(2 * F.pi() * t / period)).alias("value"))


def volumes(steps: DataFrame, faces: DataFrame) -> DataFrame:
    """time, volume, wet: depth times area over all faces; steps (time, face, depth) without any value are left out."""
    j = steps.join(faces, "face")
    return j.groupBy("time").agg(F.sum(F.col("depth") * F.col("area")).alias("volume"), F.count("depth").alias("wet")).filter("wet > 0")


def differences(off: DataFrame, on: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, off, on, delta of two runs."""
    return off.select(*keys, F.col(value).alias("off")).join(on.select(*keys, F.col(value).alias("on")), keys).withColumn("delta", F.col("off") - F.col("on"))


def gauge_totals(readings: DataFrame, every: str = "1 hour") -> DataFrame:
    """station, begin, total, readings: tumbling totals of gauges (station, ts, value)."""
    w = F.window("ts", every)
    return readings.groupBy("station", w.alias("w")).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("readings")).select("station", F.col("w.start").alias("begin"), "total", "readings")


def time_step(*steps: Column) -> Column:
    return F.least(*steps)


__all__ = ["control_series", "differences", "gauge_totals", "hyetograph", "hyetographs", "rain_blocks", "time_step", "volumes"]

"""Rain gauges as a stream: an addition to the batch operators, for readings that keep arriving.

Windowed totals with a watermark, so state is bounded by the lateness allowed;
repeated deliveries of a reading are dropped within it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def readings(spark: SparkSession, path: str, schema: str = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string", files_per_trigger: int | None = None) -> DataFrame:
    """Readings from a folder of Parquet files, as they arrive: id, station, ts, value."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path).select(F.col("event_id").alias("id"), F.col("user_id").alias("station"), F.col("ts").cast("timestamp").alias("ts"), "value")


def totals(stream: DataFrame, every: str = "1 hour", late: str = "2 hours", once: bool = True) -> DataFrame:
    """station, begin, total, readings per tumbling window; readings later than `late` are left out."""
    marked = stream.withWatermark("ts", late)
    if once:
        marked = marked.dropDuplicatesWithinWatermark(["id"])
    w = marked.groupBy("station", F.window("ts", every).alias("w")).agg(F.sum("value").alias("total"), F.count(F.lit(1)).alias("readings"))
    return w.select("station", F.col("w.start").alias("begin"), "total", "readings")


def sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """station, begin, end, total of rain events: readings with gaps below `gap`."""
    w = stream.withWatermark("ts", late).groupBy("station", F.session_window("ts", gap).alias("w")).agg(F.sum("value").alias("total"))
    return w.select("station", F.col("w.start").alias("begin"), F.col("w.end").alias("end"), "total")


def alarms(stream: DataFrame, limit: float) -> DataFrame:
    """station, ts, running: readings at which a station's running total passes a multiple of limit; one number of state per station."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total = state.get[0] if state.exists else 0.0
        for pdf in batches:
            pdf = pdf.sort_values("ts")
            run = pdf["value"].fillna(0).cumsum() + total
            before = run.shift(1, fill_value=total)
            hit = (run // limit) > (before // limit)
            total = float(run.iloc[-1]) if len(run) else total
            yield pd.DataFrame({"station": key[0], "ts": pdf["ts"][hit], "running": run[hit]})
        state.update((total,))

    return stream.groupBy("station").applyInPandasWithState(step, "station bigint, ts timestamp, running double", "total double", "append", GroupStateTimeout.NoTimeout)


def run_available(stream: DataFrame, name: str, checkpoint: str, mode: str = "append") -> None:
    """Processes all that is there into a memory table, then stops; for tests and small outputs."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Processes all that is there into Parquet files, exactly once, then stops."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()

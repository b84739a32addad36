"""Event-time windows; the same functions serve tables and streams."""

from pyspark.sql import DataFrame, functions as F


def average_volume(observations: DataFrame, window: str = "1 minute", delay: str | None = None) -> DataFrame:
    """Average volume per tumbling window, camera and location.

    `delay` sets the watermark of a stream. Null volumes are passed over; a window with only such
    gives a null average. Averages combine before the shuffle, so a busy camera is no hot spot.
    """
    if delay:
        observations = observations.withWatermark("timestamp", delay)
    return (observations
            .groupBy(F.window("timestamp", window).alias("w"), "cam_id", "location")
            .agg(F.avg("traffic_volume").alias("avg_traffic_volume"))
            .select(F.col("w.start").alias("start_time"), F.col("w.end").alias("end_time"),
                    "cam_id", "location", "avg_traffic_volume"))


def volume_history(averages: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
                   delay: str | None = None) -> DataFrame:
    """The averages of each sliding window and camera, as a list ordered by time.

    The input has one row per tumbling window, camera and location, so a list has at most
    length/slide entries per location. Null averages are left out.
    """
    averages = averages.filter(F.col("avg_traffic_volume").isNotNull())
    if delay:
        averages = averages.withWatermark("end_time", delay)
    entry = F.struct("end_time", "location", "avg_traffic_volume")
    return (averages
            .groupBy(F.window("end_time", length, slide).alias("w"), "cam_id")
            .agg(F.collect_list(entry).alias("history"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cam_id",
                    F.array_sort("history").alias("history")))


def closed_windows(windows: DataFrame, events: DataFrame, delay: str, end: str = "end_time",
                   time: str = "timestamp") -> DataFrame:
    """The windows a stream has emitted once all `events` are in: those the watermark has passed."""
    watermark = events.agg(F.max(time) - F.expr(f"INTERVAL {delay}")).scalar()
    return windows.filter(F.col(end) <= watermark)

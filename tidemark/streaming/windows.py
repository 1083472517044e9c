"""Event-time window aggregations. The same functions take batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.streaming.sources import event_time


def windowed(
    df: DataFrame,
    ts: str,
    duration: str,
    aggs: Sequence[Column],
    keys: Sequence[str] = (),
    slide: str | None = None,
    watermark: str | None = None,
) -> DataFrame:
    """Aggregate per window and key; columns ``window_start``, ``window_end``, keys, aggregates.

    Windows are aligned to 1970-01-01, so "30 days" is not a calendar month.
    """
    timed = event_time(df, ts)
    if watermark:
        timed = timed.withWatermark(ts, watermark)
    window = F.window(ts, duration, slide) if slide else F.window(ts, duration)
    grouped = timed.groupBy(window, *keys).agg(*aggs)
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return grouped.select(*bounds, *[c for c in grouped.columns if c != "window"])


def tumbling(df, ts, duration, aggs, watermark=None, keys=()) -> DataFrame:
    return windowed(df, ts, duration, aggs, keys, None, watermark)


def sliding(df, ts, duration, slide, keys, aggs, watermark=None) -> DataFrame:
    return windowed(df, ts, duration, aggs, keys, slide, watermark)


def average_delay_hours(df: DataFrame, ts: str, delay: str = "delay") -> DataFrame:
    """Mean delay in hours per 30 days, 7 days of lateness."""
    return tumbling(df, ts, "30 days", [F.round(F.avg(F.col(delay) / 60), 2).alias("moving_avg_delay")], "7 days")


def distance_totals(df: DataFrame, ts: str, distance: str = "distance") -> DataFrame:
    """Total distance per 14 days, 7 days of lateness."""
    return tumbling(df, ts, "14 days", [F.sum(distance).alias("total_distance")], "7 days")


def worst_routes(df: DataFrame, ts: str, route: str = "standardized_route", delay: str = "delay") -> DataFrame:
    """Route with the largest delay per 30 days; equal delays go to the first route by name."""
    hours = F.col(delay) / 60
    aggs = [
        # One ordering value carries delay and route, so the pick does not depend on row order.
        F.min_by(route, F.when(hours.isNotNull(), F.struct(-hours, F.col(route)))).alias("worst_route"),
        F.round(F.max(hours), 2).alias("max_delay"),
    ]
    return tumbling(df, ts, "30 days", aggs, "7 days")


def hourly_counts(df: DataFrame, ts: str) -> DataFrame:
    return tumbling(df, ts, "1 hour", [F.count(F.lit(1)).alias("flight_count")], "1 hour")


def rolling_delay(df: DataFrame, ts: str, delay: str = "delay") -> DataFrame:
    """Mean delay in hours over 7 days, every day, 8 days of lateness."""
    aggs = [F.round(F.avg(F.col(delay) / 60), 2).alias("rolling_avg_delay_hours")]
    return sliding(df, ts, "7 days", "1 day", [], aggs, "8 days")


def route_traffic(df: DataFrame, ts: str, route: str = "standardized_route", distance: str = "distance") -> DataFrame:
    """Flights and distance per route over 14 days, every 7 days, 15 days of lateness."""
    aggs = [F.count(F.lit(1)).alias("flight_count"), F.round(F.sum(distance), 0).alias("total_distance")]
    return sliding(df, ts, "14 days", "7 days", [route], aggs, "15 days")


def status_counts(df: DataFrame, ts: str, status: str = "take_off_status") -> DataFrame:
    """Flights per status over 3 hours, every hour, 4 hours of lateness."""
    return sliding(df, ts, "3 hours", "1 hour", [status], [F.count(F.lit(1)).alias("flight_count")], "4 hours")


def text_bounds(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Window bounds as text."""
    return df.withColumns({c: F.date_format(c, fmt) for c in ("window_start", "window_end")})


def stream_change_counts(feed: DataFrame, ts: str = "_commit_timestamp", watermark: str | None = "1 hour") -> DataFrame:
    """Changes by type per 10 seconds of commit time."""
    renamed = feed.withColumnRenamed("_change_type", "change_type")
    return tumbling(renamed, ts, "10 seconds", [F.count(F.lit(1)).alias("n_changes")], watermark, ["change_type"])


def stream_word_count(lines: DataFrame, ts: str, text: str, watermark: str | None = "1 minute") -> DataFrame:
    """Words per 5 seconds, every 2 seconds, cut at single spaces; a window's words leave the state when the watermark
    has passed its end."""
    timed = event_time(lines, ts)
    words = timed.select(F.explode(F.split(text, " ")).alias("word"), F.col(ts))
    return sliding(words, ts, "5 seconds", "2 seconds", ["word"], [F.count(F.lit(1)).alias("n")], watermark)

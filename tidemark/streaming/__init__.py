from tidemark.streaming.feed import stream_changes
from tidemark.streaming.flights import (
    cdc_merge_batch,
    clean_flights,
    enrich_flights,
    latest_cdc,
    parse_cdc,
    run_cdc_stream,
)
from tidemark.streaming.runner import run_stream, run_with_retry
from tidemark.streaming.sources import event_time, stream_files, stream_rate, stream_table
from tidemark.streaming.windows import sliding, stream_change_counts, stream_word_count, tumbling, windowed

__all__ = [
    "cdc_merge_batch",
    "clean_flights",
    "enrich_flights",
    "event_time",
    "latest_cdc",
    "parse_cdc",
    "run_cdc_stream",
    "run_stream",
    "run_with_retry",
    "sliding",
    "stream_change_counts",
    "stream_changes",
    "stream_files",
    "stream_rate",
    "stream_table",
    "stream_word_count",
    "tumbling",
    "windowed",
]

from tidemark.functions.columns import (
    bucket_case,
    canonical_pair,
    cast_columns,
    decode_map,
    duration_minutes,
    parse_event_ts,
    range_partition,
    route_status,
    surrogate_key,
)
from tidemark.functions.text import (
    extract_fenced,
    extract_fields,
    extract_score,
    first_keyword,
    fold_elements,
    strip_text,
    text_features,
)
from tidemark.functions.vectors import cosine, hashed_embedder

__all__ = [
    "bucket_case",
    "canonical_pair",
    "cast_columns",
    "cosine",
    "decode_map",
    "duration_minutes",
    "extract_fenced",
    "extract_fields",
    "extract_score",
    "first_keyword",
    "fold_elements",
    "hashed_embedder",
    "parse_event_ts",
    "range_partition",
    "route_status",
    "strip_text",
    "surrogate_key",
    "text_features",
]

"""Column builders. Every one is a built-in expression, so it stays inside generated code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F

# Take-off status by delay in minutes; each edge is the exclusive upper bound.
STATUS_EDGES = (0, 10, 30)
STATUS_LABELS = ("Early", "On Time", "Late", "Delay")

# Public taxi data dictionary, rate codes.
RATE_CODES = {
    1: "Standard Rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau/Westchester",
    5: "Negotiated Fare",
}


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bucket_case(value: Column | str, edges: Sequence, labels: Sequence[str]) -> Column:
    """Label by ascending exclusive upper bounds; the last label takes the rest and NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("bucket_case needs one label more than edges")
    v = as_column(value)
    first, *rest = zip(edges, labels)
    case = F.when(v < F.lit(first[0]), first[1])
    for edge, label in rest:
        case = case.when(v < F.lit(edge), label)
    return case.otherwise(labels[-1])


def route_status(delay: Column | str) -> Column:
    return bucket_case(delay, STATUS_EDGES, STATUS_LABELS)


def decode_map(code: Column | str, mapping: Mapping, default: str = "Unknown") -> Column:
    """Code to label; unknown codes and NULL get ``default``."""
    c = as_column(code)
    return F.coalesce(*[F.when(c == F.lit(k), F.lit(v)) for k, v in mapping.items()], F.lit(default))


def canonical_pair(a: Column | str, b: Column | str, sep: str = "-") -> Column:
    """Order-free key of two codes. A missing code is left out, as ``concat_ws`` does."""
    return F.concat_ws(sep, F.sort_array(F.array(as_column(a), as_column(b))))


def parse_event_ts(text: Column | str, year: int | str, fmt: str = "MMddHHmm") -> Column:
    """Timestamp from text that lacks its year; NULL when it does not parse."""
    return F.try_to_timestamp(F.concat(F.lit(str(year)), as_column(text)), F.lit(f"yyyy{fmt}"))


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two times, two decimals (whole seconds, as unix time counts them)."""
    seconds = [F.unix_timestamp(as_column(c).cast("timestamp")) for c in (end, start)]
    return F.round((seconds[0] - seconds[1]) / 60, 2)


def range_partition(value: Column | str, bounds: Sequence) -> Column:
    """RANGE LEFT partition number: one plus the boundaries below ``value`` (NULL: 1)."""
    v = as_column(value)
    below = [F.when(v > F.lit(b), 1).otherwise(0) for b in sorted(bounds)]
    return reduce(add, below, F.lit(1))


def surrogate_key(*cols: Column | str, sep: str = "|") -> Column:
    """Deterministic row key: md5 of the joined values, NULL kept apart from empty text."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit("\\N")) for c in cols]
    return F.md5(F.concat_ws(sep, *parts))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not convert becomes NULL instead of failing the job."""
    return df.withColumns({name: F.col(name).try_cast(t) for name, t in types.items()})

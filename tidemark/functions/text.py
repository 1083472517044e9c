"""Text expressions (regular expressions run inside the JVM)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from tidemark.functions.columns import as_column

# The whitespace characters that Python's str.split() and str.strip() know.
WHITESPACE = r"[\t-\r\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

FENCED_BLOCK = r"(?s)```(?:python)?\n(.*?)```"
NUMBER = r"\d+(?:\.\d+)?"


# The same characters one by one: trimming looks at the ends of a text only, where a pattern is tried at each place.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)])) + "\u2028\u2029\u202f\u205f\u3000"


def strip_text(text: Column | str) -> Column:
    """Trim Unicode whitespace on both ends."""
    return F.trim(as_column(text), F.lit(BLANKS))


def text_features(text: Column | str) -> list[Column]:
    """char_count, word_count, is_question and uppercase of a text."""
    c = as_column(text)
    stripped = strip_text(c)
    words = F.when(F.length(stripped) == 0, 0).otherwise(F.size(F.split(stripped, f"{WHITESPACE}+")))
    return [
        F.length(c).alias("char_count"),
        words.alias("word_count"),
        F.endswith(stripped, F.lit("?")).alias("is_question"),
        F.upper(c).alias("uppercase"),
    ]


def first_keyword(text: Column | str, keywords: Sequence[str], default: str = "Unknown") -> Column:
    """The first keyword of the list found in the text, ignoring case."""
    lowered = F.lower(as_column(text))
    hits = [F.when(F.contains(lowered, F.lit(k.lower())), F.lit(k)) for k in keywords]
    return F.coalesce(*hits, F.lit(default))


def extract_score(
    text: Column | str, prefix: str = "", low: float = 1.0, high: float = 10.0, default: float = 5.0
) -> Column:
    """First number after ``prefix`` (a pattern), clamped to ``[low, high]``; ``default`` if none."""
    number = F.regexp_extract(as_column(text), f"{prefix}({NUMBER})", 1).try_cast("double")
    # greatest() and least() skip NULL, so a missing number is told apart first.
    return F.when(number.isNull(), F.lit(default)).otherwise(F.greatest(F.lit(low), F.least(F.lit(high), number)))


def extract_fenced(text: Column | str) -> Column:
    """Body of the first fenced code block, or the whole text; stripped either way."""
    c = as_column(text)
    body = F.when(F.regexp_like(c, F.lit(FENCED_BLOCK)), F.regexp_extract(c, FENCED_BLOCK, 1)).otherwise(c)
    return strip_text(body)


def extract_fields(text: Column | str, patterns: Mapping[str, str]) -> list[Column]:
    """Named fields by pattern (group 1), NULL where absent. Stands in for a model's extraction."""
    c = as_column(text)
    return [F.nullif(F.regexp_extract(c, p, 1), F.lit("")).alias(name) for name, p in patterns.items()]


def fold_elements(json_text: Column | str, sep: str = "\n") -> Column:
    """``{"document": {"elements": [{"content": ...}, ...]}}`` as one text.

    Each element is preceded by ``sep``, so a non-empty result starts with it.
    """
    schema = "document struct<elements: array<struct<content: string>>>"
    contents = F.from_json(as_column(json_text), schema)["document"]["elements"]["content"]
    prefixed = F.transform(contents, lambda c: F.concat(F.lit(sep), c))
    # A NULL content makes the left-to-right concatenation NULL; array_join would skip it.
    has_null = F.exists(contents, lambda c: c.isNull())
    return F.when(~F.coalesce(has_null, F.lit(False)), F.array_join(prefixed, ""))

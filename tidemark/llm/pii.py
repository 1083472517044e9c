"""Personal data: exact patterns, and identifiers in other spellings found by bootstrapped contexts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from tidemark.llm.common import map_batches, same_type, stored, texts, words

# The kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")

# A pattern is trusted if this share of all places where its words occur leads to an identifier of its kind, and
# this many different identifiers follow it.
CONFIDENCE, SUPPORT = 0.5, 3

# Rounds of scoring patterns by instances and instances by patterns.
ROUNDS = 3

# Bits of the set of pattern hashes that every task gets; a fixed size, whatever the number of patterns.
SET_BITS = 1 << 24

# Characters before a span in which its left words are looked for.
REACH = 200

_DIGITS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOT = re.compile(r"\.")

# Other spellings that are looked at where a trusted pattern leads to them.
_LOOSE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}"),
    "ip": re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\.| \. )[0-9]{1,3}){3}(?![0-9.])"),
    "card": re.compile(r"(?<![0-9])[0-9]{4}(?:[ .-]?[0-9]{4}){2}[ .-]?[0-9]{1,7}(?![0-9])"),
    "phone": re.compile(r"(?<![0-9+])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"),
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _only_digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of name, @ and domain, in linear time: a name is read backwards from its @, as the pattern
    can only end it there, and not beyond the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and _NAME.fullmatch(text, begin - 1, begin):
            begin -= 1
        if begin < at and (domain := _DOMAIN.match(text, at + 1)):
            yield begin, domain.end()
            done = domain.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    """Numbers joined by dots, four at a time from the left; a leftover of fewer is no match."""
    for m in _DIGITS.finditer(text):
        dots = m[0].count(".")
        if dots < 3:
            continue
        at, ends = m.start(), [d.start() for d in _DOT.finditer(text, *m.span())] + [m.end()]
        for k in range(3, len(ends), 4):
            yield at, ends[k]
            at = ends[k] + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of all base matches in order; a match that fails its check is dropped for good."""
    out = []
    if "@" in text:
        out += [(s, 0, e) for s, e in _emails(text)]
    if "." in text:
        out += [(s, 1, e) for s, e in _ips(text) if all(_at_most_255(p) for p in text[s:e].split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _only_digits(m[0])
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_only_digits(m[0])) <= 15]
    return sorted(out)


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _loose_spans(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Other spellings, none of which touches a base span or an earlier one."""
    out = []
    busy = sorted((s, e) for s, _, e in taken)
    for kind, name in enumerate(KINDS):
        if kind == 0 and "at" not in text:
            continue
        for m in _LOOSE[name].finditer(text):
            if all(m.end() <= s or m.start() >= e for s, e in busy):
                out.append((m.start(), kind, m.end()))
                busy.append(m.span())
    return sorted(out)


def _word_hashes(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))


def _pairs(h: np.ndarray) -> np.ndarray:
    """Names of two words in a row; those of one word are the hashes themselves."""
    return (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] + (h[1:] << np.uint64(7)))


def _patterns(text: str, start: int) -> list[int]:
    """The lexical patterns of a span: its left word, and its two left words."""
    found = words(text[max(0, start - REACH) : start].encode())[-2:]
    h = _word_hashes(found)
    return [int(x) for x in np.concatenate([h[-1:], _pairs(h)]).view(np.int64)]


def find_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)``: base spans and candidates of each whole text, with patterns and a hash of the value."""
    frame = texts(docs)
    span = StructType(
        [StructField(n, IntegerType()) for n in ("start", "kind", "end")]
        + [StructField("base", BooleanType()), StructField("value", LongType()), StructField("patterns", ArrayType(LongType()))]
    )
    schema = StructType([same_type(frame, "doc_id", "doc_id"), StructField("spans", ArrayType(span))])
    digit = re.compile("[0-9]")

    def make():
        kind = pa.list_(
            pa.struct(
                [("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("value", pa.int64())]
                + [("patterns", pa.list_(pa.int64()))]
            )
        )

        def spans(text: str) -> list[dict]:
            if not digit.search(text) and "@" not in text and "at" not in text:
                return []
            base = base_spans(text)
            out = []
            for part, is_base in ((base, True), (_loose_spans(text, base), False)):
                for s, k, e in part:
                    value = np.uint64(xxhash.xxh3_64_intdigest(text[s:e].lower().encode(), seed=k)).view(np.int64)
                    out.append({"start": s, "kind": k, "end": e, "base": is_base, "value": int(value), "patterns": _patterns(text, s)})
            return out

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [spans(t.as_py()) for t in batch.column("text")]
            return pa.record_batch([batch.column("doc_id"), pa.array(found, kind)], schema.names)

        return run

    return map_batches(frame, make, schema)


def _occurrences(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(pattern, total)``: how often the words of each pattern occur anywhere in the corpus.

    The patterns' hashes go to the tasks as a bit set of fixed size, so that only words and pairs that may be a
    pattern are counted and shuffled; the join with the patterns then drops those that only share a bit.
    """
    spark = docs.sparkSession
    slot = F.pmod("pattern", F.lit(SET_BITS))
    cells = patterns.groupBy(F.shiftright(slot, 5).alias("cell")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pattern, 32) as int))")).alias("bits")
    )
    bits = np.zeros(SET_BITS // 32, np.uint64)  # at most this many cells come to the driver
    found = cells.toArrow()
    bits[found.column("cell").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(bits.astype(np.uint32))

    def run(batches):
        marked = sent.value
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.record_batch([pa.array(codes.view(np.int64)), pa.array(n)], ["pattern", "n"])

        for batch in batches:
            for t in batch.column("text"):
                h = _word_hashes(words(t.as_py().encode()))
                codes = np.concatenate([h, _pairs(h)])
                at = codes & np.uint64(SET_BITS - 1)  # the remainder also of a negative number, as a power of two
                hit = marked[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32) & np.uint32(1)
                held.append(codes[hit == 1])
            if sum(map(len, held)) > 1 << 20:
                yield flush()
        if held:
            yield flush()

    counted = texts(docs).select("text").mapInArrow(run, "pattern long, n long")
    return counted.groupBy("pattern").agg(F.sum("n").alias("total")).join(patterns.hint("merge"), "pattern")


def trusted_patterns(docs: DataFrame, spans: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT, rounds: int = ROUNDS) -> DataFrame:
    """``(kind, pattern, confidence)`` of the patterns that lead to identifiers often enough.

    Patterns and the values that follow them are the two sides of a graph. Base values, the seeds, have score 1. In
    each round a pattern's confidence is the summed scores of the places it leads to, over all places in the corpus
    where its words occur; a candidate's score is the chance that not all patterns that lead to it are wrong.
    """
    edges = spans.select(F.explode("spans").alias("s")).select("s.kind", "s.value", "s.base", F.explode("s.patterns").alias("pattern"))
    edges = stored(edges.groupBy("kind", "pattern", "value", "base").agg(F.count("*").alias("n")), "edges")
    seeded = edges.where("base").groupBy("kind", "pattern").agg(F.count("*").alias("support")).where(F.col("support") >= support)
    seeded = stored(seeded, "seeded")
    total = stored(_occurrences(docs, seeded.select("pattern").distinct()), "totals")
    edges = stored(edges.join(seeded.hint("merge"), ["kind", "pattern"]).join(total.hint("merge"), "pattern", "left"), "graph")
    scores = None
    for _ in range(rounds):
        told = edges if scores is None else edges.join(scores.hint("merge"), ["kind", "value"], "left")
        score = F.when(F.col("base"), 1.0).otherwise(F.lit(0.0) if scores is None else F.coalesce("score", F.lit(0.0)))
        # A word cut by the span's start is not among the corpus words; its own places are then all there are.
        places = F.greatest(F.coalesce(F.max("total"), F.lit(0)), F.sum("n"))
        patterns = told.groupBy("kind", "pattern").agg((F.sum(score * F.col("n")) / places).alias("confidence"))
        patterns = stored(patterns, "patterns")
        open_edges = edges.where("not base").select("kind", "value", "pattern").join(patterns.hint("merge"), ["kind", "pattern"])
        wrong = F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-9))))
        scores = stored(open_edges.groupBy("kind", "value").agg((1 - F.exp(wrong)).alias("score")), "scores")
    return patterns.where(F.col("confidence") >= confidence)


def personal_data(docs: DataFrame, confidence: float = CONFIDENCE, support: int = SUPPORT, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, spans)``, spans an array of (start, kind, end, base): all base spans of each text, and the candidates
    in other spellings that follow a trusted pattern.

    Start and end are code points, end exclusive; spans are sorted by start, then kind. A null or empty text has no
    spans. Repeated rows and null ids stay. Without seeds nothing is added; other columns are ignored; no rows give
    no rows. Text of any form is read in linear time.
    """
    found = stored(find_spans(docs).withColumn("row", F.monotonically_increasing_id()), "spans")
    trusted = trusted_patterns(docs, found, confidence, support, rounds)
    loose = found.select("row", F.explode("spans").alias("s")).where("not s.base")
    loose = loose.select("row", "s.start", "s.kind", "s.end", F.explode("s.patterns").alias("pattern"))
    added = loose.join(trusted.hint("merge"), ["kind", "pattern"], "left_semi").select("row", "start", "kind", "end").distinct()
    span = F.struct("start", "kind", "end", F.lit(False).alias("base"))
    added = added.groupBy("row").agg(F.collect_list(span).alias("added"))  # of one text
    base = F.transform(F.filter("spans", lambda s: s["base"]), lambda s: F.struct(s["start"], s["kind"], s["end"], s["base"]))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,base:boolean>>")
    named = found.select("doc_id", "row", base.cast(none_type()).alias("own")).join(added.hint("merge"), "row", "left")
    return named.select("doc_id", F.array_sort(F.concat("own", F.coalesce(F.col("added").cast(none_type()), none))).alias("spans"))


def none_type() -> str:
    return "array<struct<start:int,kind:int,end:int,base:boolean>>"


def span_digests(found: DataFrame) -> DataFrame:
    """Counts of base spans by kind, the digest of the base spans, and all spans as one string."""

    def joined(spans):
        name = F.array(*map(F.lit, KINDS))
        one = lambda s: F.concat_ws(":", F.element_at(name, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    base = F.filter("spans", lambda s: s["base"])

    def number(kind: int):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long")

    counts = [number(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    digest = F.sha2(joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, joined(F.col("spans")).alias("spans"))

"""Language-model scores: a probabilistic suffix tree over the bytes of words, and the unigram base beside it."""

from __future__ import annotations

import math
from collections import Counter
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, DoubleType, LongType, StringType, StructField, StructType,
)

from tidemark.llm.common import map_batches, same_type, stored, texts, words

# Symbols of a context at most. With the symbol that follows they fit in a 64-bit number.
DEPTH = 6

# A context must occur so often in the training texts, and its counts must cost this many bits less with what follows it
# than with what follows the next shorter one. Both are absolute: what is retained grows with the corpus.
MIN_COUNT = 4
MIN_BITS = 8.0

# Fixed values of the base model: what is added to each count. Also used for the distribution without context.
ADDED = 0.1

# Symbols that a text can have: all bytes but the six blanks, the space after a word, and the end.
SPACE, END = 0x20, 0x0A
SYMBOLS = 256 - 6 + 2

# The most frequent words, whose logarithms go to every task; all others are joined.
HOT_WORDS = 200_000

# The most frequent grams (a context of full length and the symbol after it), whose logarithms go to every task; all
# others are joined.
HOT_GRAMS = 2_000_000

# Contexts up to this length are retained whenever they are frequent enough; the divergence decides on longer ones. Their
# counts are one small table. Grams are counted where all contexts that end in the same SHARED symbols are.
ROOTS, SHARED = 2, 3

# Bytes that are counted or scored at once, grams that a task holds before it gives them out, and tokens per bucket. A
# worker has some hundred bytes for each of the former, which is what its memory depends on.
CHUNK, HELD, BUCKET_TOKENS = 1 << 20, 1 << 21, 2_000_000


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is divisible by 10; not so for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def symbols(found: list[bytes]) -> bytes:
    """The words, each followed by a space, and the end: one sequence for one list of words."""
    return b" ".join([*found, b"\n"])


def _grams(sequences: list[bytes], depth: int) -> np.ndarray:
    """For each symbol the ``depth`` symbols before it and itself, packed; ends stand before a text's first."""
    pad = b"\n" * depth
    flat = np.frombuffer(b"".join([x for s in sequences for x in (pad, s)]), np.uint8)
    real = np.ones(len(flat), bool)
    begun = np.cumsum([0, *(len(s) + depth for s in sequences)])[:-1]
    real[(begun[:, None] + np.arange(depth)).ravel()] = False
    code = np.zeros(len(flat) - depth, np.uint64)
    for k in range(depth + 1):
        code = (code << np.uint64(8)) | flat[k : len(flat) - depth + k]
    return code[real[depth:]]


def _summed(codes: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Each code once, in order, with the sums of its counts."""
    if not len(codes):
        return codes, *counts
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    begun = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[begun], *(np.add.reduceat(c[order], begun) for c in counts)


def _tail(codes: np.ndarray, k: int) -> np.ndarray:
    """The last ``k`` symbols of packed grams."""
    return codes & np.uint64((1 << (8 * k)) - 1)


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Where a gram is counted: by the last symbols of its context, so that all longer and shorter contexts that end
    in them, down to ``SHARED`` symbols, are at one place."""
    mixed = _tail(codes >> np.uint64(8), SHARED) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def _unpacked(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


_PACKED = "bucket int, codes binary, n binary, seen binary"


def count_grams(docs: DataFrame, depth: int, buckets: int) -> DataFrame:
    """``(bucket, codes, n, seen, low, low_n)``, one row per bucket: all grams of ``depth`` symbols of context and the
    symbol after it, packed and in order, with their counts in the rows that are not ``held_out`` and in all rows; and
    the sums of the former for the last ``ROOTS`` symbols of context.

    Each task sums up its texts first. What is shuffled is one row of numbers per task and bucket; how many buckets
    there are follows from the corpus, so a bucket's numbers fit into a task.
    """

    def run(batches):
        held: list[tuple[np.ndarray, ...]] = []

        def merge() -> None:
            held[:] = [_summed(*(np.concatenate(x) for x in zip(*held, strict=True)))]

        def flush():
            merge()
            codes, n, seen = held.pop()
            bucket = _bucket(codes, buckets)
            order = np.argsort(bucket, kind="stable")
            codes, n, seen, bucket = codes[order], n[order], seen[order], bucket[order]
            begun = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else order
            for lo, hi in zip(begun, [*begun[1:], len(bucket)], strict=True):
                one = [codes[lo:hi].tobytes(), n[lo:hi].tobytes(), seen[lo:hi].tobytes()]
                yield pa.record_batch([pa.array([bucket[lo]], pa.int32()), *(pa.array([x], pa.binary()) for x in one)], ["bucket", "codes", "n", "seen"])

        def add(sequences: list[bytes], out: bool) -> None:
            codes, seen = np.unique(_grams(sequences, depth), return_counts=True)
            held.append((codes, np.zeros_like(seen) if out else seen, seen))
            if sum(len(x[0]) for x in held[1:]) > CHUNK:
                merge()

        waiting, size = {False: [], True: []}, {False: 0, True: 0}
        for batch in batches:
            for t, out in zip(batch.column("text"), batch.column("held_out").to_pylist(), strict=True):
                waiting[out].append(symbols(words(t.as_py().encode())))
                size[out] += len(waiting[out][-1])
                if size[out] > CHUNK:
                    add(waiting[out], out)
                    waiting[out], size[out] = [], 0
                    if len(held[0][0]) > HELD:
                        yield from flush()
        for out, rest in waiting.items():
            if rest:
                add(rest, out)
        if held:
            yield from flush()

    def whole(table: pa.Table) -> pa.Table:
        codes, n, seen = _summed(_unpacked(table["codes"], np.uint64), _unpacked(table["n"], np.int64), _unpacked(table["seen"], np.int64))
        low, low_n = _summed(_tail(codes, min(ROOTS, depth) + 1), n)
        told = {"codes": codes, "n": n, "seen": seen, "low": low, "low_n": low_n}
        bucket = pa.array([table["bucket"][0].as_py()], pa.int32())
        return pa.table([bucket, *(pa.array([x.tobytes()], pa.binary()) for x in told.values())], ["bucket", *told])

    parts = docs.select("text", "held_out").mapInArrow(run, _PACKED)
    return parts.groupBy("bucket").applyInArrow(whole, f"{_PACKED}, low binary, low_n binary")


class Level:
    """The contexts of one length, from the grams of that length and their counts in order."""

    def __init__(self, codes: np.ndarray, n: np.ndarray):
        self.codes, self.n = codes, n
        self.contexts, self.own = np.unique(codes >> np.uint64(8), return_inverse=True)
        self.total = np.bincount(self.own, n, minlength=len(self.contexts))
        self.kinds = np.bincount(self.own, n > 0, minlength=len(self.contexts))
        self.share = n / np.maximum(self.total[self.own], 1)

    def smoothed(self, shorter: np.ndarray, kept: np.ndarray) -> np.ndarray:
        """Probabilities of the symbols after their contexts, given those after the next shorter ones."""
        own = self.own
        return np.where(kept[own], (self.n + self.kinds[own] * shorter) / np.maximum(self.total + self.kinds, 1)[own], shorter)


def roots(low: np.ndarray, low_n: np.ndarray, length: int, min_count: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams with contexts of ``length`` symbols, their shares and their probabilities. Contexts up to this length are
    retained if they are frequent enough. There are at most 252 ** 3 of these grams, whatever the corpus."""
    p = None
    for k in range(length + 1):
        level = Level(*_summed(_tail(low, k + 1), low_n))
        if p is None:
            p = (level.n + ADDED) / (low_n.sum() + ADDED * SYMBOLS)
        else:
            p = level.smoothed(p[np.searchsorted(before, _tail(level.codes, k))], level.total >= min_count)
        before = level.codes
    return level.codes, level.share, p


def learned(codes: np.ndarray, n: np.ndarray, depth: int, start: tuple[np.ndarray, ...], min_count: float, min_bits: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Probabilities of one bucket's grams by their longest retained context, and the retained contexts of each length
    beyond the roots'.

    A context is a candidate if it occurs ``min_count`` times, and is retained if its counts times the divergence of
    what follows it from what follows the next shorter context is ``min_bits``. The suffixes of a retained context are
    retained too; as they are no rarer they are candidates.
    """
    known, share, p = start
    first = min(ROOTS, depth)
    levels, parents, kept = [], [], []
    for k in range(first + 1, depth + 1):
        level = Level(*_summed(_tail(codes, k + 1), n))
        up = np.searchsorted(known, _tail(level.codes, k))
        seen = np.flatnonzero(level.n)
        bits = level.n[seen] * np.log2(level.share[seen] / share[up[seen]])
        told = np.bincount(level.own[seen], bits, minlength=len(level.contexts))
        kept.append((level.total >= min_count) & (told >= min_bits))
        levels.append(level)
        parents.append(up)
        known, share = level.codes, level.share
    for at in range(len(levels) - 1, 0, -1):
        shorter = levels[at - 1].contexts
        kept[at - 1][np.searchsorted(shorter, _tail(levels[at].contexts[kept[at]], first + at))] = True
    for level, up, keep in zip(levels, parents, kept, strict=True):
        p = level.smoothed(p[up], keep)
    last = levels[-1].codes if levels else start[0]
    return p[np.searchsorted(last, _tail(codes, depth + 1))], [level.contexts[k] for level, k in zip(levels, kept, strict=True)]


def gram_logs(counted: DataFrame, depth: int, min_count: float, min_bits: float) -> DataFrame:
    """``(gram, seen, log)`` of every gram of full length in any text: log10 of the probability that the longest retained
    context before its last symbol gives to it. ``counted`` is what ``count_grams`` gives, stored; a bucket needs nothing
    of any other but the roots, which are sent to every task."""
    low, low_n = np.empty(0, np.uint64), np.empty(0, np.int64)
    for row in counted.select("low", "low_n").toLocalIterator():  # a bucket at a time
        part = np.frombuffer(row.low, np.uint64), np.frombuffer(row.low_n, np.int64)
        low, low_n = _summed(np.concatenate([low, part[0]]), np.concatenate([low_n, part[1]]))
    start = roots(low, low_n, min(ROOTS, depth), min_count)
    sent = counted.sparkSession.sparkContext.broadcast(start)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                codes, n, seen = (np.frombuffer(batch.column(c)[i].as_py(), t) for c, t in (("codes", np.uint64), ("n", np.int64), ("seen", np.int64)))
                p, _ = learned(codes, n, depth, sent.value, min_count, min_bits)
                for lo in range(0, len(codes), 1 << 16):
                    part = slice(lo, lo + (1 << 16))
                    columns = [pa.array(codes[part].view(np.int64)), pa.array(seen[part]), pa.array(np.log10(p[part]))]
                    yield pa.record_batch(columns, ["gram", "seen", "log"])

    return counted.select("codes", "n", "seen").mapInArrow(run, "gram long, seen long, log double")


def count_words(docs: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts, the end of a text counted as the word of one line feed."""

    def run(batches):
        total: Counter[bytes] = Counter()

        def flush() -> pa.RecordBatch:
            out = [pa.array(list(total), pa.binary()).cast(pa.string()), pa.array(list(total.values()), pa.int64())]
            total.clear()
            return pa.record_batch(out, ["word", "n"])

        for batch in batches:
            for t in batch.column("text"):
                total.update(words(t.as_py().encode()))
            total[b"\n"] += batch.num_rows
            if len(total) > 500_000:
                yield flush()
        if total:
            yield flush()

    return docs.select("text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Lookup:
    """Logarithms of the grams that every task has, in hash tables of single slots: what finds its slot taken goes to
    the next table, so that none is left out."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, grams: np.ndarray, logs: np.ndarray):
        self.tables = []
        while len(grams):
            bits = max(8, int(len(grams) * 2).bit_length())
            at = self._slot(grams, bits, len(self.tables))
            keys, values = np.full(1 << bits, ~np.uint64(0)), np.zeros(1 << bits)
            keys[at], values[at] = grams, logs
            self.tables.append((bits, keys, values))
            lost = keys[at] != grams
            values[at[~lost]] = logs[~lost]
            grams, logs = grams[lost], logs[lost]

    def _slot(self, grams: np.ndarray, bits: int, turn: int) -> np.ndarray:
        return ((grams ^ (grams >> np.uint64(29))) * (self.FACTOR + np.uint64(2 * turn)) >> np.uint64(64 - bits)).astype(np.int64)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logarithms, 0 where there is none, and the places where there is none."""
        out, left = np.zeros(len(grams)), np.arange(len(grams))
        for turn, (bits, keys, values) in enumerate(self.tables):
            at = self._slot(grams[left], bits, turn)
            hit = keys[at] == grams[left]
            out[left[hit]] = values[at[hit]]
            left = left[~hit]
        return out, left


_lookups: dict[str, Lookup] = {}


def _lookup(name: str, grams: np.ndarray, logs: np.ndarray) -> Lookup:
    """The hash tables of a broadcast, built once in each Python worker."""
    if name not in _lookups:
        _lookups.clear()
        _lookups[name] = Lookup(grams, logs)
    return _lookups[name]


def _most_frequent(counted: DataFrame, most: int, n: str = "n") -> DataFrame:
    """The rows from a count on that ``most`` rows reach at the most, found by a histogram of the counts' logarithms:
    no task sorts or gathers the vocabulary."""
    step = F.floor(F.log2(n) * 64).cast("int")  # some thousand steps, whatever the counts
    found = counted.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    reached, least = 0, math.inf
    for row in sorted(found, key=lambda r: -r["step"]):
        reached += row["words"]
        if reached > most:
            break
        least = row["step"]
    return counted.where(step >= least) if found and least < math.inf else counted.where("false")


def score(
    docs: DataFrame,
    depth: int = DEPTH,
    min_count: float = MIN_COUNT,
    min_bits: float = MIN_BITS,
    hot: int = HOT_WORDS,
    hot_grams: int = HOT_GRAMS,
    buckets: int | None = None,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)``, one row per document.

    The model learns from the rows that are not held out. Tokens are words (A-Z in lower case) and one end. The base
    is the sum over tokens of log10((c + 0.1) / (N + 0.1 * (V + 1))). The suffix tree spells a token: the bytes of a
    word and a space, or the end, each with the probability that the longest retained suffix of the bytes before it
    gives. Distributions are smoothed with that of the next shorter context, weighted by the number of different
    symbols that follow; without context each of the 252 possible symbols has 0.1 added to its count. So
    probabilities of all texts sum to 1 at most, and unseen words have the probability of their spelling.

    Word and gram counts are of the whole training corpus and of any number, and so are the retained contexts: the
    logarithms of the ``hot`` most frequent words and the ``hot_grams`` most frequent grams go to every task, all other
    words and grams of a text are joined to theirs.

    A null or empty text is one end. A null doc_id is not held out. With no training rows the base is null and the
    tree uniform. Repeated rows stay repeated; other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    frame = texts(docs)
    counted = stored(count_words(frame.where(~is_held_out(F.col("doc_id")))), "words")
    n, v = counted.agg(F.sum("n"), F.count("*")).first()
    n, norm = n or 0, (n or 0) + ADDED * (v + 1)
    top = _most_frequent(counted, hot).toArrow()
    values = np.log10((top.column("n").to_numpy() + ADDED) / norm).tolist()
    logs = dict(zip((w.encode() for w in top.column("word").to_pylist()), values, strict=True))
    counted_grams = count_grams(frame.withColumn("held_out", is_held_out(F.col("doc_id"))), depth, buckets or max(32, -(-n // BUCKET_TOKENS)))
    spelled = stored(gram_logs(stored(counted_grams, "grams"), depth, min_count, min_bits), "gram-logs")
    often = _most_frequent(spelled, hot_grams, "seen").select("gram", "log").toArrow()
    sent = spark.sparkContext.broadcast((logs, often.column("gram").to_numpy().view(np.uint64), often.column("log").to_numpy()))
    name = uuid4().hex
    rare = ArrayType(StructType([StructField("word", StringType()), StructField("n", LongType())]))
    grams = ArrayType(StructType([StructField("gram", LongType()), StructField("n", LongType())]))
    schema = StructType(
        [same_type(frame, "doc_id", "doc_id")]
        + [StructField(c, t) for c, t in (("n_tokens", LongType()), ("hot_known", LongType()), ("hot_score", DoubleType()))]
        + [StructField("score", DoubleType()), StructField("rare", rare), StructField("grams", grams)]
    )

    def make():
        logs, often, spelt = sent.value
        known = logs.get
        lookup = _lookup(name, often, spelt)

        def spell(sequences: list[bytes]) -> tuple[np.ndarray, pa.Array]:
            """Sums of the logarithms at hand, and the other grams of each sequence with their counts."""
            codes = _grams(sequences, depth)
            owner = np.repeat(np.arange(len(sequences)), [len(s) for s in sequences])
            found, left = lookup.find(codes)
            mine, code = owner[left], codes[left]
            order = np.lexsort((code, mine))
            mine, code = mine[order], code[order]
            begun = np.flatnonzero(np.r_[True, (mine[1:] != mine[:-1]) | (code[1:] != code[:-1])]) if len(mine) else mine
            times = np.diff(np.r_[begun, len(mine)])
            offsets = np.searchsorted(mine[begun], np.arange(len(sequences) + 1)).astype(np.int32)
            pairs = pa.StructArray.from_arrays([pa.array(code[begun].view(np.int64)), pa.array(times.astype(np.int64))], ["gram", "n"])
            return np.bincount(owner, found, minlength=len(sequences)), pa.ListArray.from_arrays(pa.array(offsets), pairs)

        def run(batch: pa.RecordBatch):
            ids = batch.column("doc_id")
            begun, rows, sequences, size = 0, [], [], 0

            def of() -> pa.RecordBatch:
                scores, others = spell(sequences)
                columns = [
                    ids.slice(begun, len(rows)),
                    *(pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))),
                    pa.array(scores, pa.float64()),
                    pa.array([r[3] for r in rows], kind),
                    others,
                ]
                return pa.record_batch(columns, schema.names)

            kind = pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))
            for t in batch.column("text"):
                found = words(t.as_py().encode())
                total, hit, rest = 0.0, 0, []
                for w, k in Counter([*found, b"\n"]).items():
                    if (value := known(w)) is None:
                        rest.append({"word": w.decode(), "n": k})
                    else:
                        total, hit = total + k * value, hit + k
                rows.append((len(found) + 1, hit, total, rest))
                sequences.append(symbols(found))
                size += len(sequences[-1])
                if size > CHUNK:
                    yield of()
                    begun, rows, sequences, size = begun + len(rows), [], [], 0
            if rows:
                yield of()

        return run

    scored = map_batches(frame, make, schema).withColumn("row", F.monotonically_increasing_id())
    scored = stored(scored, "scored")
    rest = scored.select("row", F.explode("rare").alias("r")).select("row", "r.word", "r.n")
    value = F.log10((F.coalesce("c", F.lit(0)) + ADDED) / F.lit(norm))
    rest = rest.join(counted.withColumnRenamed("n", "c").hint("merge"), "word", "left").groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"), F.sum(F.col("n") * value).alias("rare_score")
    )
    others = scored.select("row", F.explode("grams").alias("g")).select("row", "g.gram", "g.n")
    others = others.join(spelled.select("gram", "log").hint("merge"), "gram").groupBy("row").agg(F.sum(F.col("n") * F.col("log")).alias("others"))
    whole = scored.drop("rare", "grams").join(rest.hint("merge"), "row", "left").join(others.hint("merge"), "row", "left")
    return whole.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "n_tokens",
        (F.col("hot_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        F.when(F.lit(n > 0), F.col("hot_score") + F.coalesce("rare_score", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("others", F.lit(0.0))).alias("score"),
    )

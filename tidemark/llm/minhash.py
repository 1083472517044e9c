"""Near-duplicate documents: banded MinHash, odd sketches, and confirmation on whole shingle sets."""

from __future__ import annotations

import math
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm.common import hint_if_counted, map_batches, same_type, stored, texts, words
from tidemark.llm.graph import components

# 32 bands of 4 samples: two sets with a similarity of 0.8 share no band once in twenty million times.
BANDS, ROWS = 32, 4

# Bits of an odd sketch. Two sets of the threshold's similarity are let through up to five standard
# errors of the 128 samples below it, so that the sketch hides a link in about one case of 100,000.
SKETCH_BITS = 512
ERRORS = 5

# Members of a bucket that meet in one join key; the pairs of blocks of larger buckets are dealt out.
BLOCK = 4096

# Bytes and number of shingle sets that meet in one join key where sets are compared inside a join, about a second's work.
BLOCK_BYTES, BLOCK_SETS = 32 << 20, 512

_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread each input bit over all 64 (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(text: bytes, size: int) -> np.ndarray:
    """The sorted set of 64-bit hashes of a text's word shingles: ``size`` words each, or the whole
    sequence if there are fewer; empty if there is no word."""
    found = words(text)
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, n)
    width = min(size, n)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total = _mix(total * _GOLD + h[k : n - width + 1 + k])
    return np.unique(total)


class Sampler:
    """MinHash samples, band keys and odd sketches of shingle sets."""

    def __init__(self, bands: int, rows: int, bits: int, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.n, self.bands, self.rows, self.bits = bands * rows, bands, rows, bits
        self.xor = rng.integers(0, 2**64, self.n, dtype=np.uint64)
        self.odd = rng.integers(0, 2**64, self.n, dtype=np.uint64) | np.uint64(1)

    def samples(self, sets: list[np.ndarray]) -> np.ndarray:
        """The smallest hash of each set under each of the hash functions; no set may be empty."""
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets)])[:-1]
        out = np.empty((len(sets), self.n), np.uint64)
        work = np.empty_like(flat)
        for i in range(self.n):
            np.bitwise_xor(flat, self.xor[i], out=work)
            np.multiply(work, self.odd[i], out=work)
            out[:, i] = np.minimum.reduceat(work, starts)
        return out

    def keys(self, samples: np.ndarray) -> np.ndarray:
        """One 64-bit key for each band; the band's number is part of it."""
        cut = samples.reshape(len(samples), self.bands, self.rows)
        key = np.broadcast_to(np.arange(self.bands, dtype=np.uint64) + np.uint64(1), cut.shape[:2])
        for k in range(self.rows):
            key = _mix(key * _GOLD + cut[:, :, k])
        return key

    def sketches(self, samples: np.ndarray) -> np.ndarray:
        """Fold the samples of each set into a bitmap in which a bit says whether an odd number of samples
        fell on it. Samples that two sets share cancel out in the XOR of their bitmaps."""
        bit = _mix(samples * _GOLD + np.arange(self.n, dtype=np.uint64)) % np.uint64(self.bits)
        out = np.zeros((len(samples), self.bits // 64), np.uint64)
        row = np.repeat(np.arange(len(samples)), self.n)
        np.bitwise_xor.at(out, (row, (bit >> np.uint64(6)).astype(np.int64).ravel()), np.uint64(1) << (bit & np.uint64(63)).ravel())
        return out


def differing_bits(similarity: float, samples: int, bits: int) -> int:
    """The expected population count of the XOR of two sketches whose sets have the given similarity."""
    return math.ceil(bits / 2 * (1 - math.exp(-4 * samples * (1 - similarity) / bits)))


def estimated_similarity(differing: Column, samples: int, bits: int) -> Column:
    """The similarity that a population count stands for."""
    return 1 + F.lit(bits / (4 * samples)) * F.log(1 - 2 * differing / bits)


def prints(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS) -> DataFrame:
    """``(doc_id, n, set_id, keys, s0..)`` for each row: the size and a 128-bit name of its shingle set, its
    band keys, and its odd sketch. Only these leave the task, never text or set."""
    frame = texts(docs)
    sketch = [f"s{i}" for i in range(bits // 64)]
    schema = StructType(
        [same_type(frame, "doc_id", "doc_id"), StructField("n", LongType()), StructField("set_id", BinaryType())]
        + [StructField("keys", ArrayType(LongType()))]
        + [StructField(s, LongType()) for s in sketch]
    )

    def make():
        sampler = Sampler(bands, rows, bits)

        def of(ids: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
            full = [i for i, s in enumerate(sets) if len(s)]
            keys, marks = np.zeros((len(sets), bands), np.uint64), np.zeros((len(sets), bits // 64), np.uint64)
            if full:
                samples = sampler.samples([sets[i] for i in full])
                keys[full], marks[full] = sampler.keys(samples), sampler.sketches(samples)
            offsets = np.arange(len(sets) + 1, dtype=np.int32) * bands
            columns = [
                ids,
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.view(np.int64).ravel())),
                *(pa.array(marks[:, k].view(np.int64)) for k in range(len(sketch))),
            ]
            return pa.record_batch(columns, schema.names)

        def run(batch: pa.RecordBatch):
            begun, sets, held = 0, [], 0
            for i, t in enumerate(batch.column("text")):
                sets.append(shingles(t.as_py().encode(), size))
                held += len(sets[-1])
                if held >= 1 << 16:  # the numbers of one round stay in the processor's cache
                    yield of(batch.column("doc_id").slice(begun, len(sets)), sets)
                    begun, sets, held = i + 1, [], 0
            if sets:
                yield of(batch.column("doc_id").slice(begun, len(sets)), sets)

        return run

    return map_batches(frame, make, schema)


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``(rep, shingles)``: the whole shingle set of each row."""
    frame = texts(docs)
    schema = StructType([same_type(frame, "doc_id", "rep"), StructField("shingles", ArrayType(LongType()))])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [shingles(t.encode(), size).view(np.int64) for t in batch.column("text").to_pylist()]
            offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
            values = np.concatenate([np.empty(0, np.int64), *sets])
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            return pa.record_batch([batch.column("doc_id"), lists], ["rep", "shingles"])

        return run

    return map_batches(frame, make, schema)


def _similar(a: str, b: str, percent: int) -> Column:
    """Whether two columns with shingle sets reach the similarity."""
    both = F.size(F.array_intersect(a, b)).cast("long")  # named once: a join condition computes each mention anew
    return (100 + percent) * both >= percent * (F.size(a).cast("long") + F.size(b))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose whole sets reach the similarity. Both joins are of two stored or shuffled sides, so
    that a document in very many pairs is split."""
    for end in ("a", "b"):
        own = sets.select(F.col("rep").alias(end), F.col("shingles").alias(f"set_{end}"))
        pairs = pairs.join(own.hint("merge"), end)
    return pairs.where(_similar("set_a", "set_b", percent)).select("a", "b")


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per document: the groups that links of
    ``percent`` or more similarity (of the sets of ``size``-word shingles) make, named by their smallest id.

    1. Each text becomes band keys and an odd sketch. Rows with equal sets become one class, so that copies,
       however many, meet no other comparison.
    2. Classes that share a band key are candidates. Those without a partner whose sketch, by the population
       count of the XOR, may reach the threshold are left out by a semi join, which gives out no pairs.
    3. Each class is confirmed against two of the pivots of its buckets, the likeliest one and a hub that buckets
       share. What these links connect needs no further comparison, which takes the square out of large groups of
       near copies.
    4. Classes with a partner in a bucket that they are not connected with yet and that the sketch lets through
       meet there again, with their sets. These are compared inside the join, so that only links leave it.

    In 2 and 4 a large bucket's pairs of blocks are dealt out over many join keys, in 4 by the number and bytes of its sets.
    Links are confirmed on whole sets of 64-bit shingle hashes. No bucket is cut or skipped.

    A text without words (also null or empty) has no shingles and links with nothing; one with fewer words
    than ``size`` has one. Rows with the same doc_id count as one document. A row without doc_id links with
    nothing; its component is null and it is kept. No rows give no rows; other columns are ignored.
    """
    sketch = [f"s{i}" for i in range(bits // 64)]
    low = percent / 100 - ERRORS * math.sqrt(percent / 100 * (1 - percent / 100) / (bands * rows))
    most = differing_bits(low, bands * rows, bits)
    found = stored(prints(docs, size, bands, rows, bits), "prints")
    named = found.where("n > 0 and doc_id is not null")
    classes = stored(named.groupBy("set_id").agg(F.min("doc_id").alias("rep")), "classes")
    reps = stored(
        named.join(classes.hint("merge"), "set_id").where("doc_id = rep").select("rep", "n", "keys", *sketch), "reps"
    )

    # Buckets of two or more classes, and their members with sketches.
    at = reps.select("rep", F.posexplode("keys").alias("band", "key"))
    buckets = at.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    sketches = reps.select("rep", "n", *sketch)
    member = stored(at.join(buckets, "key").join(sketches.hint("merge"), "rep"), "members")

    def dealt(frame: DataFrame, side: str, mine: str, other: str, blocks: Column) -> DataFrame:
        own = F.pmod(F.xxhash64("rep"), blocks).cast("int").alias(mine)
        frame = frame.select("*", own, F.explode(F.sequence(F.lit(0), blocks - 1)).alias(other))
        return frame.select("i", "j", *(F.col(c).alias(f"{c}_{side}") for c in frame.columns if c not in ("i", "j")))

    def differing(left: str, right: str) -> Column:
        return sum((F.bit_count(F.col(f"{s}_{left}").bitwiseXOR(F.col(f"{s}_{right}"))) for s in sketch), F.lit(0))

    def likely(left: str, right: str) -> Column:
        small, large = (f(f"n_{left}", f"n_{right}") for f in (F.least, F.greatest))
        return (100 * small >= percent * large) & (differing(left, right) <= most)

    by_rows = F.ceil(F.col("members") / BLOCK).cast("int")

    def meeting(
        frame: DataFrame, first: Column, how: str, blocks: Column = by_rows, last: Column | None = None, even: bool = False
    ) -> DataFrame:
        """Members of a bucket against each other, block by block: the cheap test first, then the sketches, then the
        dear test. The condition must stay short: Java leaves a method of more than 8,000 bytes uncompiled. ``even``
        blocks are shuffled as they are dealt: splitting both sides of a large bucket once more makes a task of each
        pair of splits, with little to do."""
        left, right = dealt(frame, "a", "i", "j", blocks), dealt(frame, "b", "j", "i", blocks)
        if even:
            left, right = left.repartition("key_a", "i", "j"), right.repartition("key_b", "i", "j")
        same = (F.col("key_a") == F.col("key_b")) & (left["i"] == right["i"]) & (left["j"] == right["j"])
        tests = [first, likely("a", "b")] + ([] if last is None else [last])
        return left.join(right.hint("merge"), reduce(lambda a, b: a & b, tests, same), how)

    partnered = meeting(member, F.col("rep_a") != F.col("rep_b"), "left_semi")
    member = stored(
        partnered.select(*(F.col(f"{c}_a").alias(c) for c in ("key", "band", "rep", "members", "n", *sketch))).distinct(), "partnered"
    )

    ids = stored(member.select("rep").distinct(), "candidates")
    few = hint_if_counted(ids.withColumnRenamed("rep", "doc_id"), ids.count())
    sets = stored(shingle_sets(texts(docs).join(few, "doc_id", "left_semi"), size), "sets")

    # Each bucket has two pivots: one in an order of its own, one in an order that all buckets share. A class is tried
    # with the likeliest of the first kind, which is close to it, and with the first of the second kind, a hub that
    # brings together what several close pivots gather of one large group.
    body = ("rep", "n", *sketch)
    own_order = F.struct(F.xxhash64("rep", "key").alias("h"), F.lit(False).alias("hub"), *body)
    hub_order = F.struct(F.xxhash64("rep").alias("h"), F.lit(True).alias("hub"), *body)
    pivot = member.groupBy("key").agg(F.min(own_order).alias("own"), F.min(hub_order).alias("all"))
    pivot = pivot.select("key", F.explode(F.array("own", "all")).alias("p"))
    pivot = pivot.select("key", "p.h", "p.hub", *(F.col(f"p.{c}").alias(f"{c}_b") for c in body))
    tried = member.select("key", *(F.col(c).alias(f"{c}_a") for c in body)).join(pivot.hint("merge"), "key")
    tried = tried.where((F.col("rep_a") != F.col("rep_b")) & likely("a", "b"))
    close = F.min(F.when(~F.col("hub"), F.struct(differing("a", "b").alias("z"), F.col("rep_b").alias("b"))))
    hub = F.min(F.when(F.col("hub"), F.struct("h", F.col("rep_b").alias("b"))))
    tried = tried.groupBy(F.col("rep_a").alias("a")).agg(close.alias("close"), hub.alias("far"))
    tried = tried.select("a", F.explode(F.array_distinct(F.array("close.b", "far.b"))).alias("b")).where("b is not null")
    group = stored(components(stored(_confirmed(stored(tried, "tried"), sets, percent), "links")), "groups")
    told = member.join(group.hint("merge"), F.col("rep") == F.col("node"), "left")
    told = told.select(*member.columns, F.coalesce("component", "rep").alias("group"))
    open_keys = told.groupBy("key").agg(F.min("group").alias("lo"), F.max("group").alias("hi")).where("lo < hi")
    still = stored(told.join(open_keys.select("key").hint("merge"), "key", "left_semi"), "open")

    # All pairs that those links leave unconnected. A pair meets in the first open bucket that it shares, not in each:
    # a row has its open keys of earlier bands with it (a key is of one band only).
    own_keys = still.groupBy("rep").agg(F.collect_set(F.struct("band", "key")).alias("open"))
    earlier = F.transform(F.filter("open", lambda o: o["band"] < F.col("band")), lambda o: o["key"])
    still = stored(still.join(own_keys.hint("merge"), "rep").withColumn("earlier", earlier).drop("open"), "meeting")
    apart, once = F.col("group_a") != F.col("group_b"), ~F.arrays_overlap("earlier_a", "earlier_b")
    told = ("key", "rep", "members", "n", "group", "earlier", *sketch)
    left = stored(meeting(still, apart, "left_semi", last=once).select(*(F.col(f"{c}_a").alias(c) for c in told)), "left")
    room = left.groupBy("key").agg(F.sum("n").alias("together"), F.count("*").alias("sets"))
    left = left.join(room, "key").join(sets.hint("merge"), "rep")
    by_work = F.greatest(F.ceil(8 * F.col("together") / BLOCK_BYTES), F.ceil(F.col("sets") / BLOCK_SETS)).cast("int")
    ahead, linked = (F.col("rep_a") < F.col("rep_b")) & apart, once & _similar("shingles_a", "shingles_b", percent)
    rest = meeting(left, ahead, "inner", by_work, linked, even=True).select(F.col("group_a").alias("a"), F.col("group_b").alias("b"))
    joint = components(stored(rest, "more"))  # of whole groups, named like them by their smallest member

    renamed = joint.select(F.col("node").alias("component"), F.col("component").alias("joined"))
    whole = group.join(renamed, "component", "left").select("node", F.coalesce("joined", "component").alias("component"))
    whole = whole.union(joint.join(group.select("node"), "node", "left_anti"))
    whole = stored(whole, "components")
    mine = found.select("doc_id", "n", "set_id").join(
        classes.hint("merge"), (F.col("n") > 0) & (found["set_id"] == classes["set_id"]), "left"
    ).select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    return mine.join(whole.hint("merge"), F.col("rep") == F.col("node"), "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("component", "rep"), F.lit(True)).alias("kept"),
    )

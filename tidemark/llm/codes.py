"""Vector code compression: integer product codes, their nearest entries found by Orchard's search."""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from tidemark.llm.common import hint_if_counted, map_batches, same_type, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256

# Largest size of a scaled component: squared distances of such parts, and their sums, fit in 64 bits.
LARGEST = 1 << 26


def scaled(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """``(id, label, cut)``: each component as floor(256 * x), for the vectors that are kept."""
    frame = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    schema = StructType([same_type(frame, "id", "id"), same_type(frame, "label", "label"), StructField("cut", ArrayType(IntegerType()))])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            cut = []
            for x in batch.column("vec").to_pylist():
                v = None if not x or None in x else np.floor(np.asarray(x, np.float64) * SCALE)
                good = v is not None and np.isfinite(v).all() and (np.abs(v) <= LARGEST).all()
                cut.append(v.astype(np.int32) if good else None)
            keep = pa.array([c is not None for c in cut])
            columns = [batch.column("id"), batch.column("label"), pa.array(cut, pa.list_(pa.int32()))]
            return pa.record_batch(columns, schema.names).filter(keep)

        return run

    return map_batches(frame, make, schema)


class Orchard:
    """Nearest entries of one codebook per part, all parts of many vectors at a time.

    ``books`` is (parts, entries, width). Every entry has a list of all entries by their distance from it. A search
    goes along the list of the entry it has; at one that is nearer, or as near with a lower index, it jumps to that
    one's list. Entries are marked when visited and looked at once. It ends where the list goes beyond twice the
    current distance: an entry there is further from the vector than the current one, by the triangle inequality.
    Distances are squared integers, so twice is four times, and nothing is rounded.
    """

    def __init__(self, books: np.ndarray):
        self.books = books
        apart = ((books[:, :, None, :] - books[:, None, :, :]) ** 2).sum(axis=3)
        self.order = np.argsort(apart, axis=2, kind="stable")
        self.apart = np.take_along_axis(apart, self.order, axis=2)
        # Searches begin at the entry whose first component is nearest from below.
        self.first = np.argsort(books[:, :, 0], axis=1, kind="stable")
        self.lows = np.take_along_axis(books[:, :, 0], self.first, axis=1)

    def nearest(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and its squared distance for ``cut`` of (vectors, parts, width)."""
        n, parts, width = cut.shape
        entries = self.books.shape[1]
        begin = [self.first[p][np.clip(np.searchsorted(self.lows[p], cut[:, p, 0]), 0, entries - 1)] for p in range(parts)]
        own = np.stack(begin, axis=1).ravel()
        part = np.tile(np.arange(parts), n)
        flat = cut.reshape(n * parts, width)
        far = ((flat - self.books[part, own]) ** 2).sum(axis=1)
        seen = np.zeros((n * parts, entries), bool)
        seen[np.arange(n * parts), own] = True
        at = np.zeros(n * parts, np.int64)
        open_ = np.arange(n * parts)
        while len(open_):
            p, c, k = part[open_], own[open_], at[open_]
            on = self.apart[p, c, k] <= 4 * far[open_]
            open_, p, c, k = open_[on], p[on], c[on], k[on]
            at[open_] += 1
            e = self.order[p, c, k]
            new = ~seen[open_, e]
            look, p, e = open_[new], p[new], e[new]
            seen[look, e] = True
            d = ((flat[look] - self.books[p, e]) ** 2).sum(axis=1)
            better = (d < far[look]) | ((d == far[look]) & (e < own[look]))
            jump = look[better]
            own[jump], far[jump], at[jump] = e[better], d[better], 0
            open_ = open_[at[open_] < entries]
        return own.reshape(n, parts), far.reshape(n, parts)


def _whole(batch: pa.RecordBatch, parts: int, width: int) -> np.ndarray:
    """The cut vectors of a batch as (vectors, parts, width), filled up with zeros."""
    cut = batch.column("cut")
    flat = cut.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(cut), -1)
    return np.pad(flat, ((0, 0), (0, parts * width - flat.shape[1]))).reshape(len(cut), parts, width)


def _sums(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """Per part and entry, how many parts are nearest to it and their componentwise sums; each task adds up its own
    rows first, so what is shuffled is parts x entries rows per task."""
    parts, entries, width = books.shape
    schema = StructType([StructField("part", IntegerType()), StructField("entry", IntegerType()), StructField("n", LongType()), StructField("total", ArrayType(LongType()))])

    def run(batches):
        search = Orchard(books)
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            cut = _whole(batch, parts, width)
            own, _ = search.nearest(cut)
            place = np.broadcast_to(np.arange(parts), own.shape)
            np.add.at(n, (place, own), 1)
            np.add.at(total, (place, own), cut)
        p, e = np.nonzero(n)
        yield pa.record_batch(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(n[p, e]), pa.array(list(total[p, e]), pa.list_(pa.int64()))],
            schema.names,
        )

    told = kept.select("cut").mapInArrow(run, schema)
    return told.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(F.col("total")[k]).alias(f"t{k}") for k in range(width)))


def train(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks of (parts, entries, width): the parts of the vectors with the smallest ids, moved in each round to
    the floor of the mean of the parts nearest to them. Held on the driver and sent to the tasks: parts x entries
    rows of a part each, whatever the data. Fewer vectors make fewer entries; none, no codebooks."""
    first = kept.orderBy(F.col("id").asc_nulls_last(), "cut").limit(entries).collect()
    if not first:
        return None
    length = len(first[0].cut)
    width = -(-length // parts)
    books = np.zeros((len(first), parts * width), np.int64)
    books[:, :length] = [r.cut for r in first]
    books = books.reshape(len(first), parts, width).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        moved = books.copy()
        for r in _sums(kept, books).collect():  # at most parts x entries rows
            moved[r.part, r.entry] = [r[f"t{k}"] // r.n for k in range(width)]
        books = moved
    return books


def encoded(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """``(id, label, code, error)``: the nearest entry per part as one byte each, and the squared distances' sum."""
    parts, entries, width = books.shape
    assert entries <= 256
    schema = StructType([same_type(kept, "id", "id"), same_type(kept, "label", "label"), StructField("code", BinaryType()), StructField("error", LongType())])

    def make():
        search = Orchard(books)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            own, far = search.nearest(_whole(batch, parts, width))
            code = [row.tobytes() for row in own.astype(np.uint8)]
            return pa.record_batch([batch.column("id"), batch.column("label"), pa.array(code, pa.binary()), pa.array(far.sum(axis=1))], schema.names)

        return run

    return map_batches(kept, make, schema)


def compressed(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, code, error, label_error, codebooks_sha256)``, one row per kept vector: 16 bytes as hex digits, the
    squared distance between the vector and what they stand for, that sum over all vectors of the same label (nulls
    together), and a digest of the codebooks.

    Vectors that are null or empty, hold a null or a number that is not finite, or one beyond 2^18 in size (its
    distances have no place in 64 bits) are dropped, and so are those whose length is not that of the first
    kept one. A length that 16 does not divide is filled up with zeros, which are part of the codebooks. Rows that repeat an id
    are all kept and coded; null ids come last in the order that the codebooks begin with. Errors are summed per label
    before a shuffle, and come back by a broadcast where labels are counted to be few, so no label is one task's work.
    No rows give no rows.
    """
    kept = stored(scaled(vectors, key, vector, label), "scaled")
    first = kept.orderBy(F.col("id").asc_nulls_last(), "cut").select(F.size("cut")).first()
    if first is not None:
        kept = kept.where(F.size("cut") == first[0])
    books = train(kept)
    if books is None:
        books = np.zeros((PARTS, 1, 1), np.int64)
    told = sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    codes = stored(encoded(kept, books), "codes")
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    c, s = codes.alias("c"), hint_if_counted(sums, sums.count()).alias("s")
    return c.join(s, F.col("c.label").eqNullSafe(F.col("s.label"))).select(
        F.col("c.id").alias("vec_id"),
        F.lower(F.hex("c.code")).alias("code"),
        "c.error",
        "s.label_error",
        F.lit(told).alias("codebooks_sha256"),
    )

"""Near-duplicate vectors: random-hyperplane tables, exact cosines, connected components."""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from tidemark.llm.common import hint_if_counted, map_batches, same_type, stored
from tidemark.llm.graph import components

# Mean number of vectors in a bucket, and the chance that a pair at the threshold shares no bucket.
BUCKET = 32
MISS = 1e-5

# Members of a bucket that are compared at once; larger buckets are compared block by block in many tasks.
BLOCK = 512


def plan(n: int, cosine: float, bucket: int = BUCKET, miss: float = MISS) -> tuple[int, int]:
    """Bits per table, so that buckets keep their mean size as ``n`` grows, and the number of tables that this
    takes for the wanted recall at the threshold (pairs above it share a bucket more often)."""
    bits = min(62, max(4, math.ceil(math.log2(max(n, 2) / bucket))))
    meet = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(miss) / math.log1p(-meet)))


def _codes(frame: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    """``(id, class, codes, vec)``: a digest of the vector's own bytes and its bucket in each table; null where a
    vector can link with nothing."""
    schema = StructType(
        [same_type(frame, "id", "id"), StructField("class", BinaryType()), StructField("codes", ArrayType(LongType())), same_type(frame, "vec", "vec")]
    )

    def make():
        planes: dict[int, np.ndarray] = {}
        weight = np.int64(1) << np.arange(bits, dtype=np.int64)

        def code(v: np.ndarray) -> list[int]:
            d = len(v)
            if d not in planes:
                planes[d] = np.random.default_rng([seed, d]).standard_normal((d, bits * tables))
            return ((v / np.linalg.norm(v) @ planes[d]) >= 0).reshape(tables, bits) @ weight

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, codes = [], []
            for x in batch.column("vec").to_pylist():
                v = None if x is None or None in x else np.asarray(x, np.float64)
                good = v is not None and len(v) and np.isfinite(v).all() and np.isfinite(np.linalg.norm(v)) and v.any()
                names.append(blake2b((v + 0.0).tobytes(), digest_size=16).digest() if good else None)
                codes.append(code(v).tolist() if good else None)
            columns = [batch.column("id"), pa.array(names, pa.binary()), pa.array(codes, pa.list_(pa.int64())), batch.column("vec")]
            return pa.record_batch(columns, schema.names)

        return run

    return map_batches(frame, make, schema)


def _forest(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Those of the pairs that connect what earlier ones did not: fewer than there are vectors."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = top.get(up, up)
            x = up
        return x

    out = []
    for a, b in pairs.tolist():
        ra, rb = find(a), find(b)
        if ra != rb:
            top[max(ra, rb)] = min(ra, rb)
            out.append((a, b))
    return out


def _links(dealt: DataFrame, cosine: float) -> DataFrame:
    """Compare the vectors of each (bucket, pair of blocks) in full.

    A pair counts in the first table that brings it together, and there only, so counts need no distinct. What
    leaves a task is, for each vector, the number of rows it links with, and a spanning forest of the links:
    never the pairs themselves, of which a large group has the square of its size.
    """
    key = same_type(dealt, "rep", "rep")
    schema = StructType([key, StructField("links", LongType()), StructField("b", key.dataType)])
    names = ["key", "i", "j", "table", "rep", "weight", "own", "vec", "codes"]

    def run(batches):
        group, held = None, []

        def compare() -> pa.RecordBatch | None:
            _, i, j, table, *_ = held[0]
            by_size: dict[int, list] = {}
            for row in held:
                by_size.setdefault(len(row[7]), []).append(row)
            reps, links, ends = [], [], []
            for rows in by_size.values():
                if len(rows) < 2:
                    continue
                v = np.array([r[7] for r in rows], np.float64)
                norm, weight = np.sqrt((v * v).sum(axis=1)), np.array([r[5] for r in rows], np.int64)
                own, codes = np.array([r[6] for r in rows]), np.array([r[8] for r in rows], np.int64)
                left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
                near = (v[left] @ v[right].T) / norm[left][:, None] / norm[right][None, :] >= cosine
                a, b = np.nonzero(near)
                a, b = left[a], right[b]
                once = a < b if i == j else np.ones(len(a), bool)
                a, b = a[once], b[once]
                for lo in range(0, len(a), 65536):  # the first table in which the two meet is this one
                    x, y = a[lo : lo + 65536], b[lo : lo + 65536]
                    new = ~(codes[x, :table] == codes[y, :table]).any(axis=1)
                    x, y = x[new], y[new]
                    count = np.bincount(x, weight[y], len(rows)) + np.bincount(y, weight[x], len(rows))
                    for k in np.flatnonzero(count):
                        reps.append(rows[k][4]), links.append(int(count[k])), ends.append(None)
                    for m, n in _forest(np.stack([x, y], axis=1)):
                        reps.append(rows[m][4]), links.append(0), ends.append(rows[n][4])
            if not reps:
                return None
            return pa.record_batch([pa.array(reps, kind), pa.array(links, pa.int64()), pa.array(ends, kind)], schema.names)

        for batch in batches:
            kind = batch.schema.field("rep").type
            for row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if group != row[:3]:
                    if held and (out := compare()) is not None:
                        yield out
                    group, held = row[:3], []
                held.append(row)
        if held and (out := compare()) is not None:
            yield out

    return dealt.select(names).mapInArrow(run, schema)


def near_vectors(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.95, seed: int = 1
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector: how many others it links with directly
    (cosine, in double precision, of ``cosine`` or more), and the smallest id that links reach.

    Equal vectors are one class and meet only as such. Every class falls into one bucket of each table, by the
    signs of its products with random planes; in a bucket all classes are compared exactly. The number of planes
    and tables follows from the number of rows (see ``plan``). Large buckets are compared in pairs of blocks.

    A vector that is null, empty, zero or holds a null or a number that is not finite links with nothing; so does
    a row without id, which is kept and has no component. Vectors of different lengths never link. Rows that repeat
    an id and a vector count as one vector. No rows give no rows.
    """
    frame = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vec"))
    bits, tables = plan(frame.count(), cosine)
    coded = stored(_codes(frame, bits, tables, seed), "codes")
    named = coded.where("class is not null and id is not null")
    # A class goes by its digest until the end: an id may come with several vectors, and be the smallest of several classes.
    classes = named.groupBy("class").agg(F.min("id").alias("smallest"), F.countDistinct("id").alias("weight"))
    classes = stored(classes, "classes")
    whole = named.select("class", "codes", "vec").dropDuplicates(["class"]).join(classes.select("class", "weight").hint("merge"), "class")
    whole = stored(whole.select(F.col("class").alias("rep"), "weight", "codes", "vec"), "vectors")

    at = whole.select("rep", F.posexplode("codes").alias("table", "code"))
    at = at.select("rep", "table", F.xxhash64("table", "code").alias("key"))
    buckets = at.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("own")
    spread = at.join(buckets, "key").select("key", "table", "rep", own, blocks.alias("blocks"))
    spread = spread.select("key", "table", "rep", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    spread = spread.select("key", "table", "rep", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    dealt = spread.join(whole.hint("merge"), "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    links = stored(_links(dealt, cosine), "links")

    direct = links.where("links > 0").groupBy("rep").agg(F.sum("links").alias("direct")).withColumnRenamed("rep", "class")
    group = stored(components(links.where("b is not null"), "rep", "b"), "components").withColumnRenamed("node", "class")
    least = group.join(classes.hint("merge"), "class").groupBy("component").agg(F.min("smallest").alias("least"))
    least = stored(least, "least")
    group = group.join(hint_if_counted(least, least.count()), "component").select("class", "least")
    told = classes.join(stored(direct, "direct").hint("merge"), "class", "left").join(group.hint("merge"), "class", "left")
    mine = coded.select("id", F.when(F.col("id").isNotNull(), F.col("class")).alias("class")).join(told.hint("merge"), "class", "left")
    component = F.coalesce("least", "smallest", "id")
    return mine.select(
        F.col("id").alias("vec_id"),
        (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("direct", F.lit(0))).alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )

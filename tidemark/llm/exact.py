"""Exact duplicates: sort whole normalised texts and compare neighbours."""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, BooleanType, LongType, StringType, StructField, StructType

from tidemark.llm.common import map_batches, same_type, stored, texts

# Bytes of a text that the splitters of the range partitioning see; after them comes a hash of the whole
# text and the id, so that neither a common beginning nor a group of copies stays in one task, and the sample
# for the splitters holds short rows however long the texts are.
SPLIT_BYTES = 64


def normalised(docs: DataFrame) -> DataFrame:
    """``(doc_id, norm)``: the UTF-8 bytes with A-Z in lower case, all others as they are."""
    frame = texts(docs)

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            norm = [t.as_py().encode().lower() for t in batch.column("text")]
            return pa.record_batch([batch.column("doc_id"), pa.array(norm, pa.binary())], ["doc_id", "norm"])

        return run

    return map_batches(frame, make, StructType([same_type(frame, "doc_id", "doc_id"), StructField("norm", BinaryType())]))


def _runs(ordered: DataFrame) -> DataFrame:
    """Cut each sorted partition into runs of equal texts by comparing neighbours in full.

    A row tells its run, its place in it, the run's size and last id, and the text's digest. The first row of a
    partition's first and last run also holds the text, for the comparison with the next partition. A task
    holds the ids of one run at a time, at most those of its own partition.
    """
    key = same_type(ordered, "doc_id", "doc_id")
    names = ("part", "run", "place", "size")
    schema = StructType(
        [key, StructField("last", key.dataType)]
        + [StructField(n, LongType()) for n in names]
        + [StructField("sha", StringType()), StructField("edge", BinaryType())]
        + [StructField("opens", BooleanType()), StructField("closes", BooleanType())]
    )

    def run(batches):
        part, number, ids, text, kind = TaskContext.get().partitionId(), 0, [], None, None

        def flush(closes: bool) -> pa.RecordBatch:
            n, opens = len(ids), number == 0
            known = [i for i in ids if i is not None]
            edge = [text if opens or closes else None] + [None] * (n - 1)
            columns = [
                pa.array(ids, kind),
                pa.array([known[-1] if known else None] * n, kind),
                *(pa.array(x, pa.int64()) for x in ([part] * n, [number] * n, range(n), [n] * n)),
                pa.array([sha256(text).hexdigest()] * n, pa.string()),
                pa.array(edge, pa.binary()),
                pa.array([opens] * n),
                pa.array([closes] * n),
            ]
            return pa.record_batch(columns, schema.names)

        done = []
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("norm").to_pylist(), strict=True):
                if ids and t != text:
                    done.append(flush(False))
                    number, ids = number + 1, []
                if not ids:
                    text = t
                ids.append(i)
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
                done = []
        if ids:
            yield flush(True)

    return ordered.mapInArrow(run, schema)


def exact_groups(docs: DataFrame) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``, one row per document. Texts are equal when identical
    after lower-casing A-Z; of equal texts the row with the largest doc_id stays.

    Sampled splitters deal the texts to range partitions; each is sorted (spilling to disk as needed) by bytes, then
    id, and neighbours are compared in full. A group of copies may cover many partitions: the runs at the ends of
    adjacent partitions are compared too, and their sizes and last ids put together. That step has two rows for each
    partition, whatever the data, so its result is broadcast. Whole texts are shuffled once and never again.

    A null text counts as empty. Null ids sort before all others. If the last id of a group has several rows, one of
    them is kept; if it has none but null ids, keep_id is null and one row is kept. No rows give no rows.
    """
    begin = F.substring("norm", 1, SPLIT_BYTES)
    cut = normalised(docs).withColumns({"begin": begin, "hash": F.xxhash64("norm")})
    dealt = cut.repartitionByRange("begin", "hash", "doc_id").sortWithinPartitions("begin", "hash", "norm", "doc_id")
    runs = stored(_runs(dealt.select("doc_id", "norm")), "runs")

    # Two rows per partition at most, and one for one with a single run.
    ends = stored(runs.where("edge is not null"), "ends")
    order = Window.orderBy("part")
    parts = ends.groupBy("part").agg(F.max("run").alias("final"))
    parts = parts.select("part", "final", F.row_number().over(order).alias("nth"))  # a row per partition
    last = ends.where("closes").join(parts, "part").select((F.col("nth") + 1).alias("nth"), F.col("edge").alias("before"))
    first = ends.where("opens").join(parts, "part").join(last, "nth", "left")
    first = first.select("part", "nth", "final", (F.col("edge") == F.col("before")).alias("joined"))
    # A run that goes on from the previous partition takes that partition's last run for its start.
    here = F.struct(F.col("part").alias("p"), F.lit(0).cast("long").alias("r"))
    previous = F.struct(F.lag("part").over(order).alias("p"), F.lag("final").over(order).alias("r"))
    chain = first.withColumn(
        "start",
        F.when(~F.coalesce("joined", F.lit(False)), here).when(F.lag("final").over(order) > 0, previous),
    )
    chain = chain.withColumn("start", F.last("start", ignorenulls=True).over(order))
    own = F.when(F.col("run") == 0, F.col("start")).otherwise(F.struct(F.col("part").alias("p"), F.col("run").alias("r")))
    ends = ends.join(chain.select("part", "start"), "part").select("part", "run", "last", "size", own.alias("start"))
    total = ends.groupBy("start").agg(
        F.max("last").alias("keep"), F.sum("size").alias("whole"), F.max("part").alias("final_part")
    )
    total = F.broadcast(ends.select("part", "run", "start").join(total, "start").drop("start"))

    stays = (F.col("place") == F.col("size") - 1) & (F.col("part") == F.coalesce("final_part", "part"))
    return runs.join(total, ["part", "run"], "left").select(
        "doc_id",
        F.coalesce("keep", "last").alias("keep_id"),
        F.coalesce("whole", "size").alias("group_size"),
        stays.alias("kept"),
        F.col("sha").alias("text_sha256"),
    )

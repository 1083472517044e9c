"""From raw documents to token ids: classify, deduplicate, mix, encode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, exact, minhash, mixing, quality
from tidemark.llm.common import hint_if_counted, prepare, stored
from tidemark.llm.queries import BYTE_BPE

# Words of a shingle for near duplicates.
SHINGLE = 5


def _without(docs: DataFrame, told: DataFrame) -> DataFrame:
    """The rows whose doc_id a deduplication keeps. Only ids of dropped documents are joined, and broadcast if they
    are few, so that texts then stay where they are. Rows without id are kept."""
    gone = told.groupBy("doc_id").agg(F.max(F.col("kept").cast("int")).alias("kept")).where("kept = 0")
    gone = stored(gone.select("doc_id"), "dropped")
    return docs.join(hint_if_counted(gone, gone.count()), "doc_id", "left_anti").select(*docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the co-trained classifier rejects."""
    prepare(spark)
    return quality.good(docs, quality.fit(docs, quality.read_labels(spark, sf_dir)))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keep the document with the largest id. A row that repeats both id and text goes too."""
    prepare(spark)
    told = stored(exact.exact_groups(docs), "copies")
    left = _without(docs, told)
    # An id that keeps one row and loses another has the same text twice, or two texts.
    twice = told.groupBy("doc_id").agg(F.count("*").alias("rows"), F.max(F.col("kept").cast("int")).alias("kept"))
    twice = stored(twice.where("rows > 1 and kept = 1 and doc_id is not null").select("doc_id"), "repeated")
    n = twice.count()
    if not n:
        return left
    own = hint_if_counted(twice, n)
    once = left.join(own, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return left.join(own, "doc_id", "left_anti").select(*docs.columns).unionByName(once)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group of near duplicates."""
    prepare(spark)
    return _without(docs, minhash.near_duplicates(docs, size=SHINGLE))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or drop documents so that sources have their target shares of the words."""
    prepare(spark)
    sizes = stored(mixing.document_sizes(docs), "sizes")
    copied = mixing.with_copies(docs, stored(mixing.mixing_plan(sizes), "plan"), "_copies_taken")
    copied = copied.where("_copies_taken > 0")
    return copied.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies_taken")))).select(*docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded_sha256)`` of each copy: the ids, and the digest of what they decode to."""
    prepare(spark)
    ids = bpe.encode(docs, BYTE_BPE).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("ids").alias("again"))
    told = bpe.decode(ids, BYTE_BPE, ids="again")
    return told.select("doc_id", "n_tokens", "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("classify_quality", classify_quality),
    ("drop_copies", drop_copies),
    ("drop_near_copies", drop_near_copies),
    ("mix_sources", mix_sources),
    ("encode_texts", encode_texts),
]

# A trained classifier, MinHash and a tokenizer are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each reading what the one before it wrote."""
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

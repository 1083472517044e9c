"""Vector top-k and what follows it: context, prompt, grading, fallback."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tidemark.functions.vectors import EPSILON
from tidemark.operators.ordered import top_n_per_key
from tidemark.session import broadcast_if_small, materialize

QUERY_LIMIT = 4096  # Most queries whose vectors are shipped whole to every task.
QUERY_BATCH = 256  # Queries that a task compares with a batch of vectors at a time.
HITS_LIMIT = 100_000  # Most hits, of a few numbers each, that later joins may broadcast.
DECIMALS = 12  # Digits kept of a similarity.
BLOCK_ROWS = 32_768  # Vectors or queries of a cell that one task compares, once queries are too many to ship.
CELLS = 1024  # Most cells of an index: their centroids are sent to every task.
FIRST_PROBES = 4  # Cells that a query looks at in the first round; each round looks at four times as many.


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a matrix, without a Python object per row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _scores(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Cosine of every query (rows) with every vector (columns).

    Matrix kernels may differ in the last bits by a row's place in its batch; rounding makes
    copies of a vector score the same wherever they lie, so that ties go to the lower id.
    """
    norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
    return np.round((queries @ vectors.T) / (norms + EPSILON), DECIMALS)


def _best(scores: np.ndarray, ids: list[np.ndarray], k: int) -> np.ndarray:
    """Positions of the ``k`` best scores, equal scores by ascending id columns."""
    if len(scores) > k:
        floor = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((*(i[near] for i in reversed(ids)), -scores[near]))][:k]


def _partial_top_k(query_ids: list, queries: np.ndarray, k: int, vec_ids: list[str], vector: str, schema: pa.Schema):
    """Per task: stream over its vectors and keep the ``k`` best per query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best_ids: list[list[np.ndarray]] = [[]] * len(query_ids)
        best = [np.empty(0)] * len(query_ids)
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = [batch.column(i).to_numpy(zero_copy_only=False) for i in vec_ids]
            vectors = _matrix(batch.column(vector))
            for at in range(0, len(query_ids), QUERY_BATCH):
                scores = _scores(vectors, queries[at : at + QUERY_BATCH])
                for q, row in enumerate(scores, start=at):
                    top = _best(row, ids, k)
                    merged = np.concatenate([best[q], row[top]])
                    found = [i[top] for i in ids]
                    merged_ids = [np.concatenate(x) for x in zip(best_ids[q], found)] if best_ids[q] else found
                    keep = _best(merged, merged_ids, k)
                    best[q], best_ids[q] = merged[keep], [i[keep] for i in merged_ids]
        repeated = [qid for qid, found in zip(query_ids, best) for _ in found]
        if repeated:
            arrays = [repeated, *(np.concatenate(x) for x in zip(*best_ids)), np.concatenate(best)]
            yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, schema.types)], schema=schema)

    return run


def vector_topk(
    vectors: DataFrame, query: Sequence[float], k: int = 3, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """The ``k`` vectors most similar to one query, ties by id. Each task sends on ``k`` rows."""
    queries = np.asarray(query, dtype=np.float64)[None, :]
    out = pa.schema([("query_id", pa.int64()), (vec_id, pa.int64()), ("similarity", pa.float64())])
    job = _partial_top_k([0], queries, k, [vec_id], vector, out)
    ddl = f"query_id bigint, `{vec_id}` bigint, similarity double"
    stored = vectors.select(F.col(vec_id).cast("long").alias(vec_id), vector).filter(F.col(vector).isNotNull())
    partial = stored.mapInArrow(job, ddl)
    return partial.drop("query_id").orderBy(F.col("similarity").desc(), F.col(vec_id)).limit(k)


def vector_topk_batch(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 3,
    vec_id: str | Sequence[str] = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    query_limit: int = QUERY_LIMIT,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Exact top-k per query: ``query_id, vec_id, similarity, rank``.

    Up to ``query_limit`` queries travel to the tasks and the vectors are not shuffled. More than
    that search an inverted file (``CellIndex``): each query looks at its nearest cells first, and at further
    ones only while these could hold a better hit. Either way only ``k`` rows per query and task or
    block reach the final ranking.

    ``vec_id`` is a whole number, or several columns of any type that make up the id together; a vector without all of
    them is passed over.
    """
    if isinstance(vec_id, str):
        vec_ids = [vec_id]
        v = vectors.select(F.col(vec_id).cast("long").alias(vec_id), vector)
    else:
        vec_ids = list(vec_id)
        v = vectors.select(*vec_ids, vector).dropna(subset=vec_ids)
    v = v.filter(F.col(vector).isNotNull())
    q = queries.select(F.col(query_id).cast("long").alias(query_id), query_vector)
    q = q.filter(F.col(query_vector).isNotNull())
    kinds = [v.schema[i].dataType for i in vec_ids]
    ddl = ", ".join([f"`{query_id}` bigint", *(f"`{i}` {x.simpleString()}" for i, x in zip(vec_ids, kinds)), "similarity double"])
    parts = [(i, to_arrow_type(x)) for i, x in zip(vec_ids, kinds)]
    out = pa.schema([(query_id, pa.int64()), *parts, ("similarity", pa.float64())])
    few = q.limit(query_limit + 1).collect()
    bounded = len(few) <= query_limit
    if bounded:
        if not few:
            partial = v.sparkSession.createDataFrame([], ddl)
        else:
            matrix = np.asarray([r[1] for r in few], dtype=np.float64)
            partial = v.mapInArrow(_partial_top_k([r[0] for r in few], matrix, k, vec_ids, vector, out), ddl)
    else:
        partial = CellIndex.build(v, vec_ids, vector, block_rows).search(q, k, query_id, query_vector, out, ddl)
    rank = F.row_number().over(Window.partitionBy(query_id).orderBy(F.col("similarity").desc(), *vec_ids))
    hits = partial.withColumn("rank", rank).filter(F.col("rank") <= k)
    # Few queries have at most k times as many hits: fetching their texts need not shuffle the index.
    return F.broadcast(hits) if bounded and len(few) * k <= HITS_LIMIT else hits


def _unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of length 1, and which of them are too short for their direction to tell their similarities."""
    norms = np.linalg.norm(vectors, axis=1)
    short = norms < 1e-3
    return vectors / np.where(short, 1, norms)[:, None], short


@dataclass
class CellIndex:
    """An inverted file: every vector is in the cell of the centroid nearest to it in angle.

    Centroids are a sample of the vectors, drawn by a hash of the id, so they depend on the data alone. By the triangle
    inequality no vector of a cell is nearer to a query than the angle to the centroid less the cell's radius. A
    search looks at the cells in the order of that bound, and is over when the next one's is beaten by the
    query's k-th hit: so its result is exact, with every copy and tie, and how many cells it takes depends on how
    well the data cluster. Vectors without a direction (nearly zero) are in a cell of their own that all look at.
    """

    lists: DataFrame  # vec_ids, vector, cell, block
    vec_ids: list[str]
    vector: str
    centroids: np.ndarray
    radius: np.ndarray
    blocks: dict[int, int]
    block_rows: int

    @classmethod
    def build(cls, vectors: DataFrame, vec_ids: list[str], vector: str, block_rows: int = BLOCK_ROWS, cells: int = CELLS) -> CellIndex:
        """Two passes over the vectors: one draws the centroids, one files every row. Lists are written out."""
        order = F.xxhash64(*vec_ids)
        drawn = vectors.select(vector, order.alias("_h"), *vec_ids).orderBy("_h", *vec_ids).limit(cells).collect()  # at most `cells`
        wide = Counter(len(r[0]) for r in drawn).most_common(1)
        centroids, short = _unit(np.asarray([r[0] for r in drawn if len(r[0]) == wide[0][0]], dtype=np.float64).reshape(-1, wide[0][0] if wide else 1))
        centroids = np.unique(centroids[~short], axis=0) if len(centroids) else centroids
        fields = [vectors.schema[c] for c in (*vec_ids, vector)]
        schema = StructType([*fields, StructField("cell", IntegerType()), StructField("angle", DoubleType())])

        def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                unit, none = _unit(_matrix(batch.column(vector)))
                cell, angle = np.full(len(unit), -1), np.zeros(len(unit))
                for at in range(0, len(unit) if len(centroids) else 0, 4096):
                    part = slice(at, at + 4096)
                    cosines = unit[part] @ centroids.T
                    cell[part] = cosines.argmax(axis=1)
                    angle[part] = np.arccos(np.clip(cosines.max(axis=1), -1, 1))
                cell[none], angle[none] = -1, 0
                columns = [batch.column(c) for c in (*vec_ids, vector)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(cell, pa.int32()), pa.array(angle)], names=[f.name for f in schema])

        filed = materialize(vectors.select(*vec_ids, vector).mapInArrow(file, schema), "filed")
        sizes = filed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("r")).collect()  # a row per cell
        blocks = {r.cell: -(-r.n // block_rows) for r in sizes}
        radius = np.zeros(len(centroids))
        for r in sizes:
            if r.cell >= 0:
                radius[r.cell] = r.r
        return cls(filed, vec_ids, vector, centroids, radius, blocks, block_rows)

    def _probes(self, first: int, count: int, query_id: str, query_vector: str):
        """Per query, the cells at places ``first`` to ``first + count`` of its order that could still better its k-th hit."""
        filled = np.array(sorted(c for c in self.blocks if c >= 0), np.int64)
        centroids, radius, aside = self.centroids[filled], self.radius[filled], -1 in self.blocks

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                unit, none = _unit(_matrix(batch.column(query_vector)))
                floor = batch.column("kth").to_numpy(zero_copy_only=False)
                rows, cells = [], []
                if len(filled):
                    angle = np.arccos(np.clip(unit @ centroids.T, -1, 1)) - radius
                    # Similarities are damped towards 0 where norms are small, so no bound is below 0.
                    bound = np.maximum(np.cos(np.maximum(angle, 0)), 0) + 1e-6
                    bound[none] = 2
                    order = np.argsort(-bound, axis=1, kind="stable")[:, first : first + count]
                    open_ = ~(np.take_along_axis(bound, order, axis=1) < floor[:, None])
                    at, place = np.nonzero(open_)
                    rows.append(at)
                    cells.append(filled[order[at, place]])
                if aside and not first:
                    rows.append(np.arange(batch.num_rows))
                    cells.append(np.full(batch.num_rows, -1))
                take = np.concatenate(rows) if rows else np.zeros(0, np.int64)
                columns = [batch.column(c).take(pa.array(take)) for c in (query_id, query_vector)]
                cell = pa.array(np.concatenate(cells) if cells else take, pa.int32())
                yield pa.RecordBatch.from_arrays([*columns, cell], names=[query_id, query_vector, "cell"])

        return run

    def search(self, queries: DataFrame, k: int, query_id: str, query_vector: str, out: pa.Schema, ddl: str) -> DataFrame:
        """Candidates that hold each query's k best, of which the caller ranks the first k.

        Each round files the queries under the cells that they look at; a (cell, block of vectors, block of queries)
        is one task-sized matrix product, and leaves k rows per query. A round's rows are written out.
        """
        spark = queries.sparkSession
        state = queries.withColumn("kth", F.lit(None).cast("double"))
        schema = StructType([*(queries.schema[c] for c in (query_id, query_vector)), StructField("cell", IntegerType())])
        best, first, count, cells = None, 0, FIRST_PROBES, max(1, len([c for c in self.blocks if c >= 0]))
        while first < cells:
            probes = state.mapInArrow(self._probes(first, count, query_id, query_vector), schema)
            probes = materialize(probes, "probes")
            asked = {r.cell: r.n for r in probes.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per cell
            if asked:
                hits = self._matched(probes, asked, k, query_id, query_vector, out, ddl)
                together = hits if best is None else best.unionByName(hits)
                ids = [F.col("similarity").desc(), *self.vec_ids]
                best = materialize(top_n_per_key(together, [query_id], ids, k), "best")
            first, count = first + count, count * 4
            if first < cells:
                # The k-th hit so far, a lower bound of the final one; none while there are fewer hits.
                nth = best.groupBy(query_id).agg(F.count(F.lit(1)).alias("_n"), F.min("similarity").alias("_s")) if best is not None else None
                if nth is not None:
                    kth = nth.select(F.col(query_id).alias("_q"), F.when(F.col("_n") >= k, F.col("_s")).alias("kth"))
                    state = queries.join(kth, F.col(query_id) == F.col("_q"), "left").select(*queries.columns, "kth")
        return best if best is not None else spark.createDataFrame([], ddl)

    def _matched(self, probes, asked: dict[int, int], k: int, query_id: str, query_vector: str, out: pa.Schema, ddl: str) -> DataFrame:
        """The k best of each (cell, block) for each query that looks at the cell."""
        spark = probes.sparkSession
        told = [(c, n, -(-asked[c] // self.block_rows)) for c, n in self.blocks.items() if c in asked]
        counts = lambda: F.broadcast(spark.createDataFrame(told, "cell int, _vn int, _qn int"))  # noqa: E731 - a row per cell
        dealt = lambda c, n: F.pmod(F.xxhash64(*c), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = self.lists.drop("angle").join(counts(), "cell").withColumn("_vb", dealt(self.vec_ids, "_vn")).withColumn("_qb", every("_qn"))
        right = probes.join(counts(), "cell").withColumn("_qb", dealt([query_id], "_qn")).withColumn("_vb", every("_vn"))
        vec_ids, vector = self.vec_ids, self.vector

        def match(vs: pa.Table, qs: pa.Table) -> pa.Table:
            if not vs.num_rows or not qs.num_rows:
                return out.empty_table()
            ids = [vs.column(i).to_numpy() for i in vec_ids]
            base, wanted, qids = _matrix(vs.column(vector)), _matrix(qs.column(query_vector)), qs.column(query_id).to_numpy()
            found_q, found_v, found_s = [], [[] for _ in ids], []
            for at in range(0, len(qids), QUERY_BATCH):
                scores = _scores(base, wanted[at : at + QUERY_BATCH])
                for row, qid in zip(scores, qids[at : at + QUERY_BATCH]):
                    top = _best(row, ids, k)
                    found_q.append(np.full(len(top), qid))
                    for found, i in zip(found_v, ids):
                        found.append(i[top])
                    found_s.append(row[top])
            arrays = [np.concatenate(a) for a in (found_q, *found_v, found_s)]
            return pa.table([pa.array(a, t) for a, t in zip(arrays, out.types)], schema=out)

        by = ["cell", "_vb", "_qb"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(match, ddl)


def assemble_context(hits: DataFrame, query_id: str, text: str, rank: str = "rank", sep: str = "\n\n") -> DataFrame:
    """Texts of each query's hits in rank order as one context (hits are at most k per query)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(rank), F.col(text))))
    return hits.groupBy(query_id).agg(F.array_join(F.transform(ordered, lambda h: h[text]), sep).alias("context"))


def render_prompt(template: str, values: Mapping[str, Column | str]) -> Column:
    """Fill ``{name}`` places of a template; inserted text is not searched again."""
    out, rest = [], template
    while True:
        found = [(rest.find("{" + n + "}"), n) for n in values if "{" + n + "}" in rest]
        if not found:
            break
        at, name = min(found)
        value = values[name]
        out += [F.lit(rest[:at]), F.col(value) if isinstance(value, str) else value]
        rest = rest[at + len(name) + 2 :]
    return F.concat(*out, F.lit(rest))


def overlap_score(question: Column, context: Column) -> Column:
    """Share of the question's distinct tokens found in the context (stands in for a model)."""
    tokens = lambda c: F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda t: t != ""))
    asked = tokens(question)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(asked, tokens(context))), F.size(asked)), F.lit(0.0))


def grade_and_route(df: DataFrame, question: str, context: str, threshold: float, category: Column) -> DataFrame:
    """Grade each answer's context yes/no; "no" goes to the fallback of the question's category."""
    graded = df.withColumn("grade", F.when(overlap_score(F.col(question), F.col(context)) >= threshold, "yes").otherwise("no"))
    return graded.withColumn("route", F.when(F.col("grade") == "yes", "end").otherwise("fallback")).withColumn(
        "category", F.when(F.col("route") == "fallback", category)
    )


def fallback_lookup(df: DataFrame, docs: DataFrame, category: str = "category", name: str = "fallback_text") -> DataFrame:
    """Reference text for a category, or a message that there is none."""
    key = F.lower(F.trim(category))
    side = broadcast_if_small(docs.select(F.col("category").alias("_category"), F.col("text").alias("_text")))
    message = F.concat(F.lit("No documentation found for category: "), F.coalesce(key, F.lit("")))
    return df.join(side, key == F.col("_category"), "left").select(*df.columns, F.coalesce("_text", message).alias(name))


def coalesce_answer(final: Column | str, initial: Column | str, default: str = "No answer could be determined.") -> Column:
    """First answer that is neither NULL nor empty."""
    as_answer = lambda c: F.nullif(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return F.coalesce(as_answer(final), as_answer(initial), F.lit(default))


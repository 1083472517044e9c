"""Documents to graded answers: chunk, embed, search, assemble, grade, fall back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import surrogate_key
from tidemark.functions.vectors import Embedder
from tidemark.operators.documents import chunk_fixed, embed
from tidemark.operators.retrieval import (
    assemble_context,
    coalesce_answer,
    fallback_lookup,
    grade_and_route,
    render_prompt,
    vector_topk_batch,
)

PROMPT = "Context:\n{context}\n\nQuestion: {question}"


def index_documents(
    docs: DataFrame, doc_id: str, text: str, size: int = 512, overlap: int = 50, embedder: Embedder | None = None
) -> DataFrame:
    """Chunks of documents, known by the document's id (of any type) and ``chunk_index``: a text key and the vector."""
    chunks = chunk_fixed(docs, doc_id, text, size, overlap)
    keyed = chunks.withColumn("chunk_key", surrogate_key(doc_id, "chunk_index"))
    return embed(keyed, "chunk_text", embedder)


def answer_questions(
    index: DataFrame,
    questions: DataFrame,
    fallback: DataFrame,
    category: Column,
    k: int = 3,
    threshold: float = 0.5,
    embedder: Embedder | None = None,
    doc_id: str = "doc_id",
) -> DataFrame:
    """One row per ``(query_id, question)``: prompt, grade, route and final text.

    ``index`` is read twice, for the vectors and for the texts of the hits: pass a stored table.

    The model call is left out: the best context stands for the initial answer, and the fallback
    text for the second attempt.
    """
    asked = embed(questions, "question", embedder, "query_vector")
    chunk = [doc_id, "chunk_index"]
    hits = vector_topk_batch(index, asked, k, chunk)
    texts = hits.join(index.select(*chunk, "chunk_text"), chunk)
    contexts = assemble_context(texts, "query_id", "chunk_text")
    rows = questions.join(contexts, "query_id")
    graded = grade_and_route(rows, "question", "context", threshold, category)
    answered = fallback_lookup(graded, fallback)
    final = F.when(F.col("route") == "fallback", F.col("fallback_text"))
    return answered.select(
        "query_id",
        render_prompt(PROMPT, {"context": "context", "question": "question"}).alias("prompt"),
        "grade",
        "route",
        coalesce_answer(final, "context").alias("answer"),
    )

"""Document jobs: page text, chunking, sentences, embedding.

Every operator works within one row at a time, so no step shuffles, and in time linear in the text.
Built-in expressions do it where they can; the splitters that need a running position, and the
embedder, run in Python on Arrow batches. Texts are always processed whole.
"""

from __future__ import annotations

import html as html_lib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import WHITESPACE, extract_fields, fold_elements, strip_text
from tidemark.functions.vectors import EPSILON, Embedder, hashed_embedder
from tidemark.session import small_batches, spread

# What a page shows no text of, as one pattern that goes through the page once from left to right: scripts, styles,
# comments, the document type, and tags. What is not closed reaches to the end of the page, so every match is found
# at the place where it begins, and no place is tried twice.
HIDDEN = (
    r"(?is)<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<!--.*?(?:-->|\z)|<!doctype[^>]*(?:>|\z)"
    r"|</?[a-z][^>]*(?:>|\z)"
)
TITLE = r"(?is)<title\b[^>]*(?:>|\z)(.*?)(?:</title\s*>|\z)"
ROOT_TAG = r"(?is)<html\b[^>]*"
LANGUAGE = r"(?i)\blang=[\"']?([a-zA-Z-]+)"

# Fixed value: a sentence ends at whitespace after one of these marks.
SENTENCE_BREAK = f"(?<=[.!?]){WHITESPACE}++"


def _unescape():
    @F.pandas_udf("string")
    def decode(texts: pd.Series) -> pd.Series:
        return texts.map(html_lib.unescape, na_action="ignore")

    return decode


def unescape(text: str) -> Column:
    """Decode the character references of a text column, all by the standard library's rules. Texts without an
    ampersand have none: they arrive in Python as NULL."""
    return F.coalesce(_unescape()(F.when(F.contains(text, F.lit("&")), F.col(text))), F.col(text))


def html_to_text(pages: DataFrame, url: str = "url", html: str = "html", separator: str = "") -> DataFrame:
    """Visible text of a page with its source, title and language, in time linear in the page.

    Text nodes are joined by ``separator``; the default joins them directly. Tags end at the first ``>``; a script,
    style, comment, tag or title that is not closed ends with the page.
    """
    parts = spread(pages).withColumns(
        {
            "source": F.col(url),
            "title": F.regexp_extract(html, TITLE, 1),
            "language": F.regexp_extract(F.regexp_extract(html, ROOT_TAG, 0), LANGUAGE, 1),
            "page_text": F.regexp_replace(html, HIDDEN, separator),
        }
    )
    return parts.drop(html, url).withColumns({"title": unescape("title"), "page_text": unescape("page_text")})


def _check_window(size: int, overlap: int) -> int:
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    return size - overlap


def _join_head(length: int):
    return lambda chunk, after: F.concat(chunk, F.coalesce(F.left(after, F.lit(length)), F.lit("")))


def chunk_fixed(df: DataFrame, doc_id: str, text: str, size: int = 512, overlap: int = 50) -> DataFrame:
    """Slices of ``size`` characters, each starting ``size - overlap`` after the one before.

    A short last slice is kept even when it lies inside the overlap. The text is cut once into
    steps and each step is extended by the head of what follows, so the cost is linear in the
    text (taking substrings by offset would walk it from the start for every slice).
    """
    step = _check_window(size, overlap)
    pieces = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{step}}}"), F.lit(0))
    cut = spread(df.select(doc_id, text)).select(doc_id, pieces.alias("_pieces"))
    chunks = F.col("_pieces")
    missing, ahead = overlap, 1
    while missing > 0:
        take = min(missing, step)
        chunks = F.zip_with(chunks, F.slice("_pieces", ahead + 1, F.size("_pieces") + 1), _join_head(take))
        missing, ahead = missing - take, ahead + 1
    return cut.select(doc_id, F.posexplode(chunks).alias("chunk_index", "chunk_text"))


# The recursive splitter's separators, coarsest first; "" means every character.
SEPARATORS = ("\n\n", "\n", " ", "")

# A length function, made for one text: the lengths of spans of it.
Spans = list[tuple[int, int]]
Measure = Callable[[str], Callable[[Spans], list[int]]]

_WORD = re.compile(r"\S+")


def by_characters(text: str) -> Callable[[Spans], list[int]]:
    return lambda spans: [b - a for a, b in spans]


def by_words(text: str) -> Callable[[Spans], list[int]]:
    """Whitespace tokens (a stand-in for a model's tokenizer): words are found once, and a span's number is the
    difference of two prefix counts."""
    found = np.fromiter(chain.from_iterable(m.span() for m in _WORD.finditer(text)), np.int64)
    starts, ends = found[::2], found[1::2]

    def lengths(spans: Spans) -> list[int]:
        if not spans or not len(found):
            return [0] * len(spans)
        cut = np.array(spans, np.int64)
        first = np.searchsorted(ends, cut[:, 0], "right")  # the first word that ends behind the span's begin
        return np.maximum(np.searchsorted(starts, cut[:, 1], "left") - first, 0).tolist()

    return lengths


def by_tokenizer(count: Callable[[list[str]], list[int]]) -> Measure:
    """Lengths by a tokenizer, given as a function from texts to numbers of tokens; each span is counted once per
    separator at most."""
    return lambda text: lambda spans: list(count([text[a:b] for a, b in spans]))


def _runs(text: str, start: int, end: int, size: int, level: int, lengths) -> Iterator[tuple[Spans, list[int]]]:
    """Spans of ``text[start:end]`` cut before the coarsest separator that occurs, with their lengths.

    Yields runs of small spans to be packed with each other; a span that is still too long is
    cut at the next separator, and its runs are packed apart from its neighbours.
    """
    while SEPARATORS[level] and text.find(SEPARATORS[level], start, end) < 0:
        level += 1
    sep = SEPARATORS[level]
    if not sep:
        spans = [(i, i + 1) for i in range(start, end)]
        yield spans, lengths(spans)
        return
    cuts, at = [start], text.find(sep, start, end)
    while at >= 0:
        cuts.append(at)
        at = text.find(sep, at + len(sep), end)
    cuts.append(end)
    spans = [(a, b) for a, b in zip(cuts, cuts[1:]) if a < b]
    run, sizes = [], []
    for span, n in zip(spans, lengths(spans)):
        if n < size:
            run.append(span)
            sizes.append(n)
            continue
        if run:
            yield run, sizes
            run, sizes = [], []
        yield from _runs(text, *span, size, level + 1, lengths)
    if run:
        yield run, sizes


def recursive_spans(text: str, size: int, overlap: int, measure: Measure = by_characters) -> Iterator[tuple[int, int]]:
    """Begin and end of chunks: adjacent pieces packed up to ``size``, each chunk beginning with up to
    ``overlap`` of the one before. Prefix sums of the lengths tell where a chunk ends and where the next begins, so
    each level is linear in its pieces."""
    for run, sizes in _runs(text, 0, len(text), size, 0, measure(text)):
        upto = [0, *accumulate(sizes)]
        first, n = 0, len(run)
        while True:
            last = max(bisect_right(upto, upto[first] + size, first) - 1, first + 1)
            yield run[first][0], run[last - 1][1]
            if last == n:
                break
            first = max(bisect_left(upto, max(upto[last] - overlap, upto[last + 1] - size), first, last + 1), first)
            first = min(first, last)


# Characters of chunks that leave a worker at once.
CHUNKED = 1 << 20


def _chunk_batches(
    batches: Iterator[pa.RecordBatch], size: int, overlap: int, measure: Measure, names: Sequence[str]
) -> Iterator[pa.RecordBatch]:
    """Batches of ids and texts to batches of chunks, each of about ``CHUNKED`` characters and a text's rest at most; with
    five names the chunks' lengths are told. Texts are taken one at a time, so that memory goes by the largest one."""
    for batch in batches:
        ids, texts = batch.columns
        rows, found, held = [], [], 0
        for row, body in enumerate(texts):
            body = body.as_py()
            if body:
                counted = measure(body)
                cuts = recursive_spans(body, size, overlap, lambda _: counted)  # noqa: B023 - used up in this round
                spans = [(a, b) for a, b in cuts if not body[a:b].isspace()]
                totals = counted(spans) if len(names) == 5 else [None] * len(spans)
                for n, ((a, b), total) in enumerate(zip(spans, totals)):
                    raw = body[a:b]
                    rows.append(row)
                    found.append((n, a + len(raw) - len(raw.lstrip()), total, raw.strip()))
                    held += len(raw)
                    if held >= CHUNKED:
                        yield _chunk_batch(ids, rows, found, names)
                        rows, found, held = [], [], 0
        if rows:
            yield _chunk_batch(ids, rows, found, names)


def _chunk_batch(ids: pa.Array, rows: list[int], found: list[tuple], names: Sequence[str]) -> pa.RecordBatch:
    index, starts, totals, chunks = zip(*found)
    numbers = (index, starts, totals) if len(names) == 5 else (index, starts)
    columns = [ids.take(pa.array(rows)), *(pa.array(x, pa.int32()) for x in numbers), pa.array(chunks, pa.string())]
    return pa.record_batch(columns, list(names))


def _chunked(df: DataFrame, doc_id: str, text: str, size: int, overlap: int, measure: Measure, length: str | None) -> DataFrame:
    _check_window(size, overlap)
    id_type = df.schema[doc_id].dataType.simpleString()
    names = [doc_id, "chunk_index", "start_index", *([length] if length else []), "chunk_text"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from _chunk_batches(batches, size, overlap, measure, names)
        finally:  # the worker lives on for other tasks
            pa.default_memory_pool().release_unused()

    small_batches(df.sparkSession)
    schema = f"`{doc_id}` {id_type}, chunk_index int, start_index int, {length + ' int, ' if length else ''}chunk_text string"
    return spread(df.select(doc_id, text)).mapInArrow(split, schema)


def chunk_recursive(df: DataFrame, doc_id: str, text: str, size: int = 1000, overlap: int = 200) -> DataFrame:
    """Split at paragraphs, lines, spaces, characters into chunks of at most ``size`` characters,
    with the offset at which each starts."""
    return _chunked(df, doc_id, text, size, overlap, by_characters, None)


def chunk_tokens(
    df: DataFrame, doc_id: str, text: str, size: int = 250, overlap: int = 0, measure: Measure = by_words
) -> DataFrame:
    """Split as ``chunk_recursive`` does, with lengths counted in tokens: whitespace tokens, or those of any tokenizer
    (``by_tokenizer``). Paragraphs and lines are kept whole where they fit, and so are the blanks between words."""
    return _chunked(df, doc_id, text, size, overlap, measure, "n_tokens")


def sentence_array(text: Column | str) -> Column:
    """Sentences of a text in order. The breaks take all blanks with them, so each is trimmed; only
    a blank text leaves an empty piece to drop."""
    return F.array_remove(F.split(strip_text(text), SENTENCE_BREAK), "")


def split_sentences(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    cut = spread(df.select(doc_id, text))
    return cut.select(doc_id, F.posexplode(sentence_array(text)).alias("sentence_index", "sentence"))


def context_array(sentences: Column, buffer: int) -> Column:
    """Each sentence joined with up to ``buffer`` neighbours on either side.

    The array is zipped with shifted copies of itself, so the cost is linear in the sentences.
    """
    gap = F.array_repeat(F.lit(None).cast("string"), 1)
    join = lambda a, b: F.concat_ws(" ", a, b)  # noqa: E731 - skips the NULL beyond either end
    contexts, before, after = sentences, sentences, sentences
    for _ in range(buffer):
        before = F.slice(F.concat(gap, before), 1, F.size(sentences))
        after = F.slice(after, 2, F.size(sentences))
        contexts = F.zip_with(F.zip_with(before, contexts, join), after, join)
    return contexts


def sentence_context(df: DataFrame, doc_id: str, text: str, buffer: int = 1) -> DataFrame:
    """One row per sentence with its context. The neighbours are in the same row: no window."""
    cut = spread(df.select(doc_id, text)).select(doc_id, sentence_array(text).alias("_sentences"))
    pairs = F.arrays_zip(F.col("_sentences").alias("sentence"), context_array(F.col("_sentences"), buffer).alias("context"))
    return cut.select(doc_id, F.posexplode(pairs).alias("sentence_index", "_p")).select(
        doc_id, "sentence_index", "_p.sentence", "_p.context"
    )


def _embed_column(embedder: Embedder):
    @F.pandas_udf("array<float>")
    def embed_texts(texts: pd.Series) -> pd.Series:
        return pd.Series(list(embedder(texts.tolist())))

    return embed_texts


def embed(df: DataFrame, column: str, embedder: Embedder | None = None, name: str = "embedding") -> DataFrame:
    """Add a float vector per text. ``embedder`` maps a list of texts to a matrix and runs inside
    the tasks on Arrow batches."""
    return df.withColumn(name, _embed_column(embedder or hashed_embedder())(F.col(column)))


def _semantic_runs(embedder: Embedder, threshold: float):
    """Sentences and their contexts to chunks: cut where neighbouring contexts are far apart."""

    def runs(sentences: Sequence[str], contexts: Sequence[str]) -> list[str]:
        if len(sentences) < 2:
            return list(sentences)
        vectors = np.asarray(embedder(list(contexts)), dtype=np.float64)
        norms = np.linalg.norm(vectors, axis=1)
        dots = np.einsum("ij,ij->i", vectors[:-1], vectors[1:])
        distances = 1 - dots / (norms[:-1] * norms[1:] + EPSILON)
        edges = [0, *(np.flatnonzero(distances > threshold) + 1), len(sentences)]
        return [" ".join(sentences[a:b]) for a, b in zip(edges, edges[1:])]

    @F.pandas_udf("array<string>")
    def split(sentences: pd.Series, contexts: pd.Series) -> pd.Series:
        return pd.Series([runs(s, c) for s, c in zip(sentences, contexts)])

    return split


def chunk_semantic(
    df: DataFrame,
    doc_id: str,
    text: str,
    threshold: float = 0.15,
    buffer: int = 1,
    embedder: Embedder | None = None,
) -> DataFrame:
    """Runs of sentences, cut where neighbouring contexts are further apart than ``threshold``
    (one minus cosine). A document is handled within its own row, so nothing is shuffled."""
    small_batches(df.sparkSession)
    cut = spread(df.select(doc_id, text)).select(doc_id, sentence_array(text).alias("_sentences"))
    runs = _semantic_runs(embedder or hashed_embedder(), threshold)
    chunks = runs("_sentences", context_array(F.col("_sentences"), buffer))
    return cut.select(doc_id, F.posexplode(chunks).alias("chunk_index", "chunk_text"))


def word_count(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of each token between single spaces (pre-counted before the shuffle)."""
    return df.select(F.explode(F.split(text, " ")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def doc_elements_to_text(df: DataFrame, parsed: str, name: str = "document_text") -> DataFrame:
    return df.withColumn(name, fold_elements(parsed)).drop(parsed)


def fields_of(df: DataFrame, keep: Sequence[str], text: str, patterns: dict[str, str]) -> DataFrame:
    return df.select(*keep, *extract_fields(text, patterns))

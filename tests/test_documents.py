"""Chunkers, sentences and pages against plain Python."""

import re

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidemark.functions.text import strip_text, text_features
from tidemark.functions import vectors
from tidemark.functions.vectors import hashed_embedder
from tidemark.operators import documents as docs
from tidemark.operators.retrieval import render_prompt
from tidemark.session import materialize


def pieces_at(text, sep):
    """Cut before every separator, which stays at the head of its piece."""
    if sep == "":
        return list(text)
    head, *rest = text.split(sep)
    return [p for p in [head, *[sep + r for r in rest]] if p]


def split_by_hand(text, size, overlap, seps=("\n\n", "\n", " ", ""), length=len):
    """The recursive rule, on strings and lists."""
    i = next(n for n, s in enumerate(seps) if s == "" or s in text)
    out, small = [], []

    def pack():
        held = []
        for piece in small:
            if held and sum(map(length, held)) + length(piece) > size:
                out.append("".join(held).strip())
                while sum(map(length, held)) > overlap or (held and sum(map(length, held)) + length(piece) > size):
                    held.pop(0)
            held.append(piece)
        if held:
            out.append("".join(held).strip())
        small.clear()

    for piece in pieces_at(text, seps[i]):
        if length(piece) < size or seps[i] == "":
            small.append(piece)
        else:
            pack()
            out.extend(split_by_hand(piece, size, overlap, seps[i + 1 :], length))
    pack()
    return [c for c in out if c]


@settings(max_examples=300, deadline=None)
@given(
    st.text(alphabet="ab \n", max_size=120),
    st.integers(2, 20).flatmap(lambda s: st.tuples(st.just(s), st.integers(0, s - 1))),
)
def test_recursive_spans(text, window):
    size, overlap = window
    for measure, length in ((docs.by_characters, len), (docs.by_words, words_in), (docs.by_tokenizer(half_lengths), lambda t: half_lengths([t])[0])):
        got = [text[a:b].strip() for a, b in docs.recursive_spans(text, size, overlap, measure)] if text else []
        assert [c for c in got if c] == (split_by_hand(text, size, overlap, length=length) if text else [])


def words_in(text):
    return len(text.split())


def half_lengths(texts):
    """Lengths that do not add up, as those of a model's tokenizer."""
    return [(len(t) + 1) // 2 for t in texts]


def test_chunks_leave_the_worker_in_small_batches(spark):
    texts = [f"{n} " + "word " * 600 for n in range(2_000)] + [None, ""]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["i", "t"])
    names = ["i", "chunk_index", "start_index", "n_tokens", "chunk_text"]
    got = list(docs._chunk_batches(iter([batch]), 250, 0, docs.by_words, names))
    assert len(got) > 3 and all(b.nbytes < 2 * docs.CHUNKED for b in got)
    assert sum(n for b in got for n in b["n_tokens"].to_pylist()) == 601 * 2_000
    assert [r for b in got for r in b["i"].to_pylist()] == sorted(n for n in range(2_000) for _ in range(3))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    docs.chunk_tokens(spark.createDataFrame([(1, "a b")], "i int, t string"), "i", "t")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1_000


def test_trimming_looks_at_the_ends_only(spark):
    blanks = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
    texts = [c + "a" + c + "b" + c for c in blanks] + ["", blanks, "\u200b a \u200b", "x" * 70_000 + blanks]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip_text("t").alias("s"))
    assert all(r.s == r.t.strip() for r in df.collect())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "trim(" in plan


def test_embedder_counts_in_blocks(monkeypatch):
    texts = ["The cat\nthe  dog", "", None, "É " * 50, "cat"] * 7
    whole = hashed_embedder(16)(texts)
    monkeypatch.setattr(vectors, "TOKENS", 3)
    monkeypatch.setattr(vectors._Hashes, "MOST", 2)
    assert (hashed_embedder(16)(texts) == whole).all()
    assert whole.sum(axis=1)[:5].tolist() == [4, 0, 0, 50, 1] and hashed_embedder()([]).shape == (0, 64)


def test_chunks_by_tokens_keep_paragraphs_and_blanks(spark):
    text = "One two  three.\n\nFour five\nsix seven eight nine ten\n\n" + "long " * 9 + "end"
    got = docs.chunk_tokens(spark.createDataFrame([(1, text), (2, None), (3, " \n ")], "i int, t string"), "i", "t", 6, 2)
    rows = got.orderBy("i", "chunk_index").collect()
    assert {r.i for r in rows} == {1}
    assert [(r.n_tokens, r.chunk_text) for r in rows] == [
        (3, "One two  three."), (2, "Four five"), (5, "six seven eight nine ten"), (6, "long long long long long long"), (6, "long long long long long end"),
    ]
    assert all(text[r.start_index :].startswith(r.chunk_text) for r in rows)


def test_chunking_is_linear():
    """Ten times the text takes about ten times as long, whatever it is made of."""
    import time

    def seconds(text, measure):
        start = time.perf_counter()
        assert sum(1 for _ in docs.recursive_spans(text, 250, 50, measure))
        return time.perf_counter() - start

    for unit in ("word ", "x", "\n", "a b\n\n", "x" * 300 + " "):
        for measure in (docs.by_characters, docs.by_words):
            short = unit * (20_000 // len(unit))
            seconds(short, measure)
            assert seconds(short * 10, measure) < 60 * max(0.005, seconds(short, measure))


def test_recursive_chunks_carry_their_offsets(spark, tables):
    texts = {r.doc_id: r.text for r in tables.documents.collect()}
    chunks = docs.chunk_recursive(tables.documents, "doc_id", "text", 1000, 200).collect()
    assert {c.doc_id for c in chunks} == set(texts)
    for c in chunks:
        assert texts[c.doc_id][c.start_index : c.start_index + len(c.chunk_text)] == c.chunk_text
        assert len(c.chunk_text) <= 1000
    for doc_id in list(texts)[:20]:
        mine = [c.chunk_text for c in sorted(chunks, key=lambda c: (c.doc_id, c.chunk_index)) if c.doc_id == doc_id]
        assert mine == split_by_hand(texts[doc_id], 1000, 200)


def sentences_of(text):
    return [s.strip() for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s.strip()]


def semantic_by_hand(text, threshold, buffer, embed):
    import numpy as np

    sentences = sentences_of(text)
    contexts = [" ".join(sentences[max(0, i - buffer) : i + buffer + 1]) for i in range(len(sentences))]
    vectors = embed(contexts).astype(float)
    chunks = [sentences[:1]]
    for a, b, sentence in zip(vectors, vectors[1:], sentences[1:]):
        far = 1 - a @ b / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-10) > threshold
        if far:
            chunks.append([])
        chunks[-1].append(sentence)
    return [" ".join(c) for c in chunks if c]


@pytest.mark.parametrize("buffer", [0, 1, 2])
def test_semantic_chunks(tables, buffer):
    embed = hashed_embedder(32)
    texts = {r.doc_id: r.text for r in tables.documents.orderBy("doc_id").limit(40).collect()}
    few = tables.documents.filter(F.col("doc_id").isin(*texts))
    got = {}
    for r in docs.chunk_semantic(few, "doc_id", "text", 0.2, buffer, embed).orderBy("doc_id", "chunk_index").collect():
        got.setdefault(r.doc_id, []).append(r.chunk_text)
    assert got == {d: semantic_by_hand(t, 0.2, buffer, embed) for d, t in texts.items()}


def test_overlapping_chunks_rebuild_the_text(spark, tables):
    texts = {r.doc_id: r.text for r in tables.documents.collect()}
    built = {}
    for r in docs.chunk_fixed(tables.documents, "doc_id", "text", 300, 40).orderBy("doc_id", "chunk_index").collect():
        built[r.doc_id] = built.get(r.doc_id, "") + r.chunk_text[40 if r.chunk_index else 0 :]
    assert built == texts


def test_page_text(spark):
    html = (
        '<!DOCTYPE html><html lang="en"><head><title>A &amp; B</title><style>p{}</style>'
        '<script>var t="</p>";</script></head><body><!-- no --><p>x &lt; y</p><p>&copy; z</p></body></html>'
    )
    page = docs.html_to_text(spark.createDataFrame([(1, "http://a", html)], "page_id int, url string, html string")).first()
    assert (page.title, page.language, page.source) == ("A & B", "en", "http://a")
    assert page.page_text == "A & Bx < y© z"


def pages_of(spark, *htmls):
    frame = spark.createDataFrame([(i, "u", h) for i, h in enumerate(htmls)], "page_id int, url string, html string")
    return docs.html_to_text(frame).orderBy("page_id").collect()


def test_pages_are_read_once_from_left_to_right(spark):
    """What a script, comment or tag holds opens nothing else; what is not closed reaches to the end."""
    got = pages_of(
        spark,
        "a<!-- <script> -->b<script>x = '<!--'</script>c<!-- </style> -->d",
        "a<style>p{}</STYLE >b<scripty>c</scripty>d < e <3 <!DOCTYPE x>f",
        "a<b", "a<script>b</scrip>", "a<!-- b --", "a<title>b", "<html data-lang='x' LANG=fr-CA>a", None, "",
    )
    assert [r.page_text for r in got] == ["abcd", "abcd < e <3 f", "a", "a", "a", "ab", "a", None, ""]
    assert [r.title for r in got][5:7] == ["b", ""] and got[6].language == "x"


def test_unclosed_tags_take_linear_time(spark):
    import time

    spark.range(1).select(F.regexp_replace(F.lit("<a>"), docs.HIDDEN, "")).collect()
    for tag in ("<a href=x ", "<script>", "<!-- ", "<title>", "<html ", "</", "<style>&amp", "<title", "&"):
        page = spark.createDataFrame([(1, "u", tag * 20_000)], "page_id int, url string, html string").coalesce(1)
        start = time.perf_counter()
        docs.html_to_text(page).collect()
        assert time.perf_counter() - start < 3, tag  # a job's own time included


def test_character_references_have_one_decoder(spark):
    import html

    texts = ["caf&eacute; &#233; &#x1F600;", "&amp;lt; &lt;", "a & b; &unknown; &amp;", "&copy 2024", "&copy 2024 &eacute;", "plain", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(docs.unescape("t")).collect()]
    assert got == [t and html.unescape(t) for t in texts]


def test_text_features(spark):
    texts = ["Can this be enriched?", "  two words ", "", "what ? "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [tuple(r) for r in df.select(*text_features("t")).collect()]
    assert got == [(len(t), len(t.split()), t.strip().endswith("?"), t.upper()) for t in texts]


def test_prompt_values_are_not_templates(spark):
    df = spark.createDataFrame([("{question}", "why?")], "context string, question string")
    prompt = render_prompt("C: {context} Q: {question}", {"context": "context", "question": "question"})
    assert df.select(prompt).first()[0] == "C: {question} Q: why?"


@pytest.mark.parametrize("ids,kind", [((1, 1 + 2**40, 5 - 2**62), "long"), (("a", "b|0", "ü"), "string")])
@pytest.mark.parametrize("limit", [100, 1])
def test_answers_come_from_the_document_that_was_hit(spark, monkeypatch, ids, kind, limit):
    """Ids whose low bits are alike, and text ids, whether queries travel or are matched in blocks."""
    from tidemark.operators import retrieval
    from tidemark.plans import documents as plan

    few = lambda *args: retrieval.vector_topk_batch(*args, query_limit=limit)
    monkeypatch.setattr(plan, "vector_topk_batch", few)
    said = ("red apples grow here", "blue whales swim there", "green tea is warm")
    docs = spark.createDataFrame(list(zip(ids, said)), f"doc_id {kind}, text string")
    index = materialize(plan.index_documents(docs, "doc_id", "text"), "index")
    asked = spark.createDataFrame(list(enumerate(said)), "query_id long, question string")
    fallback = spark.createDataFrame([("none", "nothing")], "category string, text string")
    got = plan.answer_questions(index, asked, fallback, F.lit("none"), k=1).select("query_id", "answer").collect()
    assert sorted(tuple(r) for r in got) == list(enumerate(said))

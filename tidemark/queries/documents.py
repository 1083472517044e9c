"""Documents, chunks, vectors and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.text import extract_fields
from tidemark.functions.vectors import cosine
from tidemark.operators import documents as docs
from tidemark.operators.retrieval import (
    assemble_context,
    coalesce_answer,
    fallback_lookup,
    grade_and_route,
    render_prompt,
    vector_topk,
    vector_topk_batch,
)
from tidemark.queries.expressions import RE2_SPACE, elements_json
from tidemark.queries.registry import query
from tidemark.sources import Tables


# The character references that the test pages hold.
_REFERENCES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": "\u00a0", "&copy;": "©", "&middot;": "·", "&amp;": "&"}


def _unescape_sql(expr: str) -> str:
    for entity, char in _REFERENCES.items():
        quoted, plain = entity.replace("'", "''"), char.replace("'", "''")
        expr = f"replace({expr}, '{quoted}', '{plain}')"
    return expr


_LANG = docs.LANGUAGE.replace("'", "''")


@query(
    "html_to_text",
    "SELECT page_id, url AS source, "
    + _unescape_sql(f"regexp_extract(html, '{docs.TITLE}', 1)")
    + f" AS title, regexp_extract(regexp_extract(html, '{docs.ROOT_TAG}'), '{_LANG}', 1) AS language, "
    + _unescape_sql(f"regexp_replace(html, '{docs.HIDDEN}', '', 'g')")
    + " AS page_text FROM pages",
)
def html_to_text(t: Tables) -> DataFrame:
    return docs.html_to_text(t.pages)


@query("doc_elements_to_text", "SELECT doc_id, chr(10) || text AS document_text FROM documents")
def doc_elements_to_text(t: Tables) -> DataFrame:
    return docs.doc_elements_to_text(t.documents.select("doc_id", elements_json("text").alias("parsed")), "parsed")


# The default embedder's slot of a token.
SLOT_SQL = "('0x' || substr(md5(w), 1, 8))::bigint % 64"

FIXED_SQL = (
    "SELECT doc_id, (start // 462)::int AS chunk_index, substr(text, start + 1, 512) AS chunk_text FROM "
    "(SELECT doc_id, text, unnest(range(0, length(text), 462))::int AS start FROM documents)"
)


@query("chunk_fixed", FIXED_SQL)
def chunk_fixed(t: Tables) -> DataFrame:
    return docs.chunk_fixed(t.documents, "doc_id", "text", 512, 50)


def _recursive_sql(size: int, overlap: int, length: str, told: str) -> str:
    """The recursive splitter over all documents; ``length`` is SQL for the length of ``x``.

    Level by level, what is too long is cut before a separator (one that does not occur leaves it whole); a text without
    any separator is cut into characters. Runs of small siblings are packed: a chunk goes as far as the prefix sums of the lengths allow, and the next begins with as much
    of it as the overlap allows.
    """
    seps = ["chr(10) || chr(10)", "chr(10)", "' '", None]
    steps = [
        "long0 AS (SELECT doc_id, 0 AS start, text AS x, NOT contains(text, ' ') AND NOT contains(text, chr(10)) AS bare "
        "FROM documents WHERE text <> '')"
    ]
    for i, sep in enumerate(seps):
        cut = "list_transform(range(1, len(x) + 1), lambda i: substr(x, i, 1))"
        if sep:
            parts = f"string_split(x, {sep})"
            cut = f"list_prepend({parts}[1], list_transform({parts}[2:], lambda y: {sep} || y))"
        steps.append(
            f"cut{i} AS (SELECT doc_id, bare, parent, parent + coalesce(sum(len(x)) OVER (PARTITION BY doc_id, parent ORDER BY place "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start, x FROM (SELECT doc_id, bare, start AS parent, "
            f"unnest(range(len({cut}))) AS place, unnest({cut}) AS x FROM long{i}) WHERE x <> ''), "
            f"part{i} AS (SELECT *, {length} AS n, {'TRUE' if sep is None else f'{length} < {size} AND NOT bare'} AS small FROM cut{i}), "
            f"run{i} AS (SELECT *, {i} AS level, sum((NOT small)::int) OVER (PARTITION BY doc_id, parent ORDER BY start) AS run FROM part{i}), "
            f"long{i + 1} AS (SELECT doc_id, start, x, bare FROM part{i} WHERE NOT small)"
        )
    pieces = " UNION ALL ".join(f"SELECT doc_id, level, parent, run, start, len(x) AS wide, n FROM run{i} WHERE small" for i in range(4))
    strip = f"regexp_replace(regexp_replace(raw, '^{RE2_SPACE}+', ''), '{RE2_SPACE}+$', '')"
    return (
        "WITH RECURSIVE " + ", ".join(steps) + f", pieces AS ({pieces}), "
        "sums AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, level, parent, run ORDER BY start) AS upto FROM pieces), "
        "runs AS (SELECT row_number() OVER () AS r, doc_id, list(start ORDER BY start) AS starts, max(start + wide) AS stop, "
        "list_prepend(0, list(upto ORDER BY start)) AS p FROM sums GROUP BY doc_id, level, parent, run), "
        f"packed(r, f, e) AS (SELECT r, 0::bigint, (len(list_filter(p, lambda x: x <= {size})) - 1)::bigint FROM runs UNION ALL "
        f"SELECT r, g, (len(list_filter(p, lambda x: x <= p[g + 1] + {size})) - 1)::bigint FROM (SELECT r, p, least(e, len(list_filter(p, "
        f"lambda x: x < greatest(p[e + 1] - {overlap}, p[e + 2] - {size})))) AS g FROM packed JOIN runs USING (r) WHERE e < len(starts))), "
        "chunks AS (SELECT d.doc_id, starts[f + 1] AS start, "
        "substr(text, starts[f + 1]::bigint + 1, (coalesce(starts[e + 1], stop) - starts[f + 1])::bigint) AS raw "
        "FROM packed JOIN runs USING (r) JOIN documents d USING (doc_id)) "
        "SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY start) - 1)::int AS chunk_index, "
        f"(start + len(raw) - len(regexp_replace(raw, '^{RE2_SPACE}+', '')))::int AS start_index, {told}{strip} AS chunk_text "
        f"FROM chunks WHERE {strip} <> ''"
    )


@query("chunk_recursive", _recursive_sql(1000, 200, "len(x)", ""))
def chunk_recursive(t: Tables) -> DataFrame:
    return docs.chunk_recursive(t.documents, "doc_id", "text", 1000, 200)


_WORDS_IN = "len(regexp_extract_all({0}, '" + RE2_SPACE.replace("[", "[^", 1).replace("{", "{{").replace("}", "}}") + "+'))"


@query("chunk_tokens", _recursive_sql(250, 0, _WORDS_IN.format("x"), f"{_WORDS_IN.format('raw')}::int AS n_tokens, "))
def chunk_tokens(t: Tables) -> DataFrame:
    """Paragraphs, lines and words packed into chunks of 250 tokens."""
    return docs.chunk_tokens(t.documents, "doc_id", "text", 250, 0)


@query("chunk_tokens_overlap", _recursive_sql(200, 50, _WORDS_IN.format("x"), f"{_WORDS_IN.format('raw')}::int AS n_tokens, "))
def chunk_tokens_overlap(t: Tables) -> DataFrame:
    return docs.chunk_tokens(t.documents, "doc_id", "text", 200, 50)


_SENTENCES = (
    "sentences AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace("
    f"regexp_replace(text, '^{RE2_SPACE}+|{RE2_SPACE}+$', '', 'g'), '([.!?]){RE2_SPACE}+', '\\1' || chr(30), 'g'), chr(30)), "
    f"lambda s: regexp_replace(s, '^{RE2_SPACE}+|{RE2_SPACE}+$', '', 'g')), lambda s: s <> '') AS s FROM documents)"
)


@query(
    "split_sentences",
    f"WITH {_SENTENCES} SELECT doc_id, i::int AS sentence_index, s[i + 1] AS sentence "
    "FROM (SELECT *, unnest(range(len(s))) AS i FROM sentences)",
)
def split_sentences(t: Tables) -> DataFrame:
    return docs.split_sentences(t.documents, "doc_id", "text")


@query(
    "sentence_context",
    f"WITH {_SENTENCES} SELECT doc_id, i::int AS sentence_index, s[i + 1] AS sentence, "
    "array_to_string(s[greatest(i, 1):i + 2], ' ') AS context FROM (SELECT *, unnest(range(len(s))) AS i FROM sentences)",
)
def sentence_context(t: Tables) -> DataFrame:
    return docs.sentence_context(t.documents, "doc_id", "text", 1)


_SEMANTIC = (
    f"WITH {_SENTENCES}, ctx AS (SELECT doc_id, i, s[i + 1] AS sentence, array_to_string(s[greatest(i, 1):i + 2], ' ') AS context "
    "FROM (SELECT *, unnest(range(len(s))) AS i FROM sentences)), words AS (SELECT doc_id, i, "
    "unnest(string_split(replace(lower(context), chr(10), ' '), ' ')) AS w FROM ctx), "
    f"slots AS (SELECT doc_id, i, {SLOT_SQL} AS slot, count(*) AS n FROM words WHERE w <> '' GROUP BY 1, 2, 3), "
    "norms AS (SELECT doc_id, i, sqrt(sum(n * n)) AS norm FROM slots GROUP BY 1, 2), "
    "dots AS (SELECT a.doc_id, b.i, sum(a.n * b.n) AS dot FROM slots a JOIN slots b ON a.doc_id = b.doc_id AND b.i = a.i + 1 "
    "AND a.slot = b.slot GROUP BY 1, 2), breaks AS (SELECT c.doc_id, c.i, c.sentence, "
    "coalesce(1 - coalesce(dot, 0) / (p.norm * n.norm + 1e-10) > 0.15, false)::int AS new_chunk FROM ctx c "
    "JOIN norms n USING (doc_id, i) LEFT JOIN norms p ON p.doc_id = c.doc_id AND p.i = c.i - 1 "
    "LEFT JOIN dots d ON d.doc_id = c.doc_id AND d.i = c.i) "
    "SELECT doc_id, chunk_index::int AS chunk_index, string_agg(sentence, ' ' ORDER BY i) AS chunk_text FROM "
    "(SELECT *, sum(new_chunk) OVER (PARTITION BY doc_id ORDER BY i) AS chunk_index FROM breaks) GROUP BY 1, 2"
)


@query("chunk_semantic", _SEMANTIC)
def chunk_semantic(t: Tables) -> DataFrame:
    return docs.chunk_semantic(t.documents, "doc_id", "text", 0.15, 1)


@query(
    "embed_chunks",
    f"WITH chunks AS ({FIXED_SQL}), words AS (SELECT doc_id, chunk_index, unnest(string_split(replace(lower(chunk_text), "
    f"chr(10), ' '), ' ')) AS w FROM chunks), slots AS (SELECT doc_id, chunk_index, {SLOT_SQL} AS slot, count(*) AS n "
    "FROM words WHERE w <> '' GROUP BY 1, 2, 3), sums AS (SELECT doc_id, chunk_index, sum(n)::double AS n_words, "
    "count(*) AS n_slots, round(sqrt(sum(n * n)), 6) AS norm, max_by(slot, (n, -slot))::int AS top_slot FROM slots GROUP BY 1, 2) "
    "SELECT c.doc_id, c.chunk_index, 64 AS dim, coalesce(n_words, 0) AS n_words, coalesce(n_slots, 0)::int AS n_slots, "
    "coalesce(norm, 0) AS norm, coalesce(top_slot, 0) AS top_slot FROM chunks c LEFT JOIN sums USING (doc_id, chunk_index)",
)
def embed_chunks(t: Tables) -> DataFrame:
    """Vectors of the fixed chunks, told by their length, sum, filled slots, norm and largest slot."""
    vectors = docs.embed(docs.chunk_fixed(t.documents, "doc_id", "text"), "chunk_text")
    v = F.col("embedding")
    total = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)
    squares = F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x)
    return vectors.select(
        "doc_id",
        "chunk_index",
        F.size(v).alias("dim"),
        total.alias("n_words"),
        F.size(F.filter(v, lambda x: x > 0)).alias("n_slots"),
        F.round(F.sqrt(squares), 6).alias("norm"),
        (F.array_position(v, F.array_max(v)) - 1).cast("int").alias("top_slot"),
    )


def _cosine_sql(a: str, b: str) -> str:
    dot = "list_inner_product({0}::double[], {1}::double[])"
    norms = f"sqrt({dot.format(a, a)}) * sqrt({dot.format(b, b)})"
    return f"round({dot.format(a, b)} / ({norms} + 1e-10), 6)"


_UNIT = "[CASE WHEN i % 3 = 0 THEN 1 ELSE i / 64.0 END FOR i IN range(64)]::double[]"


@query("cosine_score", f"SELECT vec_id, {_cosine_sql('embedding', _UNIT)} AS similarity FROM embeddings")
def cosine_score(t: Tables) -> DataFrame:
    probe = F.array(*[F.lit(1.0 if i % 3 == 0 else i / 64) for i in range(64)])
    return t.embeddings.select("vec_id", F.round(cosine("embedding", probe), 6).alias("similarity"))


@query(
    "vector_topk",
    f"SELECT vec_id, {_cosine_sql('embedding', _UNIT)} AS similarity FROM embeddings ORDER BY similarity DESC, vec_id LIMIT 4",
)
def nearest_vectors(t: Tables) -> DataFrame:
    probe = [1.0 if i % 3 == 0 else i / 64 for i in range(64)]
    return vector_topk(t.embeddings, probe, 4).withColumn("similarity", F.round("similarity", 6))


def _centroids(t: Tables) -> DataFrame:
    """The mean vector of every label: the queries of the batch search."""
    parts = t.embeddings.select("label", F.posexplode("embedding").alias("i", "x"))
    means = parts.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    # One row per dimension: the list of a label is as long as a vector.
    ordered = F.array_sort(F.collect_list(F.struct("i", "m")))
    return means.groupBy(F.col("label").cast("bigint").alias("query_id")).agg(
        F.transform(ordered, lambda p: p["m"]).alias("query_vector")
    )


_HITS = (
    "centroids AS (SELECT label::bigint AS query_id, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(x) AS m FROM "
    "(SELECT label, unnest(embedding)::double AS x, unnest(range(64)) AS i FROM embeddings) GROUP BY 1, 2) GROUP BY 1), "
    f"hits AS (SELECT query_id, vec_id, {_cosine_sql('embedding', 'q')} AS similarity, row_number() OVER ("
    f"PARTITION BY query_id ORDER BY {_cosine_sql('embedding', 'q')} DESC, vec_id)::int AS rank FROM embeddings, centroids "
    "QUALIFY rank <= 3)"
)


@query("vector_topk_batch", f"WITH {_HITS} SELECT * FROM hits")
def nearest_per_label(t: Tables) -> DataFrame:
    return vector_topk_batch(t.embeddings, _centroids(t), 3).withColumn("similarity", F.round("similarity", 6))


@query(
    "vector_topk_index",
    f"SELECT q.vec_id AS query_id, v.vec_id, round({_cosine_sql('v.embedding', 'q.embedding')}, 6) AS similarity, row_number() OVER ("
    f"PARTITION BY q.vec_id ORDER BY round({_cosine_sql('v.embedding', 'q.embedding')}, 12) DESC, v.vec_id)::int AS rank "
    "FROM embeddings v, embeddings q WHERE q.vec_id % 50 = 0 QUALIFY rank <= 5",
)
def vector_topk_index(t: Tables) -> DataFrame:
    """Every fiftieth vector as a query against all vectors, by the inverted file whatever their number."""
    queries = t.embeddings.filter(F.col("vec_id") % 50 == 0)
    queries = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").cast("array<double>").alias("query_vector"))
    return vector_topk_batch(t.embeddings, queries, 5, query_limit=0).withColumn("similarity", F.round("similarity", 6))


@query(
    "context_assemble",
    f"WITH {_HITS} SELECT query_id, string_agg(text, chr(10) || chr(10) ORDER BY rank) AS context FROM hits "
    "JOIN documents ON vec_id = doc_id GROUP BY query_id",
)
def context_assemble(t: Tables) -> DataFrame:
    """Hits of the batch search, with the document of the same number as the chunk text."""
    hits = vector_topk_batch(t.embeddings, _centroids(t), 3)
    texts = t.documents.select(F.col("doc_id").alias("vec_id"), "text")
    return assemble_context(hits.join(texts, "vec_id"), "query_id", "text")


def _questions(t: Tables) -> DataFrame:
    """User messages as questions, the reply that follows as their context."""
    c = t.conversations
    question = c.filter(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("question"))
    reply = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("context"))
    return question.join(reply, ["conv_id", "turn"])


_QUESTIONS = (
    "questions AS (SELECT u.conv_id, u.turn, u.text AS question, r.text AS context FROM conversations u "
    "JOIN conversations r ON u.conv_id = r.conv_id AND u.turn + 1 = r.turn WHERE u.role = 'user')"
)
_TEMPLATE = "Answer from the context only.\nContext: {context}\nQuestion: {question}\nAnswer:"


@query(
    "prompt_render",
    f"WITH {_QUESTIONS} SELECT conv_id, turn, 'Answer from the context only.' || chr(10) || 'Context: ' || context || chr(10) "
    "|| 'Question: ' || question || chr(10) || 'Answer:' AS prompt FROM questions",
)
def prompt_render(t: Tables) -> DataFrame:
    prompt = render_prompt(_TEMPLATE, {"context": "context", "question": "question"})
    return _questions(t).select("conv_id", "turn", prompt.alias("prompt"))


_CATEGORY = {"de": "databricks", "la": "azure"}


def category_of(question: str):
    words = F.split(F.lower(question), " ")
    hits = [F.when(F.array_contains(words, w), F.lit(c)) for w, c in _CATEGORY.items()]
    return F.coalesce(*hits, F.lit("other"))


CATEGORY_SQL = (
    "CASE " + " ".join(f"WHEN list_contains(string_split(lower(question), ' '), '{w}') THEN '{c}'" for w, c in _CATEGORY.items())
    + " ELSE 'other' END"
)
_GRADED = (
    _QUESTIONS + ", tokens AS (SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(question), '[^\\p{L}\\p{N}]+'), "
    "lambda x: x <> '')) AS asked, list_distinct(list_filter(regexp_split_to_array(lower(context), '[^\\p{L}\\p{N}]+'), "
    "lambda x: x <> '')) AS given FROM questions), graded AS (SELECT conv_id, turn, question, context, "
    "CASE WHEN coalesce(len(list_intersect(asked, given))::double / nullif(len(asked), 0), 0) >= 0.4 THEN 'yes' ELSE 'no' END AS grade, "
    f"{CATEGORY_SQL} AS cat FROM tokens)"
)


@query(
    "grade_and_route",
    f"WITH {_GRADED} SELECT conv_id, turn, grade, CASE WHEN grade = 'yes' THEN 'end' ELSE 'fallback' END AS route, "
    "CASE WHEN grade = 'no' THEN cat END AS category FROM graded",
)
def graded_questions(t: Tables) -> DataFrame:
    graded = grade_and_route(_questions(t), "question", "context", 0.4, category_of("question"))
    return graded.select("conv_id", "turn", "grade", "route", "category")


def reference_texts(t: Tables) -> DataFrame:
    """One reference text per category."""
    rows = [("databricks", "All about tables."), ("azure", "All about clouds.")]
    return t.spark.createDataFrame(rows, "category string, text string")


FALLBACK_SQL = (
    "CASE cat WHEN 'databricks' THEN 'All about tables.' WHEN 'azure' THEN 'All about clouds.' "
    "ELSE 'No documentation found for category: ' || cat END"
)


@query("fallback_lookup", f"WITH {_GRADED} SELECT conv_id, turn, cat AS category, {FALLBACK_SQL} AS fallback_text FROM graded")
def looked_up(t: Tables) -> DataFrame:
    asked = _questions(t).select("conv_id", "turn", category_of("question").alias("category"))
    return fallback_lookup(asked, reference_texts(t))


@query(
    "coalesce_answer",
    f"WITH {_GRADED} SELECT conv_id, turn, CASE WHEN grade = 'no' AND cat <> 'other' THEN {FALLBACK_SQL} "
    "WHEN grade = 'yes' THEN context ELSE 'No answer could be determined.' END AS answer FROM graded",
)
def answers(t: Tables) -> DataFrame:
    """The fallback text where there is one, else the graded context, else the default."""
    graded = grade_and_route(_questions(t), "question", "context", 0.4, category_of("question"))
    found = fallback_lookup(graded, reference_texts(t))
    final = F.when((F.col("route") == "fallback") & (F.col("category") != "other"), F.col("fallback_text"))
    initial = F.when(F.col("grade") == "yes", F.col("context")).otherwise("")
    return found.select("conv_id", "turn", coalesce_answer(final, initial).alias("answer"))


_FIELDS = {
    "Title": r"(?s)^\s*([^\n.!?]+)",
    "Secret": r"token = \"([0-9a-f]+)\"",
    "Content": r"(?s)^[^\n]*\n(.*)$",
}


@query(
    "extract_fields",
    "SELECT doc_id, " + ", ".join(f"nullif(regexp_extract(text, '{p}', 1), '') AS {n}" for n, p in _FIELDS.items()) + " FROM documents",
)
def fields(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", *extract_fields("text", _FIELDS))

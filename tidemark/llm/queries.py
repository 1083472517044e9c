"""The registered queries of these operators, with DuckDB twins where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, codes, counts, decontam, exact, merkle, minhash, mixing, pii, quality, suffix, vectors, warc
from tidemark.llm.common import prepare

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir), BYTE_BPE)


def minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_documents(spark, sf_dir), size=4)


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_documents(spark, sf_dir))


def suffix_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.score(_documents(spark, sf_dir))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(_documents(spark, sf_dir), PIECES)


def warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.span_digests(pii.personal_data(_documents(spark, sf_dir)))


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def cotrained_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_documents(spark, sf_dir), quality.read_labels(spark, sf_dir))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(_documents(spark, sf_dir))


def vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe_codec": bpe_codec,
    "op2_minhash_dedup": minhash_dedup,
    "op3_exact_dedup": exact_dedup,
    "op4_suffix_lm": suffix_lm,
    "op5_token_counts": token_counts,
    "op6_warc_revisits": warc_revisits,
    "op7_personal_data": personal_data,
    "op8_source_mixing": source_mixing,
    "op9_near_vectors": near_vectors,
    "op10_cotrained_quality": cotrained_quality,
    "op11_benchmark_decontamination": benchmark_decontamination,
    "op12_merkle_manifest": merkle_manifest,
    "op13_vector_codes": vector_codes,
    "pipeline": pipeline,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)
    """,
    "op8_source_mixing": """
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   [1, 2, 3][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
            FROM d GROUP BY source),
        f AS (
            SELECT *, source_size * 3 AS most,
                   (sum(source_size) OVER () - coalesce(sum(source_size * 3) OVER (
                       ORDER BY source_size * 3 / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS left_words,
                   (sum(weight) OVER (ORDER BY source_size * 3 / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS open_weight
            FROM s),
        l AS (
            SELECT left_words, open_weight FROM f WHERE left_words / open_weight <= most::DOUBLE / weight
            ORDER BY most / weight, left_words LIMIT 1),
        g AS (
            SELECT f.source, f.source_size,
                   least(f.weight::DOUBLE * l.left_words / l.open_weight, f.most::DOUBLE) AS target
            FROM f CROSS JOIN l),
        r AS (
            SELECT d.doc_id, d.size, g.source_size, g.target,
                   CASE WHEN g.target >= 3 * g.source_size THEN 3 ELSE floor(g.target / g.source_size) END AS base,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id
                       ROWS UNBOUNDED PRECEDING) AS upto
            FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
        SELECT doc_id, size, source_size, target,
               ((base + (upto - size / 2 <= target - base * source_size)::INT) * size)::BIGINT AS taken,
               (base + (upto - size / 2 <= target - base * source_size)::INT)::INT AS copies
        FROM r
    """,
}


# The words of op11, and CRC-32 bit by bit (the polynomial is a fixed value of that checksum).
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_SHIFT = "lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
_BYTE = f"lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), {_SHIFT})"
_CRC = (
    "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, "
    f"list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), {_BYTE}))"
)

SQL["op11_benchmark_decontamination"] = f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
    i AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {_WORDS} AS w FROM benchmark),
    s AS (SELECT item_id, w, least(10, len(w)) AS size FROM i WHERE len(w) > 0),
    windows AS (
        SELECT DISTINCT item_id, size, array_to_string(w[k : k + size - 1], ' ') AS words
        FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k FROM s)),
    places AS (
        SELECT r, k, size, array_to_string(w[k : k + size - 1], ' ') AS words
        FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS k
              FROM d CROSS JOIN (SELECT DISTINCT size FROM windows) z)),
    found AS (SELECT p.r, p.k, p.size, v.item_id FROM places p JOIN windows v ON p.words = v.words AND p.size = v.size),
    hits AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(k, k + size)) AS place FROM found) GROUP BY r),
    named AS (
        SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
        FROM (SELECT DISTINCT r, item_id FROM found) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(m.n, 0)::BIGINT AS n_items,
           sha256(coalesce(m.ids, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
    FROM d LEFT JOIN hits h USING (r) LEFT JOIN named m USING (r)
"""


def _leaf(text: str) -> str:
    told = [f"coalesce(octet_length(encode({c}::VARCHAR)) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars")]
    return f"sha256({' || '.join(told)} || coalesce(octet_length(encode({text})) || ':' || {text}, '-'))"


SQL["op12_merkle_manifest"] = f"""
    WITH RECURSIVE t AS (
        SELECT doc_id, lang, {_leaf("text")} AS leaf,
               CASE WHEN {_CRC} % 3 = 0 AND text IS NOT NULL THEN {_leaf(_LOWER)} ELSE {_leaf("text")} END AS given
        FROM documents),
    leaves AS (
        SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
               count(*) OVER (PARTITION BY lang) AS n FROM t),
    up(lang, level, i, n, h) AS (
        SELECT lang, 0, i, n, leaf FROM leaves
        UNION ALL
        SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
        FROM up WHERE n > 1 GROUP BY lang, level, i // 8, n),
    groups AS (
        SELECT lang, h, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1),
    above(level, i, n, h) AS (
        SELECT 0, i, n, h FROM groups
        UNION ALL
        SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i)) FROM above WHERE n > 1 GROUP BY level, i // 8, n),
    way AS (
        SELECT r, 0 AS phase, level, lang, i // (8 ** level)::BIGINT AS place
        FROM (SELECT l.r, l.lang, l.i, u.level FROM leaves l JOIN (SELECT DISTINCT lang, level FROM up WHERE n > 1) u
              ON l.lang IS NOT DISTINCT FROM u.lang)
        UNION ALL
        SELECT l.r, 1, a.level, NULL, g.i // (8 ** a.level)::BIGINT
        FROM leaves l JOIN groups g ON l.lang IS NOT DISTINCT FROM g.lang
        CROSS JOIN (SELECT DISTINCT level FROM above WHERE n > 1) a),
    nodes AS (SELECT 0 AS phase, level, lang, i, h FROM up WHERE n > 1 UNION ALL SELECT 1, level, NULL, i, h FROM above WHERE n > 1),
    steps AS (
        SELECT w.r, row_number() OVER (PARTITION BY w.r ORDER BY w.phase, w.level) AS step,
               coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i < w.place), '') AS l,
               coalesce(string_agg(x.h, '' ORDER BY x.i) FILTER (x.i > w.place), '') AS r_
        FROM way w JOIN nodes x
        ON w.phase = x.phase AND w.level = x.level AND w.lang IS NOT DISTINCT FROM x.lang AND w.place // 8 = x.i // 8
        GROUP BY w.r, w.phase, w.level),
    folds(r, step, h) AS (
        SELECT r, 0, given FROM leaves
        UNION ALL
        SELECT f.r, f.step + 1, sha256(s.l || f.h || s.r_) FROM folds f JOIN steps s ON f.r = s.r AND s.step = f.step + 1),
    proofs AS (SELECT r, sha256(string_agg(l || r_, '' ORDER BY step)) AS proof FROM steps GROUP BY r),
    folded AS (SELECT r, arg_max(h, step) AS h FROM folds GROUP BY r),
    root AS (SELECT h FROM above WHERE n = 1)
    SELECT doc_id, leaf, g.h AS subroot, root.h AS root, coalesce(proof, sha256('')) AS proof_sha256,
           folded.h AS folded_root, folded.h = root.h AS verified
    FROM leaves l JOIN groups g ON l.lang IS NOT DISTINCT FROM g.lang CROSS JOIN root
    JOIN folded USING (r) LEFT JOIN proofs USING (r)
"""


def _rounds() -> str:
    apart = "list_sum([(c.v[k] - b.v[k]) * (c.v[k] - b.v[k]) for k in range(1, len(c.v) + 1)])"
    out = []
    for k in range(3):
        out.append(
            f"near{k} AS (SELECT c.r, c.part, min({{'d': {apart}, 'e': b.entry}}) AS m "
            f"FROM cut c JOIN book{k} b USING (part) GROUP BY c.r, c.part)"
        )
        if k < 2:
            out.append(
                f"sums{k} AS (SELECT part, m.e AS entry, place, floor(sum(x) / count(*))::BIGINT AS x FROM (SELECT n.part, n.m, "
                f"unnest(c.v) AS x, unnest(range(len(c.v))) AS place FROM near{k} n JOIN cut c USING (r, part)) GROUP BY part, m.e, place), "
                f"book{k + 1} AS (SELECT part, entry, coalesce(s.v, b.v) AS v FROM book{k} b LEFT JOIN "
                f"(SELECT part, entry, list(x ORDER BY place) AS v FROM sums{k} GROUP BY part, entry) s USING (part, entry))"
            )
    return ", ".join(out)


SQL["op13_vector_codes"] = f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS r, vec_id, label, [floor(x::DOUBLE * 256)::BIGINT for x in embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cut AS (
        SELECT r, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS v
        FROM (SELECT r, v, unnest(range(16)) AS part FROM kept)),
    book0 AS (SELECT part, r AS entry, v FROM cut WHERE r < 64),
    {_rounds()},
    told AS (SELECT r, string_agg(format('{{:02x}}', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM near2 GROUP BY r),
    books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS sha FROM book2)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256
    FROM kept JOIN told USING (r) CROSS JOIN books
"""


def _run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return QUERIES[name](spark, sf_dir.rstrip("/"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: partial(_run, name) for name in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

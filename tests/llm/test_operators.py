"""Each operator against brute force: on the small test tables, and on rows made to be awkward."""

import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from tests.conftest import SMALL
from tests.llm import brute
from tidemark.llm import bpe, counts, exact, graph, minhash, mixing, pii, quality, suffix, vectors, warc
from tidemark.llm.queries import BYTE_BPE, PIECES, oracle_sql, queries

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "One two three"),
    (6, "one TWO three"),
    (7, "É é ÀB àb ñ"),
    (8, "é é Àb àb ñ"),
    (9, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 40),
    (10, "x" * 70_000),
    (11, "<|endoftext|>a<|endoftext|><|endoftext|> b"),
    (12, "line one\r\nline two\x0bthree\x0cfour  five six"),
    (13, "日本語 🙂 '' 're ''s 12345   \n\n  x" * 3),
    (14, "mail a.b@c.de, and @x.y z@q +1 (555) 010-2030 1.2.3.4.5.6.7.8.9 4111 1111 1111 1111 999.1.1.1"),
    (15, "0" * 20_000 + "." + "1." * 500 + "+" + "(" * 2_000 + "a" * 5_000 + "@"),
    (16, "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"),
]
AWKWARD += [(20 + k, "one long copied line of words that is the same in all of these rows and goes on") for k in range(60)]
AWKWARD += [(100 + k, " ".join(f"w{j}" if j != k else "changed" for j in range(100))) for k in range(12)]
AWKWARD += [(200, "one"), (200, "one"), (201, AWKWARD[8][1]), (202, AWKWARD[9][1])]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def small(spark, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SMALL}/{name}.parquet").select(*columns).collect()]


def run(spark, name):
    return queries()[name](spark, SMALL)


def test_bpe_small(spark):
    assert rows(run(spark, "op1_bpe_codec")) == sorted(brute.bpe(small(spark, "documents", "doc_id", "text")), key=str)


@pytest.mark.parametrize("leaf", [7, 16_384])
def test_bpe_awkward(documents, leaf):
    few = [r for r in AWKWARD if leaf > 100 or len(r[1] or "") < 3_000]
    assert rows(bpe.digests(documents(few), BYTE_BPE, leaf_chars=leaf)) == sorted(brute.bpe(few), key=str)


def test_bpe_tree_is_exact():
    c, rnd = bpe.codec(BYTE_BPE), random.Random(5)
    parts = ["abc", "aaaa", "'", "'s", " ", "  ", "\n", "1", "!!", "ü", "日本", "the", " the", "\r\n", "'re", "...", "🙂"]
    for _ in range(300):
        text = "".join(rnd.choice(parts) * rnd.choice([1, 1, 30]) for _ in range(rnd.randint(1, 60)))
        cut = rnd.choice([1, 3, 16, 50])
        pieces = [bpe.Piece.of(c, text[i : i + cut].encode()) for i in range(0, len(text), cut)]
        joined = bpe.join_all(c, pieces, rnd.choice([1, 2, 16]))
        assert joined.ids.tolist() == c.plain(text).tolist() and joined.words.tolist() == c.word_starts(text).tolist()


def test_bpe_decode_of_any_ids(spark):
    t = Tokenizer.from_file(BYTE_BPE)
    lists = [[], [50256], list(range(0, 400, 3)), [220, 50256, 9], None]
    df = spark.createDataFrame([(i, x, "y") for i, x in enumerate(lists)], "doc_id long, ids array<int>, decoded string")
    told = {r["doc_id"]: r["decoded"] for r in bpe.decode(df, BYTE_BPE).collect()}
    assert told == {i: None if x is None else t.decode(x, skip_special_tokens=False) for i, x in enumerate(lists)}


def test_near_duplicates_small(spark):
    assert rows(run(spark, "op2_minhash_dedup")) == sorted(brute.near(small(spark, "documents", "doc_id", "text"), 4), key=str)


def test_near_copies_meet_in_small_blocks_of_sets(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SETS", 7)
    rnd = random.Random(5)
    base = [f"b{j}" for j in range(50)]
    made = []
    for k in range(120):  # one bucket in most bands, many pairs near the threshold
        w = list(base)
        for _ in range(rnd.randint(1, 3)):
            w[rnd.randrange(50)] = f"z{rnd.randrange(10**6)}"
        made.append((k, " ".join(w)))
    assert rows(minhash.near_duplicates(documents(made), size=4)) == sorted(brute.near(made, 4), key=str)


def test_near_duplicates_awkward(documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 5)
    rnd = random.Random(3)
    base = [f"b{j}" for j in range(60)]
    made = [r for r in AWKWARD if r[0] != 200]
    for k in range(40):  # one hub, whose variants are often too far from one another
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(60)] = f"z{rnd.randrange(10**6)}"
        made.append((300 + k, " ".join(w)))
    assert rows(minhash.near_duplicates(documents(made), size=4)) == sorted(brute.near(made, 4), key=str)


def test_odd_sketches_estimate_similarity():
    rng = np.random.default_rng(7)
    sampler = minhash.Sampler(32, 4, 512)
    found = []
    for _ in range(100):
        both, a, b = (rng.integers(0, 2**64, n, dtype=np.uint64) for n in (800, 100, 100))
        sets = [np.unique(np.concatenate([both, x])) for x in (a, b)]
        x, y = sampler.sketches(sampler.samples(sets))
        z = sum(int(v).bit_count() for v in x ^ y)
        found.append(1 + 512 / (4 * 128) * math.log(1 - 2 * z / 512))
    assert abs(np.mean(found) - 0.8) < 0.02 and np.std(found) < 0.06
    assert minhash.differing_bits(1.0, 128, 512) == 0


def test_components_of_chain_star_and_loop(spark):
    edges = [(k, k + 1) for k in range(200)] + [(1000, k) for k in range(1001, 1300)] + [(2000, 2000), (None, 5)]
    got = rows(graph.components(spark.createDataFrame(edges, "a long, b long")))
    want = [(k, 0) for k in range(201)] + [(k, 1000) for k in range(1000, 1300)] + [(2000, 2000)]
    assert got == sorted(want, key=str)


def test_exact_small(spark):
    assert rows(run(spark, "op3_exact_dedup")) == sorted(brute.exact(small(spark, "documents", "doc_id", "text")), key=str)


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_exact_awkward_over_many_partitions(spark, documents, parts):
    """A group of copies that covers whole partitions is put together again."""
    few = [r for r in AWKWARD if r[0] != 200]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert rows(exact.exact_groups(documents(few))) == sorted(brute.exact(few), key=str)
        twice = [r[:4] for r in rows(exact.exact_groups(documents([(1, "a"), (1, "A"), (None, "a"), (None, "b")])))]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(twice, key=str) == sorted([(1, 1, 3, False), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True)], key=str)


def test_scores_small(spark):
    folder = SMALL.replace("0.001", "0.01")  # too few texts are no corpus
    got = sorted(tuple(r) for r in queries()["op4_suffix_lm"](spark, folder).collect())
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    want = sorted(brute.base_scores(map(tuple, docs.collect())))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, want, strict=True))
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held) and all(r[6] < 0 for r in got)


def scored(told):
    return sorted(((r.doc_id, r.score) for r in told.collect()), key=str)


@pytest.mark.parametrize("depth,min_count,min_bits,hot_grams,buckets", [(6, 4, 8.0, 10**6, None), (6, 2, 1.0, 0, 7), (4, 4, 8.0, 50, 1), (3, 3, 2.0, 10**6, 3), (2, 2, 0.0, 0, 5)])
def test_suffix_tree_by_brute_force(documents, depth, min_count, min_bits, hot_grams, buckets):
    """Counts, divergence test, suffixes of retained contexts, smoothing and the start of a text, whether grams are sent
    to the tasks or joined, and wherever they are counted."""
    texts = [(i, t) for i, t in AWKWARD if len(t or "") < 3_000]
    want, kept = brute.suffix_scores(texts, depth, min_count, min_bits)
    got = scored(suffix.score(documents(texts), depth, min_count, min_bits, hot=20, hot_grams=hot_grams, buckets=buckets))
    assert [r[0] for r in got] == [r[0] for r in sorted(want, key=str)]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert math.isclose(a[1], b[1], rel_tol=1e-9), (a, b)
    assert depth < 4 or any(len(c) > 2 for c in kept)


def test_retained_contexts_are_those_of_the_definition():
    texts = [(i, t) for i, t in AWKWARD if len(t or "") < 3_000]
    _, kept = brute.suffix_scores(texts, 6, 4, 8.0)
    train = [suffix.symbols(suffix.words((t or "").encode())) for i, t in texts if zlib.crc32(str(i).encode()) % 10]
    codes, n = np.unique(suffix._grams(train, 6), return_counts=True)
    start = suffix.roots(*suffix._summed(suffix._tail(codes, 3), n), 2, 4)
    _, found = suffix.learned(codes, n, 6, start, 4, 8.0)
    got = {int(c).to_bytes(8, "big")[8 - k :] for k, level in enumerate(found, start=3) for c in level.tolist()}
    assert got == {c for c in kept if len(c) > 2} and len(got) > 50


def test_what_is_learned_grows_with_the_corpus(documents):
    """Ten times the sources retain more contexts: none is measured by its share of the corpus."""
    rng = random.Random(8)
    sources = [[f"{''.join(rng.choice('abcdefghij') for _ in range(8))}" for _ in range(30)] for _ in range(20)]
    texts = [(k, " ".join(rng.choice(sources[k // 10]) for _ in range(80))) for k in range(200)]
    sizes = [sum(len(c) > 4 for c in brute.suffix_scores(texts[:n], 6, 4, 8.0)[1]) for n in (20, 200)]
    assert sizes[1] > 5 * sizes[0] > 0
    some = brute.suffix_scores(texts, 6, 4, 8.0)[0]
    got = scored(suffix.score(documents(texts)))
    assert all(math.isclose(a[1], b[1], rel_tol=1e-9) for a, b in zip(sorted(got), sorted(some), strict=True))


def test_scores_awkward(documents):
    got = sorted(tuple(r) for r in suffix.score(documents([r for r in AWKWARD if r[0] != 200]), hot=5).collect())
    want = sorted(brute.base_scores([r for r in AWKWARD if r[0] != 200]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, want, strict=True))


def test_retained_contexts_do_not_depend_on_the_share():
    """A small source's contexts stay when the corpus grows around it, and more text gives more contexts."""
    small = [(i, "kabm rabn") for i in range(1, 40)]
    other = [(i, " ".join(f"{chr(97 + (i * j) % 23)}{i * j % 89}" for j in range(300))) for i in range(100, 400)]

    def contexts(rows):
        codes, n = np.unique(suffix._grams([brute.spelled(t) for _, t in rows], 4), return_counts=True)
        start = suffix.roots(*suffix._summed(suffix._tail(codes, 3), n), 2, 10)
        return set(suffix.learned(codes, n, 4, start, 10, 20)[1][0].tolist())

    alone, among = contexts(small), contexts(small + other)
    assert int.from_bytes(b"kab") in alone and int.from_bytes(b"kab") in among
    assert len(among) > 5 * len(alone)


def test_token_counts(spark, documents):
    vocab = counts.vocabulary(PIECES)
    real = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=True))

    def want(text):
        return len(real.encode(counts.SPACE + text.replace(" ", counts.SPACE), add_special_tokens=False).ids) if text else 0

    few = [r for r in AWKWARD if len(r[1] or "") < 20_000]
    got = [r[:2] for r in rows(counts.token_counts(documents(few), PIECES))]
    assert got == sorted([(i, want(t or "")) for i, t in few], key=str)
    told = {r["doc_id"]: r["n_tokens"] for r in run(spark, "op5_token_counts").collect()}
    assert told == {i: want(t) for i, t in small(spark, "documents", "doc_id", "text")}


def test_token_count_ties_with_fractional_scores():
    rnd = random.Random(2)
    vocab = [("<unk>", 0.0)] + [(p, rnd.choice([-1.0, -1.5, -2.0, -3.0])) for p in ("a", "b", "ab", "ba", "aab", "bb", "▁", "▁a", "a▁b", "abab")]
    real, c = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=False)), counts.Counter(vocab)
    for _ in range(500):
        text = "".join(rnd.choice("ab ") for _ in range(rnd.randint(1, 30)))
        marked = "▁" + text.replace(" ", "▁")
        assert c.count(text)[0] == len(real.encode(marked, add_special_tokens=False).ids)


def test_warc_small(spark):
    assert rows(run(spark, "op6_warc_revisits")) == sorted(brute.warc(small(spark, "pages", "page_id", "html")), key=str)


def test_warc_awkward(spark):
    pages = [(i, t) for i, t in AWKWARD if i != 200] + [(-5, "one"), (900, "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n</p>")]
    df = spark.createDataFrame([(i, None if i % 2 else f"http://x/\r\n{i}", t, 1) for i, t in pages], "page_id long, url string, html string, sha int")
    assert rows(warc.archived(df.repartition(4))) == sorted(brute.warc(pages), key=str)
    large = {r["page_id"]: r["record_type"] for r in warc.archived(df, min_bytes=50).collect()}
    assert large[-5] == large[4] == "response" and large[20] == "revisit"
    odd = spark.createDataFrame([(None, "u", "z"), (None, "u", "z"), (1, "u", "q"), (1, "u", "q")], "page_id long, url string, html string")
    assert [r[3] for r in rows(warc.archived(odd))] == ["response"] * 4


def test_warc_rejects_cut_and_damaged_archives():
    import io

    whole = warc.record("response", "1", "u", b"abc", warc.digest(b"abc"), None, "2024-01-01T00:00:00Z")
    assert len(list(warc.parse(io.BytesIO(whole * 2)))) == 2
    with pytest.raises(ValueError):
        list(warc.parse(io.BytesIO(whole[:-8])))


def test_personal_data_small(spark):
    got, want = rows(run(spark, "op7_personal_data")), sorted(brute.personal(small(spark, "documents", "doc_id", "text")), key=str)
    assert [r[:6] for r in got] == [r[:6] for r in want]
    assert all(set(b[6].split(",")) <= set(a[6].split(",")) for a, b in zip(got, want, strict=True))


def test_personal_data_awkward(documents):
    few = [r for r in AWKWARD if r[0] not in (10, 15)]
    rnd = random.Random(4)
    few += [(400 + k, "".join(rnd.choice("a1.@+-( )25") for _ in range(80))) for k in range(200)]
    got = rows(pii.span_digests(pii.personal_data(documents(few))))
    assert [r[:6] for r in got] == [r[:6] for r in sorted(brute.personal(few), key=str)]
    assert len(pii.personal_data(documents([AWKWARD[14], AWKWARD[9]])).collect()) == 2  # in linear time


def test_personal_data_learns_contexts(documents):
    """A context that leads to seeds leads to another spelling; one that mostly leads elsewhere does not."""
    made = [(k, f"w{k} please write to: person{k}@mail{k}.org thanks") for k in range(8)]
    made += [(20, "please write to: someone (at) place (dot) org thanks"), (21, "they sat on someone (at) place (dot) org")]
    made += [(30 + k, f"on w{k}") for k in range(9)]
    spans = {r["doc_id"]: [s["base"] for s in r["spans"]] for r in pii.personal_data(documents(made)).collect()}
    assert all(spans[k] == [True] for k in range(8)) and spans[20] == [False] and spans[21] == []


def test_mixing(spark, documents):
    rnd = random.Random(1)
    made = [(k, "w " * rnd.choice([0, 1, 5, 50, 400]), rnd.choice(["a", "b", "b", "b", "b", "b", "c", None])) for k in range(600)]
    made += [(1000, None, "a"), (1001, "x y", "tiny"), (1002, "", "empty")]
    got = mixing.mix(documents(made)).collect()
    assert len(got) == len(made) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    source = {r[0]: r[2] for r in made}
    for s in {"a", "b", "c", None, "tiny", "empty"}:
        own = [r for r in got if source[r["doc_id"]] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2 + 1e-6
        assert sum(r["size"] for r in own) == own[0]["source_size"] and own[0]["target"] <= 3 * own[0]["source_size"]
    targets = {source[r["doc_id"]]: r["target"] for r in got}
    assert math.isclose(sum(targets.values()), sum(r["size"] for r in got))
    assert sorted(map(tuple, got), key=str) == rows(mixing.mix(documents(made)))


def test_vectors_small(spark):
    assert rows(run(spark, "op9_near_vectors")) == sorted(brute.vectors(small(spark, "embeddings", "vec_id", "embedding")), key=str)


def test_vectors_awkward(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 7)
    rng = np.random.default_rng(2)
    hub = rng.standard_normal(16)
    made = [(k, (hub + rng.standard_normal(16) * rng.choice([0.05, 0.2, 0.3])).tolist()) for k in range(80)]
    made += [(100 + k, rng.standard_normal(16).tolist()) for k in range(100)]
    made += [(200 + k, made[3][1]) for k in range(20)] + [(300, (np.array(made[3][1]) * 4).tolist())]
    nan = float("nan")
    made += [(400, None), (401, []), (402, [0.0] * 16), (403, [1.0, None]), (404, [nan] * 16), (405, [float("inf")] * 16), (406, [1.0] * 5), (407, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "x", "y") for i, v in made], "vec_id long, embedding array<double>, label string, rep string")
    assert rows(vectors.near_vectors(df.repartition(3))) == sorted(brute.vectors(made), key=str)


def test_ids_with_several_vectors_lose_no_link(spark):
    """An id that is the smallest of two classes: each keeps its own links and component."""
    a, b = [1.0, 0.0, 0.2], [0.0, 1.0, -0.3]
    near = lambda v: [x + 0.001 for x in v]
    data = [(1, a), (1, b), (2, a), (3, b), (4, near(a)), (5, near(b)), (1, a), (6, [0.0, 0.0, 1.0])]
    got = rows(vectors.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<double>")))
    two, three = (1, 2, 1, True), (2, 2, 1, False)
    assert got == sorted([two, two, two, three, (3, 2, 1, False), (4, 2, 1, False), (5, 2, 1, False), (6, 0, 6, True)], key=str)


def test_vector_plan_keeps_recall():
    for n in (10, 10**5, 10**9):
        bits, tables = vectors.plan(n, 0.95)
        assert (1 - (1 - math.acos(0.95) / math.pi) ** bits) ** tables <= 1.01e-5


def test_quality(spark):
    told = {r["doc_id"]: r for r in run(spark, "op10_cotrained_quality").collect()}
    assert len(told) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    labels = small(spark, "labels", "doc_id", "quality")
    assert np.mean([told[i]["kept"] == bool(q) for i, q in labels if i in told]) > 0.9


def test_quality_held_out_accuracy(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), quality.read_labels(spark, folder)
    model = quality.fit(docs, labels)
    assert model.accuracy > 0.97


def test_quality_awkward(spark, documents):
    docs = documents(AWKWARD)
    none = spark.createDataFrame([(1, None), (None, 1), (7, 1), (8, 1)], "doc_id long, quality int")
    assert all(r["kept"] and r["quality"] is None for r in quality.classify(docs, none).collect())
    some = spark.createDataFrame([(i, i % 2) for i, _ in AWKWARD] + [(9, 0), (9, 1)], "doc_id long, quality int")
    assert quality.classify(docs, some).count() == len(AWKWARD)
    assert quality.good(docs, quality.fit(docs, some)).columns == docs.columns


def test_no_rows(spark, documents):
    docs = documents(AWKWARD[:3]).where("false")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    embeddings = spark.createDataFrame([], "vec_id long, embedding array<float>")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for made in (
        bpe.digests(docs, BYTE_BPE), minhash.near_duplicates(docs), exact.exact_groups(docs), suffix.score(docs),
        counts.token_counts(docs, PIECES), warc.archived(pages), pii.span_digests(pii.personal_data(docs)),
        mixing.mix(docs), vectors.near_vectors(embeddings), quality.classify(docs, labels),
    ):
        assert made.collect() == []


def test_null_ids(spark, documents):
    docs = documents([(None, "some words here and there"), (None, None), (1, "some words here and there")])
    assert bpe.digests(docs, BYTE_BPE).count() == 3 and suffix.score(docs).count() == 3
    assert [(r[0], r[2], r[3]) for r in rows(minhash.near_duplicates(docs))] == [(1, 1, True), (None, None, True), (None, None, True)]
    assert mixing.mix(docs).count() == 3 and pii.personal_data(docs).count() == 3


def test_sql_twins_exist():
    assert set(oracle_sql()) <= set(queries())

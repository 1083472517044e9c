"""The pipeline against the same steps by brute force."""

from collections import Counter

from tests.conftest import SMALL
from tests.llm import brute
from tests.llm.test_operators import AWKWARD
from tidemark.llm import quality
from tidemark.llm.queries import BYTE_BPE

import corpus_pipeline
from tokenizers import Tokenizer


def test_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    at = docs
    kept = dict.fromkeys(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, at, SMALL)
        assert out.columns == docs.columns
        ids = Counter(r["doc_id"] for r in out.collect())
        pairs = [(i, rows[i]["text"]) for i in kept]
        if name == "classify_quality":
            told = quality.classify(at, quality.read_labels(spark, SMALL)).where("kept").collect()
            want = {r["doc_id"] for r in told}
        elif name == "drop_copies":
            want = {r[0] for r in brute.exact(pairs) if r[3]}
        elif name == "drop_near_copies":
            want = {r[0] for r in brute.near(pairs, corpus_pipeline.SHINGLE) if r[3]}
        else:
            want = set(ids)
            assert max(ids.values()) <= 3 and set(ids) <= set(kept)
        assert set(ids) == want, name
        if name != "mix_sources":
            assert set(ids.values()) == {1}
        kept = dict.fromkeys(sorted(ids))
        at = spark.createDataFrame([tuple(rows[i]) for i in ids.elements()], docs.schema)
    t = Tokenizer.from_file(BYTE_BPE)
    for r in corpus_pipeline.encode_texts(spark, at, SMALL).collect():
        text = rows[r["doc_id"]]["text"]
        assert r["ids"] == t.encode(text, add_special_tokens=False).ids and r["n_tokens"] == len(r["ids"])
        assert r["decoded_sha256"] == brute.hexed(text)


def test_run_repeats(spark):
    first = [sorted(map(str, corpus_pipeline.run(spark, SMALL).collect())) for _ in range(2)]
    assert first[0] == first[1] and first[0]


def test_stages_on_awkward_rows(spark, documents):
    docs = documents([*AWKWARD, (None, "no id"), (None, None)])
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SMALL)
        out.collect()
        if stage is not corpus_pipeline.STAGES[-1][1]:
            assert out.columns == docs.columns
    left = corpus_pipeline.drop_copies(spark, docs, SMALL).collect()
    assert Counter(r["doc_id"] for r in left)[200] <= 1
    assert [stage(spark, docs.where("false"), SMALL).count() for _, stage in corpus_pipeline.STAGES] == [0] * 5

"""Decontamination, Merkle manifest and vector codes against brute force: small tables and awkward rows."""

import math
import random

import numpy as np
import pytest

from tests.conftest import plan_of
from tests.llm import brute
from tests.llm.test_operators import rows, run, small
from tidemark.llm import codes, decontam, merkle
from tidemark.llm.queries import oracle_sql

FIELDS = "doc_id long, source string, lang string, n_chars long, text string"
CLASHING = ("id", "at", "doc", "words", "shingle", "group", "key", "hash", "row", "rank", "n", "i", "path", "label2", "code", "cut", "error")


def clashing(df):
    return df.selectExpr("*", *(f"'x' AS `{c}`" for c in CLASHING)).repartition(3)


def ordered(told):
    return sorted((tuple(r) for r in told), key=str)


# ---- benchmark decontamination


def test_decontamination_small(spark):
    want = brute.contaminated(small(spark, "documents", "doc_id", "text"), small(spark, "benchmark", "item_id", "text"))
    got = rows(run(spark, "op11_benchmark_decontamination"))
    assert got == ordered(want)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def awkward_items():
    rng = random.Random(3)
    some = [f"w{k}" for k in range(40)]
    long = " ".join(rng.choice(some) for _ in range(200))
    items = [
        (1, None), (2, ""), (3, " .,!"), (4, "Lone"), (5, "two words"), (6, "a b c d e"), (7, "a b c d e f"),
        (8, "one two three four five six seven eight nine"), (9, "x " * 30), (10, long), (10, "same id other text"),
        (11, "ÀB cd Éf 日本 x1 a b c d e f g"), (12, "a b c d e"), (None, "no id at all"), (13, "Z" * 5_000),
        (14, "p q p q p q p q p q p q"),
    ]
    return items, long


def test_decontamination_awkward(spark):
    items, long = awkward_items()
    w = long.split()
    texts = [
        None, "", " \t.", "lone", "LONE lone-lone", "two  WORDS two", "a b c d e f", "b c d e", "x " * 9, "x " * 500, long, long.upper(),
        " ".join(w[5:15]), " ".join(w[5:14]), " ".join(w[:30] + ["gap"] + w[30:60]), "Àb CD Éf 日本 X1 a,b;c.d e f-g", "àb cd éf 日本 x1 a b c d",
        "one two three four five six seven eight nine ten", "one two three four five six seven eight", "same id other text no id at all",
        "z" * 5_000, "q p q p q p q p q p q p q", ("filler " * 50 + long + " ") * 20, "nothing of these",
    ]
    docs = [(k, t) for k, t in enumerate(texts)] + [(3, "lone"), (3, "lone"), (None, "two words"), (10, "other")]
    frame = clashing(spark.createDataFrame(docs, "doc_id long, text string"))
    for part in (items, items[9:10], items[3:4]):
        bench = spark.createDataFrame(part, "item_id long, text string").selectExpr("*", "'x' AS id", "'x' AS words", "'x' AS at").repartition(4)
        assert rows(decontam.contaminated(frame, bench)) == ordered(brute.contaminated(docs, part))


def test_decontamination_of_copies_and_common_passages(spark):
    """Half of the documents hold one passage, and many items share it; a few-word vocabulary repeats shingles."""
    rng = random.Random(5)
    word = lambda: rng.choice("abcd")
    passage = " ".join(f"p{k}" for k in range(30))
    items = [(k, passage + f" tail{k}") for k in range(40)] + [(100 + k, " ".join(word() for _ in range(14))) for k in range(60)]
    docs = [(k, " ".join(word() for _ in range(300)) + (f" {passage} " if k % 2 else " ") + "end") for k in range(60)]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == ordered(brute.contaminated(docs, items))


def test_decontamination_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(decontam, "hint_if_counted", lambda df, *_: df.hint("merge"))
    items, long = awkward_items()
    docs = [(k, t) for k, (_, t) in enumerate(items)] + [(99, long * 2)]
    got = decontam.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert rows(got) == ordered(brute.contaminated(docs, items))


def test_decontamination_is_native(spark):
    plan = plan_of(run(spark, "op11_benchmark_decontamination"))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_decontamination_of_nothing(spark):
    no_docs, no_items = (spark.createDataFrame([], f"{k} long, text string") for k in ("doc_id", "item_id"))
    one = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert decontam.contaminated(no_docs, no_items).collect() == []
    assert rows(decontam.contaminated(one, no_items)) == ordered(brute.contaminated([(1, "a b c")], []))


# ---- Merkle manifest


def test_manifest_small(spark):
    want = brute.merkle(small(spark, "documents", *merkle.FIELDS))
    got = rows(run(spark, "op12_merkle_manifest"))
    assert got == ordered(want)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


@pytest.mark.parametrize("fanout", [2, 3, 8])
def test_manifest_awkward(spark, fanout):
    rng = random.Random(1)
    langs = [None, "", "de", "z", "É", "日本", "a", "B", "-"]
    docs = [(k, rng.choice([None, "s", ""]), "en", rng.choice([None, 0, -5]), rng.choice([None, "", "Text", "É Y", "x" * 20_000])) for k in range(130)]
    docs += [(1_000 + 7 * k, "s", g, 1, f"T{k}") for k, g in enumerate(langs * 3)] + [(5_000, "s", "lone", 1, "A")]
    docs += [(7, "s", "de", 1, "same"), (7, "s", "de", 1, "same"), (7, "t", "de", 1, "other"), (None, None, None, None, None), (None, "s", "en", 2, "UP")]
    frame = clashing(spark.createDataFrame(docs, FIELDS))
    assert rows(merkle.manifest(frame, fanout=fanout)) == ordered(brute.merkle(docs, fanout))


@pytest.mark.parametrize("n", [0, 1, 8, 9, 64, 65])
def test_manifest_of_one_group(spark, n):
    docs = [(k, "s", "en", k, f"Text {k}") for k in range(n)]
    assert rows(merkle.manifest(spark.createDataFrame(docs, FIELDS))) == ordered(brute.merkle(docs))


def test_proofs_tell_a_changed_row(spark):
    """A proof that a reader checks by himself: the root from one row and its siblings alone, and another after a change."""
    docs = [(k, "s", "en", 4, f"t {k}") for k in range(100)]
    told = {r.doc_id: r for r in merkle.manifest(spark.createDataFrame(docs, FIELDS)).collect()}
    assert all(r.verified for r in told.values())  # lower case already: nothing is altered
    docs[40] = (40, "s", "en", 4, "t changed")
    again = {r.doc_id: r for r in merkle.manifest(spark.createDataFrame(docs, FIELDS)).collect()}
    assert again[0].root != told[0].root
    assert [k for k in told if again[k].leaf != told[k].leaf] == [40]
    assert again[40].proof_sha256 == told[40].proof_sha256


# ---- vector codes


def test_codes_small(spark):
    want = brute.codes(small(spark, "embeddings", "vec_id", "embedding", "label"))
    assert rows(run(spark, "op13_vector_codes")) == ordered(want)


@pytest.mark.parametrize("width,n", [(64, 150), (16, 40), (20, 70), (5, 10)])
def test_codes_awkward(spark, width, n):
    rng = np.random.default_rng(width)
    data = [(k, (rng.integers(-3, 4, width) / 128).tolist(), [None, 0, 1][k % 3]) for k in range(n)]  # many ties
    data += [(500, None, 1), (501, [], None), (502, [None] * width, 0), (503, [math.nan] * width, 0), (504, [math.inf] * width, None)]
    data += [(505, [1e30] * width, 0), (506, [1.0] * (width + 1), 0), (3, data[3][1], 0), (3, data[4][1], 0), (None, [0.5] * width, 7)]
    data += [(600 + k, [0.25] * width, 0) for k in range(60)]
    frame = clashing(spark.createDataFrame(data, "vec_id long, embedding array<double>, label int"))
    assert rows(codes.compressed(frame)) == ordered(brute.codes(data))


def test_codes_of_nothing(spark):
    nothing = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert codes.compressed(nothing).collect() == []
    assert codes.compressed(spark.createDataFrame([(1, None, 2)], nothing.schema)).collect() == []


def test_orchard_visits_few_and_finds_the_nearest():
    rng = np.random.default_rng(2)
    books = rng.integers(-40, 40, (3, 64, 4))
    cut = rng.integers(-60, 60, (500, 3, 4))
    own, far = codes.Orchard(books).nearest(cut)
    every = ((cut[:, :, None, :] - books[None]) ** 2).sum(axis=3)
    assert (own == every.argmin(axis=2)).all() and (far == every.min(axis=2)).all()


def test_new_queries_have_twins():
    assert {"op11_benchmark_decontamination", "op12_merkle_manifest", "op13_vector_codes"} <= set(oracle_sql())

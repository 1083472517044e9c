import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents of ``(doc_id, text)`` or ``(doc_id, text, source)`` rows, with columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA)
        extra = ("ids", "n", "row", "rep", "key", "kept", "size", "word", "part", "run", "copies", "hash", "label", "node")
        return df.selectExpr("*", *(f"'x' as {c}" for c in extra)).repartition(3)

    return make

"""Quality classifier by co-training: a view of the text and a view of the metadata teach each other."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidemark.llm.common import map_batches, same_type, stored

# Labelled rows that the classifiers are fitted on at most, chosen by a hash of the id. Half of the labelled rows of
# this sample fit the views, a quarter calibrates them, and a quarter is left for reporting accuracy.
LABELLED = 20_000

# Rounds of co-training, and pseudo-labels that a view gives the other per class and round, at most.
ROUNDS, GIVEN = 3, 1_000

# A view is confident above this probability of a class.
CONFIDENT = 0.98

# Documents below this probability of being good are rejected.
KEEP_FROM = 0.5

# Cells of the metadata view for the hash of the source and of the language.
SOURCE_CELLS, LANG_CELLS = 32, 8

_LETTERS = np.zeros(256, np.int64)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def text_view(text: str) -> list[float]:
    """Shares and rates that do not depend on the language: how letters, capitals, digits, marks and lines are spread,
    and how much a text repeats itself."""
    data = text.encode()
    found = text.split()
    n, k = max(len(data), 1), max(len(found), 1)
    of = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    letters = max(int(of @ _LETTERS), 1)
    marks = int(of[33:48].sum() + of[58:65].sum() + of[91:97].sum() + of[123:127].sum())
    plain = int(of[44] + of[46] + of[39] + of[45])
    lines = text.split("\n")
    repeats = sum(a == b for a, b in zip(found, found[1:], strict=False)) / k
    shares = [
        int(of[65:91].sum()) / letters,
        int(of[48:58].sum()) / n,
        (marks - plain) / n,
        plain / n,
        repeats,
        1 - len(set(found)) / k,
        1 - len(set(lines)) / len(lines),
        letters / n,
    ]
    sizes = [np.log1p(n), np.log1p(k), n / k if found else 0.0, np.log1p(max(map(len, found), default=0))]
    # Roots open up the small shares, in which good and bad texts differ most.
    return [*shares, *(s**0.5 if s > 0 else 0.0 for s in shares), *sizes, sizes[0] ** 2, float(not found)]


def metadata_view(source: str | None, lang: str | None, n_chars: int | None) -> list[float]:
    """What is known of a document without its text: hashed source and language, and the noted length."""
    out = [0.0] * (SOURCE_CELLS + LANG_CELLS + 3)
    out[_cell(source, SOURCE_CELLS)] = 1.0
    out[SOURCE_CELLS + _cell(lang, LANG_CELLS)] = 1.0
    size = np.log1p(max(n_chars, 0)) if n_chars is not None else 0.0
    out[-3:] = [size, size**2 / 10, float(n_chars is None)]
    return out


def _cell(value: str | None, cells: int) -> int:
    import zlib

    return zlib.crc32(("" if value is None else str(value)).encode()) % cells


@dataclass
class Logistic:
    """A logistic regression on scaled features."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray

    @staticmethod
    def fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 25) -> Logistic:
        """Newton's method with an L2 penalty; the intercept is the log odds alone if there is one class."""
        mean, scale = x.mean(axis=0), x.std(axis=0)
        scale[scale < 1e-9] = 1.0
        z = np.c_[np.ones(len(x)), (x - mean) / scale]
        w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], penalty)
        ridge[0] = 1e-3
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            gradient = z.T @ (p - y) + ridge * w
            hessian = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(ridge)
            move = np.linalg.solve(hessian, gradient)
            w -= move * min(1.0, 5.0 / max(np.abs(move).max(), 1e-12))
            if np.abs(move).max() < 1e-6:
                break
        return Logistic(mean, scale, w)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(x)), (x - self.mean) / self.scale] @ self.weight


@dataclass
class Model:
    """Both views and the regression on their two logits that calibrates and combines them."""

    text: Logistic
    metadata: Logistic
    combined: Logistic
    accuracy: float | None = None

    def logits(self, text: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        return np.clip(np.c_[self.text.logit(text), self.metadata.logit(metadata)], -30, 30)

    def quality(self, logits: np.ndarray) -> np.ndarray:
        return _sigmoid(self.combined.logit(logits))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _views(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    text = [text_view(t or "") for t in batch.column("text").to_pylist()]
    facts = zip(*(batch.column(c).to_pylist() for c in ("source", "lang", "n_chars")), strict=True)
    return np.array(text), np.array([metadata_view(*f) for f in facts])


def features(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_view, metadata_view)``: some sixty numbers per document."""
    frame = docs.select("doc_id", "text", "source", "lang", "n_chars")
    view = ArrayType(DoubleType())
    schema = StructType([same_type(docs, "doc_id", "doc_id"), StructField("text_view", view), StructField("metadata_view", view)])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            columns = [pa.array(list(v), pa.list_(pa.float64())) for v in _views(batch)]
            return pa.record_batch([batch.column("doc_id"), *columns], schema.names)

        return run

    return map_batches(frame, make, schema)


def _some(frame: DataFrame, rows: int) -> pd.DataFrame:
    """``rows`` rows at most, the same in every run. What comes to the driver is cut by a hash first, as the best of
    each task would be too much where there are many tasks."""
    n = frame.count()
    if n > rows:
        frame = frame.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < 1.2 * rows / n * 1_000_003 + 8)
    return frame.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).toPandas()


def _matrix(frame: pd.DataFrame, view: str) -> np.ndarray:
    return np.stack(frame[view].to_numpy()) if len(frame) else np.empty((0, 0))


def _confident(pool: DataFrame, model: Logistic, view: str, given: int) -> tuple[pd.DataFrame, np.ndarray]:
    """Rows of the pool of whose class a view is most sure, ``given`` of each class at most, and their classes."""
    schema = StructType([*pool.schema, StructField("sure", DoubleType())])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array(batch.column(view).to_pylist())
            return pa.record_batch([*batch.columns, pa.array(_sigmoid(model.logit(x)))], schema.names)

        return run

    told = map_batches(pool, make, schema)
    parts, classes = [], []
    for y, sure in ((1, F.col("sure")), (0, 1 - F.col("sure"))):
        # Any of the sure: the surest alone are all of one kind.
        best = _some(told.where(sure >= CONFIDENT), given)
        parts.append(best)
        classes.append(np.full(len(best), y))
    return pd.concat(parts, ignore_index=True), np.concatenate(classes)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    given: int = GIVEN,
) -> Model | None:
    """Fit both views by co-training; none if the labels name no document or only one class.

    At most ``labelled`` rows are fitted on (documents whose labels contradict each other are left out). All other
    documents are the pool. In each round every view is fitted, scores the whole pool where it lies, and gives the
    other view up to ``given`` pseudo-labels per class among those it is sure of. Labelled rows that fitted no view
    calibrate the two logits: one regression on both is the combined classifier.
    """
    told = labels.groupBy("doc_id").agg(F.avg("quality").alias("quality")).where("quality in (0.0, 1.0)")
    rows = stored(features(docs), "features")
    named = stored(rows.join(told.hint("merge"), "doc_id"), "labelled")
    sample = _some(named, labelled)
    if len(sample) < 8 or sample["quality"].nunique() < 2:
        return None
    pool = rows.join(told.select("doc_id").hint("merge"), "doc_id", "left_anti") if rounds else rows
    pool = stored(pool, "pool")
    part = np.arange(len(sample)) % 4
    fitted, calibrating, left = sample[part < 2], sample[part == 2], sample[part == 3]
    view = {v: [_matrix(fitted, v)] for v in ("text_view", "metadata_view")}
    truth = {v: [fitted["quality"].to_numpy(float)] for v in view}
    models = {}
    for turn in range(rounds + 1):
        models = {v: Logistic.fit(np.concatenate(view[v]), np.concatenate(truth[v])) for v in view}
        if turn == rounds:
            break
        for teacher, pupil in (("text_view", "metadata_view"), ("metadata_view", "text_view")):
            taught, classes = _confident(pool, models[teacher], teacher, given)
            if len(taught):
                # A later round replaces what the teacher said before.
                view[pupil][1:], truth[pupil][1:] = [_matrix(taught, pupil)], [classes.astype(float)]
    model = Model(models["text_view"], models["metadata_view"], models["text_view"])
    both = model.logits(_matrix(calibrating, "text_view"), _matrix(calibrating, "metadata_view"))
    model.combined = Logistic.fit(both, calibrating["quality"].to_numpy(float))
    if len(left):
        said = model.quality(model.logits(_matrix(left, "text_view"), _matrix(left, "metadata_view")))
        model.accuracy = float(((said >= KEEP_FROM) == (left["quality"] == 1)).mean())
    return model


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """``(doc_id, text_score, metadata_score, quality, kept)``: each view's own probability and the combined one. The
    model is some hundred numbers; nothing is shuffled. Without model the scores are null and all is kept."""
    frame = docs.select("doc_id", "text", "source", "lang", "n_chars")
    names = ["text_score", "metadata_score", "quality"]
    schema = StructType([same_type(docs, "doc_id", "doc_id"), *(StructField(n, DoubleType()) for n in names)])

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            if model is None:
                told = [pa.nulls(batch.num_rows, pa.float64())] * 3
            else:
                logits = model.logits(*_views(batch))
                told = [*map(pa.array, _sigmoid(logits.T)), pa.array(model.quality(logits))]
            return pa.record_batch([batch.column("doc_id"), *told], schema.names)

        return run

    return map_batches(frame, make, schema).withColumn("kept", F.coalesce(F.col("quality") >= KEEP_FROM, F.lit(True)))


def good(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model keeps."""
    if model is None:
        return docs

    def make():
        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep = model.quality(model.logits(*_views(batch))) >= KEEP_FROM
            return batch.filter(pa.array(keep))

        return run

    return map_batches(docs, make, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Fit on the labels and score all documents.

    Null or empty texts are texts without words; null metadata has a cell of its own. Documents without id are scored
    like others but never labelled. Repeated rows get equal scores. Labels without document, with null or conflicting
    quality say nothing. No documents give no rows.
    """
    return scored(docs, fit(docs, labels, **options))


def read_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")

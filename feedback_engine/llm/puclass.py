"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text train a small network by the
non-negative unbiased risk (Kiryo et al., 2017) with an estimated class prior:
the risk of taking unlabelled texts for negative, less the share of it that
positives explain, is kept from falling below zero. No row is trained on as a
negative.

The fit reads bounded samples: the ``MOST_POSITIVE`` and ``MOST_UNLABELLED``
documents with the smallest hashes of their ids. Everything else covers all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import portions, remainder

MOST_POSITIVE, MOST_UNLABELLED = 20_000, 40_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
# Bytes of text that a task works on at once, if no single text has more.
PORTION = 2_000_000

FEATURES = (
    "upper", "digit", "symbol", "mark", "bar", "stop", "comma", "wide", "blank", "line",
    "word_length", "repeated", "distinct", "words",
)
# Classes of bytes, in the order of the first ten features; a byte outside ASCII is "wide".
_CLASSES = [
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*@^~<>{}[]\\=+_`", b"!?", b"|", b".;:", b",",
    bytes(range(128, 256)), b" \t\r\x0b\x0c", b"\n",
]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _bytes in enumerate(_CLASSES):
    _CLASS_OF[list(_bytes)] = _k


def features(texts: list[str | None]) -> np.ndarray:
    """One row of ``FEATURES`` for each text: shares of bytes and of words. A blank text has zeros."""
    raw = [(text or "").encode() for text in texts]
    made = np.zeros((len(raw), len(FEATURES)), np.float32)
    for k, text in enumerate(raw):
        if not text:
            continue
        counts = np.bincount(_CLASS_OF[np.frombuffer(text, np.uint8)], minlength=len(_CLASSES) + 1)
        made[k, : len(_CLASSES)] = counts[:-1] / len(text)
        words = text.split()
        n = len(words)
        if n:
            again = sum(map(bytes.__eq__, words[:-1], words[1:]))
            made[k, len(_CLASSES) :] = (
                (len(text) - counts[8] - counts[9]) / n / 20,
                again / n,
                len(set(words)) / n,
                np.log1p(n) / 10,
            )
    made[:, : len(_CLASSES)] = np.sqrt(made[:, : len(_CLASSES)])
    return made


class Model:
    """A network of one hidden layer over scaled features; ``score`` is the chance of quality."""

    def __init__(self, size: int, hidden: int = 24, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        self.middle, self.scale = np.zeros(size), np.ones(size)
        self.weights = [
            rng.normal(0, size**-0.5, (size, hidden)), np.zeros(hidden),
            rng.normal(0, hidden**-0.5, hidden), np.zeros(1),
        ]

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._forward(self.scaled(rows))[1], -30, 30)))

    def scaled(self, rows: np.ndarray) -> np.ndarray:
        return np.clip((rows - self.middle) / self.scale, -6, 6)

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first, shift, second, base = self.weights
        hidden = np.tanh(x @ first + shift)
        return hidden, hidden @ second + base[0]

    def gradients(self, x: np.ndarray, slope: np.ndarray) -> list[np.ndarray]:
        """Gradients of the weights, ``slope`` being that of the loss by the output of each row."""
        hidden, _ = self._forward(x)
        inner = np.outer(slope, self.weights[2]) * (1 - hidden**2)
        return [x.T @ inner, inner.sum(axis=0), hidden.T @ slope, np.array([slope.sum()])]


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 60, seed: int = 0) -> Model:
    """Minimises the non-negative risk with logistic losses, by Adam over mini-batches."""
    model = Model(len(FEATURES), seed=seed)
    if not len(positive) or not len(unlabelled):
        model.weights[3][0] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        model.weights[2][:] = 0
        return model
    rows = np.concatenate((positive, unlabelled)).astype(float)
    model.middle, model.scale = rows.mean(axis=0), rows.std(axis=0) + 1e-3
    p, u = model.scaled(positive.astype(float)), model.scaled(unlabelled.astype(float))
    rng = np.random.default_rng(seed)
    first, second = ([np.zeros_like(w) for w in model.weights] for _ in range(2))
    step = 0
    batches = max(1, len(u) // 1000)
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 1e-4
        for some_p, some_u in zip(
            np.array_split(rng.permutation(len(p)), batches), np.array_split(rng.permutation(len(u)), batches)
        ):
            if not len(some_p):
                continue
            xp, xu = p[some_p], u[some_u]
            gp, gu = model._forward(xp)[1], model._forward(xu)[1]
            up, uu = 1 / (1 + np.exp(-np.clip(gp, -30, 30))), 1 / (1 + np.exp(-np.clip(gu, -30, 30)))
            as_negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            for_negative = [
                a - prior * b for a, b in zip(model.gradients(xu, uu / len(uu)), model.gradients(xp, up / len(up)))
            ]
            if as_negative >= 0:
                for_positive = model.gradients(xp, prior * (up - 1) / len(up))
                change = [a + b for a, b in zip(for_positive, for_negative)]
            else:  # below zero it is fitted to the sample: step back
                change = [-g for g in for_negative]
            step += 1
            for k, g in enumerate(change):
                g = g + 1e-4 * model.weights[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g**2
                model.weights[k] -= (
                    rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                )
    return model


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of ``labels`` (doc_id, quality) over the texts of ``docs``.

    Only ids outside the held-out fold are learned from. Positives are ids whose
    labels all say 1; the class prior is their share of the labelled ids;
    unlabelled rows are documents whatever their label. Without positives or
    documents every score is the prior (one half without any label).
    """
    fold = remainder(F.col("doc_id"), FOLDS)
    agreed = labels.where(fold != HELD_OUT).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    agreed = agreed.where("quality is not null")
    order = (F.xxhash64("doc_id"), "doc_id")
    counts = agreed.agg(F.avg((F.col("quality") == 1).cast("double")).alias("prior")).first()
    prior = 0.5 if counts["prior"] is None else float(counts["prior"])
    trusted = agreed.where("quality = 1").select("doc_id").join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    positive = trusted.orderBy(*order).limit(MOST_POSITIVE)
    web = docs.where(fold != HELD_OUT).select("doc_id").distinct().orderBy(*order).limit(MOST_UNLABELLED)
    chosen = positive.select("doc_id", F.lit(1).alias("p"), F.lit(0).alias("u")).unionAll(
        web.select("doc_id", F.lit(0), F.lit(1))
    )
    chosen = chosen.groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"))
    # Bounded by the two limits, so it can be sent to every task and the texts stay where they are.
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.select("doc_id", "p", "u", "text").mapInArrow(_measure, _MEASURED)
    # Rows that repeat an id count once.
    one = rows.groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u"), F.min("x").alias("x"))
    sample = one.orderBy("doc_id").toArrow().to_pydict()
    x = np.array(sample["x"], np.float32).reshape(-1, len(FEATURES))
    p, u = (np.array(sample[name], bool) for name in ("p", "u"))
    return fit(x[p], x[u], prior)


_MEASURED = "doc_id long, p int, u int, x array<float>"


def _measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, 3, PORTION):
        rows = features(batch.column(3).to_pylist())
        x = pa.array(list(rows), pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], x], names=["doc_id", "p", "u", "x"])


def scored(docs: DataFrame, model: Model, score_col: str = "score") -> DataFrame:
    """``docs`` with the model's score of each row's whole text. Null and empty texts get the score of a blank one."""
    at, names = docs.columns.index("text"), [*docs.columns, score_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, at, PORTION):
            made = model.score(features(batch.column(at).cast(pa.string()).to_pylist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.float64())], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{score_col}` double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; an id that is null is in no fold and never learned from."""
    made = scored(docs.select("doc_id", "text"), learn(docs, labels))
    return made.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


# A name that does not clash with columns of documents.
SCORE = "__quality_score"


def without_junk(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose score is at least ``THRESHOLD``, unchanged."""
    return scored(docs, learn(docs, labels), SCORE).where(F.col(SCORE) >= THRESHOLD).drop(SCORE)

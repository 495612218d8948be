"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its character n-grams, hashed into a
fixed number of rows, and a linear softmax over it gives the languages. Trained
by stochastic gradient descent in numpy; a temperature and a threshold for
rejection are then fitted on documents that were kept out of the descent.

The fit reads a bounded sample: the ``MOST`` documents with a language that
have the smallest hashes of their ids. Predictions cover all rows and whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import remainder

MOST = 4000
FOLDS, HELD_OUT = 4, 2
NGRAMS = (2, 3, 4)
ROWS = 1 << 16
UNKNOWN = "und"
# Bytes of text that a task works on at once, if no single text has more.
PORTION = 1_000_000
# Accuracy that the predictions which are not rejected are calibrated to.
ACCURACY = 0.99

# Bytes that are not of letters become blanks, so n-grams are of words and their ends.
_KEPT = np.full(256, 32, np.uint8)
for _byte in [*range(97, 123), *range(128, 256)]:
    _KEPT[_byte] = _byte


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the lower-cased texts, one text after the other, and where each text starts (and the last ends).

    N-grams over bytes: those within blanks are left out, those at word ends have one blank or more.
    """
    parts = [b" " + text.lower().encode() + b" " for text in texts]
    ends = np.cumsum([0, *map(len, parts)])
    data = _KEPT[np.frombuffer(b"".join(parts), np.uint8)]
    wide = np.concatenate((data, np.full(max(NGRAMS), 32, np.uint8))).astype(np.uint64)
    hashed, owners = [], []
    owner = np.repeat(np.arange(len(parts)), np.diff(ends))
    left = np.repeat(ends[1:], np.diff(ends)) - np.arange(len(data))  # bytes to the end of the text
    for n in NGRAMS:
        code = np.full(len(data), n, np.uint64)
        blank = np.ones(len(data), bool)
        for k in range(n):
            code = code << np.uint64(8) | wide[k : k + len(data)]
            blank &= wide[k : k + len(data)] == 32
        keep = ~blank & (left >= n)
        code = code[keep] * np.uint64(0x9E3779B97F4A7C15)
        hashed.append((code >> np.uint64(48)).astype(np.int32) & (ROWS - 1))
        owners.append(owner[keep])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(parts))
    return np.concatenate(hashed)[order], np.concatenate(([0], np.cumsum(counts)))


class Model:
    """Embeddings times softmax weights, folded into one table of ``ROWS`` by languages."""

    def __init__(self, languages: list[str], table: np.ndarray, base: np.ndarray, temperature=1.0, threshold=0.0) -> None:
        self.languages, self.table, self.base = languages, table.astype(np.float32), base
        self.temperature, self.threshold = temperature, threshold

    def logits(self, texts: list[str]) -> np.ndarray:
        rows, starts = ngrams(texts)
        made = np.tile(self.base, (len(texts), 1)).astype(float)
        some = np.flatnonzero(np.diff(starts))
        if len(some):
            for k in range(len(self.languages)):
                sums = np.add.reduceat(self.table[rows, k], starts[some], dtype=np.float64)
                made[some, k] += sums / np.diff(starts)[some]
        return made

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated probability of it, and whether it is rejected, of each text."""
        known = [k for k, text in enumerate(texts) if self.languages and has_letter(text)]
        languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if known:
            chances = softmax(self.logits([texts[k] for k in known]) / self.temperature)
            best = chances.argmax(axis=1)
            for k, b in zip(known, best.tolist()):
                languages[k] = self.languages[b]
            scores[known] = chances[np.arange(len(known)), best]
        return languages, scores, scores < max(self.threshold, 1e-300)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(texts: list[str], labels: list[str], width: int = 12, epochs: int = 6, seed: int = 0) -> Model:
    """Trains on four fifths of the texts; the others set the temperature and the threshold."""
    languages = sorted(set(labels))
    if len(languages) < 2:
        return Model(languages, np.zeros((ROWS, len(languages))), np.zeros(len(languages)))
    bags = [np.unique(ngrams([text])[0], return_counts=True) for text in texts]
    target = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    embedding = rng.uniform(-1 / width, 1 / width, (ROWS, width))
    weights, base = np.zeros((width, len(languages))), np.zeros(len(languages))
    calibration = np.arange(len(texts)) % 5 == 4
    training = np.flatnonzero(~calibration) if calibration.any() else np.arange(len(texts))
    for epoch in range(epochs):
        rate = 0.5 * (1 - epoch / epochs)
        for some in np.array_split(rng.permutation(training), max(1, len(training) // 16)):
            grams = [bags[k] for k in some if len(bags[k][0])]
            which = [k for k in some if len(bags[k][0])]
            if not which:
                continue
            rows = np.concatenate([g[0] for g in grams])
            shares = np.concatenate([g[1] / g[1].sum() for g in grams])
            starts = np.cumsum([0, *(len(g[0]) for g in grams[:-1])])
            mean = np.add.reduceat(embedding[rows] * shares[:, None], starts)
            slope = softmax(mean @ weights + base)
            slope[np.arange(len(which)), target[which]] -= 1
            back = np.repeat(slope @ weights.T, [len(g[0]) for g in grams], axis=0) * shares[:, None]
            weights -= rate * mean.T @ slope
            base -= rate * 0.1 * slope.mean(axis=0)
            np.subtract.at(embedding, rows, rate * 4 * back)
    model = Model(languages, embedding @ weights, base)
    held = np.flatnonzero(calibration & np.array([len(b[0]) > 0 for b in bags]))
    if len(held):
        logits = model.logits([texts[k] for k in held])
        model.temperature = min(np.geomspace(0.05, 5, 60), key=lambda t: _loss(logits / t, target[held]))
        chances = softmax(logits / model.temperature)
        order = np.argsort(-chances.max(axis=1), kind="stable")
        right = (chances.argmax(axis=1) == target[held])[order]
        accurate = np.flatnonzero(np.cumsum(right) / np.arange(1, len(held) + 1) >= ACCURACY)
        model.threshold = float(chances.max(axis=1)[order[accurate[-1]]]) if len(accurate) else 1.0
    return model


def _loss(logits: np.ndarray, target: np.ndarray) -> float:
    return -np.log(softmax(logits)[np.arange(len(target)), target] + 1e-12).mean()


def learn(docs: DataFrame) -> Model:
    """The model of the texts and languages of ``docs`` outside the held-out fold.

    Rows without an id, a language or a letter are not learned from. Rows that
    repeat an id may count again, within the bound. Without any language the
    model knows none and every text is ``UNKNOWN``.
    """
    fold = remainder(F.col("doc_id"), FOLDS)
    usable = docs.where((fold != HELD_OUT) & F.col("lang").isNotNull())
    # The ids are chosen first, so that texts of the sample alone are sorted and sent.
    ids = usable.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(MOST)
    rows = usable.select("doc_id", "lang", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    sample = rows.groupBy("doc_id").agg(F.min_by(F.struct("lang", "text"), F.struct("lang", "text")).alias("row"))
    chosen = sample.orderBy("doc_id").select("row.lang", "row.text").toArrow().to_pydict()
    pairs = [(t, x) for t, x in zip(chosen["text"], chosen["lang"]) if has_letter(t)]
    return fit([t for t, _ in pairs], [x for _, x in pairs])


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row.

    ``lang_pred`` is ``und`` and the score zero for texts without a letter;
    ``rejected`` marks scores below the calibrated threshold.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            size = np.cumsum([len(text or "") for text in texts]) // PORTION
            cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(texts)]
            made = [model.predict(texts[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([x for some in made for x in some[0]], pa.string()),
                    pa.array([x for some in made for x in some[1].tolist()], pa.float64()),
                    pa.array([x for some in made for x in some[2].tolist()], pa.bool_()),
                ],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    chosen = docs.select("doc_id", F.col("text").cast("string"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def language_predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row; an id that is null is in no fold."""
    made = identified(docs, learn(docs))
    held_out = F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return made.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")

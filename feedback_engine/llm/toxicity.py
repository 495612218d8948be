"""Toxicity of texts, judged after noisy-channel deobfuscation.

A writer who hides a word swaps letters for look-alikes, spaces the letters out
or repeats them. Each token is a lattice: a run of equal characters may stand
for itself or for what the channel could have made it from, at the channel's
cost. A character language model (four-grams within words, counted on all
documents) scores what is meant, and the Viterbi path through the lattice is the
restored text. Its distinct words, and the stems that longer words start with,
are the features of a logistic regression.

Words and stems are features if their likelihood ratio between toxic and other
labelled documents is significant among all that were tried; near copies (equal minimum of
the hashes of five-word shingles) weigh as one document. The fit reads at most
``most`` labelled documents, those with the smallest hashes of their ids;
everything else covers all rows and whole texts.

Null, empty and letterless texts get the score of a text without features.
Repeated rows come back like any other; a document id counts once in the fit,
with the label 1 if any of its labels is 1. Rows without an id are scored and
never learned from. Without labelled documents every score is almost 0; an empty
table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import portions, remainder, written

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
# Bytes of text that a task works on at once, if no single text has more.
PORTION = 1_000_000
# Tokens whose restored words a task remembers: bounds memory only.
REMEMBERED = 200_000

# Letters that a character is commonly written for.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou", "€": "e", "£": "l", "¡": "i",
    "а": "a", "в": "b", "е": "e", "і": "i", "к": "k", "м": "m", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y",
    "х": "x", "ѕ": "s", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
}

_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in LEET)

# Costs of the channel, as negative logarithms.
SWAP = 1.5  # a letter written as another character
PLAIN_INSIDE, PLAIN_AT_EDGE = 2.0, 0.1  # such a character meant as itself
REPEAT, DOUBLED, KEPT_RUN = 1.0, 6.0, 4.0  # a run of three or more for one or two; two for one; a long run meant so
BREAK, JOIN = 0.5, 2.0  # a mark within a token that ends a word, or that was put into one
SPACED_BREAK, SPACED_JOIN = 1.0, 0.2  # the same between letters that stand alone

# Symbols of the character model: 0 ends a word, then a to z, any other letter, any digit.
OTHER, DIGIT, BITS = 27, 28, 5
SYMBOLS = DIGIT + 1
_CONTEXT = (1 << 3 * BITS) - 1
# Joins letters that stood alone: a character for private use, which is no white space.
_SPACER = "\ue000"
# Lengths of the stems of longer words.
STEMS = range(4, 10)
_SPACED = re.compile(r"(?<!\S)(?:\S[ \t]{1,2}){2,}\S(?!\S)")
_TWICE = re.compile(r"(.)\1")
_SPOT = re.compile(r"(.)\1+|[^a-z]", re.DOTALL)


def folded(text: str) -> str:
    """Lower case without marks on letters and without invisible characters."""
    text = text.lower()
    if text.isascii():
        return text
    kept = (c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) not in ("Mn", "Cf"))
    return "".join(kept).lower()


def _symbol(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return OTHER if c.isalpha() else DIGIT if c.isdecimal() else 0


@lru_cache(maxsize=1)
def _symbol_of_point() -> np.ndarray:
    """The symbol of every code point of the basic plane, by the first character it folds to; others end words."""
    points = np.zeros(1 << 16, np.uint8)
    for point in range(1 << 16):
        text = folded(chr(point)) if not 0xD800 <= point < 0xE000 else ""
        points[point] = _symbol(text[0]) if text else 0
    return points


def four_grams(texts: list[str | None]) -> np.ndarray:
    """How often each symbol follows each three symbols of its word, packed as ``context * 32 + symbol``."""
    points = np.frombuffer("\n".join(t or "" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(points < 1 << 16, points, 0)
    padded = np.concatenate(([0] * 3, _symbol_of_point()[points], [0])).astype(np.int64)
    now, last = padded[3:], padded[2:-1]
    before = np.where(last > 0, padded[1:-2], 0)
    first = np.where(before > 0, padded[:-3], 0)
    packed = ((first << BITS | before) << BITS | last) << BITS | now
    # A mark after a mark ends no word.
    return np.bincount(packed[(now > 0) | (last > 0)], minlength=1 << 4 * BITS)


def character_model(docs: DataFrame) -> np.ndarray:
    """Costs (negative logarithms) of all four-grams, with Witten-Bell smoothing, counted on all rows.

    Tasks send the four-grams they saw; there are at most 2 ** 20 of them, so
    their sums are of bounded size.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << 4 * BITS, np.int64)
        for some in portions(batches, 0, PORTION):
            counts += four_grams(some.column(0).to_pylist())
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["gram", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "gram long, n long")
    sums = counted.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << 4 * BITS)
    counts[sums["gram"].to_numpy()] = sums["n"].to_numpy()
    return smoothed(counts.reshape([1 << BITS] * 4))


def smoothed(counts: np.ndarray) -> np.ndarray:
    """Costs by context and symbol: each order of context leans on the next shorter one by its number of followers."""
    valid = np.arange(1 << BITS) < SYMBOLS
    chance = (counts.sum(axis=(0, 1, 2)) + 1) * valid
    chance = chance / chance.sum()
    for axes in ((0, 1), (0,), ()):
        some = counts.sum(axis=axes)
        followers = (some > 0).sum(axis=-1, keepdims=True)
        weight = np.maximum(followers, 1)
        chance = (some + weight * chance) / (some.sum(axis=-1, keepdims=True) + weight)
    return -np.log(np.maximum(chance, 1e-300)).astype(np.float32).ravel()


class Decoder:
    """Restores tokens by Viterbi search; remembers what it restored."""

    def __init__(self, costs: np.ndarray) -> None:
        self.costs = array("f", costs.tobytes())
        self.known: dict[str, str] = {}

    def restore(self, text: str) -> str:
        """The whole text restored, in lower case, its white space kept where letters were not spaced out."""
        return re.sub(r"\S+", lambda m: self.token(m.group()), spaced_out_joined(text))

    def words(self, text: str) -> list[str]:
        return [word for token in spaced_out_joined(text).split() for word in self.token(token).split()]

    def token(self, token: str) -> str:
        """The words that a token of lower case stands for, separated by single spaces."""
        found = self.known.get(token)
        if found is None:
            # Marks at an end that are written for no letter only end the word.
            core = token.strip(_MARKS)
            found = core if core.isascii() else folded(core)
            # Letters, none twice in a row and none written for another, stand for themselves alone.
            if not found.isalpha() or _TWICE.search(found) or not (found.isascii() or LEET.keys().isdisjoint(found)):
                found = self._viterbi(found)
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            self.known[token] = found
        return found

    def _viterbi(self, token: str) -> str:
        costs = self.costs
        # The cheapest way to each context: its cost, and its texts as nested pairs.
        states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
        for options in lattice(token):
            reached: dict[int, tuple[float, tuple | None]] = {}
            for start, (so_far, path) in states.items():
                for text, symbols, cost in options:
                    context, cost = start, cost + so_far
                    for symbol in symbols:
                        if symbol:
                            context = context << BITS | symbol
                            cost += costs[context]
                            context &= _CONTEXT
                        elif context:  # a mark after a mark says nothing
                            cost += costs[context << BITS]
                            context = 0
                    best = reached.get(context)
                    if best is None or cost < best[0]:
                        reached[context] = (cost, (path, text))
            states = reached
        ends = [(cost + (costs[context << BITS] if context else 0.0), context) for context, (cost, _) in states.items()]
        path, texts = states[min(ends)[1]][1], []
        while path:
            path, text = path
            texts.append(text)
        return " ".join("".join(reversed(texts)).split())


def spaced_out_joined(text: str) -> str:
    """Lower case, with three or more characters that stand alone made one token."""
    return _SPACED.sub(lambda m: re.sub(r"[ \t]+", _SPACER, m.group()), text.lower())


def features(word: str) -> list[str]:
    """The word, and marked as such the stems that it goes on from."""
    return [word, *(word[:k] + "+" for k in STEMS if k < len(word))]


def lattice(token: str) -> Iterator[list[tuple[str, tuple[int, ...], float]]]:
    """For each run of equal characters of a folded token, the (text, symbols, channel cost) it may stand for.

    Letters from a to z that stand once are put together.
    """
    done, end = 0, len(token)
    for spot in _SPOT.finditer(token):
        start, stop = spot.span()
        if start > done:
            yield _as_it_is(token[done:start])
        yield _options(token[start], stop - start, 0 < start and stop < end)
        done = stop
    if done < end:
        yield _as_it_is(token[done:])


def _as_it_is(letters: str) -> list[tuple[str, tuple[int, ...], float]]:
    return [(letters, tuple([ord(c) - 96 for c in letters]), 0.0)]


@lru_cache(maxsize=4096)
def _options(c: str, n: int, inside: bool) -> list[tuple[str, tuple[int, ...], float]]:
    symbol, letters = _symbol(c), LEET.get(c, "")
    made: list[tuple[str, float]] = []
    if c == _SPACER:
        made = [(" ", SPACED_BREAK), ("", SPACED_JOIN)]
    elif symbol and not letters:
        made = [(c * n, 0.0 if n < 3 else KEPT_RUN)]
    elif letters:
        made = [(c * n if symbol else " ", PLAIN_INSIDE if inside or symbol else PLAIN_AT_EDGE)]
    else:
        made = [(" ", BREAK)] + [("", JOIN)] * inside
    for letter in letters or (c if symbol and symbol != DIGIT else ""):
        swap = SWAP if letters else 0.0
        if n == 1 and letters:
            made.append((letter, swap))
        elif n == 2:
            made += [(letter, swap + DOUBLED)] + [(letter * 2, swap)] * bool(letters)
        elif n > 2:
            made += [(letter, swap + REPEAT), (letter * 2, swap + REPEAT)]
    return [(text, tuple(map(_symbol, text)), cost) for text, cost in made]


class Model:
    """Weights of words and stems over a base; ``score`` is the chance that a text with these is toxic."""

    def __init__(self, words: list[str], weights: np.ndarray, base: float) -> None:
        self.weights = dict(zip(words, map(float, weights)))
        self.base = base

    def score(self, words: Iterable[str]) -> float:
        found = sorted(self.weights.keys() & set(words))
        return float(1 / (1 + np.exp(-np.clip(self.base + sum(self.weights[word] for word in found), -30, 30))))


def fit(
    rows: list[list[int]], labels: np.ndarray, weights: np.ndarray, size: int, penalty: float = 0.1
) -> tuple[np.ndarray, float]:
    """Logistic regression over presence of features by gradient descent with momentum; the base is not penalised."""
    at = np.repeat(np.arange(len(rows)), list(map(len, rows)))
    feature = np.array([f for row in rows for f in row], np.int64)
    beta, base = np.zeros(size), 0.0
    if not len(rows):
        return beta, -30.0
    # The curvature is at most a quarter of the largest eigenvalue of the weighted features (found by powers) and the penalty.
    direction, curvature = np.ones(size + 1), 1.0
    for _ in range(50):
        along = weights * (direction[-1] + np.bincount(at, direction[feature], len(rows)))
        direction = np.append(np.bincount(feature, along[at], size), along.sum())
        curvature = max(float(np.linalg.norm(direction)), 1e-12)
        direction /= curvature
    rate = 1 / (0.3 * curvature + penalty)
    ahead, ahead_base = beta, base
    for k in range(3000):
        z = ahead_base + np.bincount(at, ahead[feature], len(rows))
        slope = weights * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        next_beta = ahead - rate * (np.bincount(feature, slope[at], size) + penalty * ahead)
        next_base = ahead_base - rate * slope.sum()
        momentum = k / (k + 3)
        ahead, ahead_base = next_beta + momentum * (next_beta - beta), next_base + momentum * (next_base - base)
        beta, base = next_beta, float(np.clip(next_base, -30, 30))
    return beta, base


_MEASURED = "toxic int, copies long, words array<string>"


def learn(
    docs: DataFrame,
    labels: DataFrame,
    costs: np.ndarray,
    most: int = 40_000,
    kept: int = 2_000,
    chance: float = 0.01,
) -> Model:
    """The model of ``labels`` (doc_id, toxic) over the restored texts of ``docs``.

    At most ``most`` labelled documents outside the held-out fold are read, and
    the ``kept`` most telling words and stems used, of those whose likelihood
    ratio has less than ``chance`` to come up among all of them without cause.
    """
    fold = remainder(F.col("doc_id"), FOLDS)
    agreed = labels.where(fold != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic is not null")
    agreed = agreed.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    # Bounded by ``most``, so it can be sent to every task and the texts stay where they are.
    chosen = agreed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))

    def measure(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(costs)
        for some in portions(batches, 1, PORTION):
            words = [decoder.words(text or "") for text in some.column(1).to_pylist()]
            copies = [min(zlib.crc32(" ".join(w[k : k + 5]).encode()) for k in range(max(1, len(w) - 4))) for w in words]
            yield pa.RecordBatch.from_arrays(
                [some.column(0), pa.array(copies, pa.int64()), pa.array([sorted({f for x in set(w) for f in features(x)}) for w in words], pa.list_(pa.string()))],
                names=["toxic", "copies", "words"],
            )

    sample = one.select((F.col("toxic") == 1).cast("int").alias("toxic"), "text").mapInArrow(measure, _MEASURED)
    sample = written(sample, "toxicity-sample")
    # As few rows as the sample at most.
    sizes = sample.groupBy("toxic", "copies").agg((1 / F.count("*")).alias("weight"))
    sample = written(sample.join(F.broadcast(sizes), ["toxic", "copies"]), "toxicity-weighed")
    totals = dict(sample.groupBy("toxic").agg(F.sum("weight")).collect())
    clean, toxic = totals.get(0, 0.0), totals.get(1, 0.0)

    each = sample.select("toxic", "weight", F.explode("words").alias("word"))
    counts = each.groupBy("word").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("weight")).otherwise(0.0)).alias("t"),
        F.sum(F.when(F.col("toxic") == 0, F.col("weight")).otherwise(0.0)).alias("c"),
    )
    counts = written(counts.select("word", "t", "c", _likelihood_ratio(toxic, clean).alias("ratio")), "toxicity-words")
    tried = counts.count()
    limit = NormalDist().inv_cdf(1 - chance / 2 / max(tried, 1)) ** 2
    telling = counts.where(F.col("ratio") > limit).orderBy(F.desc("ratio"), "word").limit(kept)
    words = [row.word for row in telling.select("word").collect()]
    place = {word: k for k, word in enumerate(words)}
    # Of the bounded sample, only the telling words of each document.
    listed = F.array_sort(F.array_intersect("words", F.array(*map(F.lit, words)))) if words else F.array().cast("array<string>")
    rows = sample.select("toxic", "weight", listed.alias("words")).groupBy("toxic", "words").agg(F.sum("weight").alias("weight"))
    found = rows.orderBy("toxic", "words").collect()
    beta, base = fit(
        [[place[word] for word in row.words] for row in found],
        np.array([row.toxic for row in found], float), np.array([row.weight for row in found], float), len(words),
    )
    return Model(words, beta, base)


def _likelihood_ratio(toxic: float, clean: float) -> F.Column:
    """G squared of a word's weights t and c against as many toxic and clean documents."""
    both = toxic + clean
    terms = F.lit(0.0)
    for seen, absent, size in (("t", toxic - F.col("t"), toxic), ("c", clean - F.col("c"), clean)):
        present = F.col("t") + F.col("c")
        for count, margin in ((F.col(seen), present), (absent, F.lit(both) - present)):
            expected = margin * (size / both if both else 0.0)
            terms = terms + F.when(count > 1e-9, count * F.log(count / expected)).otherwise(0.0)
    return 2 * terms


def scored(docs: DataFrame, costs: np.ndarray, model: Model, score_col: str = "score") -> DataFrame:
    """``docs`` with the score of each row's whole text."""
    at, names = docs.columns.index("text"), [*docs.columns, score_col]
    sent = docs.sparkSession.sparkContext.broadcast((costs, model))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder, judge = Decoder(sent.value[0]), sent.value[1]
        telling: dict[str, list[str]] = {}
        for some in portions(batches, at, PORTION):
            made = []
            for text in some.column(at).cast(pa.string()).to_pylist():
                found = set()
                for token in set(spaced_out_joined(text or "").split()):
                    words = telling.get(token)
                    if words is None:
                        if len(telling) >= REMEMBERED:
                            telling.clear()
                        words = telling[token] = [
                            f for word in decoder.token(token).split() for f in features(word) if f in judge.weights
                        ]
                    found.update(words)
                made.append(judge.score(found))
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(made, pa.float64())], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{score_col}` double")


def restored(docs: DataFrame, costs: np.ndarray, restored_col: str = "restored") -> DataFrame:
    """``docs`` with the restored text of each row; null for null."""
    at, names = docs.columns.index("text"), [*docs.columns, restored_col]
    sent = docs.sparkSession.sparkContext.broadcast(costs)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(sent.value)
        for some in portions(batches, at, PORTION):
            made = [None if t is None else decoder.restore(t) for t in some.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*some.columns, pa.array(made, pa.string())], names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, `{restored_col}` string")


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    costs = character_model(docs)
    made = scored(docs.select("doc_id", "text"), costs, learn(docs, labels, costs))
    return made.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

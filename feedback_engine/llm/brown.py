"""Language model of Brown classes: exchange clustering, class transitions, word emissions.

A word's probability is that of its class after the class before it, times that
of the word within its class. Words are gathered in ``BUCKETS`` buckets by hash,
and exchange clustering assigns buckets to classes: what precedes and follows
the words of each bucket, by class, is counted over all training tokens; then
every bucket moves to the class that raises the likelihood of the class bigrams
most, and the counting starts again. Counts of single words are exact.

Texts are tokenised once, into chunks of bounded size with a vocabulary of their
own, and all later passes read those. Numbers and words of a chunk are packed
bytes there, so that neither the executor nor its workers hold them as arrays of
a row each while they are moved, and a worker unpacks one chunk at a time. What is
summed over chunks is either exact word counts, dealt out by hash, or tables whose
size the parameters fix; these are summed in a tree, and only they reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import give_back, portions, remainder, written

FOLDS, HELD_OUT = 7, 2
BUCKETS, CLASSES = 1 << 16, 32
ROUNDS = 3
CHUNK = 6_000_000  # bytes of text in a chunk, if no single text has more
SLICE = 250_000  # bytes of text that are read, and tokens that are scored, at once, if no single text has more
WORDS_IN_RANGE = 400_000  # expected entries of vocabularies that one task sums
FAN_IN = 16  # tables summed by one task of the tree
PRIOR = 1.0  # weight of class frequencies in the smoothing of transitions
# Texts end with a token of its own, and its class is also what precedes their first word.
END = CLASSES

# Words are joined by line ends, which none of them holds; ``buckets`` and ``seen`` have a number for each of them.
CHUNKS = (
    "chunk long, n_words int, words binary, buckets binary, seen binary, ids array<{}>, learned array<boolean>, held array<boolean>, "
    "ends array<int>, tokens binary"
)


def chunked(docs: DataFrame) -> DataFrame:
    """Chunks of rows: their different words, how often training rows have each, and the rows' tokens by number."""
    fold = remainder(F.col("doc_id"), FOLDS)
    given = docs.select(
        "doc_id",
        F.col("text").cast("string").alias("text"),
        F.coalesce(fold != HELD_OUT, F.lit(False)).alias("learned"),
        F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held"),
    )
    id_type = given.schema["doc_id"].dataType.simpleString()

    def packed(number: int, rows: list[tuple], number_of: dict[bytes, int], kind: pa.DataType) -> pa.RecordBatch:
        words, sizes = list(number_of), [len(row[1]) for row in rows]
        tokens = np.concatenate([row[1] for row in rows])
        learned = np.repeat(np.array([row[2] for row in rows], bool), sizes)
        seen = np.bincount(tokens[learned], minlength=len(words)).astype(np.int32)
        columns = [
            pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
            pa.array([len(words)], pa.int32()),
            pa.array([_squeezed(np.frombuffer(b"\n".join(words), np.uint8))], pa.binary()),
            pa.array([_squeezed(_buckets(_hashes(words)).astype(np.int32))], pa.binary()),
            pa.array([_squeezed(seen)], pa.binary()),
            pa.array([[row[0] for row in rows]], pa.list_(kind)),
            pa.array([[row[2] for row in rows]], pa.list_(pa.bool_())),
            pa.array([[row[3] for row in rows]], pa.list_(pa.bool_())),
            _one_list(np.cumsum(sizes).astype(np.int32)),
            pa.array([_squeezed(tokens)], pa.binary()),
        ]
        names = ["chunk", "n_words", "words", "buckets", "seen", "ids", "learned", "held", "ends", "tokens"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, number_of, size, number, kind = [], {}, 0, 0, pa.int64()
        for batch in portions(batches, 1, SLICE):
            kind = batch.column(0).type
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                text = (row[1] or "").encode().lower()
                words = text.split()
                for word in dict.fromkeys(words):
                    number_of.setdefault(word, len(number_of))
                rows.append((row[0], np.fromiter(map(number_of.__getitem__, words), np.int32, len(words)), row[2], row[3]))
                size += len(text)
                if size >= CHUNK:
                    yield packed(number, rows, number_of, kind)
                    rows, number_of, size, number = [], {}, 0, number + 1
        if rows:
            yield packed(number, rows, number_of, kind)

    return given.mapInArrow(run, CHUNKS.format(id_type))


def _one_list(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _values(batch: pa.RecordBatch | pa.Table, name: str, row: int) -> np.ndarray:
    return batch.column(name)[row].values.to_numpy(zero_copy_only=False)


def _squeezed(values: np.ndarray) -> bytes:
    """``values`` by place of their bytes, compressed; the first eight bytes have the size."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return planes.nbytes.to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def _restored(batch: pa.RecordBatch | pa.Table, name: str, row: int, kind: type = np.int32) -> np.ndarray:
    packed = batch.column(name)[row].as_py()
    planes = np.frombuffer(pa.decompress(packed[8:], int.from_bytes(packed[:8], "little"), "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _hashes(words: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(words, object), categorize=False)


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _neighbours(batch: pa.RecordBatch, row: int, class_of: np.ndarray):
    """Of the training rows' tokens and ends: bucket (``BUCKETS`` for an end), class before, class after."""
    tokens, ends = _restored(batch, "tokens", row), _values(batch, "ends", row)
    learned = _values(batch, "learned", row)
    sizes = np.diff(np.concatenate(([0], ends)))
    tokens, sizes = tokens[np.repeat(learned, sizes)], sizes[learned]
    stops = np.cumsum(sizes + 1) - 1
    which = np.full(len(tokens) + len(sizes), BUCKETS, np.int32)
    inner = np.ones(len(which), bool)
    inner[stops] = False
    which[inner] = _restored(batch, "buckets", row)[tokens]
    classes = class_of.astype(np.int32)[which]
    end = np.full(min(len(classes), 1), END, np.int32)
    return which, np.concatenate((end, classes[:-1])), np.concatenate((classes[1:], end))


TABLE = "node long, packed binary"


def _packed(node: int, table: np.ndarray) -> dict:
    return {"node": node, "packed": pa.compress(pa.py_buffer(table.astype(np.int64, copy=False)), "zstd", asbytes=True)}


def _unpacked(packed: bytes, size: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(packed, size * 8, "zstd"), np.int64)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema([("node", pa.int64()), ("packed", pa.binary())])
    return pa.RecordBatch.from_pylist(rows, schema)


def summed(tables: DataFrame, count: int, size: int) -> np.ndarray:
    """Sum of at most ``count`` packed tables of ``size`` numbers, by a tree of tasks that add ``FAN_IN`` or so each."""

    def adder(groups: int):
        def add(group: pa.Table) -> pa.Table:
            total = np.zeros(size, np.int64)
            for packed in group["packed"]:
                total += _unpacked(packed.as_py(), size)
            made = pa.Table.from_batches([_batch([_packed(group["node"][0].as_py() % groups, total)])])
            give_back()
            return made

        return add

    # Added up at least once, so that small inputs go the way of large ones and the driver gets few.
    while True:
        count = max(1, -(-count // FAN_IN))
        tables = tables.groupBy(F.col("node") % count).applyInArrow(adder(count), TABLE)
        if count <= FAN_IN:
            break
    rows = tables.select("packed").toArrow()["packed"].to_pylist()
    return sum((_unpacked(packed, size) for packed in rows), np.zeros(size, np.int64))


CONTEXT = 2 * (CLASSES + 1)


def contexts(chunks: DataFrame, class_of: np.ndarray) -> np.ndarray:
    """[bucket, 2 x class]: how often a word of the bucket follows each class, and is followed by it."""
    size = (BUCKETS + 1) * CONTEXT

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int32)
        for batch in batches:
            for row in range(batch.num_rows):
                which, before, after = _neighbours(batch, row, class_of)
                np.add.at(total, which * CONTEXT + before, np.int32(1))
                np.add.at(total, which * CONTEXT + CLASSES + 1 + after, np.int32(1))
        if total.any():
            yield _batch([_packed(TaskContext.get().partitionId(), total)])
        give_back()

    read = chunks.select("buckets", "learned", "ends", "tokens")
    return summed(read.mapInArrow(run, TABLE), read.rdd.getNumPartitions(), size).reshape(BUCKETS + 1, CONTEXT)


def exchanged(context: np.ndarray, class_of: np.ndarray, step: int = 512) -> np.ndarray:
    """Classes after every bucket, the most frequent first, has moved to where the likelihood gains most.

    Gains are exact for one move, given the classes of all others as counted;
    buckets are moved ``step`` at a time, and the class bigrams follow.
    """

    def f(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-12))

    class_of = class_of.copy()
    left, right = (context[:, k : k + CLASSES + 1].astype(float) for k in (0, CLASSES + 1))
    bigrams = np.zeros((CLASSES + 1, CLASSES + 1))
    np.add.at(bigrams, class_of, right)
    order = np.argsort(-left.sum(axis=1), kind="stable")
    order = order[(order < BUCKETS) & (left[order].sum(axis=1) > 0)]
    for at in range(0, len(order), step):
        some = order[at : at + step]
        now, r, l = class_of[some], right[some], left[some]
        k = np.arange(len(some))
        own = np.repeat(bigrams[None], len(some), axis=0)
        own[k, now, :] = np.maximum(own[k, now, :] - r, 0)
        own[k, :, now] = np.maximum(own[k, :, now] - l, 0)
        rows, columns = own.sum(axis=2), own.sum(axis=1)
        size = r.sum(axis=1, keepdims=True)
        gain = (
            (f(own + r[:, None, :]) - f(own)).sum(axis=2)
            + (f(own + l[:, :, None]) - f(own)).sum(axis=1)
            - f(rows + size) + f(rows) - f(columns + size) + f(columns)
        )
        gain[:, END] = -np.inf
        best = gain.argmax(axis=1)
        best = np.where(gain[k, best] > gain[k, now] + 1e-9, best, now)
        moved = np.flatnonzero(best != now)
        for sign, to in ((-1, now), (1, best)):
            np.add.at(bigrams, to[moved], sign * r[moved])
            np.add.at(bigrams.T, to[moved], sign * l[moved])
        np.maximum(bigrams, 0, out=bigrams)
        class_of[some] = best
    return class_of


def first_classes(frequency: np.ndarray) -> np.ndarray:
    """Buckets in turn over the classes, by frequency; the end has its own."""
    class_of = np.empty(BUCKETS + 1, np.int64)
    class_of[np.argsort(-frequency[:BUCKETS], kind="stable")] = np.arange(BUCKETS) % CLASSES
    class_of[BUCKETS] = END
    return class_of


def word_counts(chunks: DataFrame, class_of: np.ndarray) -> DataFrame:
    """(chunk, local, counts, stats): training counts over the corpus of a chunk's words, in portions by hash range.

    ``stats`` is given once a range: how many words and tokens each class has, and how many words occur once and twice.
    """
    entries = chunks.agg(F.sum("n_words")).first()[0] or 0
    ranges = max(1, -(-entries // WORDS_IN_RANGE))

    def deal(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                words, seen = _restored(batch, "words", row, np.uint8).tobytes().split(), _restored(batch, "seen", row)
                hashes = _hashes(words)
                part = (hashes % np.uint64(ranges)).astype(np.int32)
                order = np.argsort(part, kind="stable").astype(np.int32)
                words = [words[k] for k in order.tolist()]
                cuts = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=ranges)))).tolist()
                spans = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
                columns = [
                    pa.array(np.arange(ranges, dtype=np.int32)),
                    pa.array(np.full(ranges, batch.column("chunk")[row].as_py(), np.int64)),
                    pa.array([order[some].tobytes() for some in spans], pa.binary()),
                    pa.array([b"\n".join(words[some]) for some in spans], pa.binary()),
                    pa.array([seen[order[some]].tobytes() for some in spans], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "local", "words", "seen"])
        give_back()

    def count(table: pa.Table) -> pa.Table:
        words = [value.as_py().split() for value in table["words"]]
        sizes = list(map(len, words))
        coded = pa.array(chain.from_iterable(words), pa.binary(), size=sum(sizes)).dictionary_encode()
        del words
        code = coded.indices.to_numpy()
        seen = np.frombuffer(b"".join(table["seen"].to_pylist()), np.int32)
        total = np.bincount(code, seen, len(coded.dictionary)).astype(np.int64)
        hashes = pd.util.hash_array(coded.dictionary.to_numpy(zero_copy_only=False).astype(object), categorize=False)
        classes, known = class_of[_buckets(hashes)], total > 0
        stats = np.concatenate((
            np.bincount(classes[known], minlength=CLASSES + 1),
            np.bincount(classes, total, CLASSES + 1).astype(np.int64),
            [(total == 1).sum(), (total == 2).sum()],
        ))
        given = pa.array([stats.tolist(), *[None] * (len(sizes) - 1)], pa.list_(pa.int64()))
        ends = np.cumsum(sizes)
        counts = pa.array([total[code[end - size : end]].tobytes() for size, end in zip(sizes, ends)], pa.binary())
        give_back()
        return pa.table({"chunk": table["chunk"], "local": table["local"], "counts": counts, "stats": given})

    dealt = chunks.select("chunk", "words", "seen").mapInArrow(deal, "part int, chunk long, local binary, words binary, seen binary")
    made = dealt.groupBy("part").applyInArrow(count, "chunk long, local binary, counts binary, stats array<long>")
    return written(made, "brown_counts")


SCORED = "doc_id {}, held_out boolean, n_tokens long, n_known long, base_score double, score double"


class Model(NamedTuple):
    """Class transitions [before, class] (the last row is for what follows an unknown word) and emissions."""

    follow: np.ndarray
    emission: np.ndarray  # of a class: one over its tokens
    unknown: np.ndarray  # of a class: its chance of an unknown word
    discount: float  # taken off every known word's count
    tokens: int
    words: int


def model_of(bigrams: np.ndarray, stats: np.ndarray, ends: int) -> Model:
    types, mass = stats[: CLASSES + 1].astype(float), stats[CLASSES + 1 : 2 * CLASSES + 2].astype(float)
    once, twice = stats[2 * CLASSES + 2 :]
    types[END], mass[END] = 0, ends
    n, v = int(mass.sum()), int(types.sum()) + (ends > 0)
    # Absolute discounting: what it takes off the words of a class is the class's chance of an unknown word.
    discount = once / (once + 2 * twice) if once else 0.0
    share = mass / max(n, 1)
    follow = (bigrams + PRIOR * share) / (bigrams.sum(axis=1, keepdims=True) + PRIOR)
    follow = np.vstack((follow, share))  # after an unknown word
    unknown = np.minimum(discount * types / np.maximum(mass, 1), 1.0)
    return Model(follow, 1 / np.maximum(mass, 1), unknown, discount, n, v)


def _scorer(class_of: np.ndarray, model_: Model, ends: int):
    """Scores the rows of a chunk, given the counts of its words."""
    follow, emission, unknown, discount, n, v = model_
    least = 1 / (n + v + 1) ** 2  # only if no word occurs once, so that nothing is set aside for unknown ones
    log_follow = np.log10(np.maximum(follow, least))
    log_unknown = np.log10(np.maximum(follow @ unknown, least))

    def score(key, texts: pa.Table, counts: pa.Table) -> pa.Table:
        out = []
        for row in range(texts.num_rows):
            bucket = _restored(texts, "buckets", row)
            total = np.zeros(len(bucket) + 1, np.int64)
            for local, count in zip(counts["local"], counts["counts"]):
                total[np.frombuffer(local.as_py(), np.int32)] = np.frombuffer(count.as_py(), np.int64)
            total[-1] = ends
            classes = np.append(class_of[bucket], END)
            tokens, stops = _restored(texts, "tokens", row), _values(texts, "ends", row)
            # Whole texts, as many as have ``SLICE`` tokens.
            cuts = [0, *(np.flatnonzero(np.diff(stops // SLICE)) + 1).tolist(), len(stops)]
            for start, end in zip(cuts, cuts[1:]):
                first = stops[start - 1] if start else 0
                sizes = np.diff(stops[start:end], prepend=first)
                some = scored(tokens[first : stops[end - 1]], sizes, total, classes)
                ids, held = (texts[x][row].values.slice(start, end - start) for x in ("ids", "held"))
                out.append(pa.table({"doc_id": ids, "held_out": held, **some}))
        made = pa.concat_tables(out)
        give_back()
        return made

    def scored(tokens: np.ndarray, sizes: np.ndarray, total: np.ndarray, classes: np.ndarray) -> dict[str, pa.Array]:
        """Of texts of these ``sizes``; ``total`` and ``classes`` have the words by number, the end last."""
        last = np.cumsum(sizes + 1) - 1
        which = np.full(len(tokens) + len(sizes), len(total) - 1, np.int64)
        inner = np.ones(len(which), bool)
        inner[last] = False
        which[inner] = tokens
        c, known = total[which], total[which] > 0
        now = np.where(known, classes[which], END + 1)
        before = np.concatenate(([END], now[:-1]))
        before[last[:-1] + 1] = END
        taken = np.where(which < len(total) - 1, discount, 0.0)
        seen = np.log10(np.maximum((c - taken) * emission[np.minimum(now, END)], least))
        model = np.where(known, log_follow[before, np.minimum(now, END)] + seen, log_unknown[before])
        base = np.log10((c + 1) / (n + v + 1))
        firsts = last - sizes
        return {
            "n_tokens": pa.array(sizes + 1, pa.int64()),
            "n_known": pa.array(np.add.reduceat(known.astype(np.int64), firsts)),
            "base_score": pa.array(np.add.reduceat(base, firsts)),
            "score": pa.array(np.add.reduceat(model if n else base, firsts)),
        }

    return score


def scores(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row's whole text.

    ``score`` is the model's log10 probability of the text and its end, ``base_score`` that of add-one unigrams.
    Null and empty texts are an end alone. Rows without an id are scored but not learned from; repeated rows count
    as often as they occur. Without training rows both scores are those of the base.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    chunks = written(chunked(docs), "brown_chunks", packed=True)
    ends = chunks.agg(F.sum(F.size(F.filter("learned", lambda x: x)))).first()[0] or 0
    # Frequencies of buckets are the contexts under any classes.
    class_of = np.zeros(BUCKETS + 1, np.int64)
    class_of[BUCKETS] = END
    context = contexts(chunks, class_of)
    class_of = first_classes(context[:, : CLASSES + 1].sum(axis=1))
    for _ in range(rounds):
        class_of = exchanged(contexts(chunks, class_of), class_of)
    context = contexts(chunks, class_of)
    bigrams = np.zeros((CLASSES + 1, CLASSES + 1))
    np.add.at(bigrams, class_of, context[:, CLASSES + 1 :])
    counts = word_counts(chunks, class_of)
    stats = [F.sum(F.get("stats", F.lit(k))).alias(f"s{k}") for k in range(2 * CLASSES + 4)]
    totals = np.array([x or 0 for x in counts.where("stats is not null").agg(*stats).first()], np.int64)
    model = model_of(bigrams, totals, ends)
    score = _scorer(class_of, model, ends)
    made = (
        chunks.select("chunk", "buckets", "ids", "held", "ends", "tokens")
        .groupBy("chunk")
        .cogroup(counts.select("chunk", "local", "counts").groupBy("chunk"))
        .applyInArrow(score, SCORED.format(id_type))
    )
    perplexity = F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    return made.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", perplexity.alias("perplexity"),
    )

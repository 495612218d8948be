"""Substring de-duplication by sliding sentence spans.

A run is some consecutive sentences, at least ``LEAST_SENTENCES`` of them and
``LEAST_WORDS`` words. Hashed are the shortest run from every sentence and the
shortest run up to every sentence. Whatever longer run is repeated, these cover
all of it: where the run from a sentence leaves the repeated one, the sentence
lies in the run up to its end. An equality on the hashes brings equal runs of all documents together; the first
of them, by document and place, is kept, and sentences that any later one
covers go.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_engine.llm.common import written

LEAST_SENTENCES, LEAST_WORDS = 2, 20
# A sentence of more words than LONG is cut after words whose checksum is divisible by CUT, wherever it begins, and
# after MOST words at the latest.
LONG, CUT, MOST = 16, 8, 32

_END = re.compile(r"[.!?…]+(?=\s)|[。！？]+|\n")
_WORD = re.compile(r"\S+")


def sentences(text: str) -> list[tuple[int, int, bytes, int]]:
    """(start, end, words joined by one space, number of words) of each sentence, offsets in code points.

    Letters count alike in either case, and so does any white space.
    """
    found, at = [], 0
    for stop in [*(m.end() for m in _END.finditer(text)), len(text)]:
        part = text[at:stop]
        words = part.lower().split()
        if len(words) > LONG:
            start = at
            some: list[str] = []
            for m in _WORD.finditer(part):
                word = m[0].lower()
                some.append(word)
                if crc32(word.encode()) % CUT == 0 or len(some) == MOST:
                    found.append((start, at + m.end(), " ".join(some).encode(), len(some)))
                    start, some = at + m.end(), []
            if some:
                found.append((start, stop, " ".join(some).encode(), len(some)))
        elif words:
            found.append((at, stop, " ".join(words).encode(), len(words)))
        at = stop
    return found


def spans(text: str | None) -> list[tuple[int, int, int, int, int, int, bool]]:
    """(two halves of the hash, first and last sentence, start, end, again) of each run.

    ``again`` says that the text has the same run before, clear of this one.
    """
    if not text:
        return []
    units = sentences(text)
    made = []
    ended: dict[int, int] = {}  # last sentence of the first run of each hash
    for first, last in shortest_runs([unit[3] for unit in units]):
        digest = xxhash.xxh3_128_intdigest(b"\n".join(unit[2] for unit in units[first : last + 1]))
        again = first > ended.setdefault(digest, last)
        made.append((*divmod(digest, 1 << 64), first, last, units[first][0], units[last][1], again))
    return made


def shortest_runs(words: list[int]) -> list[tuple[int, int]]:
    """(first, last) of the runs that no sentence can leave at the front or none at the back, in order.

    ``words`` has the number of words of each sentence. Whether a run is one of
    these depends on its own sentences alone, so all its copies are.
    """
    found = set()
    first = total = 0
    for last, more in enumerate(words):
        total += more
        while last - first >= LEAST_SENTENCES and total - words[first] >= LEAST_WORDS:
            total -= words[first]
            first += 1
        if last - first + 1 >= LEAST_SENTENCES and total >= LEAST_WORDS:
            found.add((first, last))
    last, total = -1, 0
    for first, less in enumerate(words):
        while last + 1 < len(words) and (last - first + 1 < LEAST_SENTENCES or total < LEAST_WORDS):
            last += 1
            total += words[last]
        if last - first + 1 < LEAST_SENTENCES or total < LEAST_WORDS:
            break
        found.add((first, last))
        total -= less
    return sorted(found)


def hashed_spans(docs: DataFrame) -> DataFrame:
    """(high, low, doc_id, first, last, start, end, again) of every run in the whole texts of ``docs``."""
    names = ["high", "low", "doc_id", "first", "last", "start", "end", "again"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, ids = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                some = spans(text.as_py())
                made += some
                ids += [doc] * len(some)
            if made:
                high, low, *places, again = zip(*made)
                hashes = [pa.array(np.array(x, np.uint64).view(np.int64)) for x in (high, low)]
                rest = [pa.array(x, pa.int32()) for x in places]
                yield pa.RecordBatch.from_arrays([*hashes, pa.array(ids, kind), *rest, pa.array(again)], names=names)

    chosen = docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    kind = pa.int64()
    return chosen.mapInArrow(
        run, "high long, low long, doc_id long, first int, last int, start int, end int, again boolean"
    )


def _packed(runs: DataFrame) -> DataFrame:
    """The runs with their places as two numbers: rows take two thirds of the bytes when they are shuffled."""
    place = F.shiftleft(F.col("first").cast("long"), 32) + 2 * F.col("last").cast("long") + F.col("again").cast("long")
    stretch = F.shiftleft(F.col("start").cast("long"), 32) + F.col("end").cast("long")
    return runs.select("high", "low", "doc_id", place.alias("place"), stretch.alias("stretch"))


def _unpacked(runs: DataFrame) -> DataFrame:
    def upper(name: str):
        return F.shiftright(name, 32).cast("int")

    def lower(name: str):
        return F.col(name).bitwiseAND(F.lit(2**32 - 1))

    places = {
        "first": upper("place"), "last": F.shiftright(lower("place"), 1).cast("int"),
        "start": upper("stretch"), "end": lower("stretch").cast("int"),
    }
    return runs.withColumns(places).drop("place", "stretch")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end, n_sentences, first_doc_ids) of every stretch of text that goes, in code points.

    A run whose hash also occurs earlier, in a document of a smaller id or
    further up in the same one, is a repeat unless the two overlap; stretches
    are what repeats cover, joined where they touch. ``first_doc_ids`` lists the
    documents that keep a first occurrence. Rows of one id are one document:
    repeated rows do not make each other go. Rows without an id are not looked
    at; null, blank and short texts have no runs; an empty table has none.
    """
    runs = written(hashed_spans(docs), "sentence_spans")
    firsts = runs.groupBy("high", "low").agg(F.min("doc_id").alias("kept"), F.count(F.lit(1)).alias("n"))
    # Written, so that a run of very many documents can be split in the join.
    firsts = written(firsts.where("n > 1").select("high", "low", "kept"), "repeated_spans")
    later = _unpacked(_packed(runs).join(firsts, ["high", "low"]).where("doc_id <> kept or place % 2 = 1"))
    in_order = Window.partitionBy("doc_id").orderBy("first", "last")
    covered = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("first") > covered + 1, F.lit(True)).cast("int")
    islands = later.withColumn("opens", opens).withColumn("island", F.sum("opens").over(in_order))
    return islands.groupBy("doc_id", "island").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.max("last") - F.min("first") + 1).alias("n_sentences"),
        F.sort_array(F.collect_set("kept")).alias("first_doc_ids"),
    ).drop("island")


# Names that do not clash with columns of documents.
STRETCHES = "__repeated_stretches"


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with repeated stretches cut out of their texts; ``n_chars``, if there, follows."""
    found = repeats(docs.select("doc_id", "text"))
    found = found.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias(STRETCHES))
    whole = F.concat(F.col(STRETCHES), F.array(F.struct(F.length("text").alias("start"), F.length("text").alias("end"))))
    kept = F.transform(
        whole,
        lambda x, k: F.substring(
            F.col("text"),
            F.when(k == 0, 1).otherwise(F.get(F.col(STRETCHES), k - 1)["end"] + 1),
            x["start"] - F.when(k == 0, 0).otherwise(F.get(F.col(STRETCHES), k - 1)["end"]),
        ),
    )
    joined = docs.join(found, "doc_id", "left")
    cut = joined.withColumn("text", F.when(F.col(STRETCHES).isNull(), F.col("text")).otherwise(F.array_join(kept, "")))
    if "n_chars" in docs.columns:
        changed = F.when(F.col(STRETCHES).isNotNull(), F.length("text").cast("long"))
        cut = cut.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return cut.select(*docs.columns)

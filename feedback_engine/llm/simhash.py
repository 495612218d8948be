"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two halves. Of two fingerprints that
differ in at most three bits, one half differs in at most one bit, so the two
agree on that half once one bit of it is struck out. Every distinct
fingerprint is therefore indexed under its 64 halves with one bit struck out,
an equality on those variants brings the candidates together, and the full
distance decides.

A variant shared by more fingerprints than ``BUCKET`` is not compared all
against all: three differing bits leave one of four pieces of the bits not yet
fixed untouched, so its members are indexed again under each piece, as often
as it takes. No link is lost by that.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from feedback_engine.llm.common import components, map_batches, spanning_links, written

DISTANCE = 3
SHINGLE = 3
SEED = 42
# Largest bucket that is compared all against all, within one task.
BUCKET = 256


def fingerprint(text: str | None) -> int:
    """SimHash of the word shingles of ``text``, as a signed 64-bit number.

    Null and blank texts have the fingerprint zero; a text of fewer words than
    a shingle is one shingle.
    """
    words = (text or "").encode().lower().split()  # both are ASCII rules for bytes
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= SHINGLE:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        slices = map(slice, starts[: n - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist())
        shingles = map(joined.__getitem__, slices)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), np.uint64, n - SHINGLE + 1)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    """The bits that more than half of the hashes have set, as a signed 64-bit number."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        some = hashes[at : at + 65536].astype("<u8").view(np.uint8)
        ones += np.unpackbits(some, bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(``id_col``, fp) of every row; other columns are not read."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        made = [fingerprint(text.as_py()) for text in batch.column(1)]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.int64())], names=[id_col, "fp"])

    chosen = docs.select(id_col, F.col(text_col).cast("string"))
    return map_batches(chosen, run, f"{id_col} {chosen.schema[id_col].dataType.simpleString()}, fp long")


def near_pairs(distinct: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that connect all fingerprints ``fp`` at ``distance`` (three at most) or less.

    Links within a bucket are thinned to a spanning forest, so a large group
    yields as many links as it has members, not all of its pairs.
    """
    if not 0 <= distance <= 3:
        raise ValueError("two halves serve distances up to 3")
    if bucket < 8:  # fewer than four bits cannot be cut into four pieces
        raise ValueError("a bucket must be allowed eight members")
    rows = map_batches(distinct.select("fp"), _variants, ROW)
    links: DataFrame | None = None
    while True:
        dealt = rows.repartition("key").sortWithinPartitions("key", "fp")
        found = written(dealt.mapInArrow(_linker(distance, bucket), LINK), "simhash")
        some = found.where("b is not null").select("a", "b")
        links = some if links is None else links.unionAll(some)
        hot = found.where("b is null").select("key", F.col("a").alias("fp"), "free")
        if hot.isEmpty():
            return links
        rows = map_batches(hot, _refined, ROW)


# A row of the index: ``free`` has the bits in which members of the bucket may differ.
ROW = "key long, fp long, free long"
# A link within a bucket, or (b null) a member of a bucket that has to be indexed finer.
LINK = "key long, a long, b long, free long"
HALVES = (range(32), range(32, 64))


def _mask(bits: Iterable[int]) -> np.uint64:
    return np.uint64(sum(1 << bit for bit in bits))


def _mixed(value: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the finaliser of splitmix64)."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def _index_rows(key: np.ndarray, fp: np.ndarray, free: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in (key, fp, free)], names=names)


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _variants(batch: pa.RecordBatch) -> pa.RecordBatch:
    """64 rows for each fingerprint: a half of it without one of its bits."""
    fp = _unsigned(batch.column(0))
    keys, free = [], []
    for half in HALVES:
        for bit in half:
            fixed = _mask(half) & ~_mask([bit])
            keys.append(_mixed(_mixed(fp & fixed) + np.uint64(bit + 1)))
            free.append(np.full(len(fp), ~fixed))
    return _index_rows(np.concatenate(keys), np.tile(fp, 64), np.concatenate(free), ["key", "fp", "free"])


def _refined(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Four rows for each member of a large bucket: the bucket and one piece of the free bits."""
    key, fp, free = (_unsigned(batch.column(i)) for i in range(3))
    keys, fps, frees = [], [], []
    for mask in np.unique(free):
        at = free == mask
        bits = [bit for bit in range(64) if int(mask) >> bit & 1]
        for piece in range(4):
            fixed = _mask(bits[piece::4])
            keys.append(_mixed(key[at] + _mixed((fp[at] & fixed) + np.uint64(piece + 1))))
            fps.append(fp[at])
            frees.append(np.full(at.sum(), mask & ~fixed))
    return _index_rows(np.concatenate(keys), np.concatenate(fps), np.concatenate(frees), ["key", "fp", "free"])


def _linker(distance: int, bucket: int):
    """Reads index rows sorted by key and yields links, or the members of buckets above ``bucket``.

    The bucket that a batch ends in is carried to the next one only as long as
    it may still be compared; a larger one streams through.
    """

    def links(key: np.ndarray, fp: np.ndarray, out: list[np.ndarray]) -> None:
        if len(fp) > 1:
            apart = np.bitwise_count(fp[:, None] ^ fp[None, :])
            left, right = np.nonzero(np.triu(apart <= distance, 1))
            if len(left):
                for a, b in zip(*spanning_links(len(fp), left, right)):
                    out.append((key[0], fp[a], fp[b], 0, True))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.uint64)] * 3
        streaming: np.uint64 | None = None  # key of the bucket that streams through
        for batch in batches:
            if not batch.num_rows:
                continue
            key, fp, free = (np.concatenate(x) for x in zip(held, (_unsigned(batch.column(i)) for i in range(3))))
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            ends = np.concatenate((starts[1:], [len(key)]))
            wanted = (ends - starts > 1) | (starts == 0) | (ends == len(key))
            out: list[tuple] = []
            held = [np.empty(0, np.uint64)] * 3
            for a, b in zip(starts[wanted].tolist(), ends[wanted].tolist()):
                if key[a] == streaming or b - a > bucket:
                    out.extend((key[a], x, 0, y, False) for x, y in zip(fp[a:b], free[a:b]))
                    streaming = key[a]
                elif b == len(key):
                    held = [key[a:b], fp[a:b], free[a:b]]
                else:
                    links(key[a:b], fp[a:b], out)
            if out:
                yield _found(out)
        out = []
        links(held[0], held[1], out)
        if out:
            yield _found(out)

    return run


def _found(rows: list[tuple]) -> pa.RecordBatch:
    key, a, b, free, linked = zip(*rows)
    key, a, b, free = (np.array(x, dtype=np.uint64).view(np.int64) for x in (key, a, b, free))
    columns = [pa.array(key), pa.array(a), pa.array(b, mask=~np.array(linked)), pa.array(free)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "a", "b", "free"])


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc id, fp, root, component) of every row of ``docs``.

    Fingerprints link at ``DISTANCE`` or fewer differing bits. ``root`` is the
    smallest fingerprint reachable by links, ``component`` the smallest id
    reachable, the row's own included. Rows without an id take part;
    ``component`` is null where no row of the group has one. Repeated rows come
    back as often as they occur, an empty table gives an empty one, and columns
    beside the two named are not read. Copies share a fingerprint, and only
    distinct fingerprints are indexed and compared.
    """
    prints = written(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min(id_col).alias("first")), "distinct_fingerprints")
    roots = components(near_pairs(distinct), "simhash_links").withColumnRenamed("node", "fp")
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    by_print = rooted.join(firsts, "root").select("fp", "root", "component")
    return prints.join(by_print, "fp").select(id_col, "fp", "root", "component")


def near_dedup(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near copies: of each group the one with the smallest id stays.

    Rows that repeat an id are copies of one document, and the first by text
    stays. A row without an id goes if its group has a row with one; of a group
    without any id, one row stays.
    """
    return keep_first(docs, simhash_groups(docs), fingerprint)


def keep_first(docs: DataFrame, groups: DataFrame, print_of: Callable[[str | None], int]) -> DataFrame:
    """The rows that ``near_dedup`` keeps of ``groups``, whose ``fp`` is ``print_of`` the text."""
    groups = written(groups, "near_groups")
    kept = groups.where("doc_id = component").select("doc_id").distinct()
    in_order = Window.partitionBy("doc_id").orderBy("text")
    named = docs.join(kept, "doc_id", "left_semi").withColumn(CHOICE, F.row_number().over(in_order))
    fingerprint_of = F.pandas_udf(lambda texts: texts.map(print_of), "long")
    # Ids are rarely missing, and scans skip what has none, so this part is small.
    roots = groups.where("doc_id is null and component is null").select(
        F.col("fp").alias(f"{PRINT}_of"), F.col("root").alias(ROOT)
    ).distinct()
    printed = docs.where("doc_id is null").withColumn(PRINT, fingerprint_of("text"))
    of_group = Window.partitionBy(ROOT).orderBy("text")
    nameless = printed.join(roots, F.col(PRINT) == F.col(f"{PRINT}_of")).withColumn(CHOICE, F.row_number().over(of_group))
    return (
        named.where(F.col(CHOICE) == 1)
        .select(*docs.columns)
        .unionByName(nameless.where(F.col(CHOICE) == 1).select(*docs.columns))
    )


# Names that do not clash with those of any table of documents.
CHOICE, PRINT, ROOT = "__simhash_choice", "__simhash_print", "__simhash_root"

"""Alignment of two tokenizers' tokens over the bytes of the same text, as an Arrow pipeline.

A task encodes a portion of rows with both tokenizers. The id lists are
flattened; the parent index of a token is its document. Segmented running sums
of token lengths give the byte at which each token ends within its document, and
(document, end) is a key. One outer hash join on that key puts the ends of both
tokenizers into one table: sorted by key, each of its rows is one overlap of an
A token with a B token, and where both tokenizers have an end a group ends.
``Table.group_by`` counts the pairs of ids of each document and of each chunk of
documents; Spark merges the chunks' counts, joins the totals to the chunks that
asked for them, and a second Arrow step sums them up for each document.

Two tokenizers: A is byte-level BPE (a ``tokenizers`` file, without added
prefix space), B is sentencepiece with byte fallback, which adds a space.
Null and empty texts, and texts whose tokens do not spell a space and the text
again, have no tokens: zeros and an empty string. Repeated rows, rows that
repeat an id and rows without an id come back like any other and count each.
An empty table gives no rows. Columns other than id and text are not read. A
text of any length is encoded in pieces cut where neither tokenizer can have a
token across.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import portions, written

# Bytes of text that are aligned at once, if no single text has more.
PORTION = 1_500_000
# Bytes of text whose counts are put together before they leave the task.
CHUNK = 8_000_000
# A space with neither white space nor B's sign for it beside: A starts a pre-token there, and no entry of B has a space
# inside. So texts are cut at each, the space left out, and every different piece is encoded once a portion.
_SEAM = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
# Texts without any of these have no other spaces.
_OTHER_SPACE = re.compile(r"\s\s|\A | \Z|▁")
# Different pieces whose ids a task remembers from portion to portion, and the longest of them: at most some 80 MB.
REMEMBERED, LONGEST = 400_000, 64
# An id pair as one number: A's id times this, and B's id.
SHIFT = 1 << 32
_IDS = pa.list_(pa.int32())


def _pieces(text: str) -> list[str]:
    return _SEAM.split(text) if _OTHER_SPACE.search(text) else text.split(" ")


class Tokenizers:
    """Both tokenizers, with the bytes of every entry."""

    def __init__(self, byte_level: str, pieces: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        if any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(self.b.vocab_size())):
            raise ValueError("tokenizer B has entries with a space inside")
        byte_of = _byte_of_character()
        entries = {i: entry for entry, i in self.a.get_vocab(with_added_tokens=False).items()}
        size = max(entries) + 1
        self.a_bytes = pa.array([bytes(map(byte_of.get, entries.get(i, ""))) for i in range(size)], pa.binary())
        self.b_bytes = pa.array(list(map(self._piece, range(self.b.vocab_size()))), pa.binary())
        self._forget()

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.known_a = self.known_b = pa.array([], _IDS)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[pa.ListArray, pa.ListArray]:
        """The id lists of A over a space and the text, and of B over the text."""
        cut = [_pieces(text) if text else [] for text in texts]
        pieces = pa.array(chain.from_iterable(cut), pa.string()).dictionary_encode()
        last = pa.array(np.cumsum([0, *map(len, cut)]))
        at = pc.index_in(pieces.dictionary, self.known)
        new = pieces.dictionary.filter(at.is_null())
        a, b = self._encode_new(new)
        # Places in what was known, followed by what is new.
        place = at.to_numpy(zero_copy_only=False)
        missing = np.isnan(place) if at.null_count else np.zeros(len(place), bool)
        place = np.where(missing, len(self.known) + np.cumsum(missing) - 1, np.nan_to_num(place)).astype(np.int64)
        indices = pa.array(place).take(pieces.indices)

        def whole(known: pa.ListArray, found: pa.ListArray) -> pa.ListArray:
            of_pieces = pa.concat_arrays([known, found]).take(indices)
            return pa.ListArray.from_arrays(of_pieces.offsets.take(last), of_pieces.flatten())

        made = whole(self.known_a, a), whole(self.known_b, b)
        self._remember(new, a, b)
        return made

    def _encode_new(self, new: pa.Array) -> tuple[pa.ListArray, pa.ListArray]:
        different = new.to_pylist()
        # Without offsets, which are not used.
        a = [e.ids for e in self.a.encode_batch_fast([" " + piece for piece in different], add_special_tokens=False)]
        b = self.b.encode(different, num_threads=1) if different else []
        return pa.array(a, _IDS), pa.array(b, _IDS)

    def _remember(self, new: pa.Array, a: pa.ListArray, b: pa.ListArray) -> None:
        """Keeps the short ones of ``new`` for the next portions; starts over when there are too many."""
        short = pc.less_equal(pc.binary_length(new), LONGEST)
        if len(self.known) + (pc.sum(short).as_py() or 0) > REMEMBERED:
            self._forget()
        kept = (x.filter(short).slice(0, REMEMBERED) for x in (new, a, b))
        self.known, self.known_a, self.known_b = (
            pa.concat_arrays(x) for x in zip((self.known, self.known_a, self.known_b), kept)
        )


def _byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level entry stands for."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


def _spelled(ids: pa.ListArray, entry_bytes: pa.Array) -> pa.Array:
    """The joined bytes of each list of ids."""
    data = pc.take(entry_bytes, ids.flatten())
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, data), b"")


def _ends(ids: pa.ListArray, entry_bytes: pa.Array, position: str) -> pa.Table:
    """(key, ``position``) of every token: document and end byte as one number, and the place in the flat list."""
    lengths = pc.binary_length(entry_bytes).take(ids.flatten()).cast(pa.int64())
    running = pc.cumulative_sum(lengths)
    parents = pc.list_parent_indices(ids).cast(pa.int64())
    offsets = ids.offsets.to_numpy()
    before = np.concatenate(([0], running.to_numpy(zero_copy_only=False)))[offsets[:-1]]
    within = pc.subtract(running, pa.array(before).take(parents))
    key = pc.add(pc.multiply(parents, pa.scalar(SHIFT)), within)
    return pa.table({"key": key, position: pa.array(np.arange(len(key)))})


def align(ids_a: pa.ListArray, ids_b: pa.ListArray, a_bytes: pa.Array, b_bytes: pa.Array) -> tuple[pa.Table, pa.Table]:
    """Links (doc, pair) and group ends (doc, a_last, b_last: places in the flat lists) of lists that spell the same bytes.

    A row of the joined ends is the stretch of bytes up to that end; the tokens
    that hold it are the next of each kind to end, there or later. The last
    tokens of a document end at the same byte, so no stretch leaves it.
    """
    ends = _ends(ids_a, a_bytes, "a").join(
        _ends(ids_b, b_bytes, "b"), "key", join_type="full outer", use_threads=False
    )
    ends = ends.take(pc.sort_indices(ends["key"])).combine_chunks()
    doc = pc.shift_right(ends["key"], pa.scalar(32, pa.int64()))
    a, b = (pc.fill_null_backward(ends[name]) for name in "ab")
    first = pc.multiply(ids_a.flatten().take(a).cast(pa.int64()), pa.scalar(SHIFT))
    pair = pc.add(first, ids_b.flatten().take(b).cast(pa.int64()))
    shared = pc.and_(ends["a"].is_valid(), ends["b"].is_valid())
    groups = pa.table({"doc": doc, "a_last": ends["a"], "b_last": ends["b"]}).filter(shared)
    return pa.table({"doc": doc, "pair": pair}), groups.combine_chunks()


def group_texts(ids_a: pa.ListArray, ids_b: pa.ListArray, groups: pa.Table) -> list[str]:
    """Each document's groups as text: ``a1,a2|b1;a3|b2,b3``."""
    sides = []
    for ids, last in ((ids_a, "a_last"), (ids_b, "b_last")):
        offsets = np.concatenate(([0], groups[last].to_numpy() + 1)).astype(np.int32)
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), ids.flatten().cast(pa.string())), ","))
    each = pc.binary_join_element_wise(*sides, "|")
    counts = np.bincount(groups["doc"].to_numpy(), minlength=len(ids_a))
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), each), ";").to_pylist()


def _counted(table: pa.Table, keys: list[str], sums: str | None = None) -> pa.Table:
    wanted = ([], "count_all") if sums is None else (sums, "sum")
    made = table.group_by(keys, use_threads=False).aggregate([wanted])
    return made.rename_columns([*keys, "n"])


def _emptied(ids: pa.ListArray, keep: np.ndarray) -> pa.ListArray:
    """The lists where ``keep``, empty lists elsewhere."""
    lengths = np.where(keep, ids.value_lengths().to_numpy(zero_copy_only=False), 0)
    flat = ids.flatten().filter(pa.array(keep).take(pc.list_parent_indices(ids)))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32()), flat)


def _aligned_portion(both: Tokenizers, texts: pa.Array, digest: bool) -> tuple[dict[str, pa.Array], pa.Table]:
    """Columns for each text of the portion, and (pair, n) of the portion."""
    texts = texts.fill_null("")
    ids_a, ids_b = both.encode(texts.to_pylist())
    wanted = pc.binary_join_element_wise(" ", texts, "").cast(pa.binary())
    same = pc.and_(
        pc.equal(_spelled(ids_a, both.a_bytes), wanted), pc.equal(_spelled(ids_b, both.b_bytes), wanted)
    )
    keep = pc.and_(same, pc.greater(pc.binary_length(texts), 0)).to_numpy(zero_copy_only=False)
    ids_a, ids_b = _emptied(ids_a, keep), _emptied(ids_b, keep)
    links, groups = align(ids_a, ids_b, both.a_bytes, both.b_bytes)
    text = group_texts(ids_a, ids_b, groups)
    if digest:
        text = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in text]
    hits = _counted(links, ["doc", "pair"]).sort_by([("doc", "ascending"), ("pair", "ascending")])
    offsets = np.searchsorted(hits["doc"].to_numpy(), np.arange(len(texts) + 1)).astype(np.int32)
    columns = {
        "n_a": ids_a.value_lengths().cast(pa.int64()),
        "n_b": ids_b.value_lengths().cast(pa.int64()),
        "n_groups": pa.array(np.bincount(groups["doc"].to_numpy(), minlength=len(texts)), pa.int64()),
        "groups": pa.array(text, pa.string()),
        "pairs": pa.ListArray.from_arrays(pa.array(offsets), hits["pair"].combine_chunks()),
        "hits": pa.ListArray.from_arrays(pa.array(offsets), hits["n"].combine_chunks()),
    }
    return columns, _counted(hits, ["pair"], "n")


_NAMES = ("n_a", "n_b", "n_groups", "groups", "pairs", "hits")
_COLUMNS = "n_a long, n_b long, n_groups long, groups string, pairs array<long>, hits array<long>"


def _encoded(docs: DataFrame, byte_level: str, pieces: str, digest: bool) -> DataFrame:
    """A row (chunk, whole = false, id, ...) for each document, and one (chunk, whole = true, pairs, hits) for each chunk."""
    with open(byte_level, encoding="utf-8") as a, open(pieces, "rb") as b:
        sent = docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_cpu_count(1)
        both = Tokenizers(*sent.value)
        chunk, size, counts = TaskContext.get().partitionId() * SHIFT, 0, []

        def closed() -> pa.RecordBatch:
            merged = _counted(pa.concat_tables(counts), ["pair"], "n").combine_chunks()
            lists = [pa.array([merged[name].to_pylist()], pa.list_(pa.int64())) for name in ("pair", "n")]
            empty = [pa.nulls(1, kind) for kind in (id_type, pa.int64(), pa.int64(), pa.int64(), pa.string())]
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk]), pa.array([True]), *empty, *lists], names=["chunk", "whole", "id", *_NAMES]
            )

        for some in portions(batches, 1, PORTION):
            id_type = some.column(0).type
            columns, merged = _aligned_portion(both, some.column(1), digest)
            n = some.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, chunk)), pa.array(np.zeros(n, bool)), some.column(0), *columns.values()],
                names=["chunk", "whole", "id", *columns],
            )
            counts.append(merged)
            size += pc.sum(pc.binary_length(some.column(1))).as_py() or 0
            if size > CHUNK:
                yield closed()
                chunk, size, counts = chunk + 1, 0, []
            elif len(counts) > 8:
                counts = [_counted(pa.concat_tables(counts), ["pair"], "n")]
        if counts:
            yield closed()

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"chunk long, whole boolean, id {kind}, {_COLUMNS}")


def pair_counts(encoded: DataFrame) -> DataFrame:
    """(pair, count, best) of the whole corpus; best: no A id is linked with the pair's B id more often."""
    rows = encoded.where("whole").select(F.explode(F.arrays_zip("pairs", "hits")).alias("x"))
    totals = rows.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.hits").alias("count"))
    totals = totals.withColumn("b", F.col("pair") % SHIFT)
    highest = totals.groupBy("b").agg(F.max("count").alias("highest"))
    return totals.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def aligned(
    docs: DataFrame, byte_level: str, pieces: str, id_col: str = "doc_id", text_col: str = "text", digest: bool = False
) -> DataFrame:
    """(``id_col``, n_a, n_b, n_groups, groups, n_links, n_best, count_sum) of every row.

    ``byte_level`` and ``pieces`` are files on the driver. ``groups`` is the
    alignment as text, ``a1,a2|b1;a3|b2,b3``, or its SHA-256 with ``digest``.
    """
    chosen = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    encoded = written(_encoded(chosen, byte_level, pieces, digest), "crosstok-encoded")
    counts = written(pair_counts(encoded), "crosstok-pairs")
    asked = encoded.where("whole").select(F.col("chunk").alias("of"), F.explode("pairs").alias("pair"))
    asked = asked.join(counts, "pair")
    kind = chosen.schema["id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "groups", "n_links", "n_best", "count_sum"]
    made = (
        encoded.where("not whole").drop("whole").groupBy("chunk").cogroup(asked.groupBy("of"))
        .applyInArrow(
            _summed, f"id {kind}, n_a long, n_b long, n_groups long, groups string, n_links long, n_best long, count_sum long"
        )
    )
    return made.select(F.col("id").alias(id_col), *names)


def _summed(rows: pa.Table, counts: pa.Table) -> pa.Table:
    """Links, best links and counts of each row, by a hash join of its pairs with the counts."""
    pa.set_cpu_count(1)
    rows = rows.combine_chunks()
    pairs, hits = (rows[name].combine_chunks() for name in ("pairs", "hits"))
    flat = pa.table({"row": pc.list_parent_indices(pairs).cast(pa.int64()), "pair": pairs.flatten(), "n": hits.flatten()})
    flat = flat.join(counts.select(["pair", "count", "best"]), "pair", join_type="inner", use_threads=False)
    flat = pa.table({
        "row": flat["row"],
        "n_links": flat["n"],
        "n_best": pc.multiply(flat["n"], flat["best"].cast(pa.int64())),
        "count_sum": pc.multiply(flat["n"], flat["count"]),
    })
    sums = flat.group_by("row", use_threads=False).aggregate([(name, "sum") for name in flat.column_names[1:]])
    at = sums["row"].to_numpy()
    made = rows.select(["id", "n_a", "n_b", "n_groups", "groups"])
    for name in ("n_links", "n_best", "count_sum"):
        values = np.zeros(len(rows), np.int64)
        values[at] = sums[f"{name}_sum"].to_numpy()
        made = made.append_column(name, pa.array(values))
    return made

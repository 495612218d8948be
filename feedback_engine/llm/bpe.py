"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pre-tokens are linked lists of byte pieces. Every adjacent pair whose bytes
are a token waits in the bucket of that token's rank. A bitmap of two levels
has a bit for every bucket in use, so two find-first-set steps give the lowest
rank, however long the lists are. A merge changes at most two pairs; their old
entries stay in their buckets and are skipped when they come up.

Merges in different pre-tokens do not touch each other, so one queue serves all
new pre-tokens of a batch: a bucket is merged with a few numpy steps.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import portions

BLOCK = 256
# How many different strings, and characters of them, a task remembers: bounds memory only.
REMEMBERED, REMEMBERED_CHARS = 200_000, 6_000_000
# Characters, or ids, that are worked on at once, if no single text holds more.
PORTION = 1_500_000
# Positions in a bucket up to which they are merged one by one.
FEW = 12


class RankQueue:
    """Buckets of positions by rank; ``pop`` takes the bucket of the lowest rank."""

    def __init__(self) -> None:
        self.top = 0  # a bit for each block with a bucket in use
        self.blocks: dict[int, int] = {}  # a bit for each bucket in use
        self.buckets: dict[int, list[int]] = {}

    def push(self, rank: int, positions: list[int]) -> None:
        bucket = self.buckets.get(rank)
        if bucket is not None:
            bucket += positions
            return
        self.buckets[rank] = positions
        block, bit = divmod(rank, BLOCK)
        self.blocks[block] = self.blocks.get(block, 0) | 1 << bit
        self.top |= 1 << block

    def pop(self) -> tuple[int, list[int]]:
        block = (self.top & -self.top).bit_length() - 1
        bits = self.blocks[block]
        lowest = bits & -bits
        self.blocks[block] = bits ^ lowest
        if bits == lowest:
            self.top ^= 1 << block
        rank = block * BLOCK + lowest.bit_length() - 1
        return rank, self.buckets.pop(rank)


class BytePairs:
    """Encoder and decoder for a vocabulary in tiktoken's file format."""

    def __init__(self, vocabulary: bytes, pattern: str) -> None:
        lines = (line.split() for line in vocabulary.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.size = max(self.ranks.values(), default=0) + 1
        self.pieces = regex.compile(pattern).findall
        by_rank = [b""] * self.size
        for token, rank in self.ranks.items():
            by_rank[rank] = token
        self.bytes = np.frombuffer(b"".join(by_rank), np.uint8)
        self.lengths = np.fromiter(map(len, by_rank), np.int64, self.size)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.single = np.array([self.ranks.get(bytes([x]), -1) for x in range(256)], np.int32)
        # Every pair of tokens that makes a token, as left * size + right, and the rank it makes.
        self.made = made = {
            self.ranks[token[:k]] * self.size + self.ranks[token[k:]]: rank
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        }
        self.pairs = np.array(sorted(made), np.int64)
        self.makes = np.array([made[x] for x in self.pairs.tolist()], np.int32)
        # Whether a token, next to some other, is part of a pair of a lower rank.
        self.opens_lower = np.zeros(self.size, bool)
        for side in divmod(self.pairs, self.size):
            self.opens_lower[side[self.makes < side]] = True
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.known_chars = 0
        self.ids = np.empty(0, np.int32)  # of all known strings, one after the other
        self.ends = np.zeros(1, np.int64)  # of each known string within ids, after a leading zero

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens; -1 where the two make none."""
        if not len(self.pairs):
            return np.full(len(left), -1, np.int32)
        keys = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.makes[at], np.int32(-1))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all ``texts``, one after the other, and where each text starts (and the last ends)."""
        strings = [_strings(text, self.pieces) for text in texts]
        if len(self.known) > REMEMBERED or self.known_chars > REMEMBERED_CHARS:
            self.forget()
        counts = np.fromiter(map(len, strings), np.int64, len(strings))
        flat = list(chain.from_iterable(strings))
        del strings
        new = set(flat) - self.known.keys()
        if new:
            self._learn(list(new))
        chosen = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        del flat
        lengths = self.ends[chosen + 1] - self.ends[chosen]
        before = np.concatenate(([0], np.cumsum(lengths)))
        offsets = before[np.concatenate(([0], np.cumsum(counts)))]
        return self.ids[_ranges(self.ends[chosen], lengths)], offsets

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ``ids`` and, for each of ``offsets`` into the ids, the offset into the bytes."""
        if len(ids) and not (0 <= ids.min() and ids.max() < self.size and self.lengths[ids].all()):
            raise ValueError("an id is not in the vocabulary")
        lengths = self.lengths[ids]
        before = np.concatenate(([0], np.cumsum(lengths)))
        return self.bytes[_ranges(self.starts[ids], lengths)], before[offsets]

    def _learn(self, strings: list[str]) -> None:
        split = [self.pieces(x) for x in strings]
        pieces = [piece.encode() for some in split for piece in some]
        distinct = {piece: k for k, piece in enumerate(dict.fromkeys(pieces))}
        ids, ends = self._merged(list(distinct))
        chosen = np.fromiter(map(distinct.__getitem__, pieces), np.int64, len(pieces))
        lengths = ends[chosen + 1] - ends[chosen]
        before = np.concatenate(([0], np.cumsum(lengths)))
        string_ends = before[np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))]
        del split, pieces, distinct
        start = len(self.known)
        self.known.update(zip(strings, range(start, start + len(strings))))
        self.known_chars += sum(map(len, strings))
        self.ends = np.concatenate((self.ends, string_ends + len(self.ids)))
        self.ids = np.concatenate((self.ids, ids[_ranges(ends[chosen], lengths)]))

    def _merged(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all ``pieces``, one after the other, and their ends after a leading zero."""
        whole = np.array([self.ranks.get(piece, -1) for piece in pieces], np.int32)
        sizes = np.where(whole < 0, np.fromiter(map(len, pieces), np.int64, len(pieces)), 1)
        ends = np.cumsum(sizes)
        open_pieces = [piece for piece, rank in zip(pieces, whole.tolist()) if rank < 0]
        token = np.empty(int(ends[-1]), np.int32)
        alive = np.ones(len(token), bool)
        is_whole = np.repeat(whole >= 0, sizes)
        token[is_whole] = whole[whole >= 0]
        token[~is_whole] = self.single[np.frombuffer(b"".join(open_pieces), np.uint8)]
        self._merge(token, alive, ends)
        counted = np.concatenate(([0], np.cumsum(alive)))
        return token[alive], counted[np.concatenate(([0], ends))]

    def _merge(self, token: np.ndarray, alive: np.ndarray, ends: np.ndarray) -> None:
        """Merges within the lists that end before each of ``ends``; a merged pair's right piece is no longer alive."""
        n = len(token)
        after = np.arange(1, n + 1)
        after[ends - 1] = n  # n: none
        after = np.append(after, n)
        before = np.arange(-1, n - 1)
        before[np.concatenate(([0], ends[:-1]))] = -1
        pair = np.full(n + 1, -1, np.int32)  # rank of a piece and the next one; one more for "none"
        inner = np.flatnonzero(after[:n] < n)
        pair[inner] = self.rank_of(token[inner], token[after[inner]])
        queue = RankQueue()
        start = np.flatnonzero(pair >= 0)
        start = start[np.argsort(pair[start], kind="stable")]
        cuts = np.flatnonzero(np.diff(pair[start])) + 1
        for some in np.split(start, cuts):
            if len(some):
                queue.push(int(pair[some[0]]), some.tolist())
        while queue.top:
            rank, bucket = queue.pop()
            if len(bucket) <= FEW:
                self._merge_few(rank, sorted(set(bucket)), queue, token, alive, after, before, pair)
                continue
            at = np.array(bucket)
            at = np.unique(at[pair[at] == rank])  # the others are stale
            if not len(at):
                continue
            if self.opens_lower[rank] and len(at) > 1:
                # A merge that opens a pair of a lower rank must be the only one in its list for now.
                list_of = np.searchsorted(ends, at, side="right")
                lower = self._lower_beside(rank, token, before[at], after[after[at]])
                if lower.any():
                    single = np.isin(list_of, list_of[lower])
                    _, leftmost = np.unique(list_of, return_index=True)
                    waits = single.copy()
                    waits[leftmost] = False
                    if waits.any():
                        queue.push(rank, at[waits].tolist())
                        at = at[~waits]
            at = _without_overlaps(at, after)
            gone = after[at]
            token[at] = rank
            alive[gone] = False
            pair[gone] = -1
            end = after[gone]
            after[at] = end
            inside = end < n
            before[end[inside]] = at[inside]
            left = before[at]
            changed = np.concatenate((at[inside], left[left >= 0]))
            pair[at[~inside]] = -1
            pair[changed] = new = self.rank_of(token[changed], token[after[changed]])
            opens = new >= 0
            push = queue.push
            for position, made in zip(changed[opens].tolist(), new[opens].tolist()):
                push(made, [position])

    def _merge_few(self, rank, positions, queue, token, alive, after, before, pair) -> None:
        """The same for a bucket too small for numpy to pay, from the left, until a lower rank turns up."""
        n, size, made = len(token), self.size, self.made
        for k, i in enumerate(positions):
            if pair[i] != rank:
                continue
            gone = after[i]
            token[i] = rank
            alive[gone] = False
            pair[gone] = -1
            end = after[i] = after[gone]
            left, lowest = before[i], rank
            pair[i] = -1
            if end < n:
                before[end] = i
                pair[i] = new = made.get(rank * size + int(token[end]), -1)
                if new >= 0:
                    queue.push(new, [i])
                    lowest = min(lowest, new)
            if left >= 0:
                pair[left] = new = made.get(int(token[left]) * size + rank, -1)
                if new >= 0:
                    queue.push(new, [int(left)])
                    lowest = min(lowest, new)
            if lowest < rank:
                if positions[k + 1 :]:
                    queue.push(rank, positions[k + 1 :])
                return

    def _lower_beside(self, rank: int, token: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the token ``rank`` would make one of a lower rank with a neighbour, as that is or once merged alike."""
        lower = np.zeros(len(left), bool)
        fixed = np.full(len(left), rank, np.int32)
        for side, exists in ((left, left >= 0), (right, right < len(token))):
            beside = np.where(exists, token[np.clip(side, 0, len(token) - 1)], rank)
            made = self.rank_of(beside, fixed) if side is left else self.rank_of(fixed, beside)
            lower |= (made >= 0) & (made < rank)
        twice = self.rank_of(fixed[:1], fixed[:1])[0]
        return lower | (0 <= twice < rank)


def _without_overlaps(at: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Every other one of each run of pairs that share a piece, from the left."""
    joined = after[at[:-1]] == at[1:]
    if not joined.any():
        return at
    begins = np.concatenate(([True], ~joined))
    k = np.arange(len(at))
    return at[(k - np.maximum.accumulate(np.where(begins, k, 0))) % 2 == 0]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its length says, one after the other."""
    total = int(lengths.sum())
    shift = starts - (np.cumsum(lengths) - lengths)
    return np.repeat(shift, lengths) + np.arange(total)


# A space beside other white space. At any other space a pre-token may start, and none goes across it, since a
# pattern of this kind joins white space at most with what follows.
_WHITE = [chr(x) for x in range(0x3001) if chr(x).isspace()]
_UNEVEN = list(dict.fromkeys([*(x + " " for x in _WHITE), *(" " + x for x in _WHITE)]))


def _strings(text: str | None, pieces: Callable[[str], list[str]]) -> list[str]:
    """Strings that pre-tokens do not cross, joined the text: single words where its spaces are single."""
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or any(x in text for x in _UNEVEN):
        return pieces(text)
    first, *others = text.split(" ")
    return [first, *map(" ".__add__, others)]


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    back: bool = False,
    portion: int = PORTION,
) -> DataFrame:
    """(``id_col``, ids) of every row: the token ids of the whole text, without special tokens.

    ``vocabulary`` is the path of a rank file on the driver, which sends it to
    the tasks; ``pattern`` splits a text into pre-tokens. With ``back`` the ids
    are decoded again, into a column ``decoded``, by the same task. ``portion``
    is the characters that a task works on at once. Null and
    empty texts have no ids. Rows without an id and repeated rows come back like
    any other; further columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairs(sent.value, pattern)
        for some in portions(batches, 1, portion):
            ids, offsets = coder.encode(some.column(1).to_pylist())
            made = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            columns, names = [some.column(0), made], [id_col, "ids"]
            if back:
                columns, names = [*columns, _decoded(coder, made)], [*names, "decoded"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    chosen = docs.select(id_col, F.col(text_col).cast("string"))
    kind = chosen.schema[id_col].dataType.simpleString()
    return chosen.mapInArrow(run, f"{id_col} {kind}, ids array<int>" + ", decoded binary" * back)


def decode(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """(doc_id, ids) with the bytes that the array ``ids`` stands for as ``decoded``.

    Null ids give null. An id outside the vocabulary is an error.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(_read(vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = BytePairs(sent.value, pattern)
        for some in portions(batches, 1, PORTION):
            made = _decoded(coder, some.column(1))
            yield pa.RecordBatch.from_arrays([*some.columns, made], names=[*some.schema.names, "decoded"])

    chosen = encoded.select("doc_id", "ids")
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded binary")


def _decoded(coder: BytePairs, ids: pa.ListArray) -> pa.Array:
    lengths = ids.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    data, ends = coder.decode(ids.flatten().to_numpy(zero_copy_only=False), offsets)
    made = pa.Array.from_buffers(
        pa.binary(), len(ids), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)]
    )
    return pa.compute.if_else(ids.is_valid(), made, pa.scalar(None, pa.binary())) if ids.null_count else made


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def digests(decoded: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows with doc_id, ids and decoded, and ``more`` of them."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )

"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens.

Tokens of key-like characters are taken apart by the encoding they may be of.
Tests compare a token with what a random key of that encoding looks like:
chi-squared for the use of the alphabet's parts, runs of characters of one part
or of one character, and serial correlation of neighbouring characters. The probability that a random
key deviates as much in any of them is the token's likeness.

What ordinary tokens look like is a model of neighbouring characters, counted on
the corpus itself: its short tokens and its words. A token's p-value is the
ratio of its chance under that model to its chance as a random key: over the
tokens of a length that the model makes, the inverse ratio is one on average, so
(Markov's inequality) the p-value is valid however few tokens there are. The
step-up procedure of Benjamini and Hochberg, over all tokens of a range of
length, decides which are secrets.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from math import erfc, exp, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedback_engine.llm.common import portions, written

# Fixed patterns and least lengths.
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # whole runs, so the same as dropping shorter ones
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
LENGTHS = (16, 20, 24, 32, 48)  # each range of length reaches to the next one
BINS = 100  # of p-values, in steps of their natural logarithm
FALSE_DISCOVERIES = 0.01
LEAST_LIKENESS = 0.001  # a token less like a random key than this is none, however unlike words it is
RANDOM = 3
# Bytes of text that a task works on at once, if no single text has more.
PORTION = 2_000_000

# Parts of an alphabet: how many characters of it each has. Tried in this order.
_ENCODINGS = [
    (re.compile(r"[0-9a-f]+\Z"), (10, 6, 0, 0)),
    (re.compile(r"[0-9A-F]+\Z"), (10, 0, 6, 0)),
    (re.compile(r"[A-Z2-7]+=*\Z"), (6, 0, 26, 0)),
    (re.compile(r"[0-9a-z]+\Z"), (10, 26, 0, 0)),
    (re.compile(r"[0-9A-Z]+\Z"), (10, 0, 26, 0)),
    (re.compile(r"[0-9A-Za-z]+\Z"), (10, 26, 26, 0)),
    (re.compile(r"[0-9A-Za-z+/_-]+=*\Z"), (10, 26, 26, 2)),
]
_PART = {c: k for k, part in enumerate(("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "+/_-")) for c in part}
_ORDINARY = re.compile(r"(?:[a-z]+|[A-Z]+|[A-Z][a-z]+)\Z")


def likeness(token: str) -> float:
    """Chance that a random key of the token's encoding deviates as much from the expected in any test."""
    body = token.rstrip("=")
    n = len(body)
    parts = [_PART[c] for c in body]
    for pattern, alphabet in _ENCODINGS:
        if pattern.match(token):
            break
    shares = [size / sum(alphabet) for size in alphabet]
    used = [k for k in range(4) if alphabet[k]]
    chi = sum((parts.count(k) - n * shares[k]) ** 2 / (n * shares[k]) for k in used)
    # Upper tail of chi-squared with one, two or three degrees of freedom.
    half = chi / 2
    tails = {1: erfc(sqrt(half)), 2: exp(-half), 3: erfc(sqrt(half)) + 2 * sqrt(half / np.pi) * exp(-half)}
    chances = [tails[len(used) - 1]]
    same = sum(share**2 for share in shares)
    changes = sum(a != b for a, b in zip(parts, parts[1:]))
    cubes = sum(share**3 for share in shares)
    variance = max((n - 1) * same * (1 - same) + 2 * (n - 2) * (cubes - same**2), 0.25)
    chances.append(erfc(abs(changes - (n - 1) * (1 - same)) / sqrt(2 * variance)))
    # Runs of one character: neighbours that are equal are about Poisson.
    rate, below, term = (n - 1) / sum(alphabet), 0.0, exp(-(n - 1) / sum(alphabet))
    for k in range(sum(a == b for a, b in zip(body, body[1:]))):
        below, term = below + term, term * rate / (k + 1)
    chances.append(max(1 - below, 0.0))
    codes = np.frombuffer(body.encode(), np.uint8).astype(float)
    codes -= codes.mean()
    spread = float(codes @ codes)
    serial = float(codes[:-1] @ codes[1:]) / spread if spread else 1.0
    chances.append(erfc(abs(serial + 1 / n) * sqrt(n / 2)))
    return min(1.0, len(chances) * min(chances))


# Characters of tokens by number; all others count as EDGE.
_KEY = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_-="
EDGE = len(_KEY)
_CODE = np.full(256, EDGE, np.int64)
_CODE[np.frombuffer(_KEY.encode(), np.uint8)] = np.arange(EDGE)
# Weight, in characters, of single characters against pairs.
BACKOFF = 20
# Chance that a word of a name like theseWords or these_words ends at a character.
JOINT = 0.1


def _codes(text: str) -> np.ndarray:
    """Number of each code point."""
    return _CODE[np.frombuffer(text.encode("latin-1", "replace"), np.uint8)]


def pairs(text: str) -> np.ndarray:
    """Counts of neighbouring characters in tokens that are short or words, clear of the fixed patterns."""
    codes, base = _codes(text), base_spans(text)
    for start, end, _ in base:
        codes[start:end] = EDGE
    for m in TOKEN.finditer(text):
        if not _ORDINARY.match(m[0]):
            codes[m.start() : m.end()] = EDGE
    codes = np.concatenate(([EDGE], codes))
    kept = codes[1:] != EDGE
    return np.bincount(codes[:-1][kept] * EDGE + codes[1:][kept], minlength=(EDGE + 1) * EDGE).reshape(EDGE + 1, EDGE)


def model(docs: DataFrame) -> np.ndarray:
    """Counts of neighbouring characters over all texts: a table of fixed size, all that comes to the driver."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((EDGE + 1) * EDGE, np.int64)
        for batch in portions(batches, 0, PORTION):
            for value in batch.column(0):
                if text := value.as_py():
                    counts += pairs(text).ravel()
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], names=["k", "n"])

    counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "k long, n long")
    counts = np.zeros((EDGE + 1) * EDGE)
    for row in counted.groupBy("k").agg(F.sum("n").alias("n")).collect():
        counts[row["k"]] = row["n"]
    return counts.reshape(EDGE + 1, EDGE)


def evidence(token: str, counts: np.ndarray) -> float:
    """Minus the logarithm of a token's p-value.

    What a word itself adds to ``counts`` is taken off; other long tokens are not in them.
    """
    codes, body = _codes(token), len(token.rstrip("="))
    before, after = np.concatenate(([EDGE], codes[:-1])), codes
    pair, rows, single, total = counts[before, after], counts.sum(1)[before], counts.sum(0)[after], counts.sum()
    if _ORDINARY.match(token):
        pair = np.maximum(pair - _own(before * EDGE + after), 0)
        rows = np.maximum(rows - _own(before), 0)
        single = np.maximum(single - _own(after), 0)
        total = max(total - len(codes), 0)
    plain = _log_chance(pair, rows, single, total)[:body].sum()  # padding has no choice
    # Any digits make an ordinary number, however rare numbers are in the corpus.
    number = -body * log(10) if token.isdigit() else -np.inf
    ordinary = np.logaddexp(np.logaddexp(plain, _joined(codes[:body], counts)), number) - log(3)
    size = next(sum(alphabet) for pattern, alphabet in _ENCODINGS if pattern.match(token))
    # A key is of any of the encodings.
    return float(-ordinary - body * log(size) - log(len(_ENCODINGS)))


def _log_chance(pair: np.ndarray, rows: np.ndarray, single: np.ndarray, total: float) -> np.ndarray:
    return np.log((pair + BACKOFF * (single + 1) / (total + EDGE)) / (rows + BACKOFF))


def _joined(codes: np.ndarray, counts: np.ndarray) -> float:
    """Logarithm of the chance of a name of joined words: a capital or a sign begins a word."""
    capital, sign = (codes >= 36) & (codes < 62), codes >= 62
    opens = capital & ~np.concatenate(([False], capital[:-1]))
    after = np.where(opens, codes - 26, codes)
    before = np.concatenate(([EDGE], after[:-1]))
    before[opens | np.concatenate(([True], sign[:-1]))] = EDGE
    chance = _log_chance(counts[before, after], counts.sum(1)[before], counts.sum(0)[after], counts.sum())
    chance = np.where(sign, log(JOINT / 4), chance + np.where(opens, log(JOINT), log(1 - 2 * JOINT)))
    return float(chance.sum())


def _own(keys: np.ndarray) -> np.ndarray:
    """How often each of ``keys`` occurs among them."""
    _, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[at]


def _bin(token: str, counts: np.ndarray) -> int:
    """Bin of a token's p-value; the last ones are the smallest p-values, and bin 0 is never a secret."""
    found = evidence(token, counts)
    return 0 if found < 1 or likeness(token) < LEAST_LIKENESS else min(BINS - 1, int(found))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the fixed patterns, in code points, by start and then kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in _KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[1]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[0], x[2]))


def tokens(text: str, taken: list[tuple[int, int, int]], counts: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(start, end, range of length, bin) of the tokens that lie clear of the spans ``taken``."""
    found = []
    for m in TOKEN.finditer(text):
        start, end = m.span()
        if any(a < end and start < b for a, b, _ in taken):
            continue
        length = sum(end - start >= least for least in LENGTHS) - 1
        found.append((start, end, length, _bin(m[0], counts)))
    return found


_SCANNED = (
    "doc_id {}, base array<struct<start:int,end:int,kind:int>>, "
    "tokens array<struct<start:int,end:int,length:int,bin:int>>"
)


def scanned(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """(doc_id, base, tokens) of every row's whole text; a null text has neither."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1, PORTION):
            base, other = [], []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = base_spans(text)
                base.append([dict(zip(("start", "end", "kind"), x)) for x in spans])
                names = ("start", "end", "length", "bin")
                other.append([dict(zip(names, x)) for x in tokens(text, spans, counts)])
            i = pa.int32()
            span = pa.list_(pa.struct([("start", i), ("end", i), ("kind", i)]))
            token = pa.list_(pa.struct([("start", i), ("end", i), ("length", i), ("bin", i)]))
            columns = [batch.column(0), pa.array(base, span), pa.array(other, token)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "tokens"])

    chosen = docs.select("doc_id", F.col("text").cast("string"))
    return chosen.mapInArrow(run, _SCANNED.format(chosen.schema["doc_id"].dataType.simpleString()))


def limits(scan: DataFrame, false_discoveries: float = FALSE_DISCOVERIES) -> list[int]:
    """For each range of length, the bin from which on tokens are secrets; ``BINS`` if none is.

    Counts of all tokens by range and bin come to the driver: at most
    ``len(LENGTHS) * BINS`` rows. A bin stands for the largest p-value in it.
    """
    counted = scan.select(F.explode("tokens").alias("t")).groupBy("t.length", "t.bin").count().collect()
    table = np.zeros((len(LENGTHS), BINS))
    for row in counted:
        table[row["length"], row["bin"]] = row["count"]
    p = np.exp(-np.arange(float(BINS)))
    found = []
    for tested in table:
        discovered = np.cumsum(tested[::-1])[::-1]
        passing = np.flatnonzero((discovered > 0) & (p * tested.sum() <= false_discoveries * discovered))
        found.append(int(passing[0]) if len(passing) else BINS)
    return found


def _secret(bins: list[int]) -> str:
    which = " or ".join(f"(t.length = {k} and t.bin >= {bins[k]})" for k in range(len(bins)))
    return f"filter(tokens, t -> {which})"


def found_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (start, end, kind), in order of start and kind.

    ``spans`` has the base spans and those the tests add. Rows without an id and
    repeated rows are scanned like any other; null and empty texts have none.
    """
    scan = written(scanned(docs, model(docs)), "secret_scan")
    added = f"transform({_secret(limits(scan))}, t -> named_struct('start', t.start, 'end', t.end, 'kind', {RANDOM}))"
    in_order = "case when a.start < b.start or (a.start = b.start and a.kind < b.kind) then -1 else 1 end"
    spans = F.expr(f"array_sort(concat(base, {added}), (a, b) -> {in_order})")
    return scan.select("doc_id", "base", spans.alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row."""
    names = "array(" + ", ".join(f"'{kind}'" for kind in KINDS) + ")"

    def joined(column: str):
        text = f"transform({column}, s -> concat_ws(':', {names}[s.kind], s.start, s.end))"
        return F.expr(f"array_join({text}, ',')")

    counts = [
        F.expr(f"cast(size(filter(base, s -> s.kind = {k})) as bigint)").alias(f"n_{KINDS[k]}") for k in range(RANDOM)
    ]
    return found_spans(docs).select(
        "doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


MARK = "[secret]"


def redacted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with ``MARK`` in place of every secret, and ``n_chars`` of the new text."""
    counts = model(docs)
    bins = limits(scanned(docs, counts))
    at, size = docs.columns.index("text"), docs.columns.index("n_chars")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, at, PORTION):
            texts, sizes = batch.column(at).to_pylist(), batch.column(size).to_pylist()
            for k, text in enumerate(texts):
                if text and (spans := _all_spans(text, bins, counts)):
                    texts[k] = _replaced(text, spans)
                    sizes[k] = len(texts[k])
            columns = list(batch.columns)
            columns[at], columns[size] = pa.array(texts, columns[at].type), pa.array(sizes, columns[size].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _all_spans(text: str, bins: list[int], counts: np.ndarray) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    added = [(a, b, RANDOM) for a, b, length, bin_ in tokens(text, base, counts) if bin_ >= bins[length]]
    return sorted(base + added)


def _replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with one mark for each stretch that spans cover, overlapping ones together."""
    parts, at, covered = [], 0, -1
    for start, end, _ in spans:
        if start >= covered:
            parts += [text[at:start], MARK]
        covered = at = max(covered, end)
    return "".join([*parts, text[at:]])

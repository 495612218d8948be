"""Language identification from character trigrams.

Training is a Spark aggregation over all labelled rows, or over a bounded sample
of them, and keeps every trigram. Its result follows the alphabets, not the
number of texts, so scoring needs neither join nor shuffle: the profile is sent
to the tasks once, and each adds up scores for its own rows. Joining trigrams as
rows would shuffle every document apart and together again.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
MIN_CHARS = 20
LOG_SCALE = 1000

# Each match consumes one character and captures the three starting there.
_TRIGRAM = r"(?s)(?=(.{3}))."
# Trigrams that a task sorts and counts at once.
COUNTED = 1_000_000


def trigram_counts(df: DataFrame, text: str, lang: str) -> DataFrame:
    """How often each trigram occurs per language.

    Tasks count them within portions of texts, so a row is shuffled for each
    different one and not for each character.
    """
    lowered = df.select(F.col(lang).alias("lang"), F.lower(text).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0).dictionary_encode("encode")
            which = groups.indices.to_numpy(zero_copy_only=False)
            for k, value in enumerate(groups.dictionary):
                of_group = batch.column(1).filter(pa.array(which == k))
                for _, pieces in _portions(_plain(of_group), COUNTED):
                    codes, counts = np.unique(_grams(pieces)[0], return_counts=True)
                    columns = [pa.repeat(value, len(codes)), pa.array(_spelled(codes), pa.string()), pa.array(counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    kind = lowered.schema["lang"].dataType.simpleString()
    counted = lowered.mapInArrow(run, f"lang {kind}, gram string, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def labelled_sample(df: DataFrame, lang: str, key: str, rows: int) -> DataFrame:
    """At most ``rows`` rows per language: those with the smallest hashes of ``key``."""
    order = Window.partitionBy(lang).orderBy(F.xxhash64(key), key)
    ranked = df.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= rows).drop("_rank")


def train_profile(df: DataFrame, text: str, lang: str) -> DataFrame:
    """All trigrams per language with smoothed log-probabilities.

    Logarithms are scaled to integers so that sums do not depend on row order.
    ``floor`` is the value of a trigram the language's profile does not hold.
    To bound the fit, hand in a ``labelled_sample``.
    """
    counts = trigram_counts(df, text, lang)
    mass = counts.groupBy("lang").agg((F.sum("n") + F.count("*")).alias("mass"))

    def scaled_log(share: Column) -> Column:
        return F.round(F.log(share) * F.lit(float(LOG_SCALE))).cast("bigint")

    return counts.join(mass, "lang").select(
        "lang",
        "gram",
        "n",
        scaled_log((F.col("n") + 1) / F.col("mass")).alias("logp"),
        scaled_log(F.lit(1.0) / F.col("mass")).alias("floor"),
    )


def save_profile(profile: DataFrame, folder: str, version: int) -> None:
    """Store a trained profile under its version; the same version again replaces it."""
    profile.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{VERSION}={version}")


def stored_profile(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored profile, the newest if none is named."""
    stored = spark.read.parquet(folder)
    if version is None:
        version = stored.agg(F.max(VERSION)).first()[0]
    return stored.filter(F.col(VERSION) == version).drop(VERSION)


VERSION = "version"
SHIFT = np.uint64(21)


def _trigram_codes(chars: np.ndarray) -> np.ndarray:
    """Each trigram packed into one integer, 21 bits per character."""
    return (((chars[:-2] << SHIFT) | chars[1:-1]) << SHIFT) | chars[2:]


def _code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)


def _plain(texts: pa.Array) -> Iterator[str]:
    """The texts that are not null, one after the other."""
    return (text.as_py() for text in texts if text.is_valid)


def _grams(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the trigrams within each piece, and the place of the piece of each."""
    sizes = np.array([len(piece) for piece in pieces])
    grams = _trigram_codes(_code_points("".join(pieces)))
    owner = np.repeat(np.arange(len(pieces)), sizes)[: len(grams)]
    # Trigrams that reach into the next piece are none.
    left = np.repeat(np.cumsum(sizes), sizes)[: len(grams)] - np.arange(len(grams))
    return grams[left > 2], owner[left > 2]


def _spelled(codes: np.ndarray) -> list[str]:
    """The trigrams of codes."""
    mask = np.uint64((1 << 21) - 1)
    chars = np.stack([codes >> (SHIFT + SHIFT), (codes >> SHIFT) & mask, codes & mask], axis=1)
    text = chars.astype("<u4").tobytes().decode("utf-32-le")
    return [text[k : k + 3] for k in range(0, len(text), 3)]


# Trigrams times languages that are scored at once; each takes some 40 bytes for a moment.
CELLS = 1_000_000


def _portions(texts: Iterable[str], size: int) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of texts, and the number of the text of each, in portions of at most ``size`` trigrams.

    A longer text is cut into pieces that overlap by two characters, so each of its trigrams is in one of them.
    """
    owners: list[int] = []
    pieces: list[str] = []
    room = size
    for k, text in enumerate(texts):
        for start in range(0, len(text) - 2, size):
            piece = text[start : start + size + 2]
            if pieces and len(piece) - 2 > room:
                yield owners, pieces
                owners, pieces, room = [], [], size
            owners.append(k)
            pieces.append(piece)
            room -= len(piece) - 2
    if pieces:
        yield owners, pieces


@dataclass(frozen=True)
class LanguageProfile:
    """A trained profile: trigram codes, and for each the languages that hold it with their gains."""

    languages: list[str]
    codes: np.ndarray
    starts: np.ndarray  # where each code's entries start, and where the last ends
    entry_language: np.ndarray
    entry_gain: np.ndarray
    floors: np.ndarray
    # The broadcast variable that holds this profile, by application.
    sent: dict = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self) -> dict:
        return {**self.__dict__, "sent": {}}

    @classmethod
    def from_rows(cls, profile: DataFrame) -> LanguageProfile:
        """Bring a trained profile to the driver as Arrow columns."""
        table = profile.select("lang", "gram", "logp", "floor").toArrow()
        if not table.num_rows:
            raise ValueError("a profile needs at least one trigram")
        lang = table["lang"].to_pandas()
        languages = sorted(lang.unique())
        which = lang.map({name: k for k, name in enumerate(languages)}).to_numpy(np.int32)
        packed = _trigram_codes(_code_points("".join(table["gram"].to_pylist())))[::3]
        logp, floor = table["logp"].to_numpy(), table["floor"].to_numpy()
        floors = np.zeros(len(languages), dtype=np.int64)
        floors[which] = floor
        order = np.lexsort((which, packed))
        codes, starts = np.unique(packed[order], return_index=True)
        gains = (logp - floor).astype(np.int32)[order]
        return cls(languages, codes, np.append(starts, len(order)), which[order], gains, floors)

    def best(self, texts: list[str | None]) -> list[str | None]:
        """Most probable language of each text; none for short texts or without a known trigram."""
        usable = [k for k, text in enumerate(texts) if text is not None and len(text) >= MIN_CHARS]
        found: list[str | None] = [None] * len(texts)
        if not usable:
            return found
        sizes = np.array([len(texts[k]) for k in usable])
        # Whole numbers below 2**53, so their sums as doubles are exact.
        sums = np.zeros((len(usable), len(self.languages)))
        some = np.zeros(len(usable), dtype=bool)
        for owners, pieces in _portions((texts[k] for k in usable), max(1, CELLS // len(self.languages))):
            owners, place = np.unique(owners, return_inverse=True)
            gains, known = self._gains(pieces, place, len(owners))
            sums[owners] += gains
            some[owners] |= known
        scores = sums + (sizes - 2)[:, None] * self.floors
        for k, ok, language in zip(usable, some, scores.argmax(axis=1)):
            if ok:
                found[k] = self.languages[language]
        return found

    def _gains(self, pieces: list[str], place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Gains of the trigrams of the pieces, added up for each of ``n`` places and each language; whether a place has a known one."""
        grams, owner = _grams(pieces)
        owner = place[owner]
        at = np.minimum(np.searchsorted(self.codes, grams), len(self.codes) - 1)
        known = self.codes[at] == grams
        at, owner = at[known], owner[known]
        counts = self.starts[at + 1] - self.starts[at]
        before = np.cumsum(counts) - counts
        entries = np.repeat(self.starts[at] - before, counts) + np.arange(counts.sum())
        cells = np.repeat(owner, counts) * len(self.languages) + self.entry_language[entries]
        sums = np.bincount(cells, self.entry_gain[entries], n * len(self.languages))
        return sums.reshape(n, -1), np.bincount(owner, minlength=n) > 0

    def detect(self, text: Column) -> Column:
        """Language code column, computed for whole Arrow batches; the profile is sent to each executor once."""
        context = SparkSession.active().sparkContext
        if context.applicationId not in self.sent:
            self.sent[context.applicationId] = context.broadcast(self)
        profile = self.sent[context.applicationId]

        @F.pandas_udf(T.StringType())
        def detect_language(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(profile.value.best(batch.tolist()), dtype=object)

        return detect_language(F.lower(text))


# Rows of a profile (about 20 bytes each in memory) up to which it is sent to every executor.
SENT_ROWS = 5_000_000


def detect_languages(df: DataFrame, key: str, text: str, profile: DataFrame, sent_rows: int = SENT_ROWS) -> DataFrame:
    """(``key``, language) of every row; a key must be unique.

    A profile of many scripts may outgrow the executors; beyond ``sent_rows``
    it stays a table that the texts' trigrams are joined to.
    """
    if profile.limit(sent_rows + 1).count() <= sent_rows:
        found = LanguageProfile.from_rows(profile)
        return df.select(key, found.detect(F.col(text)).alias("language"))
    return _detect_by_join(df, key, text, profile)


def _detect_by_join(df: DataFrame, key: str, text: str, profile: DataFrame) -> DataFrame:
    """Trigrams counted within each text, joined to the profile, and their gains summed up per text and language."""
    floors = sorted(profile.select("lang", "floor").distinct().collect())  # a row for each language
    lowered = df.select(key, F.lower(text).alias("_text"))
    usable = lowered.filter(F.length("_text") >= MIN_CHARS)
    grams = usable.select(key, F.explode(F.regexp_extract_all("_text", F.lit(_TRIGRAM), F.lit(1))).alias("gram"))
    times = grams.groupBy(key, "gram").agg(F.count("*").alias("times"))
    gains = profile.select("gram", "lang", (F.col("logp") - F.col("floor")).alias("gain"))
    sums = times.join(gains, "gram").groupBy(key, "lang").agg(F.sum(F.col("times") * F.col("gain")).alias("gain"))
    of_text = sums.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("lang", "gain"))).alias("_gains"))

    def score(place: int, lang: str, floor: int) -> Column:
        gained = F.coalesce(F.try_element_at("_gains", F.lit(lang)), F.lit(0))
        total = gained + (F.length("_text") - 2) * F.lit(floor)
        return F.struct(total.alias("score"), F.lit(-place).alias("order"), F.lit(lang).alias("lang"))

    scores = F.array(*[score(k, lang, floor) for k, (lang, floor) in enumerate(floors)])
    best = F.when(F.col("_gains").isNotNull(), F.array_max(scores)["lang"])
    return lowered.join(of_text, key, "left").select(key, best.alias("language"))

"""Quality signals of cleaned text: sizes, reason codes, score."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedback_engine.functions.let import let
from feedback_engine.functions.text import LETTER, SPACE, clean_and_normalize, is_ascii, nfkc_icu

# --- fixed values --------------------------------------------------------------

MIN_CHARS = 10
MIN_WORDS = 3
MIN_ALPHA_RATIO = 0.30
CJK_SHARE = 0.3
FULL_SCORE_WORDS = 20.0
WORDS_WEIGHT = 0.7
ALPHA_WEIGHT = 0.3
LOW_SIGNAL_FACTOR = 0.3
PHRASE_EDGES = " .!?,-"
LOW_SIGNAL_PHRASES = (
    "", "first", "test", "testing", "hi", "hello", "ok", "okay", "k", "good", "bad",
    "nice", "cool", "lol", "meh", "yes", "no", "na", "wow", "n/a",
)


def char_length(text: Column) -> Column:
    """Length in code points."""
    return F.length(text)


def word_count(text: Column, squeezed: bool = False) -> Column:
    """White-space tokens, or CJK characters where those make up over 30 %.

    ``squeezed`` promises single spaces and none at the ends, as cleaning
    leaves them, and then counts spaces instead of running a regex.
    """
    if squeezed:
        tokens = F.when(text == "", 0).otherwise(
            F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1
        )
    else:
        tokens = F.regexp_count(text, F.lit(rf"(?U)[^{SPACE}]+"))

    def count(cjk: Column) -> Column:
        dominant = (cjk > 0) & (cjk / F.length(text) > CJK_SHARE)
        return F.when(dominant, F.greatest(tokens, cjk)).otherwise(tokens)

    # ASCII text cannot hold CJK characters, so it skips the count.
    cjk_chars = F.when(is_ascii(text), 0).otherwise(
        F.regexp_count(text, F.lit(r"[\x{4e00}-\x{9fff}]"))
    )
    return let(cjk_chars, count)


def alpha_ratio(text: Column) -> Column:
    """Share of letters, of any script, among all characters."""
    kept = F.when(is_ascii(text), F.regexp_replace(text, "[^A-Za-z]+", "")).otherwise(
        F.regexp_replace(text, rf"[^{LETTER}]+", "")
    )
    letters = F.length(kept)
    return letters / F.greatest(F.length(text), F.lit(1))


def low_signal_phrase(text: Column) -> Column:
    """Whether the text, bar edge punctuation and case, is a stock phrase."""
    return F.lower(F.btrim(text, F.lit(PHRASE_EDGES))).isin(*LOW_SIGNAL_PHRASES)


def low_signal_reasons(text: Column, words: Column, alpha: Column) -> Column:
    """Comma-joined reason codes; ``empty`` excludes the other four."""
    found = F.concat_ws(
        ",",
        F.when(char_length(text) < MIN_CHARS, "too_short"),
        F.when(words < MIN_WORDS, "too_few_words"),
        F.when(alpha < MIN_ALPHA_RATIO, "non_alphabetic"),
        F.when(low_signal_phrase(text), "low_signal_phrase"),
    )
    return F.when(text == "", "empty").otherwise(found)


def is_low_signal(reasons: Column) -> Column:
    """1 if there is any reason, else 0."""
    return (reasons != "").cast("int")


def round_half_even_exact(value: Column, places: int) -> Column:
    """Round the exact binary value, as Python does; Spark's ``round`` differs.

    For values below 1000 only: larger ones would get thousands separators.
    """
    return F.format_number(value, places).cast("double")


def quality_score(words: Column, alpha: Column, low_signal: Column) -> Column:
    """Word-count and letter share in [0, 1], discounted for low signal, 3 places."""
    base = (
        F.least(F.lit(1.0), words / F.lit(FULL_SCORE_WORDS)) * F.lit(WORDS_WEIGHT)
        + alpha * F.lit(ALPHA_WEIGHT)
    )
    score = F.when(low_signal == 1, base * F.lit(LOW_SIGNAL_FACTOR)).otherwise(base)
    return round_half_even_exact(score, 3)


def assess_text(cleaned: Column, squeezed: bool = False) -> Column:
    """Struct of the cleaned text and its quality signals."""

    def signals(text: Column, size: Column) -> Column:
        reasons = low_signal_reasons(text, size["words"], size["alpha"])
        return let(reasons, lambda r: F.struct(
            text.alias("cleaned_text"),
            char_length(text).alias("char_length"),
            size["words"].alias("word_count"),
            is_low_signal(r).alias("is_low_signal"),
            quality_score(size["words"], size["alpha"], is_low_signal(r)).alias("quality_score"),
            r.alias("low_signal_reasons"),
        ))

    def sized(text: Column) -> Column:
        size = F.struct(
            word_count(text, squeezed).alias("words"), alpha_ratio(text).alias("alpha")
        )
        return let(size, lambda s: signals(text, s))

    return let(cleaned, sized)


def preprocess_text(text: Column, nfkc: Callable[[Column], Column] = nfkc_icu) -> Column:
    """Clean, normalise and assess raw text in one expression.

    The whole chain is a single non-deterministic column (see ``nfkc_icu``), so
    Spark computes it once per row: filters on its fields stay above it instead
    of running the chain a second time below.
    """
    return assess_text(clean_and_normalize(text, nfkc), squeezed=True)

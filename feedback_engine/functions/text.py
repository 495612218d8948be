"""Surface cleaning and character-level normalisation of text columns.

Everything is ``Column -> Column`` and runs in the JVM. Character classes are
spelled out because Java, RE2 and Python disagree on what ``\\w`` and ``\\s``
mean outside ASCII.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedback_engine.functions.let import let

# --- fixed values: results depend on these being exactly so --------------------

# Typographic quotes and primes, and what each becomes.
SMART_QUOTES = {
    "‘": "'",
    "’": "'",
    "‚": "'",
    "‛": "'",
    "“": '"',
    "”": '"',
    "„": '"',
    "‟": '"',
    "′": "'",
    "″": '"',
}

# Characters of the Unicode property Emoji outside ASCII (Unicode 16).
EMOJI_RANGES = (
    "A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 "
    "25AA-25AB 25B6 25C0 25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A "
    "262E-262F 2638-263A 2640 2642 2648-2653 265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 "
    "2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE 26C4-26C5 26C8 26CE-26CF 26D1 "
    "26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716 271D 2721 "
    "2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 "
    "2B05-2B07 2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E "
    "1F191-1F19A 1F1E6-1F1FF 1F201-1F202 1F21A 1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 "
    "1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD 1F4FF-1F53D 1F549-1F54E 1F550-1F567 "
    "1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8 1F5B1-1F5B2 1F5BC "
    "1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5 "
    "1F6CB-1F6D2 1F6D5-1F6D9 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 "
    "1F90C-1F93A 1F93C-1F945 1F947-1F9FF 1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB "
    "1FAEF-1FAFA"
)

# Punctuation kept by cleaning; of these, runs of the first four collapse.
KEPT_PUNCTUATION = "!?,.'-"

# English contractions in the order they are tried: irregular words, then endings.
CONTRACTED_WORDS = (("won't", "will not"), ("can't", "cannot"), ("shan't", "shall not"))
CONTRACTED_ENDINGS = (
    ("n't", "not"),
    ("'re", "are"),
    ("'ve", "have"),
    ("'ll", "will"),
    ("'d", "would"),
    ("'m", "am"),
)

# --- character classes ---------------------------------------------------------

# Letters, numbers and underscore in any script. The two explicit blocks are
# ideographs added to Unicode after the Java 17 tables.
LETTER = r"\p{L}\x{2EBF0}-\x{2EE5D}\x{31350}-\x{323AF}"
WORD = LETTER + r"\p{N}_"
# Unicode white space plus the four ASCII separators; needs the (?U) flag.
SPACE = r"\s\x1c-\x1f"
_KEPT = r"!?,.'\-"


def _code_points(ranges: str) -> str:
    ends = (r.split("-") for r in ranges.split())
    return "".join("-".join(f"\\x{{{cp}}}" for cp in pair) for pair in ends)


EMOJI = _code_points(EMOJI_RANGES)
# The leading coarse ranges let ordinary text fail on one or two comparisons.
_EMOJI_CHAR = rf"[\x{{A9}}\x{{AE}}\x{{203C}}-\x{{3299}}\x{{1F004}}-\x{{1FAFF}}&&[{EMOJI}]]"
# Every emoji, keycap mark and smart quote lies in here; few letters do.
_MAYBE_SYMBOL = r"[\x{A9}\x{AE}\x{2018}-\x{3299}\x{1F004}-\x{1FAFF}]"
_EMOJI_SEQUENCE = (
    rf"[0-9#*]\x{{FE0F}}?\x{{20E3}}|{_EMOJI_CHAR}[\x{{FE0F}}\x{{1F3FB}}-\x{{1F3FF}}]*"
    rf"(?:\x{{200D}}{_EMOJI_CHAR}[\x{{FE0F}}\x{{1F3FB}}-\x{{1F3FF}}]*)*"
)


# --- surface cleaning ----------------------------------------------------------


def fold_smart_quotes(text: Column) -> Column:
    """Typographic quotes to ``'`` and ``"``."""
    return F.translate(text, "".join(SMART_QUOTES), "".join(SMART_QUOTES.values()))


def strip_urls(text: Column) -> Column:
    """Each web address, up to the next white space, becomes a space."""
    # [hw] first, so that the regex engine skips most characters at once.
    return F.regexp_replace(
        text, rf"(?iU)[hw](?:(?<=h)ttps?://|(?<=w)ww\.)[^{SPACE}]+", " "
    )


def strip_emoji(text: Column) -> Column:
    """Each emoji sequence becomes a space."""
    return F.regexp_replace(text, _EMOJI_SEQUENCE, " ")


def nfkc_icu(text: Column) -> Column:
    """NFKC by the ICU library on Spark's class path, without leaving the JVM.

    Spark treats reflective calls as non-deterministic and so never copies them
    into pushed-down filters; the call itself always gives the same answer.
    """
    return F.when(
        text.isNotNull(),
        F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), text, F.lit(True)),
    )


@F.pandas_udf(T.StringType())
def nfkc_arrow(text: pd.Series) -> pd.Series:
    """NFKC in Arrow batches, for clusters where reflective calls are barred."""
    return text.map(lambda s: unicodedata.normalize("NFKC", s), na_action="ignore")


def nfkc_normalize(text: Column) -> Column:
    """Unicode NFKC; ASCII text is passed through untouched."""
    return let(text, lambda t: F.when(is_ascii(t), t).otherwise(nfkc_icu(t)))


def strip_non_text(text: Column) -> Column:
    """All but word characters, white space and kept punctuation becomes a space."""
    return F.regexp_replace(text, rf"(?U)[^{WORD}{SPACE}{_KEPT}]", " ")


def squeeze_whitespace(text: Column) -> Column:
    """Each run of white space to one space, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"(?U)[{SPACE}]+", " "))


def is_ascii(text: Column) -> Column:
    """Whether all characters are ASCII; both lengths are cheap to get."""
    return F.octet_length(text) == F.length(text)


def clean_text(text: Column, nfkc: Callable[[Column], Column] = nfkc_icu) -> Column:
    """Surface cleaning; null gives the empty string.

    Same result as quotes, addresses, emoji, NFKC, non-text and white space one
    after the other. Addresses go first, which changes nothing as quotes are
    neither white space nor part of an address prefix, so that plain ASCII text
    can skip the three steps that only concern other characters, and text in
    accented letters the two that concern symbols. The last two steps are one
    pass: any run of white space or unwanted characters becomes one space.

    Another ``nfkc`` runs on every text: Python functions cannot be called in
    the lambda that tells the texts apart.
    """
    stripped = strip_urls(F.coalesce(text, F.lit("")))
    unwanted = rf"[^{WORD}{_KEPT}]+"
    if nfkc is not nfkc_icu:
        folded = nfkc(strip_emoji(fold_smart_quotes(stripped)))
        return F.trim(F.regexp_replace(folded, unwanted, " "))

    def fold(t: Column) -> Column:
        symbols = F.when(t.rlike(_MAYBE_SYMBOL), strip_emoji(fold_smart_quotes(t))).otherwise(t)
        return F.when(
            is_ascii(t), F.regexp_replace(t, rf"[^A-Za-z0-9_{_KEPT}]+", " ")
        ).otherwise(F.regexp_replace(nfkc_icu(symbols), unwanted, " "))

    return F.trim(let(stripped, fold))


# --- normalisation -------------------------------------------------------------


def expand_contractions(text: Column) -> Column:
    """Spell out English contractions; ``'s`` is left alone (it may be possessive).

    Patterns start with a literal and look back for the stem, as scanning every
    word for an ending is many times slower. A rule only runs where its letters
    occur at all; replacing one contraction cannot bring about another that was
    not there before. Without an apostrophe nothing runs.
    """

    def rules(original: Column, lowered: Column) -> Column:
        out = original
        for contracted, pattern, replacement in _contraction_rules():
            out = F.when(
                F.contains(lowered, F.lit(contracted)),
                F.regexp_replace(out, pattern, replacement),
            ).otherwise(out)
        return out

    def expand(t: Column) -> Column:
        lowered = F.when(F.contains(t, F.lit("'")), F.lower(t)).otherwise("")
        return let(lowered, lambda low: F.when(low == "", t).otherwise(rules(t, low)))

    return let(text, expand)


def _contraction_rules() -> list[tuple[str, str, str]]:
    """What must occur, the pattern, and the replacement, in order."""
    rules = []
    end = rf"(?![{WORD}])"
    for word, full in CONTRACTED_WORDS:
        pattern = word.replace("s", "[sſ]")
        rules.append((word[1:], rf"(?i){pattern}{end}(?<![{WORD}]{pattern})", full))
    for ending, full in CONTRACTED_ENDINGS:
        stem = rf"(?<=[{WORD}]{ending})"
        # An ending straight after a spelled-out one has lost its stem: keep it.
        again = "" if ending == "n't" else rf"((?:{ending}{end})?)"
        kept = "$1" if again else ""
        rules.append((ending, rf"(?i){ending}{end}{stem}{again}", f" {full}{kept}"))
    return rules


def collapse_letters(text: Column) -> Column:
    """Three or more of one ASCII letter in a row become two."""
    return F.regexp_replace(text, r"([A-Za-z])\1{2,}", "$1$1")


def collapse_punctuation(text: Column) -> Column:
    """A run of one of ``! ? . ,`` becomes a single one."""
    return F.regexp_replace(text, r"([!?.,])\1+", "$1")


def normalize_text(text: Column) -> Column:
    """Contractions, letter runs, punctuation runs and white space."""
    return squeeze_whitespace(_normalize_squeezed(text))


def _normalize_squeezed(text: Column) -> Column:
    return collapse_punctuation(collapse_letters(expand_contractions(text)))


def clean_and_normalize(text: Column, nfkc: Callable[[Column], Column] = nfkc_icu) -> Column:
    """``normalize_text(clean_text(text))``.

    Cleaned text has single spaces only and no rule of normalisation adds or
    joins any, so the closing white-space pass is left out.
    """
    return _normalize_squeezed(clean_text(text, nfkc))

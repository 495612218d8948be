import random
import re
import unicodedata

import pytest
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from feedback_engine.functions import text as X


@pytest.mark.parametrize(
    "rule, raw, expected",
    [
        (X.clean_text, None, ""),
        (X.clean_text, "   ", ""),
        (X.clean_text, "Go to https://x.io/a?b NOW", "Go to NOW"),
        (X.clean_text, "It’s “fine” — really…", "It's fine really..."),
        (X.clean_text, "Ｗｏｗ！", "Wow!"),
        (X.clean_text, "nice 1️⃣ ™ 👍🏽 ok", "nice ok"),
        (X.clean_text, "nice 1️⃣ ™ 👍🏽 ok 12 Ⓜ️ 🈁", "nice ok 12"),
        (X.clean_text, "a_b² (c) #5 – d e\x1cf", "a_b2 c 5 d e f"),
        (X.clean_text, "WWW.Site.com/x and Https://y z", "and z"),
        (X.expand_contractions, "won't can't shan't", "will not cannot shall not"),
        (X.expand_contractions, "WON'T CAN'T", "will not cannot"),
        (X.expand_contractions, "DON'T", "DO not"),
        (X.expand_contractions, "you're I've he'll I'd I'm", "you are I have he will I would I am"),
        (X.expand_contractions, "it's", "it's"),
        (X.expand_contractions, "a're're're", "a are're are"),
        (X.collapse_letters, "goooood 哈哈哈 AAaa", "good 哈哈哈 AAaa"),
        (X.collapse_punctuation, "!!!! ?!?! ok...", "! ?!?! ok."),
        (X.squeeze_whitespace, " \t a \n\n b \x1fc ", "a b c"),
        (X.strip_emoji, "a😀b👩‍💻c❤️d3", "a b c d3"),
        (X.fold_smart_quotes, "‘’‚‛“”„‟′″", "''''\"\"\"\"'\""),
        (X.clean_and_normalize, "I can’t   beliiieve it!!!", "I cannot beliieve it!"),
    ],
)
def test_golden(apply, rule, raw, expected):
    assert apply(rule, [raw]) == [expected]


def test_contractions_match_a_brute_force(apply):
    """Word by word in Python's own regex engine, over awkward combinations."""
    rules = [(rf"\b{w}\b", full) for w, full in X.CONTRACTED_WORDS]
    rules += [(rf"\b(\w+){e}\b", rf"\1 {full}") for e, full in X.CONTRACTED_ENDINGS]

    def expected(text):
        for pattern, replacement in rules:
            text = re.sub(pattern, replacement, text, flags=re.IGNORECASE)
        return text

    pieces = ["'re", "'ve", "n't", "'ll", "'d", "'m", "a", "re", "n", "t", "won't", "can't",
              "shan't", "WON'T", "ſhan't", " ", "é", "'", "-", "_", "don", "S", "x1", "²"]
    rng = random.Random(1)
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 9))) for _ in range(5000)]
    assert apply(X.expand_contractions, texts) == [expected(t) for t in texts]


def test_emoji_class_is_the_unicode_property(apply):
    """Each emoji outside ASCII goes; nothing but emoji goes."""
    points = [c for c in range(0xA0, 0x20000) if not 0xD800 <= c < 0xE000]
    got = apply(X.strip_emoji, [f"a{chr(c)}b" for c in points])
    newest = ("Cn", "Co")  # unassigned here means too new to compare
    for c, out in zip(points, got):
        if unicodedata.category(chr(c)) in newest:
            continue
        is_emoji = regex.match(r"\p{Emoji}", chr(c)) is not None
        assert (out == "a b") == is_emoji, hex(c)


def test_word_class_matches_python(apply):
    """Kept characters are those Python calls alphanumeric, up to newer Unicode."""
    points = [c for c in range(0x20, 0x32400) if not 0xD800 <= c < 0xE000]
    kept = apply(X.strip_non_text, [f"x{chr(c)}x" for c in points])
    wrong = [
        c for c, out in zip(points, kept)
        if not chr(c).isspace() and chr(c) not in "_!?,.'-"
        and (out != "x x") != chr(c).isalnum()
    ]
    assert len(wrong) < 800
    assert not [c for c in wrong if c < 0x800]


def test_nfkc_engines_agree(apply):
    texts = ["Ｗｏｗ ﬁ … ① é", "plain", None, "é", "한글", "㍿ ²"]
    expected = [t and unicodedata.normalize("NFKC", t) for t in texts]
    assert apply(X.nfkc_normalize, texts) == expected
    assert apply(X.nfkc_arrow, texts) == expected
    assert apply(lambda c: X.clean_text(c, X.nfkc_arrow), texts) == apply(X.clean_text, texts)


def test_composite_equals_steps(apply):
    """The fused chain gives what its steps give one after the other."""

    def steps(c):
        for step in (X.fold_smart_quotes, X.strip_urls, X.strip_emoji, X.nfkc_normalize,
                     X.strip_non_text, X.squeeze_whitespace):
            c = step(c)
        return c

    alphabet = "ab Z9'’“!?.,-_\n\t/:é哈😀™①Ｗ#1️⃣‼‍\x1c　"
    rng = random.Random(2)
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 30))) for _ in range(3000)]
    texts += [t + " http://x.y/z " + t + "www.q" for t in texts[:500]]
    assert apply(X.clean_text, texts) == apply(steps, texts)
    whole = apply(X.clean_and_normalize, texts)
    assert whole == apply(lambda c: X.normalize_text(steps(c)), texts)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=20, max_size=20))
def test_idempotent_rules(spark, texts):
    from pyspark.sql import functions as F

    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    rows = spark.createDataFrame([(t,) for t in texts], "v string")
    for rule in (X.squeeze_whitespace, X.collapse_letters, X.collapse_punctuation):
        once = rule(F.col("v"))
        assert rows.filter(once != rule(once)).count() == 0

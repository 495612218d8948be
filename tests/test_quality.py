import itertools

import pytest
from pyspark.sql import functions as F

from feedback_engine.functions import quality as Q


def assess(apply, texts):
    return apply(lambda c: Q.assess_text(c), texts)


@pytest.mark.parametrize(
    "text, words", [("", 0), ("a b c", 3), ("哈哈哈好用", 5), ("哈 aaaa bbbb", 3), ("  a\tb\n ", 2)]
)
def test_word_count(apply, text, words):
    assert apply(Q.word_count, [text]) == [words]


@pytest.mark.parametrize(
    "text, reasons",
    [
        ("", "empty"),
        ("good!", "too_short,too_few_words,low_signal_phrase"),
        ("12345 67890 4321", "non_alphabetic"),
        ("The app works well today", ""),
        ("...!!!...!!!", "too_few_words,non_alphabetic,low_signal_phrase"),
        ("N/A", "too_short,too_few_words,low_signal_phrase"),
    ],
)
def test_reasons(apply, text, reasons):
    row = assess(apply, [text])[0]
    assert row.low_signal_reasons == reasons
    assert row.is_low_signal == int(reasons != "")


def test_scores(apply):
    twenty = " ".join(["abcde"] * 20)
    assert [r.quality_score for r in assess(apply, ["", twenty])] == [0.0, 0.952]
    assert apply(Q.preprocess_text, [None])[0].low_signal_reasons == "empty"


def test_score_rounds_like_python(spark):
    """Every mix of word count, length, letter share and discount in a grid."""
    grid = [
        (w, a / n, low)
        for w, n, low in itertools.product(range(0, 23), (7, 40, 64, 80, 125, 160), (0, 1))
        for a in range(0, n + 1, 3)
    ]
    rows = spark.createDataFrame([(i, *g) for i, g in enumerate(grid)], "i int, w int, a double, l int")
    got = {r.i: r.s for r in rows.select(
        "i", Q.quality_score(F.col("w"), F.col("a"), F.col("l")).alias("s")).collect()}
    for i, (w, a, low) in enumerate(grid):
        base = min(1.0, w / 20.0) * 0.7 + a * 0.3
        assert got[i] == round(base * 0.3 if low else base, 3), grid[i]
        assert 0.0 <= got[i] <= 1.0


def test_squeezed_count_equals_general_count(apply):
    texts = ["", "a", "a b", "哈哈 b c", "one two three four"]
    assert apply(lambda c: Q.word_count(c, True), texts) == apply(Q.word_count, texts)

"""Language detection of large batches: bounded memory, and the same sums wherever a portion ends."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest

from feedback_engine.operators import langid
from tests.conftest import plan_of


@pytest.fixture
def profile():
    """Four languages over 26 letters; every language has a gain for every trigram."""
    letters = [chr(97 + k) for k in range(26)]
    grams = [a + b + c for a in letters for b in letters for c in letters]
    codes = langid._trigram_codes(langid._code_points("".join(grams)))[::3]
    n, languages = len(codes), ["de", "en", "es", "fr"]
    gains = np.random.default_rng(1).integers(1, 9000, 4 * n).astype(np.int32)
    entry_language = np.tile(np.arange(4, dtype=np.int32), n)
    floors = np.array([-9000, -9003, -9001, -9002])
    return langid.LanguageProfile(languages, codes, np.arange(0, 4 * n + 1, 4), entry_language, gains, floors)


def plainly(profile, text):
    """The best language of one text, trigram by trigram."""
    if text is None or len(text) < langid.MIN_CHARS:
        return None
    at = {int(code): k for k, code in enumerate(profile.codes)}
    sums, known = [int(f) * (len(text) - 2) for f in profile.floors], False
    for k in range(len(text) - 2):
        code = int(langid._trigram_codes(langid._code_points(text[k : k + 3]))[0])
        for e in range(profile.starts[at[code]], profile.starts[at[code] + 1]) if code in at else ():
            sums[profile.entry_language[e]] += int(profile.entry_gain[e])
            known = True
    return profile.languages[int(np.argmax(sums))] if known else None


def test_memory_of_a_batch_does_not_follow_its_characters(profile):
    draw = random.Random(2)
    word = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))
    texts = [word[k % 100 :] for k in range(400)] + [word * 200]
    tracemalloc.start()
    profile.best(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6


@pytest.mark.parametrize("cells", [1, 16, 100, 400, 1_000_000])
def test_portions_lose_no_trigram(profile, monkeypatch, cells):
    monkeypatch.setattr(langid, "CELLS", cells, raising=False)
    draw = random.Random(3)
    texts = ["".join(draw.choice("abcdefghijé 漢😀") for _ in range(n)) for n in (0, 2, 19, 20, 21, 22, 27, 60, 100, 103, 250)]
    texts = [*texts[:4], None, *texts[4:], "漢" * 40, "abc" + "漢" * 40, "漢" * 40 + "abc"]
    assert profile.best(texts) == [plainly(profile, text) for text in texts]


def test_trigrams_are_counted_before_they_are_shuffled(spark, monkeypatch):
    texts = ["ab", "", None, "aBcabc", "漢字漢字", "x😀y😀x", "abcabc\n abc", "aa" * 50]
    rows = [(text, lang) for text in texts for lang in ("en", None, "de", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    expected = Counter(
        (lang, text.lower()[k : k + 3]) for text, lang in rows if text for k in range(len(text) - 2)
    )
    for size in (1, 7, langid.COUNTED):
        monkeypatch.setattr(langid, "COUNTED", size)
        got = langid.trigram_counts(df, "text", "lang")
        assert {(r.lang, r.gram): r.n for r in got.collect()} == expected
    assert "Generate" not in plan_of(got)

"""Deobfuscation against an exhaustive search, counts and fit against plain ones, held-out and planted documents."""

import random
from collections import Counter
from itertools import product

import numpy as np
import pytest

from feedback_engine.llm import toxicity

DATA = "/root/testdata/sf0.01"
INSULTS = "idiot moron clown trash pathetic worthless scum loser stupid disgusting".split()


def slow_grams(texts):
    counts = Counter()
    for text in texts:
        symbols = [toxicity._symbol(toxicity.folded(c)[:1] or " ") if ord(c) < 1 << 16 else 0 for c in (text or "")]
        word = []
        for s in [*symbols, 0]:
            if s or word:
                a, b, c = ([0, 0, 0] + word)[-3:]
                counts[((a * 32 + b) * 32 + c) * 32 + s] += 1
            word = word + [s] if s else []
    return counts


def test_four_grams():
    texts = ["Naïve cafés, 12x!", None, "", "a b  c", "ünï\n日本 x😀y", "...", "word" * 5]
    made = toxicity.four_grams(texts)
    assert {int(g): int(made[g]) for g in np.flatnonzero(made)} == slow_grams(texts)


@pytest.fixture(scope="module")
def costs():
    text = " ".join(INSULTS * 5 + "the good idea was to throw classes at the less small moon".split() * 9)
    return toxicity.smoothed(toxicity.four_grams([text]).reshape([32] * 4).astype(float))


def test_costs_are_chances(costs):
    sums = np.exp(-costs.reshape(-1, 32).astype(float))[:, : toxicity.SYMBOLS].sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)


def path_cost(costs, parts):
    total, word = 0.0, []
    for _, symbols, cost in parts:
        total += cost
        for s in symbols:
            if s or word:
                a, b, c = ([0, 0, 0] + word)[-3:]
                total += float(costs[((a * 32 + b) * 32 + c) * 32 + s])
            word = word + [s] if s else []
    if word:
        a, b, c = ([0, 0, 0] + word)[-3:]
        total += float(costs[((a * 32 + b) * 32 + c) * 32])
    return total


def test_viterbi_equals_exhaustive_search(costs):
    rng = random.Random(5)
    decoder = toxicity.Decoder(costs)
    letters = "idotmrnscu" + "013$@!*" + "-." + toxicity._SPACER + "ß9а"
    for _ in range(300):
        token = "".join(rng.choice(letters) * rng.choice((1, 1, 1, 2, 3)) for _ in range(rng.randint(1, 5)))
        token = toxicity.folded(token)
        paths = list(product(*toxicity.lattice(token)))
        best = min(path_cost(costs, p) for p in paths)
        texts = {" ".join("".join(t for t, _, _ in p).split()) for p in paths if path_cost(costs, p) < best + 1e-6}
        assert decoder._viterbi(token) in texts


def test_restores(costs):
    restore = toxicity.Decoder(costs).restore
    hidden = {
        "1d1ot": "idiot", "m0r0n": "moron", "stuuuupid": "stupid", "st*pid": "stupid", "id.iot": "idiot", "$cum": "scum",
        "p@thetic!!": "pathetic", "l o s e r": "loser", "c-l-o-w-n": "clown", "TRASH": "trash", "w0rthle55": "worthless",
    }
    for given, meant in hidden.items():
        assert restore(given) == meant, given
        assert restore(f"the {given}\nidea") == f"the {meant}\nidea"
    assert restore("the small classes at the moon") == "the small classes at the moon"
    assert restore("") == "" and restore(" \n") == " \n"


def test_fit_is_at_the_least_loss():
    rng = np.random.default_rng(2)
    rows = [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(200)]
    labels = np.array([float(0 in r or rng.random() < 0.1) for r in rows])
    weights = rng.random(200) + 0.5
    beta, base = toxicity.fit(rows, labels, weights, 6, penalty=0.1)
    x = np.zeros((200, 6))
    for k, r in enumerate(rows):
        x[k, r] = 1

    def loss(w):
        z = x @ w[:6] + w[6]
        return (weights * (np.logaddexp(0, z) - labels * z)).sum() + 0.05 * (w[:6] ** 2).sum()

    best = np.append(beta, base)
    for k in range(7):
        for step in (-1e-3, 1e-3):
            assert loss(best) <= loss(best + step * np.eye(7)[k])


def test_held_out_and_planted(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))
    rng = random.Random(1)
    hide = str.maketrans({"i": "1", "o": "0", "s": "$", "a": "@", "e": "3"})
    clean = docs.join(labels.where("toxic = 0 and quality = 1"), "doc_id").where("lang = 'en' and length(text) < 4000").orderBy("doc_id").limit(40).collect()
    planted, plain = [], []
    for k, row in enumerate(clean):
        words = row.text.split(" ")
        for insult in rng.sample(INSULTS, 5):
            shown = rng.choice([insult.translate(hide), " ".join(insult), insult.replace("o", "ooo").replace("i", "iii"), insult])
            words.insert(rng.randrange(len(words)), shown)
        planted.append((10_000_000 + k, " ".join(words)))
        plain.append((20_000_000 + k, row.text))
    more = spark.createDataFrame(planted + plain, "doc_id long, text string")
    both = docs.select("doc_id", "text").unionAll(more)
    made = {r.doc_id: r for r in toxicity.toxicity_scores(both, labels).collect()}
    assert len(made) == both.count()
    assert sum(made[i].predicted for i, _ in planted) >= 36
    assert sum(made[i].predicted for i, _ in plain) == 0
    held = [(made[r.doc_id].predicted, r.toxic) for r in labels.join(docs.where("lang = 'en'"), "doc_id").collect() if made[r.doc_id].held_out]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in made.values())


def test_edges(spark):
    columns = "doc_id long, text string, toxic int, words string, score int"
    docs = spark.createDataFrame([(1, None, 1, "", 2), (2, "", 1, "", 2), (None, "idiot", 1, "", 2), (2, "...", 1, "", 2)], columns)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == 4 and all(r.score < 0.01 and r.predicted == 0 for r in rows)
    assert toxicity.toxicity_scores(docs.where("false"), labels).collect() == []
    # Labels that are null, repeated, or of documents that are not there; documents under one id.
    labels = spark.createDataFrame([(1, 1, None), (2, 1, 0), (2, 1, 1), (9, 0, 1), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.toxicity_scores(docs, labels).collect()
    assert len(rows) == 4 and len({r.score for r in rows if r.doc_id}) == 1
    texts = [r.restored for r in toxicity.restored(docs.select("doc_id", "text"), np.ones(1 << 20, np.float32)).collect()]
    assert texts.count(None) == 1 and len(texts) == 4

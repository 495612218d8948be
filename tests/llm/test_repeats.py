"""Repeated sentences against all runs by brute force, and vectors of one repeated id."""

from __future__ import annotations

import numpy as np
import pytest

from feedback_engine.llm import substrings, vectors
from feedback_engine.llm.common import table

SMALL = "/root/testdata/sf0.001"


def all_repeated(rows):
    """{(doc, sentence)} within any run, of whatever length, that occurs before and clear of itself; limits as the module's."""
    units = {doc: substrings.sentences(text or "") for doc, text in rows}

    def runs(doc):
        some = units[doc]
        for first in range(len(some)):
            words = 0
            for last in range(first, min(len(some), first + 24)):
                words += some[last][3]
                if last - first + 1 >= substrings.LEAST_SENTENCES and words >= substrings.LEAST_WORDS:
                    yield first, last, b"\n".join(u[2] for u in some[first : last + 1])

    seen, found = {}, set()
    for doc in sorted(units):
        for first, last, key in runs(doc):
            keeper, until = seen.setdefault(key, (doc, last))
            if keeper != doc or first > until:
                found |= {(doc, k) for k in range(first, last + 1)}
    return found


def covered(docs, rows):
    units = {doc: substrings.sentences(text or "") for doc, text in rows}
    return {
        (r.doc_id, k)
        for r in substrings.repeats(docs).collect()
        for k, unit in enumerate(units[r.doc_id])
        if r.start <= unit[0] and unit[1] <= r.end
    }


def test_every_run_counts(spark):
    rng = np.random.default_rng(8)
    vocabulary = [f"w{k}" for k in range(300)]
    pool = [" ".join(rng.choice(vocabulary, rng.integers(1, 14))) + "." for _ in range(60)]
    rows = []
    for doc in range(40):
        parts = [" ".join(rng.choice(vocabulary, rng.integers(1, 14))) + "." for _ in range(12)]
        for _ in range(2):
            at, n = int(rng.integers(0, 50)), int(rng.integers(2, 9))
            parts[int(rng.integers(0, 12)) : 0] = pool[at : at + n]
        rows.append((doc, " ".join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert covered(docs, rows) == all_repeated(rows) != set()


def test_every_run_of_the_smallest_table(spark):
    docs = table(spark, SMALL, "documents").where("n_chars < 20000")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert covered(docs, rows) == all_repeated(rows) != set()


def test_short_last_sentences_go(spark):
    body = " ".join(f"Body sentence number {k} goes on for many more words than that." for k in range(4))
    passage = f"{body} Short tail one. Short tail two. Short tail three."
    rows = [(1, f"Mine. {passage} Own end of the first one here."), (2, f"Else. {passage} Another end with its own words.")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text for r in substrings.without_repeats(docs).collect()}
    assert left == {1: rows[0][1], 2: "Else. Another end with its own words."}


def test_long_sentences_are_cut():
    assert max(unit[3] for unit in substrings.sentences("zwei drei vier fünf " * 500)) <= substrings.MOST


@pytest.mark.parametrize("block", [2, 8192])
def test_one_id_with_two_vectors(spark, block):
    rows = [(1, [1.0, 0.0, 0.0]), (1, [0.0, 1.0, 0.0]), (2, [0.0, 1.0, 0.001]), (3, [1.0, 0.001, 0.0]), (4, [0.0, 1.0, 0.0])]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in vectors.vector_links(given, block=block).collect())
    assert got == [(1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False), (4, 2, 1, False)]

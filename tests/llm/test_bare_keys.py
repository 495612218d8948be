"""Bare keys of any length in ordinary prose are secrets, on small and large tables."""

from __future__ import annotations

import string

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedback_engine.llm import secrets
from feedback_engine.llm.common import table

PROSE = "the quick brown fox jumps over the lazy dog while seven good people read their morning papers near an open window"
ORDINARY = [
    "internationalization", "Donaudampfschifffahrtsgesellschaft", "getUserNameFromDatabase", "order-20240102-00017",
    "well-known-and-often-used", "4111111111111111", "----------------------", "articles/some-title-of-a-page",
]


@pytest.mark.parametrize("large", [False, True])
def test_bare_keys(spark, large):
    rng = np.random.default_rng(3)
    mixed = np.array(list(string.ascii_letters + string.digits))
    letters = np.array(list(string.ascii_letters))
    keys = ["".join(rng.choice(mixed, n)) for n in (20, 32, 40, 64)] + ["".join(rng.choice(letters, 40))]
    rows = [(-1 - k, f"{PROSE} {key} {PROSE}") for k, key in enumerate(keys)]
    plain = [(-101 - k, f"{PROSE} {word} {PROSE}") for k, word in enumerate(ORDINARY)]
    docs = spark.createDataFrame(rows + plain, "doc_id long, text string")
    if large:
        docs = docs.unionByName(table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text"))
    start = len(PROSE) + 1
    got = {r.doc_id: r.spans for r in secrets.report(docs).where("doc_id < 0").collect()}
    assert [got[doc] for doc, _ in rows] == [f"random:{start}:{start + len(key)}" for key in keys]
    assert [got[doc] for doc, _ in plain] == [""] * len(plain)
    masked = secrets.redacted(docs.withColumn("n_chars", F.length("text").cast("long"))).where("doc_id < 0")
    texts = {r.doc_id: r.text for r in masked.collect()}
    assert all(texts[doc] == f"{PROSE} {secrets.MARK} {PROSE}" for doc, _ in rows)

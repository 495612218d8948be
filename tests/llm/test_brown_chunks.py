"""Chunks of the language model are moved packed and read one at a time; a chunk is scored in slices."""

from __future__ import annotations

import random

import pyarrow.parquet as pq
import pytest

from feedback_engine.llm import brown
from feedback_engine.llm.common import written


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(4)
    words = ["".join(draw.choice("abcdefghijklmno") for _ in range(draw.randint(2, 9))) for _ in range(2000)]
    rows = [(k, " ".join(draw.choices(words, k=draw.randint(1, 300)))) for k in range(300)]
    rows += [(None, rows[0][1]), (7, rows[7][1]), (400, None), (401, ""), (402, " \n\x0b "), (403, "é\x85ü Ö \x1c a\tA")]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_chunks_are_moved_packed_and_read_one_by_one(spark, docs, monkeypatch):
    size = sum(len(r.text or "") for r in docs.collect())
    assert brown.chunked(docs).toArrow().nbytes < size / 2
    monkeypatch.setattr(brown, "CHUNK", 20_000)
    chunks = written(brown.chunked(docs), "brown_chunks", packed=True)
    groups = sum(pq.ParquetFile(file.removeprefix("file://")).num_row_groups for file in chunks.inputFiles())
    assert groups == chunks.count() > 5


def test_scores_are_the_same_wherever_slices_end(docs, monkeypatch):
    def scores():
        return sorted((tuple(r) for r in brown.scores(docs, rounds=1).collect()), key=repr)

    monkeypatch.setattr(brown, "CHUNK", 100_000)
    expected = scores()
    assert len(expected) == docs.count()
    for part in (1, 1000):
        monkeypatch.setattr(brown, "SLICE", part)
        assert scores() == expected

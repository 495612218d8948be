"""Registered queries against their DuckDB counterparts, on the smallest data.

A sample of every family by default; FULL_ORACLE=1 runs all of them, as does
tools/check_oracle.py on any folder.
"""

import os

import pytest

from feedback_engine.catalog import REGISTRY
from feedback_engine.oracle import ORACLE
from tools.check_oracle import compare, connect

SMALL = "/root/testdata/sf0.001"
SAMPLE = """scan_posts partial_batch parse_timestamp_utc align_schema filter_pipeline nfkc_normalize
preprocess_text langid_score classify_source dropped_counts lookup_user_id check_single_community
full_report batch_stats""".split()


@pytest.fixture(scope="module")
def db():
    return connect(SMALL)


def test_every_query_has_a_counterpart():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY) if os.environ.get("FULL_ORACLE") else SAMPLE)
def test_same_rows(spark, db, name):
    assert compare(spark, db, SMALL, name) == ""

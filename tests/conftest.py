import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from feedback_engine.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        master="local[4]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Run a column rule over literal texts and give back its results in order."""
    from pyspark.sql import functions as F

    def run(rule, values, kind="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
        out = rows.select("i", rule(F.col("v")).alias("o")).orderBy("i").collect()
        return [r.o for r in out]

    return run


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()

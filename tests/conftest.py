import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cellweave.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "cellweave tests",
        master="local[4]",
        shuffle_partitions=4,
        extra={
            "spark.sql.session.timeZone": "UTC",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def settings(spark):
    """Set session options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def plan_of(df):
    """Text of the physical plan; the final one if ``df`` was collected before."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=repr)

import itertools

import pytest

from lodestar.session import local_session

SF = "/root/testdata/sf0.001"
_names = itertools.count()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    return local_session(
        4,
        "4g",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.checkpoint.dir": str(base / "shared"),
            # keep small shuffles in several partitions, so split work really is split
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
        },
    )


@pytest.fixture
def table(spark):
    """A table name nobody else uses, in a schema of its own."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS testing")
    return f"testing.t{next(_names)}"


@pytest.fixture
def sf():
    return SF


def rows(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])

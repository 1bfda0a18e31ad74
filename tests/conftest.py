import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linkgraph.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = local_session("linkgraph-tests", cores="*", shuffle_partitions=8)
    yield s


@pytest.fixture(params=["true", "false"])
def ansi(spark, request):
    """Run a test under both ANSI settings (results must not depend on it)."""
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


def rows(df, order=None):
    """Collected rows as sorted tuples (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))

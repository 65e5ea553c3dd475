import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pagetables.session import get_spark
    s = get_spark("local[*]", shuffle_partitions=8)
    yield s
    s.stop()


def pages_df(spark, rows):
    """rows: list of (page_id, url, html)."""
    from pagetables.sources.readers import PAGES_SCHEMA
    return spark.createDataFrame(rows, PAGES_SCHEMA)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())

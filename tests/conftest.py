import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shelfline.session import local_session
    s = local_session("*", shuffle_partitions=8, app="shelfline-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from shelfline.sources.tables import TABLE_NAMES, table_path
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SMALL, t)}')")
    yield con
    con.close()

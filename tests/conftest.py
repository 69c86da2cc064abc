import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = os.environ.get("PREGONERO_TEST_DATA", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pregonero.session import build_session

    session = build_session("tests", "local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables here")
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import glob

    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows_of(frame):
    """Sorted rows of a pandas frame in a form that both engines share."""
    import pandas as pd

    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if str(frame[c].dtype).startswith("datetime64"):
            frame[c] = pd.to_datetime(frame[c], utc=True).dt.strftime("%F %T.%f")

    def one(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return ""
        return str(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted(tuple(one(v) for v in r) for r in frame.astype(object).itertuples(index=False))

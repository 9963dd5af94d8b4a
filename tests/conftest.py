import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from quern.session import local_session

    return local_session(4, 4, "4g")


@pytest.fixture(scope="session")
def compare(spark):
    """compare(query name, queries, oracle): run both at the smallest scale and compare rows as multisets."""
    import duckdb

    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")

    def plain(v):
        if isinstance(v, float):
            return round(v, 9)
        return str(v)[:19] if hasattr(v, "isoformat") else v

    def run(name, queries, oracle):
        df = queries[name](spark, SMALL)
        out = duck.execute(oracle[name])
        names = [c[0] for c in out.description]
        assert sorted(names) == sorted(df.columns)
        key = lambda row: tuple((v is None, str(v)) for v in row)
        want = sorted((tuple(map(plain, r)) for r in out.fetchall()), key=key)
        got = sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=key)
        assert got == want

    return run

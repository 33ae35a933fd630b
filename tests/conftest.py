import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gristmill.session import local_session

    session = local_session("tests", cpus="4", partitions=4, **{"spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def cell(x):
    if hasattr(x, "tolist"):
        x = x.tolist()
    if isinstance(x, (list, tuple)):
        return "[" + ",".join(map(cell, x)) + "]"
    if x is None or x != x or str(x) in ("NaT", "<NA>"):
        return "null"
    if isinstance(x, float):
        return f"{x:.9g}"
    return str(x)[:10] if hasattr(x, "isoformat") else str(x)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(cell, r)) for r in frame.itertuples(index=False))


@pytest.fixture(scope="session")
def same_as_sql(spark, sf_dir, duck):
    def check(query, sql):
        got, want = query(spark, sf_dir).toPandas(), duck.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows_of(got) == rows_of(want)
        return len(got)

    return check

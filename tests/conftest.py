import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark():
    from lacquer.session import local

    session = local(4, spark__sql__shuffle__partitions="4", spark__driver__memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def against_sql(spark, sf_dir):
    """Runs a query and its SQL on the smallest tables and compares rows as sets with counts."""
    import duckdb

    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")

    def text(value):
        if value is None or value != value:
            return None
        return round(value, 6) if isinstance(value, float) else str(value)

    def rows(columns, records):
        order = sorted(range(len(columns)), key=lambda i: columns[i])
        return sorted([tuple(text(r[i]) for i in order) for r in records], key=repr)

    def check(query, sql):
        df = query(spark, sf_dir)
        got = con.execute(sql)
        names = [d[0] for d in got.description]
        assert sorted(df.columns) == sorted(names)
        assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, got.fetchall())

    return check

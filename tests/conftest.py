import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from corpusmill.session import local_session

    return local_session(4, partitions=4, memory="6g")


def rows_of(columns, rows):
    """Rows as sorted tuples that two engines agree on."""
    out = []
    for r in rows:
        values = dict(zip(columns, r, strict=True))
        cell = lambda v: None if v is None else bool(v) if isinstance(v, bool) else round(float(v), 6) if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)
        out.append(tuple(cell(values[c]) for c in sorted(columns)))
    return sorted(out, key=repr)


def duck(sql, sf=SF):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{sf}/{f}')")
    rel = con.sql(sql)
    return rel.columns, rel.fetchall()


def same(df, sql, sf=SF):
    columns, expected = duck(sql, sf)
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, expected)

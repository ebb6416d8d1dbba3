import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{ROOT}/tests:{os.environ.get('PYTHONPATH', '')}"
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from turnloom.session import ensure_checkpoint_dir, local_session

    s = local_session(cpus=4, shuffle=4)
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(x):
    """A value that compares alike whichever engine made it."""
    if x is None or x != x:
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, float):
        return f"{x:.9g}"
    if isinstance(x, (list, tuple)):
        return [plain(y) for y in x]
    if hasattr(x, "asDict"):
        return plain(list(x.asDict().values()))
    if isinstance(x, dict):
        return plain(list(x.values()))
    try:
        return int(x) if x == int(x) and not isinstance(x, str) else f"{float(x):.9g}"
    except (TypeError, ValueError):
        return str(x)


@pytest.fixture(scope="session")
def agree(spark, sf_dir, duck):
    """Checks a query against its SQL, column by column name."""

    def check(query, sql):
        df = query(spark, sf_dir)
        cols = sorted(df.columns)
        ours = sorted(repr([plain(r[c]) for c in cols]) for r in df.collect())
        rel = duck.sql(sql)
        assert sorted(rel.columns) == cols
        at = [rel.columns.index(c) for c in cols]
        theirs = sorted(repr([plain(r[i]) for i in at]) for r in rel.fetchall())
        assert ours == theirs

    return check

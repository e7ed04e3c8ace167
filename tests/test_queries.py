"""Every registered query against its SQL on the smallest tables, and the driver contract."""

import math
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from tachyline import catalog

SF = "/root/testdata/sf0.001"


def plain(frame):
    clean = lambda v: None if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) else float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v
    return sorted((tuple(clean(v) for v in row) for row in frame[sorted(frame.columns)].astype(object).itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in os.listdir(SF):
        con.sql(f"create view {table.split('.')[0]} as select * from '{SF}/{table}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_its_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    assert len(got)
    if name in catalog.ORACLE:
        want = con.sql(catalog.ORACLE[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(got) == plain(want)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_library_stands_without_the_text_operators():
    code = "import sys; sys.modules['tachyline.llm'] = None\nimport importlib.util as u; f = u.find_spec\nu.find_spec = lambda n, *a: None if n in ('tachyline.llm', 'corpus_pipeline') else f(n, *a)\nimport __spark_entry__ as e; q = e.queries(); assert q and not any(x.startswith('op1_') for x in q); assert set(e.oracle_sql()) <= set(q)"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True).returncode == 0

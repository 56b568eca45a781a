"""Every registered query against its SQL on the small tables."""

import glob
import os
import subprocess
import sys

import duckdb
import pandas as pd
import pytest

from siltwork.plans import check_queries as registry


def canonical(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 6))
        return str(pd.Timestamp(v)) if isinstance(v, pd.Timestamp) else str(v)

    return sorted(tuple(one(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_gives_the_rows_of_its_sql(spark, sf_dir, duck, name):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(registry.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("gone", ["siltwork.llm", "xxhash", "public_tokenizers", "corpus_pipeline"])
def test_the_other_queries_stay_when_a_module_is_missing(gone):
    hide = f"import sys; sys.modules[{gone!r}] = None" if gone != "siltwork.llm" else "import sys; sys.modules['siltwork.llm'] = None; sys.modules['siltwork.llm.queries'] = None"
    code = f"{hide}\nimport __spark_entry__ as e\nprint(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), check=False)
    assert out.returncode == 0 and int(out.stdout.split()[0]) >= len(registry.QUERIES), out.stderr

"""The registry: every twin has its query, and twins agree at the smallest scale."""

import duckdb
import pytest

import __spark_entry__ as entry
from mergewright.plans import parity

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def canonical(df):
    rows = df.astype(object).where(df.notna(), None)
    return sorted(repr(tuple(round(float(v), 4) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r)) for r in rows[sorted(df.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def con():
    out = duckdb.connect()
    for t in TABLES:
        out.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return out


@pytest.mark.parametrize("name", sorted(parity.ORACLES))
def test_twin(spark, con, name):
    got, want = parity.QUERIES[name](spark, SF).toPandas(), con.sql(parity.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_the_rest_works_without_the_training_data_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(entry.__file__).parent
    shutil.copytree(top / "mergewright", tmp_path / "mergewright", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    for with_pipeline in (False, True):
        if with_pipeline and (top / "corpus_pipeline.py").exists():
            shutil.copy(top / "corpus_pipeline.py", tmp_path)
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') for n in e.queries()))"
        out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
        assert out == [str(len(parity.QUERIES)), str(len(parity.ORACLES)), "False"]

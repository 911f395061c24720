import os
import shutil
import subprocess
import sys

import __spark_entry__ as E
from conftest import ROOT, SF_SMALL
from mercato.plans import catalog


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and "revenue_per_customer" in df.columns


def test_every_query_has_oracle_sql():
    assert set(catalog.ORACLE_SQL) == set(catalog.QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_duckdb_at_small_scale():
    # separate process: the checker builds its own session and DuckDB connection
    env = dict(os.environ)
    r = subprocess.run([sys.executable, os.path.join(ROOT, "tests", "oracle_check.py"), SF_SMALL, *catalog.QUERIES],
                       capture_output=True, text=True, timeout=1800, env=env)
    assert "ALL OK" in r.stdout, r.stdout[-3000:] + r.stderr[-2000:]


def test_entry_works_without_the_training_data_package(tmp_path):
    # with and without corpus_pipeline.py, which needs the package
    for name, skipped in (("a", ["llm"]), ("b", ["llm", "corpus_pipeline.py"])):
        root = tmp_path / name
        shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "__pycache__", *skipped))
        code = "import __spark_entry__ as e; q = e.queries(); print(len(q), 'pipeline' in q, set(e.oracle_sql()) == set(q))"
        r = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
        assert r.stdout.split() == [str(len(catalog.QUERIES)), "False", "True"], r.stderr

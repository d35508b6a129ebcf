"""The entry points, and every query of the engine's own operators against its SQL twin."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__
from quern.plans import catalog


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[: -len('.parquet')]} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    return [plain(v) for v in value] if isinstance(value, list | tuple) else value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(plain(row[k]) for k in order) for row in rows), key=repr)


def test_entry_is_the_flagship(spark):
    found = __spark_entry__.entry(spark)
    assert found.columns == ["doc_id", "text"]
    assert found.count() > 0


def test_every_twin_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_agrees_with_sql(spark, duck, sf_dir, name):
    found = catalog.queries()[name](spark, sf_dir)
    twin = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in twin.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, [tuple(r) for r in found.collect()]) == rows_of(columns, twin.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_query_without_twin_runs(spark, sf_dir, name):
    assert catalog.queries()[name](spark, sf_dir).count() >= (name != "short_text_pairs_levenshtein")  # few texts are that short


def test_entry_works_without_the_removable_parts(tmp_path):
    """A copy without the llm folders, though corpus_pipeline.py may still lie there."""
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(__spark_entry__.__file__))
    shutil.copytree(f"{root}/quern", tmp_path / "quern", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'pipeline' not in q and not any(n.startswith('op1') for n in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True)

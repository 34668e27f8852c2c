"""Every registered query against its SQL counterpart on the smallest tables."""

import os

import pytest
from compare import difference, open_tables

from mercato.checks import ORACLES, QUERIES

# Thresholds of these keys lie above anything in the smallest tables; sf0.01 has rows for them.
EMPTY_HERE = {"geo_sales_matrix", "geo_sales_matrix_rounded"}
FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return open_tables(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_rows(spark, tables, name):
    if name not in ORACLES:
        assert QUERIES[name](spark, FOLDER).columns
        return
    problem = difference(spark, tables, FOLDER, QUERIES[name], ORACLES[name])
    assert problem is None or (problem == "no rows" and name in EMPTY_HERE), problem


def test_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns[0] == "category"


def test_declared_columns_match_the_files(spark):
    from mercato.checks.market import SUPPLIED

    for name, declared in SUPPLIED.items():
        found = spark.read.parquet(f"{FOLDER}/{name}.parquet").schema
        wanted = spark.createDataFrame([], declared).schema
        assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in wanted], name


@pytest.mark.parametrize("pipeline", [True, False])
def test_everything_else_works_without_the_optional_part(tmp_path, pipeline):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(f"{root}/mercato", tmp_path / "mercato", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    if pipeline and os.path.exists(f"{root}/corpus_pipeline.py"):
        shutil.copy(f"{root}/corpus_pipeline.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and 'pipeline' not in q and not any(n.startswith('op') and n[2].isdigit() for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env=os.environ | {"PYTHONPATH": str(tmp_path)})

"""The driver contract in __spark_entry__.py."""

import shutil
import subprocess
import sys

import __spark_entry__ as contract
from conftest import ROOT, TESTDATA, duck, rows_of, sorted_rows


def test_entry_runs_on_smoke_data(spark):
    df = contract.entry(spark)
    assert df.columns == ["r_name", "n_name", "n_lines", "revenue"]
    assert df.count() > 0


def star_schema_queries():
    """The queries of this part; those of strata/llm (opN_..., pipeline) have tests of their own."""
    return {n: q for n, q in contract.queries().items() if not (n == "pipeline" or n.startswith("op"))}


def test_every_query_has_oracle_sql():
    assert set(star_schema_queries()) == {"revenue_by_region"}
    assert set(star_schema_queries()) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_queries_match_their_oracle_with_same_column_names(spark):
    root = TESTDATA / "sf0.01"
    oracle = contract.oracle_sql()
    for name, build in star_schema_queries().items():
        df = build(spark, str(root))
        result = duck(root).execute(oracle[name])
        assert df.columns == [d[0] for d in result.description], name
        assert rows_of(df) == sorted_rows(result.fetchall()), name


def test_entry_imports_without_the_llm_folders(tmp_path):
    """The driver deletes corpus_pipeline.py and the llm folders; the rest must still work."""
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=copy, capture_output=True, text=True, check=True)
    assert out.stdout.strip() == "['revenue_by_region'] ['revenue_by_region']"

"""The driver contract."""

import __spark_entry__ as E
from tests.conftest import SF0001

ROWS_ONLY = {"trip_preview"}


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() == 770
    assert set(df.columns) == {"time_block", "day", "month", "borough_name", "mean", "mean_int"}


def test_oracle_coverage():
    q, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(q)
    assert set(q) - set(sql) - set(E.LLM_QUERIES) == ROWS_ONLY


def test_counts_match_fixture_notes(spark):
    q = E.queries()
    assert q["trip_counts"](spark, SF0001).count() == 820
    assert q["live_vs_history"](spark, SF0001).count() == 210


def test_rest_works_without_the_training_data_folders(tmp_path):
    """A copy without the two folders: the module imports and still lists every other query."""
    import os
    import shutil
    import subprocess
    import sys
    here = os.path.dirname(os.path.abspath(E.__file__))
    for keep_pipeline in (True, False):
        copy = tmp_path / f"copy-{keep_pipeline}"
        shutil.copytree(here, copy, ignore=lambda d, names: [n for n in names if n in (".git", "llm", "__pycache__") or n.startswith(".")
                                                             or n == "corpus_pipeline.py" and not keep_pipeline])
        code = "import __spark_entry__ as E; print(len(E.queries()), len(E.oracle_sql()), len(E.LLM_QUERIES))"
        env = {**os.environ, "PYTHONPATH": str(copy), "PYTHONDONTWRITEBYTECODE": "1"}
        out = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
        assert out.returncode == 0, out.stderr[-500:]
        others = len(E.queries()) - len(E.LLM_QUERIES)
        assert out.stdout.split() == [str(others), str(others - len(ROWS_ONLY)), "0"]

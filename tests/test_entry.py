import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(setup=""):
    code = f"import sys; {setup}import __spark_entry__ as e; print(*sorted(e.queries())); print(*sorted(e.oracle_sql()))"
    return [line.split() for line in subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.strip().split("\n")]


def test_entry_works_without_the_training_data_operators():
    queries, sql = names("sys.modules['fragloom.llm'] = None; sys.modules['corpus_pipeline'] = None; ")
    assert "gold_persons" in queries and "pipeline" not in queries and set(sql) <= set(queries)
    assert not any(q.startswith("op") for q in queries)


def test_other_import_errors_are_not_hidden():
    done = subprocess.run([sys.executable, "-c", "import sys; sys.modules['fragloom.plans.queries'] = None; import __spark_entry__"], cwd=ROOT, capture_output=True, text=True)
    assert done.returncode != 0 and "fragloom.plans.queries" in done.stderr


def test_entry(spark):
    import __spark_entry__

    out = __spark_entry__.entry(spark)
    assert out.columns == ["id", "match_key", "completeness"] and out.count() > 0


def test_the_rest_works_where_the_training_data_folders_are_gone(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "spark-warehouse", "__pycache__", "llm", "corpus_pipeline.py"))
    assert not (copy / "fragloom" / "llm").exists() and not (copy / "tests" / "llm").exists()
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q) and 'pipeline' not in q; print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True)
    assert done.returncode == 0 and int(done.stdout) > 40
    collected = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-x", "-p", "no:cacheprovider", "-k", "test_waiting or test_rates or test_other_import"], cwd=copy, capture_output=True, text=True)
    assert collected.returncode == 0, collected.stdout

import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parent.parent


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_works_without_the_optional_subpackage(tmp_path):
    """A copy without the training-data operators must import and keep its other queries."""
    import shutil

    shutil.copytree(REPO / "gridscan", tmp_path / "gridscan", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'scan_nation' in q and not any(k.startswith('op') or k == 'pipeline' for k in q), q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_the_optional_subpackage():
    for f in (REPO / "gridscan").rglob("*.py"):
        if "llm" not in f.relative_to(REPO / "gridscan").parts:
            assert "llm" not in f.read_text(), f

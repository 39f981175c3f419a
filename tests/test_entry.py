import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_registry_works_without_the_training_data_operators(tmp_path):
    shutil.copytree(ROOT / "kinlink", tmp_path / "kinlink", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'recall_s1_s2' in q and 'pipeline' not in q and not any(k.startswith('op1_') for k in q); assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})


def test_nothing_else_imports_them():
    for p in (ROOT / "kinlink").rglob("*.py"):
        if "llm" not in p.parts:
            assert "kinlink.llm" not in p.read_text(), p

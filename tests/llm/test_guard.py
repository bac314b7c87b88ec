"""The rest of the library works without the text operators."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]


def test_nothing_else_imports_the_subpackage():
    for path in (ROOT / "quantloom").rglob("*.py"):
        if "llm" not in path.relative_to(ROOT).parts:
            assert "llm" not in path.read_text(), path


def test_entry_without_the_subpackage(tmp_path):
    import shutil

    shutil.copytree(ROOT / "quantloom", tmp_path / "quantloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'M1_candles_daily' in q and not any(k.startswith('op') for k in q) and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)

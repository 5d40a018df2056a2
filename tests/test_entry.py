"""The entry point with and without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent


def names(root: Path) -> set[str]:
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"],
                         cwd=root, capture_output=True, text=True, check=True).stdout.split("\n")
    assert set(out[1].split()) <= set(out[0].split())
    return set(out[0].split())


def test_entry_without_the_optional_parts(tmp_path):
    shutil.copytree(ROOT / "framecurate", tmp_path / "framecurate", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    left = names(tmp_path)
    assert len(left) >= 60 and "pipeline" not in left and not any(n.startswith("op") for n in left)
    (tmp_path / "framecurate" / "llm" / "__pycache__").mkdir(parents=True)       # what a deletion may leave
    assert names(tmp_path) == left
    assert left <= names(ROOT)

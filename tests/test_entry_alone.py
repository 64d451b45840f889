"""The entry module without the operators for training data."""

import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def names(folder, code="import __spark_entry__ as e; print(*sorted(e.queries()))"):
    return subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, env={"PATH": "/usr/bin:/bin"})


def copy(target):
    shutil.copy(ROOT / "__spark_entry__.py", target)
    shutil.copytree(ROOT / "tempestry", target / "tempestry", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    return target


def test_entry_imports_without_them(tmp_path):
    done = names(copy(tmp_path))
    assert done.returncode == 0, done.stderr
    assert "stg_events" in done.stdout and "op1_" not in done.stdout and "pipeline" not in done.stdout


def test_other_import_errors_are_not_swallowed(tmp_path):
    copy(tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import no_such_module\n")
    done = names(tmp_path)
    assert done.returncode != 0 and "no_such_module" in done.stderr

"""The entry point works with the training-data package and without it."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), any(q.startswith('op') for q in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"


def say(folder):
    return subprocess.run([sys.executable, "-B", "-c", SAY], cwd=folder, capture_output=True, text=True)


def copy(tmp_path):
    for name in ("hertzmill", "__spark_entry__.py", "corpus_pipeline.py"):
        if (ROOT / name).is_dir():
            shutil.copytree(ROOT / name, tmp_path / name, ignore=shutil.ignore_patterns("__pycache__"))
        elif (ROOT / name).exists():
            shutil.copy(ROOT / name, tmp_path)
    return tmp_path


def test_without_the_package(tmp_path):
    folder = copy(tmp_path)
    shutil.rmtree(folder / "hertzmill/llm", ignore_errors=True)
    (folder / "corpus_pipeline.py").unlink(missing_ok=True)
    said = say(folder)
    assert said.returncode == 0, said.stderr
    assert said.stdout.split()[1:] == ["False", "False", "True"] and int(said.stdout.split()[0]) > 70


@pytest.mark.skipif(not (ROOT / "hertzmill/llm").is_dir(), reason="the package has been removed")
def test_errors_inside_the_package_are_not_hidden(tmp_path):
    folder = copy(tmp_path)
    assert say(folder).stdout.split()[1:] == ["True", "True", "True"]
    (folder / "hertzmill/llm/mixing.py").write_text("import no_such_module\n")
    assert say(folder).returncode != 0


def test_nothing_else_imports_the_package():
    for path in (ROOT / "hertzmill").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path

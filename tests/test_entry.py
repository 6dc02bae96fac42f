"""The entry module with and without its optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).parent.parent


def listed(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    run = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=folder, capture_output=True, text=True)
    assert run.returncode == 0, run.stderr
    return [line.split() for line in run.stdout.splitlines()]


@pytest.mark.parametrize("pipeline", [True, False])
def test_without_the_optional_folders(tmp_path, pipeline):
    from pulsegrid.plans.queries import REGISTRY

    skip = shutil.ignore_patterns("llm", "__pycache__")
    shutil.copytree(REPO / "pulsegrid", tmp_path / "pulsegrid", ignore=skip)
    shutil.copy(REPO / "__spark_entry__.py", tmp_path)
    if pipeline and (REPO / "corpus_pipeline.py").exists():
        shutil.copy(REPO / "corpus_pipeline.py", tmp_path)
    queries, oracles = listed(tmp_path)
    assert queries == list(REGISTRY) and set(oracles) <= set(queries)


def test_nothing_imports_the_optional_folder():
    for path in (REPO / "pulsegrid").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path

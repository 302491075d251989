"""The library stands without the training-data operators."""

import shutil
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[1]
WITHOUT = """
import __spark_entry__ as entry
names = set(entry.queries())
assert "violation_union" in names and "pipeline" not in names, names
assert not [n for n in names if n.startswith("op")], names
assert set(entry.oracle_sql()) <= names
"""


def copied(target: Path, *left_out: str) -> Path:
    def ignore(folder, names):
        inside = Path(folder).relative_to(REPO)
        return [n for n in names if str(inside / n) in left_out or n in (".git", "__pycache__")]

    return Path(shutil.copytree(REPO, target, ignore=ignore))


def runs(folder: Path, code: str) -> None:
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=folder, env={"PYTHONPATH": str(folder)},
        capture_output=True, text=True, check=False,
    )
    assert done.returncode == 0, done.stderr


def test_the_rest_imports_without_llm(tmp_path):
    runs(copied(tmp_path / "a", "spanwatch/llm", "tests/llm", "corpus_pipeline.py"), WITHOUT)


def test_a_pipeline_left_behind_does_no_harm(tmp_path):
    folder = copied(tmp_path / "b", "spanwatch/llm", "tests/llm")
    assert (folder / "corpus_pipeline.py").exists()
    runs(folder, WITHOUT)

"""The library without its training-text part."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPOSITORY = Path(__file__).resolve().parents[1]
PROGRAM = """
import __spark_entry__ as entry
import bench
from deskwright.session import build_session

names = set(entry.queries())
assert "quality_dimensions" in names and set(entry.oracle_sql()) <= names
assert "pipeline" not in names and not [n for n in names if n.startswith("op")]
session = build_session("local[2]", **{"spark.ui.enabled": "false"})
print("rows:", len(entry.entry(session).collect()))
"""


def _copied(folder: Path, *absent: str) -> Path:
    ignored = shutil.ignore_patterns(".git", "__pycache__", ".pytest_cache", *absent)
    shutil.copytree(REPOSITORY, folder / "copy", ignore=ignored)
    return folder / "copy"


def _run(folder: Path, program: str) -> subprocess.CompletedProcess:
    return subprocess.run(
        [sys.executable, "-c", program], cwd=folder, capture_output=True, text=True, timeout=300
    )


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").is_dir(), reason="test tables are not there")
@pytest.mark.parametrize("absent", [["llm"], ["llm", "corpus_pipeline.py"]])
def test_rest_works_without_the_training_text_part(tmp_path, absent):
    copy = _copied(tmp_path, *absent)
    program = PROGRAM.replace("len(entry.entry(session).collect())", "1") if len(absent) > 1 else PROGRAM
    done = _run(copy, program)
    assert done.returncode == 0 and "rows: 1" in done.stdout, done.stderr[-2000:]


def test_other_missing_modules_are_errors(tmp_path):
    """Only the absence of the part itself is no error."""
    copy = _copied(tmp_path, "tests")
    queries = copy / "deskwright" / "llm" / "queries.py"
    queries.parent.mkdir(exist_ok=True)
    queries.write_text("import a_module_that_nobody_has\n", encoding="utf-8")
    (copy / "corpus_pipeline.py").touch()
    done = _run(copy, "import __spark_entry__")
    assert done.returncode != 0 and "a_module_that_nobody_has" in done.stderr

import subprocess
import sys
from pathlib import Path
from shutil import copytree, ignore_patterns

import pytest

REPO = Path(__file__).resolve().parents[1]

LISTS = """
import __spark_entry__ as e
from logloom.catalog import ORACLES, QUERIES
assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) == set(ORACLES)
assert len(QUERIES) > 100
"""


@pytest.mark.parametrize("left_out", [("llm",), ("llm", "corpus_pipeline.py")])
def test_the_rest_works_without_the_training_data_package(tmp_path, left_out):
    """A copy of the repository without the package, with and without the pipeline's file."""
    copytree(REPO, tmp_path / "copy", ignore=ignore_patterns(*left_out, ".git", "__pycache__"))
    subprocess.run([sys.executable, "-c", LISTS], cwd=tmp_path / "copy", check=True, timeout=120, env={"PATH": "/usr/bin:/bin"})


def test_other_import_errors_are_not_hidden(tmp_path):
    copytree(REPO, tmp_path / "copy", ignore=ignore_patterns(".git", "__pycache__"))
    (tmp_path / "copy/logloom/llm/mixing.py").write_text("import a_module_that_is_not_there")
    run = subprocess.run([sys.executable, "-c", LISTS], cwd=tmp_path / "copy", capture_output=True, timeout=120, env={"PATH": "/usr/bin:/bin"})
    assert run.returncode and b"a_module_that_is_not_there" in run.stderr

"""A checkout without the training-data operators imports, and lists all other queries."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as contract

REPO = Path(__file__).resolve().parents[1]
LIST = "import __spark_entry__ as c; print(*sorted(c.queries())); print(*sorted(c.oracle_sql()))"


@pytest.mark.parametrize("gone", [("tallyfold/llm",), ("tallyfold/llm", "corpus_pipeline.py"), ("corpus_pipeline.py",)])
def test_import_without(tmp_path, gone):
    left_out = shutil.ignore_patterns(".git", "__pycache__", "*.json")
    copy = tmp_path / "copy"
    shutil.copytree(REPO, copy, ignore=lambda d, names: set(left_out(d, names)) | {
        n for n in names if str((Path(d) / n).relative_to(REPO)) in gone
    })
    found = subprocess.run(
        [sys.executable, "-c", LIST], cwd=copy, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(copy)},
        capture_output=True, text=True, check=True, timeout=300,
    )
    names, sql = (set(line.split()) for line in found.stdout.splitlines()[-2:])
    own = {n for n in contract.queries() if n == "pipeline" or n.startswith("op")}
    expected = set(contract.queries()) - {"pipeline"}
    assert names == (expected - own if "tallyfold/llm" in gone else expected)
    assert sql == set(contract.oracle_sql()) - {"pipeline"} - own


def test_a_fault_within_an_optional_module_is_not_hidden(monkeypatch):
    with pytest.raises(ModuleNotFoundError):
        contract._optional("tallyfold.no_such_module")

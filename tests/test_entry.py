"""The entry module with and without the training-data package and the pipeline."""

import json
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent

RUN = """
import json, sys
sys.path.insert(0, {root!r})
import __spark_entry__ as e
from tests.conftest import make_session
rows = e.queries()["Q3_top_groups_by_volume"](make_session(), {sf!r}).count()
print("RESULT", json.dumps([rows, sorted(e.queries()), sorted(e.oracle_sql())]))
"""


@pytest.mark.parametrize("kept", [(), ("corpus_pipeline.py",)])
def test_the_rest_works_without_the_training_data_package(tmp_path, kept):
    """A copy without both ``llm`` folders, with and without ``corpus_pipeline.py``, imports and runs a query."""
    root = tmp_path / "copy"
    shutil.copytree(REPO, root, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *({"corpus_pipeline.py"} - set(kept))))
    assert not (root / "steward" / "llm").exists() and not (root / "tests" / "llm").exists()
    code = RUN.format(root=str(root), sf="/root/testdata/sf0.001")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    (line,) = [x for x in done.stdout.splitlines() if x.startswith("RESULT ")]
    rows, queries, oracles = json.loads(line.removeprefix("RESULT "))
    assert rows == 5 and len(queries) > 80 and set(oracles) <= set(queries)
    assert not [q for q in queries if q.startswith("op") or q == "pipeline"]


def test_what_an_operator_needs_is_not_taken_for_absent(tmp_path):
    """A module missing inside the package is an error of its own, not an absent package."""
    root = tmp_path / "copy"
    shutil.copytree(REPO, root, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "corpus_pipeline.py"))
    (root / "steward" / "llm").mkdir()
    (root / "steward" / "llm" / "__init__.py").touch()
    (root / "steward" / "llm" / "bindings.py").write_text("import surely_not_installed\n")
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode and "surely_not_installed" in done.stderr

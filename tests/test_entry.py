"""The entry works where the text operators, the pipeline or both have been taken out."""

import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parent.parent
BLOCK = """
import sys
from importlib.abc import MetaPathFinder

class Gone(MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if any(name == g or name.startswith(g + ".") for g in {gone!r}):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)

sys.meta_path.insert(0, Gone())
import __spark_entry__ as entry
found, checks = entry.queries(), entry.oracle_sql()
assert set(checks) <= set(found) and "k05_med_history" in found
print(sum(n.startswith("op") for n in found), "pipeline" in found)
"""


@pytest.mark.parametrize("gone,left", [([], True), (["claimweave.llm"], False), (["corpus_pipeline"], None), (["claimweave.llm", "corpus_pipeline"], False)])
def test_entry_without_the_text_operators(gone, left):
    if not (ROOT / "corpus_pipeline.py").exists() or not (ROOT / "claimweave/llm").is_dir():
        left = False
    run = subprocess.run([sys.executable, "-c", BLOCK.format(gone=gone)], cwd=ROOT, capture_output=True, text=True)
    assert not run.returncode, run.stderr
    n, pipeline = run.stdout.split()
    assert (int(n) > 0) == (left is not False) and pipeline == str(left is True)


def test_errors_inside_the_text_operators_are_not_hidden():
    broken = BLOCK.replace("import __spark_entry__", "sys.modules['claimweave.llm.texts'] = None\nimport __spark_entry__").format(gone=[])
    if (ROOT / "claimweave/llm").is_dir():
        assert subprocess.run([sys.executable, "-c", broken], cwd=ROOT, capture_output=True).returncode

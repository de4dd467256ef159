"""What is missing of the operators on texts does not take the other queries away."""

import subprocess
import sys

import pytest

from conftest import ROOT

COUNT = "import __spark_entry__ as e; q = e.queries(); print(len(q), len(set(q) - set(e.LLM_QUERIES)))"


@pytest.mark.parametrize("library", ["zstandard", "tripflow.llm", "corpus_pipeline"])
def test_import_without(library):
    code = f"import sys; sys.modules[{library!r}] = None; {COUNT}"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    found, own = map(int, done.stdout.split())
    assert own >= 36 and found >= own

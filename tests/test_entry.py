"""The entry works without the corpus operators, whichever way they cannot be imported."""

import os
import subprocess
import sys

import pytest

from tests.conftest import ROOT

SCRIPT = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r} or name.startswith({missing!r} + "."):
            raise ModuleNotFoundError("No module named " + repr(name), name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
from ingestflow.plans.catalog import QUERIES
from ingestflow.plans.oracle import ORACLE
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(ORACLE)
"""


@pytest.mark.parametrize("missing", ["ingestflow.llm", "corpus_pipeline", "xxhash"])
def test_entry_without_the_corpus_part(missing):
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(missing=missing)], cwd=ROOT, capture_output=True, text=True, timeout=120,
                          env={**os.environ, "PYTHONPATH": ROOT})
    assert done.returncode == 0, done.stderr

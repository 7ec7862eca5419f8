"""The entry module: what it registers, and what it leaves out where a library is missing."""

import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

_IMPORT = """
import importlib.abc, sys
sys.path.insert(0, {root!r})

class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name in {names!r}:
            raise ModuleNotFoundError(f"No module named {{name}}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print("FOUND", len(entry.queries()), sum(n.startswith("op") or n == "pipeline" for n in entry.queries()), len(entry.oracle_sql()))
"""


def found(*missing):
    code = _IMPORT.format(root=ROOT, names=set(missing))
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout
    return [int(x) for x in out.split("FOUND")[1].split()]


@pytest.mark.parametrize("missing", ["ahocorasick", "zstandard", "fleetledger.llm"])
def test_without_a_library_the_other_queries_stay(missing):
    from fleetledger.queries import ORACLE, QUERIES
    every, optional, sql = found(missing)
    assert (every, optional, sql) == (len(QUERIES), 0, len(ORACLE))


def test_without_the_pipeline_the_operators_stay():
    every, optional, _ = found()
    if optional:
        assert found("corpus_pipeline")[:2] == [every - 1, optional - 1]

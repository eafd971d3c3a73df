"""The driver contract without the optional queries."""

import subprocess
import sys

import pytest

BLOCKED = """
import sys, warnings
class Block:
    def find_spec(self, name, path=None, target=None):
        if name == {name!r}:
            raise ModuleNotFoundError(f"No module named {{name!r}}", name=name)
sys.meta_path.insert(0, Block())
import __spark_entry__ as e
with warnings.catch_warnings(record=True) as seen:
    warnings.simplefilter("always")
    q, o = e.queries(), e.oracle_sql()
from pricelens.catalog import QUERIES
assert set(QUERIES) <= set(q) and not any(n.startswith("op1_") for n in q), sorted(q)
assert set(o) <= set(q) and any({name!r} in str(w.message) for w in seen)
"""


@pytest.mark.parametrize("name", ["zstandard", "pricelens.llm"])
def test_other_queries_stay(name):
    subprocess.run([sys.executable, "-c", BLOCKED.format(name=name)], check=True, cwd=__file__.rsplit("/tests/", 1)[0])

"""The driver's entry module works with and without the optional subpackage."""

from __future__ import annotations

import os
import subprocess
import sys

from conftest import ROOT

WITHOUT = """
import importlib.abc, sys

class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path=None, target=None):
        if name.startswith(("mercato.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)

sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()), len(entry.oracle_sql()), "pipeline" in entry.queries())
"""


def _run(code: str) -> str:
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True,
                          env=os.environ | {"PYTHONPATH": ROOT}, timeout=120)
    assert done.returncode == 0, done.stderr
    return done.stdout.strip()


def test_entry_without_the_optional_subpackage():
    from mercato.plans import oracle, queries

    assert _run(WITHOUT) == f"{len(queries.queries())} {len(oracle.oracle_sql())} False"


def test_other_import_errors_are_not_swallowed():
    broken = WITHOUT.replace('raise ModuleNotFoundError(f"No module named {name!r}", name=name)',
                             'raise ModuleNotFoundError("No module named \'numpy\'", name="numpy")')
    code = f"""
try:
    exec({broken!r})
except ModuleNotFoundError as e:
    print(e.name)
"""
    assert _run(code) == "numpy"

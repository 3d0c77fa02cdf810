"""The driver's entry: it stands without the training-data operators, but does
not hide that something they need is missing."""

import importlib.util
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def entry(blocked):
    code = f"import sys; sys.modules[{blocked!r}] = None; import __spark_entry__ as e; print(len(e.queries()), sum(n.startswith('op') for n in e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    return subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)


def test_without_the_subpackage():
    out = entry("quarry.llm")
    assert out.returncode == 0, out.stderr
    n, ops, known = out.stdout.split()
    assert int(n) >= 77 and ops == "0" and known == "True"


def test_a_missing_library_is_told():
    if importlib.util.find_spec("quarry.llm") is None:
        pytest.skip("no training-data operators here")
    out = entry("ahocorasick")
    assert out.returncode != 0 and "ahocorasick" in out.stderr

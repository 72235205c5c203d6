"""Every module can be the first one that a program imports."""

import os
import subprocess
import sys
from concurrent.futures import ThreadPoolExecutor

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _modules():
    for folder, _, files in os.walk(os.path.join(ROOT, "lotcast")):
        parts = os.path.relpath(folder, ROOT).split(os.sep)
        if parts[1:2] != ["llm"]:
            yield from (".".join(parts + [f[:-3]] * (f != "__init__.py")) for f in files if f.endswith(".py"))


def _error(module):
    ran = subprocess.run([sys.executable, "-c", f"import {module}"], cwd=ROOT, capture_output=True, text=True)
    return ran.stderr if ran.returncode else None


def test_modules_import_in_any_order():
    modules = sorted(_modules())
    assert {"lotcast", "lotcast.streaming.scoring", "lotcast.ml"} <= set(modules)
    with ThreadPoolExecutor(4) as pool:
        assert {m: e for m, e in zip(modules, pool.map(_error, modules)) if e} == {}

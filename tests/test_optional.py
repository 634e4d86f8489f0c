"""The library and its queries work without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_without_the_subpackage(tmp_dir):
    copy = os.path.join(tmp_dir, "repo")
    left_out = shutil.ignore_patterns("llm", "corpus_pipeline.py", ".git", "__pycache__", "tests")
    shutil.copytree(ROOT, copy, ignore=left_out)
    code = "import __spark_entry__ as e; print(*sorted(e.queries())); assert set(e.oracle_sql()) <= set(e.queries())"
    out = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": copy})
    assert out.returncode == 0, out.stderr
    names = out.stdout.split()
    assert "scan_flat" in names and "pipeline" not in names and not any(n.startswith("op1_") for n in names)


def test_nothing_else_imports_the_subpackage():
    for top in ("unfurl", "workloads"):
        for folder, _, files in os.walk(os.path.join(ROOT, top)):
            if os.path.basename(folder) != "llm":
                for f in files:
                    if f.endswith(".py"):
                        assert "llm" not in open(os.path.join(folder, f), encoding="utf-8").read(), f


def test_entry_without_a_library_of_the_subpackage(tmp_dir):
    """A missing third-party library takes the optional queries with it, no others."""
    code = ("import sys; sys.modules['xxhash'] = None; import warnings; warnings.simplefilter('ignore'); import __spark_entry__ as e; "
            "assert 'scan_flat' in e.queries() and not any(n.startswith('op1_') for n in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": ROOT})
    assert out.returncode == 0, out.stderr

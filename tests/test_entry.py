"""The driver's module with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

from engagelake import catalog

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"


def counts(folder):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=folder, env=env, capture_output=True, text=True, check=True)
    return tuple(map(int, out.stdout.split()))


def test_without_the_corpus_operators(tmp_path):
    whole = tmp_path / "whole"
    shutil.copytree(ROOT, whole, ignore=shutil.ignore_patterns(".git", "__pycache__", "tests"))
    rest = len(catalog.queries()), len(catalog.oracle_sql())
    for name in ("llm", "pipeline"):  # a folder without its sources, with stale byte code or without; a missing pipeline
        part = tmp_path / name
        shutil.copytree(whole, part)
        if name == "llm":
            for f in (part / "engagelake/llm").glob("*.py"):
                f.unlink()
            (part / "engagelake/llm/__pycache__").mkdir(parents=True, exist_ok=True)
            (part / f"engagelake/llm/__pycache__/registry.{sys.implementation.cache_tag}.pyc").write_bytes(b"stale")
        else:
            shutil.rmtree(part / "engagelake/llm", ignore_errors=True)
            (part / "corpus_pipeline.py").unlink(missing_ok=True)
        assert counts(part) == rest

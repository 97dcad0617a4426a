"""Executors need no copy of the package: every query with Python tasks runs where it cannot be imported."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import importlib.util, sys
spec = importlib.util.spec_from_file_location("contract", {entry!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
from segqa.session import local_session
spark = local_session(4, "elsewhere")
for name, query in contract.queries().items():
    if name[:3] in ("op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9") or name == "pipeline":
        query(spark, {sf_dir!r}).write.format("noop").mode("overwrite").save()
        print("ran", name, flush=True)
"""


def test_all_corpus_queries_from_another_folder(tmp_path):
    entry = str(Path(__file__).resolve().parents[2] / "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(entry=entry, sf_dir="/root/testdata/sf0.001")
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600,
    )
    assert done.stdout.count("ran ") == 14, done.stderr[-3000:]

"""Executors need no copy of the package: tasks run where it cannot be imported."""

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
spark = local_session(2, "elsewhere")
for name in ("packed_captions_chunked", "infer_batch", "stream_segments", "scanned_videos"):
    assert contract.queries()[name](spark, {sf_dir!r}).count() > 0, name
print("all ran")
"""


def test_from_another_folder(tmp_path, sf_dir):
    entry = str(Path(__file__).resolve().parents[1] / "__spark_entry__.py")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(entry=entry, sf_dir=sf_dir)],
        cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "all ran" in done.stdout, done.stderr[-3000:]

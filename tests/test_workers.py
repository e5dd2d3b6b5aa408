"""Python tasks must not need the package on the workers."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from tidemark.session import build_session
from tidemark.plans import QUERIES
spark = build_session("elsewhere", {{"spark.master": "local[2]", "spark.ui.enabled": "false",
                                    "spark.sql.shuffle.partitions": "2"}})
print("rows", QUERIES["class_density"](spark, "/root/testdata/sf0.001").count())
"""


def test_density_from_another_folder(tmp_path):
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "rows 2400" in done.stdout, done.stderr[-2000:]

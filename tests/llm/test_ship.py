"""Python workers that do not find the package by themselves get it from the driver."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from flightlens.session import session
from flightlens.llm.queries import QUERIES
spark = session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[1]}})
print("rows", QUERIES["op3_best_fit_packing"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_outside_the_repository(tmp_path):
    env = {"PATH": "/usr/bin:/bin", "HOME": str(tmp_path), "PYSPARK_PYTHON": sys.executable}
    import os
    env |= {k: v for k, v in os.environ.items() if k.startswith("JAVA") or k == "PATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(tmp_path / "shared")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300,
    )
    assert "rows " in out.stdout, out.stderr[-2000:]

"""Executors need no copy of the package: task code and what it uses travel with the plan."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

from tests.llm.tables import SMALL

REPO = Path(__file__).resolve().parents[2]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(REPO)!r})
from cuadre.llm.queries import QUERIES
from cuadre.session import build_session

spark = build_session("local[4]", "workers", {{"spark.sql.shuffle.partitions": "2"}})

def importable(rows):
    import importlib.util
    yield from [(importlib.util.find_spec("cuadre") is not None,) for _ in rows]

assert not any(r[0] for r in spark.range(3).rdd.mapPartitions(importable).collect())
for name, query in QUERIES.items():
    assert query(spark, {SMALL!r}).count() > 0, name
print("all ran")
"""


def test_queries_run_where_workers_lack_the_package(tmp_path):
    (tmp_path / "run.py").write_text(SCRIPT)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    # the script's folder is the working folder, which workers search
    run = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert run.stdout.strip().endswith("all ran"), run.stderr[-3000:]

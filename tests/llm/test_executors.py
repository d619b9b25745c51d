"""Executors that do not have the package: a session started in another folder."""

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]
RUN = """
import sys
sys.path.insert(0, {root!r})
from trialmetrics.session import local_session
import __spark_entry__
spark = local_session(2, memory="2g", **{{"spark.ui.showConsoleProgress": "false"}})

def importable(_):
    try:
        import trialmetrics
        return ["there"]
    except ImportError:
        return ["missing"]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect() == ["missing"]
queries = __spark_entry__.queries()
for name in {names!r}:
    assert queries[name](spark, "/root/testdata/sf0.001").count() > 0, name
print("ran", len({names!r}))
"""


@pytest.mark.parametrize("part", [0, 1])
def test_queries_run_without_the_package_on_executors(tmp_path, part):
    sys.path.insert(0, str(ROOT))
    from trialmetrics.llm import queries

    names = [*queries.queries(), "pipeline"][part::2]
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    path = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and Path(p).resolve() != ROOT]
    if path:
        environment["PYTHONPATH"] = os.pathsep.join(path)
    done = subprocess.run([sys.executable, "-c", RUN.format(root=str(ROOT), names=names)], cwd=tmp_path, env=environment,
                          capture_output=True, text=True, timeout=900)
    assert f"ran {len(names)}" in done.stdout, done.stdout[-2000:] + done.stderr[-4000:]

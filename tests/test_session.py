"""The package reaches tasks from any working folder."""

import os
import subprocess
import sys

from conftest import ROOT, SMALL

JOB = """
import sys
sys.path.insert(0, {root!r})
from meterhouse.plans import catalog
from meterhouse.session import build_session, ship_package
spark = build_session("ship", "local[2]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false")
ship_package(spark)
for name in ("quo5_replay_gate", "str7_meter_stream"):
    print(name, catalog.queries()[name](spark, {data!r}).count())
"""


def test_replay_and_meter_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    job = JOB.format(root=str(ROOT), data=SMALL)
    done = subprocess.run(
        [sys.executable, "-c", job], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=280
    )
    counts = dict(line.split() for line in done.stdout.splitlines() if line.startswith(("quo5", "str7")))
    assert set(counts) == {"quo5_replay_gate", "str7_meter_stream"}, done.stderr[-2000:]
    assert all(int(n) > 0 for n in counts.values())

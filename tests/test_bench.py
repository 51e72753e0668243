"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_REPS": "1", "BENCH_CPUS": "2",
           "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "agg_count", "rate_by_one"],
                         capture_output=True, text=True, env=env, timeout=600, check=True)
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"agg_count", "rate_by_one"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-2 and "failed" not in d

"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_REPEATS="1", BENCH_CPUS="4")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "job_relational", "prof_nulls"],
                         capture_output=True, text=True, env=env, timeout=600, cwd="/tmp")
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(res)
    assert res["unit"] == "sec" and set(res["queries"]) == {"job_relational", "prof_nulls"}
    assert res["value"] == round(sum(res["queries"].values()), 3)

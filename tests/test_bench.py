"""bench.py prints exactly one JSON line in the driver's format."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from .conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2", BENCH_QUERIES="silver_balances,daily_balance")
    proc = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py")], capture_output=True, text=True, timeout=600, env=env
    )
    assert proc.returncode == 0, proc.stderr[-2000:]
    lines = [line for line in proc.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and set(d["queries"]) == {"silver_balances", "daily_balance"}
    assert d["value"] > 0

"""bench.py prints exactly one JSON line with the agreed keys."""

import json
import os
import subprocess
import sys

from conftest import SF_SMALL

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_REPEATS="1", BENCH_WARMUP="0",
               BENCH_BRUTE_FORCE="0", BENCH_ONCE="dq_duplicate_keys,not_registered", BENCH_QUERIES="json_envelope_flatten,stg_prices_flagged")
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py")], env=env, cwd=REPO,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"json_envelope_flatten", "stg_prices_flagged"}
    assert set(d["run_once_sec"]) == {"dq_duplicate_keys"}
    assert abs(d["value"] - sum(d["queries"].values())) < 1e-6

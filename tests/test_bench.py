import json
import os
import subprocess
import sys
from pathlib import Path


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_CPUS="2", BENCH_RUNS="1",
               BENCH_QUERIES="bucket_size,running_metrics")
    out = subprocess.run([sys.executable, "bench.py"], cwd=str(Path(__file__).resolve().parents[1]),
                         env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = out.stdout.strip().splitlines()
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["metric"] == "total_query_seconds" and d["unit"] == "sec" and d["sf"] == 0.001
    assert set(d["queries"]) == {"bucket_size", "running_metrics"}
    assert abs(d["value"] - sum(d["queries"].values())) < 0.01

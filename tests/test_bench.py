"""bench.py prints one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4"}
    out = subprocess.run(
        [sys.executable, os.path.join(ROOT, "bench.py"), "click_counts", "latest_offsets"],
        capture_output=True, text=True, env=env, timeout=600, check=True,
    ).stdout.strip().splitlines()
    assert len(out) == 1
    result = json.loads(out[0])
    assert result["unit"] == "sec" and result["sf"] == 0.001
    assert set(result["queries"]) == {"click_counts", "latest_offsets"}
    assert result["value"] == round(sum(result["queries"].values()), 3)
    assert "errors" not in result

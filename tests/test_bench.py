"""bench.py prints one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF_SMALL


def test_bench_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_CPUS": "2"}
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py"), "bhar_window"], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    rec = json.loads(out.strip().splitlines()[-1])
    assert rec["unit"] == "sec" and rec["sf"] == "0.001" and set(rec["queries"]) == {"bhar_window"}
    assert rec["value"] == rec["queries"]["bhar_window"] > 0

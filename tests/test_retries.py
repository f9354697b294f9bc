"""Tasks that fail and run again change no result and no count."""

from __future__ import annotations

import json
import os
import subprocess
import sys
from pathlib import Path


def test_failed_tasks_change_nothing(tmp_path):
    job = Path(__file__).with_name("retry_job.py")
    own_jvm = {
        name: value for name, value in os.environ.items() if not name.startswith("PYSPARK_GATEWAY")
    }
    ran = subprocess.run(
        [sys.executable, str(job), str(tmp_path)],
        env=own_jvm,
        capture_output=True,
        text=True,
        timeout=300,
        check=True,
    )
    assert json.loads(ran.stdout.splitlines()[-1]) == {
        "daily": 0,
        "silver": 0,
        "rows_counted_wrong": 0,
        "pieces": 0,
    }

"""Task failures during the batch: retried tasks leave exact, duplicate-free output."""

import json
import os
import subprocess
import sys
import tempfile

from tests.conftest import SF_SMALL


def test_batch_survives_failed_task_attempts():
    here = os.path.dirname(os.path.abspath(__file__))
    marks = tempfile.mkdtemp(prefix="tidewatch-fault-marks-")
    out = subprocess.run(
        [sys.executable, os.path.join(here, "fault_run.py"), SF_SMALL],
        capture_output=True, text=True, timeout=600, env={**os.environ, "TIDEWATCH_FAULT_MARKS": marks},
    )
    assert out.returncode == 0, out.stderr[-2000:]
    result = json.loads(out.stdout.strip().splitlines()[-1])
    assert result["failed_attempts"] > 0  # the injected failures did happen
    assert result["news_rows"] == result["news_expected"] > 0
    assert result["news_diff"] == 0 and result["gold_diff"] == 0

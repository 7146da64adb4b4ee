import os
import subprocess
import sys
from pathlib import Path

from stratalake.config import PUBLISHED


def test_publish_from_the_command_line(tmp_path):
    """A lake without Gold tables: every data set is skipped and the manifest says so."""
    run = subprocess.run(
        [sys.executable, "-m", "stratalake", "publish", "--root", str(tmp_path)],
        cwd=Path(__file__).resolve().parents[1],
        env={**os.environ, "SPARK_LOCAL_IP": "127.0.0.1"},
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    (manifest,) = (tmp_path / "data" / "powerbi" / "final" / "powerbi_manifest").glob("part-*.csv")
    lines = manifest.read_text(encoding="utf-8").splitlines()
    assert lines[0] == "dataset,status,source,target,message,generated_at_utc"
    assert [line.split(",")[:2] for line in lines[1:]] == [[name, "SKIPPED"] for name in PUBLISHED]

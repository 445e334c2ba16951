"""Checkpoint folder resolution for sessions that do not name one."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from equitas.session import reliable_checkpoint
s = (SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false")
     .config("spark.ui.showConsoleProgress", "false").getOrCreate())
assert s.conf.get("spark.checkpoint.dir", None) is None
out = reliable_checkpoint(s.range(10))
assert out.count() == 10
print("CKPT", s.sparkContext.getCheckpointDir())
s.stop()
"""


def test_local_session_without_checkpoint_setting_gets_scratch_folder():
    # an empty configuration folder: no spark-defaults, so no checkpoint setting
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="equitas-noconf-"))
    res = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT)], env=env,
                         capture_output=True, text=True, timeout=300)
    assert res.returncode == 0, res.stderr[-2000:]
    assert "CKPT file:" in res.stdout

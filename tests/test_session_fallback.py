"""Without any spark.checkpoint.dir setting the materializing queries still
run (a local fallback folder, tests only). Runs in a separate process with an
empty Spark configuration folder."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, %r)
from stockroom.session import get_spark, shared_dir
import __spark_entry__ as E
spark = get_spark("local[2]", shuffle_partitions=2)
assert spark.conf.get("spark.checkpoint.dir", None) is None
root = shared_dir(spark)
for name in ("merge_by_key", "replace_time_range", "stream_upsert_latest"):
    assert E.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
assert shared_dir(spark) == root
print("FALLBACK-OK")
""" % REPO


def test_queries_run_without_checkpoint_setting():
    env = dict(os.environ, SPARK_CONF_DIR=tempfile.mkdtemp(prefix="empty-conf-"))
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True,
                         text=True, timeout=600)
    assert "FALLBACK-OK" in out.stdout, out.stderr[-2000:]

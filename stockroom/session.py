"""Session and shared-storage helpers.

Everything that must outlive a task (work tables, stream checkpoints) goes
under the folder the cluster names in ``spark.checkpoint.dir``. A local
temporary folder is only created when that setting is missing, which is the
case in unit tests on a laptop, never on a configured cluster.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "stockroom",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A dimension above this size is joined by shuffle, not broadcast.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_FALLBACK: dict[int, str] = {}


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no local context
        return None


def shared_dir(spark: SparkSession) -> str:
    """Root folder for durable work data.

    In order: the ``spark.checkpoint.dir`` setting; the folder set with
    ``SparkContext.setCheckpointDir``; only when neither exists (tests on a
    laptop) a fresh local folder, which is then also registered as the
    context's checkpoint folder.
    """
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if root:
        return root.rstrip("/")
    sc = _context(spark)
    key = id(sc)
    if key in _FALLBACK:
        return _FALLBACK[key]
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current.rstrip("/").rsplit("/", 1)[0]   # <dir>/<application uuid>
    if key not in _FALLBACK:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: executors need a shared folder for work data")
        _FALLBACK[key] = tempfile.mkdtemp(prefix="stockroom-")
        if sc is not None:
            sc.setCheckpointDir(f"{_FALLBACK[key]}/rdd")
    return _FALLBACK[key]


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` write under the shared folder (a
    remote Spark Connect session has no local context; its server's own
    checkpoint setting applies)."""
    sc = _context(spark)
    if sc is None:
        return spark.conf.get(_CHECKPOINT_KEY, "")
    current = sc.getCheckpointDir()
    if current:
        return current
    d = f"{shared_dir(spark)}/rdd"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder."""
    return f"{shared_dir(spark)}/stockroom/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession, prefix: str = "sr") -> str:
    """Create a fresh catalog database whose managed tables live in the
    shared folder; returns its name."""
    name = f"{prefix}_{uuid.uuid4().hex[:12]}"
    location = f"{shared_dir(spark)}/stockroom/{name}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name

"""Session helpers: a local builder for tests/bench and a shared scratch folder.

Library code never sets a master; it takes the caller's ``SparkSession``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.utils import is_remote


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "cohortlab") -> SparkSession:
    """Session for tests and the bench: AQE on, UI off, Arrow on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach; it is read, never overridden, and its absence is an error. Only on
    a local master (tests, a bare local session) a fresh folder under the
    system temp dir is set.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if is_remote():                       # Spark Connect: no SparkContext, only the conf
        return configured or _no_folder()
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            _no_folder()
        configured = tempfile.mkdtemp(prefix="cohortlab-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _no_folder():
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path in the shared checkpoint folder for intermediate files.

    The folder of these paths is made once per session and removed when the
    driver's JVM ends; results read lazily from it stay valid until then.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if base not in _scratch:
        _scratch[base] = f"{base}/cohortlab-scratch-{uuid.uuid4().hex}"
        if not is_remote():
            path = spark._jvm.org.apache.hadoop.fs.Path(_scratch[base])
            fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
            fs.mkdirs(path)
            fs.deleteOnExit(path)
    return f"{_scratch[base]}/{name}-{uuid.uuid4().hex}"

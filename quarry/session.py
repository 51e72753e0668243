"""Session helpers.

Library operators never build a session: they take DataFrames and return
DataFrames. The only session-level needs are the shared checkpoint folder
(streams, ML lineage cuts) and a local builder for tests and the bench.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Settings every local run uses. On a cluster the caller's session wins;
# these only describe what the operators assume (AQE on, UTC clock).
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "quarry",
                  driver_memory: str = "8g", checkpoint_dir: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local[N] session for tests and the bench (never used by operators)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # the environment's spark.checkpoint.dir wins; ours only fills a gap
    if checkpoint_dir and not spark.conf.get(CHECKPOINT_CONF, None):
        _use_local_root(spark, checkpoint_dir)
    return spark


# Local fallback roots by application: spark.checkpoint.dir cannot be set on
# a running session (Spark refuses to modify it), so it is remembered here.
_LOCAL_ROOTS: dict[str, str] = {}


def _use_local_root(spark: SparkSession, root: str) -> None:
    sc = spark.sparkContext
    _LOCAL_ROOTS[sc.applicationId] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local master may fall back to a folder of
    its own (tests); a cluster job without the setting is refused, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or _LOCAL_ROOTS.get(sc.applicationId)
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a shared folder for cluster runs")
        root = tempfile.mkdtemp(prefix="quarry-ckpt-")
        _use_local_root(spark, root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(os.path.join(root, "rdd"))
    return root


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return os.path.join(checkpoint_root(spark), *parts)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared checkpoint folder (any file system
    Spark knows). Paths outside it are refused; a folder that is gone is fine."""
    root = checkpoint_root(spark).rstrip("/") + "/"
    if not path.startswith(root) or ".." in path.split("/"):
        raise ValueError(f"{path} is not below {root}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

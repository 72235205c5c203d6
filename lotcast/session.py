"""Session helpers: a local session for tests and benchmarks, and the
shared scratch folder every job writes intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.driver.memory": "8g",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lotcast",
                  extra: dict | None = None) -> SparkSession:
    """A local session for tests and the benchmark (never used by the
    library itself: library code takes the session it is given)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**_LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session with neither set -- tests,
    the benchmark -- gets a fresh folder of its own; on a cluster a
    machine-local folder would be lost with its executor, so there it is
    an error to leave the setting out.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="lotcast-ckpt-")
    sc.setCheckpointDir(root)
    return (sc.getCheckpointDir() or root).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared scratch root."""
    return f"{scratch_root(spark)}/lotcast/{name}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made with :func:`scratch_path` once nothing reads it."""
    if f"{scratch_root(spark)}/lotcast/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

"""Session helpers.

The library never creates its own cluster settings beyond what tests need: a
running session is reused as is.  ``checkpoint_dir`` reads the shared folder the
cluster names in ``spark.checkpoint.dir`` and only falls back to a fresh local
folder when the setting is absent (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quire") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder.

    Order: a folder already set on the context; the cluster's
    ``spark.checkpoint.dir``; in local mode only (tests, local runs), a fresh
    temporary folder.  On a cluster without the setting this raises instead of
    using a machine-local folder that executors on other hosts cannot read.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for reliable checkpoints")
    local = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the Python workers, once per application.

    Workers import ``quire`` by name (``mapInArrow``, ``mapInPandas``, data sources); they
    need it wherever the driver was started from and whatever is installed on their hosts.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="quire-src-"), "quire.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("quire", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)

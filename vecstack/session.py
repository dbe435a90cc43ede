"""Spark session helpers.

The library never creates a session behind the caller's back: every operator
takes the session (or a DataFrame) it is given.  ``get_spark`` exists for the
tests, the bench and the command line, and sets only what is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Conf keys the library reads from the session.
CHECKPOINT_DIR_KEY = "spark.checkpoint.dir"


def get_spark(master: str | None = None, app: str = "vecstack",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    The master is the caller's: tests and the bench pass theirs, everything else keeps what
    ``spark-submit`` or the Spark defaults configure.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if (master or "").startswith("local"):
        # sizes for one machine; on a cluster they come from spark-submit / the cluster defaults
        conf["spark.driver.memory"] = "16g"
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or 8)
    elif shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vecstack`` importable in every Python worker (``mapInPandas`` / ``applyInPandas``
    functions reference it): the package is zipped once and added with ``addPyFile``, which
    Spark distributes to the executors — no reliance on the workers' working directory."""
    import zipfile

    import vecstack
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(vecstack.__file__))
    fd, path = tempfile.mkstemp(prefix="vecstack-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of the session.

    On a cluster the folder is the shared one named by ``spark.checkpoint.dir``
    and is only read here.  Only a local-mode session without the setting (the
    tests) gets a fresh scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(CHECKPOINT_DIR_KEY, None) or sc.getConf().get(CHECKPOINT_DIR_KEY, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_DIR_KEY} is not set; set it to a shared folder of the cluster")
        configured = tempfile.mkdtemp(prefix="vecstack-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return configured


def cut_lineage(df):
    """Materialise ``df`` in the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

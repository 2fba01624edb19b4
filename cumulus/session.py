"""Session helpers: sane defaults for a cluster, and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job of the library assumes. AQE re-plans joins and coalesces
# shuffle partitions at run time; skew-join splitting handles hot keys that
# survive the map-side partial aggregation.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "cumulus",
    shuffle_partitions: int | None = None,
    conf: dict | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to the data: roughly input bytes / 128 MB for the
    widest shuffle, so a reducer's partition fits in executor memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, taken from ``spark.checkpoint.dir``.

    The cluster names that folder; it must be on shared storage so a lost
    executor does not lose checkpointed data. Only when the session has none
    (unit tests on one machine) is a private temporary folder created; on a
    cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cumulus-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def ship_package(spark: SparkSession) -> None:
    """Send the package to the Python workers, once a session (those of a local master do not see the driver's path either)."""
    sc = spark.sparkContext
    if getattr(sc, "_cumulus_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="cumulus-ship-"), "cumulus.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(root, "cumulus")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)
    sc._cumulus_shipped = True


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def materialize(df, name: str | None = None):
    """Cut lineage: write ``df`` as Parquet under the shared checkpoint folder and read it back.

    The table lives in the cluster's ``spark.checkpoint.dir`` (never a
    machine-local folder, never ``localCheckpoint``), so losing an executor
    later does not force recomputing the lineage, and a frame used by several
    branches of a plan is computed once. Parquet keeps the re-read columnar:
    later projections and filters prune and push down into it. Each call
    writes a fresh folder, so concurrent queries never share one.
    """
    path = scratch_path(df.sparkSession, f"{name or 'stage'}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)

"""Session helpers: building a local session for tests and benches, the shared
checkpoint folder, and reading the driver tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | str = 8, partitions: int | None = None, app: str = "palimpsest") -> SparkSession:
    """A local session configured like the tests and the bench (UI off, AQE on, UTC)."""
    if partitions is None:
        partitions = int(cpus) if str(cpus).isdigit() else 8
    parts = partitions
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # No broadcast from file-size estimates: compressed parquet sizes hide large text
        # columns. AQE still broadcasts a side whose measured shuffle size is under its
        # threshold, and explicit hints are kept for sides with a proven bound.
        .config("spark.sql.autoBroadcastJoinThreshold", "-1")
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", os.environ.get("PALIMPSEST_CLEAN_CHECKPOINTS", "true"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PALIMPSEST_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only
    when it is unset and the master is local (tests) is a scratch folder created and set;
    a cluster without the setting is an error, since executors would not see such a folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext; the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master or "").startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="palimpsest-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def _local_path(uri: str) -> str | None:
    """The local filesystem path of ``uri`` (plain path or ``file:`` URI), else None."""
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        return "/" + rest.lstrip("/") if rest.startswith("//") else rest
    return None if "://" in uri or ":" in uri.split("/", 1)[0] else uri


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared checkpoint location for written tables: every call has
    its own, on local and on shared storage (``hdfs://``, ``s3a://`` ...)."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    name = f"{name}-{uuid.uuid4().hex}"
    local = _local_path(base)
    if local is None:
        return f"{base.rstrip('/')}/tables/{name}"
    path = os.path.join(local, "tables", name)
    os.makedirs(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, so that they import it from any working
    folder; once per session. With the package installed on all nodes it does no harm."""
    sc = spark.sparkContext
    if getattr(sc, "_palimpsest_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    # executors fetch the file from the driver when their first task starts: it stays until the end
    folder = tempfile.mkdtemp(prefix="palimpsest-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "palimpsest.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for parent, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    path = os.path.join(parent, n)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._palimpsest_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")

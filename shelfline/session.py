"""Session construction and shared-folder helpers.

On a cluster the session is created by the platform; we only read the
settings it carries.  ``spark.checkpoint.dir`` names the shared folder used
for checkpoints and for tables written to cut lineage.  A folder of our own
is created only when that setting is unset (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes,
# splits skewed join partitions and coalesces small shuffle partitions;
# the broadcast threshold is the size check Spark applies before it
# broadcasts a side.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "shelfline") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", "16g")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shelfline-wh-")))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
    elif sc.master.startswith("local"):
        # Unset in a local run (tests, bench): a private folder is fine.
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="shelfline-ckpt-"))
    else:
        # On a cluster a machine-local folder is not visible to executors.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The folder that all sessions of the cluster share: the one that
    ``spark.checkpoint.dir`` names (each session has a checkpoint folder of its own
    inside); where it is unset, the private folder of a local run."""
    return (spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (the
    ``--py-files`` mechanism): zip it once per application and add it with
    ``addPyFile``.  Needed before any ``mapInPandas`` / ``applyInPandas*``
    whose functions live in this package."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="shelfline-pyfiles-"), "shelfline.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)

"""Session construction and shared-storage helpers.

Library code never creates its own session: every operator receives
DataFrames.  ``get_spark`` is only for tests, ``bench.py`` and scripts.
Iterative operators cut lineage with reliable ``checkpoint()`` into the
directory the cluster names in ``spark.checkpoint.dir``; only when that is
unset (local tests) do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str = "local[8]", shuffle_partitions: int = 8,
              app: str = "hotbeat", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions)))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a local one only if unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="hotbeat-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (for written tables)."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a table written below ``scratch_path`` once nothing reads it any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, which see only what is on their own path."""
    sc = spark.sparkContext
    if getattr(sc, "_hotbeat_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="hotbeat-package-")  # served to executors while the driver lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    name = os.path.join(folder, "hotbeat_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for top, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(top, f)
                    z.write(full, os.path.join("hotbeat", os.path.relpath(full, root)))
    sc.addPyFile(name)
    sc._hotbeat_shipped = True


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never localCheckpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int, known_rows: int | None = None):
    """Broadcast ``df`` only behind a row-count check.

    ``known_rows`` is passed when the caller can bound the size statically
    (for example groups x k centres).  Otherwise the count is measured; if it
    exceeds ``max_rows`` the plain DataFrame is returned and the planner is
    left to choose a shuffle join.
    """
    from pyspark.sql import functions as F
    n = known_rows if known_rows is not None else df.count()
    return (F.broadcast(df) if n <= max_rows else df), n


def spread_groups(df: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """Hash-partition by ``keys`` into an explicit number of partitions.

    Used before CPU-heavy grouped Python (route search, tree fits): their
    input is tiny, so adaptive execution would coalesce the shuffle into one
    task and run every group serially.  A user-specified partition count is
    kept by AQE, and the following ``groupBy(keys)`` reuses the partitioning
    (no second exchange).
    """
    n = partitions or max(1, df.sparkSession.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)

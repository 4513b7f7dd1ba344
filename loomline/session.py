"""Session defaults for local runs and tests.

On a cluster the submitting job decides; these settings only fill what is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Result-relevant settings first (zone and ANSI), then adaptive execution, which
# sizes shuffles and splits skewed joins from measured partition sizes.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Rows may be whole files or long texts: batches for Python are cut by bytes as well.
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    # Recording the Python call site of every column expression makes plans of
    # this size slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: str | int | None = None, app: str = "loomline", **extra: str) -> SparkSession:
    """Build (or reuse) a local session. Shuffle partitions follow the cores."""
    cores = str(cores or os.cpu_count() or 8)
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": cores if cores.isdigit() else "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and stage tables.

    The cluster names it in ``spark.checkpoint.dir``. Only when that is unset
    (local tests) a scratch folder is made and set; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
        folder = tempfile.mkdtemp(prefix="loomline-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder

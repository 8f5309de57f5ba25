"""Session helpers.

Operators never build sessions; pipelines receive one. ``local_session`` exists for tests
and the bench only. Checkpoints (used to cut the lineage of the iterative graph operators)
go to the folder the cluster names in ``spark.checkpoint.dir``; a private folder is created
only when that setting is unset *and* Spark runs in local mode.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stocklens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, fixed time zone)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session configuration.

    On a cluster the folder must be shared storage named by ``spark.checkpoint.dir``;
    a machine-local temporary folder is only acceptable in local mode.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at shared storage (HDFS/S3/ABFS) "
            "before running the iterative graph operators on a cluster"
        )
    folder = tempfile.mkdtemp(prefix="stocklens-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()

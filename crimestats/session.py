"""Spark session settings the reports are written for.

The library never builds its own session in production: it is handed one.
``recommended_conf`` lists the settings the plans rely on (AQE for runtime
coalescing, skew splitting and broadcast demotion; runtime bloom filters so the
large case-keyed tables are pruned before their shuffle).  ``local_session`` is
for tests, the bench and the driver smoke check.  ``staged_parquet`` writes a
relation that many branches of one report read, once, to the shared folder
named by ``spark.checkpoint.dir``; ``reliable_checkpoint`` does so by rows.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Size the shuffle for the cluster, not for a laptop: at 100 TB a partition
# count in the thousands keeps each reducer's input near 128-256 MB, and AQE
# coalesces the small stages (monthly totals, code tables) back down.
CLUSTER_SHUFFLE_PARTITIONS = 4000


def recommended_conf(shuffle_partitions: int = CLUSTER_SHUFFLE_PARTITIONS) -> dict[str, str]:
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # Reports compare text codes with binary collation and keep NULL
        # semantics of SQL; ANSI mode makes bad casts loud, the library uses
        # try_cast where the reference tolerates junk.
        "spark.sql.ansi.enabled": "true",
        # Checkpoint files of a report are removed once its DataFrames are gone.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the session's, else ``spark.checkpoint.dir``.

    Only a local-mode session (tests, bench) without one gets a fresh folder
    under the system temp dir; on a cluster the setting must name shared
    storage, so a missing one is an error rather than a machine-local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="crimestats-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder to run the reports on a cluster")
    return sc.getCheckpointDir()


def reliable_checkpoint(df):
    """Eagerly write ``df`` to the reliable checkpoint folder and return the
    DataFrame reading it back (lineage cut; survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def staged_parquet(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back:
    lineage cut, safe against lost executors, and, unlike a row checkpoint,
    its readers keep column pruning, filter pushdown and size statistics.  The
    table goes when the driver's JVM ends."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "crimestats") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in recommended_conf(shuffle_partitions).items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.driver.memory", os.environ.get("CRIMESTATS_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "64")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Session helpers.

Library operators never create or configure a session themselves; they take
DataFrames and return DataFrames. These helpers exist for tests, the bench and
the driver entry point, and for the few operators that must write state
(ledgers, checkpoints) to the shared folder the cluster names.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings that matter at scale as much as locally: AQE re-plans shuffles at
# run time (coalesces the many small shard partitions, splits skewed join
# partitions), and shard directories are never type-inferred (`00f` would
# become the double 0.0, `1e5` a decimal).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}
# (dynamic partition overwrite is set per write by the sinks, not globally)
# Only for sessions this package builds itself (tests, bench): never pushed
# onto a caller's session, since they change how results reach pandas.
LOCAL_ONLY_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "corpusprep") -> SparkSession:
    """A local session for tests and the bench (UI off, no extra ports)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in {**SCALE_CONF, **LOCAL_ONLY_CONF}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``; only a local master (one
    process, as in tests) gets a fresh scratch folder where it is unset.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the conf is visible
        sc = None
    current = (sc.getCheckpointDir() if sc is not None else None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    master = sc.master if sc is not None else ""
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that the driver "
                           "and all executors share")
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "checkpoints")
    sc.setCheckpointDir(path)
    return path


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    Installed packages need nothing of the kind; a checkout run from any other
    folder does. The sources are zipped and handed to Spark, which serves
    them to every executor; once per context.
    """
    sc = spark.sparkContext
    if getattr(sc, "_corpusprep_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="run-"), "corpusprep.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._corpusprep_shipped = True


def scale_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20,
                   max_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized from the data, for a cluster run (not applied here).

    Shuffle partitions: enough that one partition of the largest shuffle is
    about ``target_partition_bytes`` (so sorts and hash tables fit in an
    executor's share of memory instead of spilling), at least twice the
    cores, rounded up to a multiple of the cores. Scan splits: at most
    ``max_partition_bytes``. AQE then coalesces what turns out small and
    splits skewed join partitions above the same size.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    parts = -(-parts // total_cores) * total_cores
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(max_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        **SCALE_CONF,
    }

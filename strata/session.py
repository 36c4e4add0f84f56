"""Session and checkpoint-directory helpers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI arithmetic stays on, wall-clock times are
# read and written in UTC, AQE re-plans joins and coalesces shuffle partitions
# from runtime statistics, and skewed sort-merge partitions are split.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoint files go when the frame that reads them is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset and let the submit configuration decide.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(extra_conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it on the context.

    The folder comes from the session (``spark.checkpoint.dir`` or an earlier
    ``setCheckpointDir``).  Only a local-mode session without one gets a fresh
    temporary folder; a cluster session without one is an error, because a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="strata-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by all executors"
        )
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder for staged tables."""
    root = checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "strata", *parts])


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run: its source goes
    into a zip below the shared checkpoint folder, which Spark hands to them
    (``addPyFile``).  Once per application; ``--py-files`` does the same."""
    sc = spark.sparkContext
    if getattr(sc, "_strata_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in sorted(os.walk(root)):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join(os.path.basename(root), os.path.relpath(path, root)))
    target = scratch_path(spark, "code", f"strata-{uuid.uuid4().hex}.zip")
    path = sc._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
    try:
        out.write(bytearray(packed.getvalue()))
    finally:
        out.close()
    sc.addPyFile(target)
    sc._strata_shipped = True


def default_parallelism(spark: SparkSession) -> int:
    """Partition count for explicit repartitions: the shuffle setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))



def cluster_conf(input_bytes: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Suggested settings for a cluster job reading ``input_bytes``.

    Shuffle partitions start at about one per ``partition_bytes`` of input
    (AQE coalesces small ones and splits skewed ones at run time); scans read
    ``partition_bytes`` per task; broadcast stays at a size every executor
    can hold.  Pass the result as ``extra_conf`` to ``get_session`` or to
    spark-submit.
    """
    partitions = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 2),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    }

"""Session helpers.

Library code never creates its own session; it takes the caller's. ``local_session`` is for
tests, the bench and the examples only.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "feedledger") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in _DEFAULTS.items():
        builder = builder.config(key, value)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("FEEDLEDGER_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is. Only with a local
    master (tests) is a scratch folder created and set when it is unset; it goes with the process.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="feedledger-ckpt-", dir="/tmp")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    sc.setCheckpointDir(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``feedledger`` importable in Python workers (pandas UDF stages) on any cluster:
    zip the package once per application and add it with ``SparkContext.addPyFile``, which
    distributes it to every executor."""
    import os
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import feedledger

    pkg_dir = os.path.dirname(os.path.abspath(feedledger.__file__))
    root = os.path.dirname(pkg_dir)
    out_dir = tempfile.mkdtemp(prefix="feedledger-pkg-")
    zpath = os.path.join(out_dir, "feedledger.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, filenames in os.walk(pkg_dir):
            dirnames[:] = [d for d in dirnames if d != "__pycache__"]
            for fn in filenames:
                if fn.endswith(".py"):
                    full = os.path.join(dirpath, fn)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(app)


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a large cluster run, sized from the input volume.

    Shuffle partitions start at the larger of ~3 tasks per core and input / target size, so a
    shuffle partition stays around the target (256 MB) and fits executor memory without spilling;
    AQE then coalesces small partitions and splits skewed ones (a key with a third of the rows is
    split across tasks for joins), and file splits match the same target.
    """
    cores = max(1, executors * cores_per_executor)
    partitions = max(3 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # the conversion job's pandas stages: bounded Arrow batches of raw records
        "spark.sql.execution.arrow.maxRecordsPerBatch": "65536",
    }

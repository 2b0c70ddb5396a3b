"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A record that repeats a key keeps the last value, as a JSON loader does.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A hot key is split by measured size, also where a later aggregate has to be shuffled for it.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Array work costs far more per byte than row work: keep small shuffles parallel.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Payload rows are up to several MB each, so Arrow batches are bounded in bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


_SHIPPED: set[str] = set()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings every operator relies on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per context."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="voxledger-")) / "voxledger.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; it has a work folder of its own if none is set."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxledger")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not _work_folder(spark):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="voxledger-work-"))
    return configure(spark)


def _work_folder(spark: SparkSession) -> str | None:
    """The folder that all executors reach: ``spark.checkpoint.dir``, else the context's checkpoint folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    found = spark.sparkContext._jsc.sc().getCheckpointDir()
    return None if found.isEmpty() else found.get()


def shared_checkpoint(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's shared checkpoint folder, so its lineage ends there."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession, "checkpoints"))
    return df.checkpoint(eager=True)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new path below the folder that all executors reach; it is an error if the session names none."""
    root = _work_folder(spark)
    if root is None:
        raise RuntimeError("set spark.checkpoint.dir (or the context's checkpoint folder) to a folder all executors can reach")
    return f"{root}/{purpose}-{uuid.uuid4().hex}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_dir`` named, when what is in it is no longer needed."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)

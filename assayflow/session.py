"""Session settings and the shared checkpoint folder.

The library never builds a session on its own inside a job: every function
takes DataFrames or a session from the caller. ``local_session`` is for tests,
the bench and the command line on one machine.
"""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours gets. On a cluster these are the ones that
# matter at scale: AQE re-plans joins from runtime sizes (a join side becomes a
# broadcast only when Spark has measured it below the threshold), coalesces
# small shuffle partitions and splits skewed ones.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Static planning trusts file-size estimates, which undercount compressed
    # columns and derived strings: keep Spark's default there. At runtime AQE
    # broadcasts a side only after measuring it below the larger bound.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Remove checkpoint files once the DataFrames that wrote them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "assayflow",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A ``local[cores]`` session with the UI off and a checkpoint folder set."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # no SparkContext on this client (e.g. Spark Connect)
        current = None
    return current or spark.conf.get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a local session without one gets a folder in its warehouse."""
    current = checkpoint_dir(spark)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server applies spark.checkpoint.dir itself
        if current:
            return current
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"  # one machine: all folders are shared
    sc.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, name: str) -> str:
    """A path in the shared checkpoint folder that nobody has used yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it from there: later steps read only the columns they use."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a table bucketed and sorted by ``key``: what joins or groups by it later needs no shuffle.

    The files lie in the shared folder; the table is known to this session's catalog. One file for each bucket."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(n, key).write.bucketBy(n, key).sortBy(key)
    writer.option("path", shared_path(spark, name)).option("compression", "zstd").format("parquet").saveAsTable(table)
    return spark.table(table)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialize ``df`` in the shared checkpoint folder (reliable; survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows cross to the Python workers in batches of at most so many bytes (a longer row is one of its own).
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Have rows cross to the Python workers in batches of at most ``BATCH_BYTES``.

    Spark counts 10,000 rows or 64 MB, which a task holds several times over: off the heap on the way out and back, and in
    the worker. Sets the session's limit unless that is smaller already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def hand_back() -> None:
    """Return memory that the worker has freed to the system. Spark keeps idle workers for later tasks, beside those of other steps."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc
    if trim is not None:
        trim(0)

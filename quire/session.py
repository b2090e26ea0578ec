"""Session helpers: building a session, reading the input tables, checkpoint folder, size-checked broadcast."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Largest number of rows we allow on the broadcast side of a join whose size we check at run time.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 << 20


def get_spark(app: str = "quire", master: str | None = None, shuffle_partitions: int | None = None,
              driver_memory: str | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library assumes.

    On a cluster the master, memory and shuffle partitions come from spark-submit; here we only pin what changes
    results (UTC session time zone) or what keeps plans adaptive (AQE, skew-join handling).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # state of streams on disk instead of in the executors' heaps; needed by typed state
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory or (master or "").startswith("local"):
        # local mode: the driver JVM is the only executor, size it (takes effect when the JVM starts here)
        b = b.config("spark.driver.memory", driver_memory or "8g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Session setting: spread a table read by ``read_table`` round-robin over so many partitions (unset or 0: leave the scan alone).
#: Only for a handful of files of one row group each, as in the bench; real tables have more splits than cores.
SPREAD = "quire.read.spread"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given parquet tables; Catalyst prunes columns and pushes filters into this scan."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    spread = int(spark.conf.get(SPREAD, "0"))
    return df.repartition(spread) if spread else df


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        return d
    try:
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # noqa: BLE001  (no SparkContext handle in this session)
        return None


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be set by the job's configuration (a shared file system, never a machine-local folder).
    ``fallback`` is only used where the setting is absent, as in tests.
    """
    d = _configured_checkpoint_dir(spark)
    if d:
        return d
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set")
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and, in text form, ``max_bytes`` bytes (one aggregation over it)."""
    # written out as JSON a row counts with all elements of its arrays and maps
    n, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()
    return n <= max_rows and size <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                       max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only behind a measured size bound; above it the join stays a shuffle join.

    Use it for lookup tables whose size is data-derived (dictionaries, lexicons, code tables, IDF tables), never for the fact
    side.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; where none is configured, as in a local session, in a scratch folder."""
    local = spark.sparkContext.master.startswith("local") and not _configured_checkpoint_dir(spark)
    d = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="quire-ckpt-") if local else None)
    return f"{d.rstrip('/')}/quire-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Compute ``df`` once for several consumers and cut its lineage.

    The rows are written as parquet under ``spark.checkpoint.dir`` (a shared folder on a cluster; where it is unset, as in a
    local session, a scratch folder is taken) and read back: later stages re-read files instead of recomputing, and a
    lost executor costs a re-read. This runs a job immediately.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Session construction and the shared scratch / checkpoint folder.

On a cluster the checkpoint folder is whatever ``spark.checkpoint.dir`` names (a shared file
system path).  Only a local master without that setting gets a private temporary folder, which
is what tests use.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on.  Shuffle partition counts are left to the cluster; AQE coalesces
# small shuffles and splits skewed join partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, reading ``spark.checkpoint.dir`` from the session.

    A folder of our own is set only when the setting is missing and the master is local.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set
            configured = None
    if not configured:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = base[len("file:"):]
    return os.path.join(base, "tables", f"{name}-{uuid.uuid4().hex[:12]}")


def saved(df, name: str):
    """Write ``df`` under the shared checkpoint folder and read it back: cuts the lineage, and what
    several consumers read is computed once.  A small table read back is small to the planner too."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_shared_file(spark: SparkSession, path: str, data: bytes) -> None:
    """Write ``data`` to ``path`` with the Hadoop file system of its scheme (local, HDFS, object
    stores), creating parent folders."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def _hadoop(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def table_state(spark: SparkSession, path: str) -> tuple:
    """What tells a rewritten table from the one before: its bytes, files and time of change."""
    fs, p = _hadoop(spark, path)
    if not fs.exists(p):
        return ()
    size = fs.getContentSummary(p)
    return size.getLength(), size.getFileCount(), fs.getFileStatus(p).getModificationTime()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none if it does not exist), on any Hadoop file system."""
    fs, p = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p) if f.isDirectory()) if fs.exists(p) else []


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder; one that is not under the checkpoint folder is refused."""
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    if not path.removeprefix("file:").startswith(base.rstrip("/") + "/"):
        raise ValueError(f"{path} is no scratch folder")
    fs, p = _hadoop(spark, path)
    fs.delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (``addPyFile`` of a zip of the package,
    once per Spark application).  Needed by every job that runs Python on executors."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    import io
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, dirnames, filenames in os.walk(pkg_dir):
            dirnames[:] = [x for x in dirnames if x != "__pycache__"]
            for f in filenames:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    # the shared folder may be on a remote file system: write through Hadoop, not the local disk
    path = os.path.join(scratch_path(spark, "pyfiles"), "tidemark.zip")
    write_shared_file(spark, path, buf.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


# Bytes of input per range partition in the chunked scans and global ranks (one partition's rows
# of one key may be held in a Python worker at once).
CHUNK_BYTES_CONF = "tidemark.chunk.bytes"
DEFAULT_CHUNK_BYTES = 64 * 1024 * 1024  # on-disk (compressed) bytes; several times that in memory


def _scan_bytes(plan) -> int | None:
    """Bytes of the files the plan scans (the optimizer's leaf statistics), or None when a leaf
    has no size of its own.  A scanned table counts once per scan."""
    leaves = plan.collectLeaves()
    total = 0
    for i in range(leaves.size()):
        size = int(str(leaves.apply(i).stats().sizeInBytes()))
        if size >= 1 << 62:
            return None
        total += size
    return total


def range_partitions(df, num_partitions: int | None = None) -> int:
    """Partitions for a range cut of ``df``: explicit, else its bytes divided by the chunk size,
    and never fewer than ``spark.sql.shuffle.partitions``.

    The bytes are those of the files the plan scans where all its leaves have file sizes.  Join
    estimates multiply row counts and can exceed the input by orders of magnitude, so they are
    not used.  Rows that come from elsewhere (an RDD, a local list, a checkpoint) have no file
    sizes; they are counted, at the schema's default row size."""
    if num_partitions:
        return num_partitions
    floor_n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(floor_n, _partitions_of(df, input_bytes(df)))


def input_bytes(df) -> int:
    """Bytes of the files that ``df`` scans; of rows that come from elsewhere, their estimate."""
    size = _scan_bytes(df._jdf.queryExecution().optimizedPlan())
    return df.count() * df._jdf.schema().defaultSize() if size is None else size


def _partitions_of(df, size: int) -> int:
    target = max(1, int(df.sparkSession.conf.get(CHUNK_BYTES_CONF, str(DEFAULT_CHUNK_BYTES))))
    return -(-size // target)


SMALL_BYTES = 1024 * 1024


def ordered_partitions(df, num_partitions: int | None = None) -> int:
    """As ``range_partitions``, but small inputs get one partition per ``SMALL_BYTES`` only: for scans whose
    every cut costs more than the rows of a small partition do."""
    if num_partitions:
        return num_partitions
    size = input_bytes(df)
    floor_n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return max(1, min(floor_n, -(-size // SMALL_BYTES)), _partitions_of(df, size))

"""Session helpers: one place for the settings every job relies on.

The library never creates a session behind the caller's back except through
``get_session``; all operators take the session (or a DataFrame) they are
given.  Shared folders for intermediate tables come from
``spark.checkpoint.dir`` so that they live on the cluster's shared storage.
"""

from __future__ import annotations

import contextlib
import hashlib
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that change results or plans.  Time zone is pinned so epoch
# conversions match the SQL oracle; AQE re-plans joins at run time and
# splits skewed shuffle partitions.
_SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # remove reliable-checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "ratekit",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if not key.startswith("spark.sql."):
            continue
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as is; without it a job there fails at once, because executors do not
    see each other's local folders.  Only a ``local`` master (unit tests, a
    laptop) falls back to a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_single_machine(sc.master):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="ratekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _is_single_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in every Python worker.

    Workers unpickle functions by module name, so they need the package
    whatever folder the driver was started from.  The sources are zipped
    once per content and handed to Spark, which copies them to executors,
    also to those that join later.
    """
    root = Path(__file__).resolve().parent
    if not root.is_dir():  # already running from a shipped archive
        return
    files = sorted(p for p in root.rglob("*.py"))
    digest = hashlib.sha256()
    for p in files:
        digest.update(str(p.relative_to(root)).encode())
        digest.update(p.read_bytes())
    name = f"ratekit-{digest.hexdigest()[:12]}.zip"
    sc = spark.sparkContext
    if any(name in str(f) for f in sc._python_includes):
        return
    archive = Path(tempfile.mkdtemp(prefix="ratekit-ship-")) / name
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for p in files:
            z.write(p, f"ratekit/{p.relative_to(root)}")
    sc.addPyFile(str(archive))


@contextlib.contextmanager
def _settings(spark: SparkSession, settings: dict):
    """Settings of a session for the jobs run inside; those it had are put back."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int, size: int = 2**31 - 1):
    """Bound Arrow batches by rows and bytes for the jobs run inside, and put the session's bounds back.

    Without a bound of bytes Spark need not measure every row, which for
    narrow rows takes far longer than sending them.
    """
    with _settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": rows, "spark.sql.execution.arrow.maxBytesPerBatch": size}):
        yield


@contextlib.contextmanager
def shuffles_dropped(spark: SparkSession):
    """Delete a job's shuffle files when it ends, not when the driver's garbage collection finds them."""
    with _settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def own_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with the same settings, for a thread that changes some of them."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


def in_session(stored, spark: SparkSession):
    """A stored table (of `materialize`) as one of ``spark``."""
    return spark.read.schema(stored.schema).parquet(*stored.inputFiles())


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table under the shared folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "ratekit", f"{name}-{uuid.uuid4().hex[:12]}")


def default_parallelism(spark: SparkSession) -> int:
    """Number of buckets for range-partitioned helpers."""
    try:
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
    except Exception:  # pragma: no cover - conf always present
        shuffle = 200
    return max(1, shuffle)


def materialize(df, name: str, path: str | None = None, by: str | None = None, codec: str | None = None, **options):
    """Write ``df`` as Parquet under the shared folder (or to ``path``), in a folder a value of ``by``, and read it back.

    Cuts the lineage (a lost executor re-reads the files instead of
    recomputing the plan) and freezes results that are reused many times.
    """
    path = path or shared_path(df.sparkSession, name)
    df.write.options(**options).mode("overwrite").parquet(path, partitionBy=by, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # no job to find the schema


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def list_stored(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of the shared store; none if there is no such folder."""
    fs, folder = _folder(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []


def drop_stored(spark: SparkSession, path: str) -> None:
    """Delete an intermediate table that a later one has replaced."""
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)

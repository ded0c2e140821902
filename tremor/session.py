"""Session helpers: one place for the settings every job relies on.

The library never creates its own cluster settings on a real cluster; it only
fills in what is missing (a local test session has no checkpoint folder, for
example).  Calendar parts depend on the session time zone, so it is pinned to
UTC for every session this module builds.
"""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Wide event rows plus large geometry expressions make Catalyst's
    # constraint propagation grow without bound; the library never relies on
    # inferred constraints.
    "spark.sql.constraintPropagation.enabled": "false",
    # Remove key and batch checkpoints once nothing references them, so a
    # long-running refresh does not accumulate them in the shared folder.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Options of a write whose reader is told by a manifest, or by the job that
# wrote it, what to open: no marker file.  On a local file system Hadoop starts
# a process for every file and folder it makes (chmod), and each shares the
# whole memory of the driver until it runs its own program.
UNMARKED = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}


def build_session(master: str | None = None, app: str = "tremor",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session with the settings the library expects.

    ``master`` and ``shuffle_partitions`` are only meant for tests and the
    local benchmark; on a cluster the submitter decides both.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used
    as is; a cluster session without it is an error (a machine-local folder
    would not survive the loss of that machine).  Only a local-mode session
    without it (a test) gets a fresh local folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", str(sc.master)):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS, object "
                               "store) before running loads on a cluster")
        configured = tempfile.mkdtemp(prefix="tremor-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder.

    Written tables (published warehouse loads, stage outputs of the
    benchmark) live here so every executor can read them back.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "tremor", *parts, uuid.uuid4().hex])


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder on any Hadoop file system ([] if absent)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p)]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (metadata) on any Hadoop file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """Read a small text file written by ``write_text`` (None if absent)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that it appears whole or not at all (write, then rename)."""
    write_text(spark, path + ".tmp", text)
    jvm = spark.sparkContext._jvm
    part, final = (jvm.org.apache.hadoop.fs.Path(p) for p in (path + ".tmp", path))
    fs = final.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.rename(part, final):
        raise RuntimeError(f"could not publish {path}: does another load write there?")


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of ``scratch_path`` that no plan reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs hold: plans, broadcast blocks, shuffle files.

    Spark's cleaner frees them once the driver's garbage is collected, which
    may come late: a heap that fills with 4 MB broadcast chunks of finished
    stages grows instead.  Called a few times per load, never per row or task.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def byte_setting(spark: SparkSession, name: str, default: int) -> int:
    """A size setting such as ``256k`` or ``10MB`` in bytes (negative: 0)."""
    m = re.fullmatch(r"(-?\d+)\s*([bkmgt]?)i?b?", str(spark.conf.get(name, str(default))).strip().lower())
    return max(int(m[1]) * _UNITS[m[2]], 0) if m else default


def broadcast_budget(spark: SparkSession) -> int:
    """Bytes up to which a measured side may be broadcast."""
    return byte_setting(spark, "spark.sql.autoBroadcastJoinThreshold", 10 << 20)


def measured_bytes(df: DataFrame, fixed: int = 16) -> int:
    """Bytes of a DataFrame's values, strings by their length (one aggregate job)."""
    row = F.lit(fixed)
    for f in df.schema.fields:
        c = F.col(f.name)
        text = isinstance(f.dataType, (T.StringType, T.BinaryType))
        row = row + (F.coalesce(F.octet_length(c), F.lit(0)) if text else F.lit(8))
    return int(df.agg(F.sum(row.cast("long"))).first()[0] or 0)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only by tests that inspect files)."""
    return path[5:] if path.startswith("file:") else path


__all__ = ["build_session", "ensure_checkpoint_dir", "scratch_path", "list_names",
           "write_text", "read_text", "publish_text", "drop_folder", "release", "byte_setting", "broadcast_budget",
           "measured_bytes",
           "shuffle_partitions", "local_path", "DEFAULT_CONF", "UNMARKED"]

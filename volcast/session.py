"""Session construction and the shared scratch location.

The scratch location is the folder the cluster names in ``spark.checkpoint.dir``.
It is read from the running session; only a local session (tests, bench) may
fall back to a fresh folder of its own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "volcast", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench.  On a cluster, pass ``master=None`` and let
    spark-submit decide; the settings here are defaults, not overrides."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    ship_package(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """Folder under the cluster's checkpoint location.

    Uses ``spark.checkpoint.dir`` (or the context's checkpoint dir) when set.
    Only a local-mode session may create its own folder when neither is set.
    """
    sc = spark.sparkContext
    base = None
    try:
        base = spark.conf.get("spark.checkpoint.dir")
    except Exception:  # not set
        base = None
    if not base:
        base = sc.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is required on a cluster")
        base = tempfile.mkdtemp(prefix="volcast-ckpt-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    if parts:
        return os.path.join(base, *parts)
    return base


def new_name(label: str) -> str:
    """A folder name that no other run has."""
    return f"{label}-{uuid.uuid4().hex[:12]}"


def fresh_scratch(spark: SparkSession, label: str) -> str:
    """A new, unique folder under the scratch location (one per run, never reused)."""
    path = scratch_dir(spark, "volcast", new_name(label))
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def source_signature(spark: SparkSession, path: str) -> str:
    """Identity of an input (paths, sizes, modification times of its files) for memoising derived
    tables; listed by Spark, so it works on every file system, and digested to one number."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select("path", "length", "modificationTime"))
    n, digest = files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))).first()
    return f"{path}|{n}|{digest}"


_SCRATCH: dict[str, list[str]] = {}


def drop_scratch(spark: SparkSession) -> None:
    """Remove the folders that :func:`fresh_scratch` gave out in this application (end of a run)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path in _SCRATCH.pop(spark.sparkContext.applicationId, []):
        p = hadoop(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``volcast`` importable in Python workers (pandas UDFs, keyed state processors).

    Zips the package once per application and hands it to ``addPyFile`` — Spark's own
    file server copies it to every executor (a few hundred kilobytes)."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="volcast-pkg-"), "volcast.zip")     # the driver's copy; Spark ships it
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(path)
    # Driver-side Python runners (e.g. the keyed-state processor's init runner) do not
    # read addPyFile includes; they take PYTHONPATH from each function's environment.
    env = sc.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if path not in paths:
        env["PYTHONPATH"] = os.pathsep.join([path, *paths])
    _SHIPPED.add(app)


def cluster_settings(shuffled_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20,
                     max_partitions: int = 20_000) -> dict:
    """Spark settings for a cluster (pass to ``build_session(extra=...)``).

    ``shuffled_bytes`` is what the largest shuffle moves: bars and features are a small part of the
    ticks.  Partitions hold about ``target_partition_bytes``, three waves at least and
    ``max_partitions`` at most (map tasks x partitions blocks must stay countable); beyond that
    partitions grow and AQE splits the skewed ones."""
    parts = min(max(3 * total_cores, shuffled_bytes // target_partition_bytes + 1), max(max_partitions, total_cores))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }

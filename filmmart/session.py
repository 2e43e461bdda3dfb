"""Session defaults and the shared scratch / checkpoint location."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC wall clock, ANSI casts, adaptive
# execution (coalescing, skew-join splitting, runtime broadcast by measured size).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Top-n per group keeps n rows per task before the shuffle for any n a catalogue asks for.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
}

# Settings fixed when the context starts: no UI server, and checkpoint files (dense-key
# layouts) removed once nothing references them.
STARTUP_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, app: str = "filmmart",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**STARTUP_DEFAULTS, **SESSION_DEFAULTS}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Runtime-settable defaults for a session someone else built."""
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    share_code(spark)


def share_code(spark: SparkSession) -> None:
    """The folder that holds this package on the path of Python workers on this machine. On a cluster the package must be
    installed there, or sent along with ``--py-files``."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Only when it is unset (local runs, tests) a fresh local folder is chosen; on a
    cluster the setting must name shared storage.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf = tempfile.mkdtemp(prefix="filmmart-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location (never machine-local on a cluster)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/filmmart-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop FileSystem of the path (works for any scheme)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def child_dirs(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names of the sub-folders of ``path`` starting with ``prefix`` (a listing, not data)."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hpath)
            if st.isDirectory() and st.getPath().getName().startswith(prefix)]


def make_dir(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.mkdirs(hpath)


def remove_dir(spark: SparkSession, path: str) -> None:
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


__all__ = ["child_dirs", "make_dir", "share_code", "remove_dir", "get_spark", "apply_defaults", "checkpoint_dir", "scratch_path", "path_exists", "local_path",
           "SESSION_DEFAULTS", "STARTUP_DEFAULTS"]

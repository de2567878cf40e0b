"""Where intermediate tables go.

Staged tables and scratch output live under the shared folder the cluster
names in ``spark.checkpoint.dir`` (read from the session), never under a
machine-local temp folder. Only when the session has none and runs in one
process (a local test) is a private temporary folder set as the checkpoint
directory; on a cluster a missing setting is an error.
"""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    root = None
    try:
        root = spark.sparkContext.getCheckpointDir()
    except Exception:  # e.g. a Connect session has no SparkContext
        root = None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="sluice-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(root)
        except Exception:
            spark.conf.set("spark.checkpoint.dir", root)
    return root


def shared_dir(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh directory path under the shared checkpoint root."""
    tail = list(parts) + ([uuid.uuid4().hex] if unique else [])
    return posixpath.join(checkpoint_root(spark), "sluice", *tail)


_SCRATCH: ContextVar[str | None] = ContextVar("sluice_scratch", default=None)


@contextmanager
def scratch(spark: SparkSession, keep: bool = False):
    """Tables staged inside go to one folder, which is removed at the end."""
    path = shared_dir(spark, "scratch")
    token = _SCRATCH.set(path)
    try:
        yield path
    finally:
        _SCRATCH.reset(token)
        if not keep:
            remove_path(spark, path)


def staging_path(spark: SparkSession, *name: str) -> str:
    base = _SCRATCH.get()
    return posixpath.join(base, *name, uuid.uuid4().hex) if base else shared_dir(spark, "stage", *name)


def staged(df: DataFrame, *name: str) -> DataFrame:
    """Write to a fresh shared folder as parquet and read back: later plans
    know the size, and a lost executor costs a re-read."""
    spark = df.sparkSession
    path = staging_path(spark, *name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)  # an empty frame leaves nothing to infer from


_SHIPPED: set[str] = set()
_ZIP: list[str] = []


def _package_zip() -> str:
    """Zip this package once per process (named by a hash of its sources)."""
    if _ZIP:
        return _ZIP[0]
    import hashlib
    import os
    import zipfile
    from pathlib import Path

    root = Path(__file__).resolve().parent
    files = sorted(p for p in root.rglob("*.py") if "__pycache__" not in p.parts)
    digest = hashlib.sha1()
    for p in files:
        digest.update(str(p.relative_to(root)).encode())
        digest.update(p.read_bytes())
    zpath = os.path.join(tempfile.gettempdir(), f"sluice-{digest.hexdigest()[:16]}.zip")
    if not os.path.exists(zpath):
        tmp = f"{zpath}.{uuid.uuid4().hex}"
        with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as zf:
            for p in files:
                zf.write(p, posixpath.join(root.name, *p.relative_to(root).parts))
        os.replace(tmp, zpath)
    _ZIP.append(zpath)
    return zpath


def ship_package(spark: SparkSession | None = None) -> str | None:
    """Make this package importable in the executors' Python workers.

    The same as ``spark-submit --py-files``: the package source is zipped on
    the driver and registered with ``addPyFile``, which Spark copies to every
    executor. Only plans that run Python on the executors need it (the MD4
    pandas UDF, the resolver in ``mapInPandas``, ``foreachBatch``).
    Idempotent per application; returns the zip path (None without a
    SparkContext, e.g. under Spark Connect, where the client adds artifacts).
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        return None
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:
        return None
    zpath = _package_zip()
    if app not in _SHIPPED:
        sc.addPyFile(zpath)
        _SHIPPED.add(app)
    return zpath


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this package wrote (e.g. a staged table) on whatever
    filesystem its URI names, through Hadoop's FileSystem API. Returns False
    when it cannot (no JVM gateway, e.g. Spark Connect) and leaves the folder
    to the checkpoint folder's retention."""
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        return bool(fs.delete(hpath, True))
    except Exception:
        return False

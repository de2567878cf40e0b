"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import os
import posixpath
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from ..session import ship_package, shared_dir


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost
    executors, and gives later plans a known size."""
    spark = df.sparkSession
    path = shared_dir(spark, "llm", name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, "llm", name)


def prepare(df: DataFrame) -> SparkSession:
    """Called by operators that run Python on executors."""
    ship_package(df.sparkSession)
    return df.sparkSession


def free_name(columns: list[str], name: str = "_pad") -> str:
    """`name`, with as many underscores as make it none of the columns (in any case)."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def _local(uri: str) -> str | None:
    parts = urlparse(uri)
    return unquote(parts.path) if parts.scheme in ("", "file") else None


def write_file(uri: str, write, name: str | None = None) -> str:
    """Run `write(stream)` on a new file under `uri` (a folder) and return the
    file's uri. Each attempt of a task gets a name of its own; only names
    returned by attempts that Spark commits are ever read. With a `name` the
    file appears whole under it and the name is returned; attempts that write
    the same rows may replace each other's file."""
    own = f"{uuid.uuid4().hex}.bin"
    path = _local(uri)
    if path is not None:
        os.makedirs(path, exist_ok=True)
        with open(os.path.join(path, own), "wb") as out:
            write(out)
        if name:
            os.replace(os.path.join(path, own), os.path.join(path, name))
            return name
    else:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(posixpath.join(root, own)) as out:
            write(out)
        if name:
            store.move(posixpath.join(root, own), posixpath.join(root, name))
            return name
    return posixpath.join(uri, own)


def map_file(uri: str) -> np.ndarray:
    """The file's bytes, memory-mapped. A file of a store without paths is
    copied to the worker's temp folder and unlinked at once, so its space goes
    with the mapping."""
    path = _local(uri)
    if path is not None:
        return np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.zeros(0, np.uint8)
    import tempfile

    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(uri)
    with tempfile.NamedTemporaryFile() as copy, store.open_input_stream(root) as src:
        while block := src.read(8 << 20):
            copy.write(block)
        copy.flush()
        return np.memmap(copy.name, dtype=np.uint8, mode="r") if os.path.getsize(copy.name) else np.zeros(0, np.uint8)

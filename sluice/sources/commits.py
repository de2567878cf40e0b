"""Several tables published at one point (K1, K2, L1).

A publication writes each table to a folder of its own attempt,
``<base>/<table>/batch_date=<id>/attempt=<uuid>``, and then appends one small
file to ``<base>/_commits`` that names the folders. Readers read the commits
first and then the folders they name, so a batch is seen whole or not at all: a
crash before the commit leaves folders that no reader looks at, and a rerun of
a batch replaces it at its own commit, while readers of the earlier one go on
reading its files. ``drop_uncommitted`` removes folders that no current commit
names.

A commit's record may carry the source files it covers, so that a stream whose
checkpoint is lost does not publish them again.
"""

from __future__ import annotations

import time
import uuid
from typing import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import remove_path
from .readers import read_table
from .sinks import BATCH_COLUMN, batch_path, new_batch_id, write_options

COMMITS = "_commits"
ATTEMPT = "attempt"
_SCHEMA = "batch string, attempt string, at long, format string, tables array<string>, sources array<string>"


def write_attempt(
    frames: Mapping[str, DataFrame],
    base: str,
    batch_id: str,
    fmt: str = "csv",
    *,
    options: Mapping[str, str] | None = None,
    observations: Mapping[str, Observation] | None = None,
    attempt: str | None = None,
) -> str:
    """Write the tables of a batch (``{"TRANSACTIONS": .., "invalid/claim": ..}``)
    beside what is published; returns the attempt's name, to be committed."""
    attempt = attempt or uuid.uuid4().hex
    for name, df in frames.items():
        out = df.drop(BATCH_COLUMN, ATTEMPT)
        if (obs := (observations or {}).get(name)) is not None:
            out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
        path = f"{batch_path(base, name, batch_id)}/{ATTEMPT}={attempt}"
        out.write.format(fmt.lower()).mode("overwrite").options(**write_options(fmt, options)).save(path)
    return attempt


def commit(
    spark: SparkSession, base: str, batch_id: str, attempt: str, tables: Sequence[str], fmt: str = "csv", sources: Sequence[str] = ()
) -> None:
    """The one step that publishes an attempt: a single file appears."""
    row = (batch_id, attempt, time.time_ns(), fmt, list(tables), list(sources))
    spark.createDataFrame([row], _SCHEMA).coalesce(1).write.mode("append").json(f"{base}/{COMMITS}")


def publish(
    frames: Mapping[str, DataFrame], base: str, batch_id: str | None = None, fmt: str = "csv", *, sources: Sequence[str] = (), **more
) -> str:
    """``write_attempt`` and ``commit``; returns the batch id."""
    batch_id = batch_id or new_batch_id()
    spark = next(iter(frames.values())).sparkSession
    commit(spark, base, batch_id, write_attempt(frames, base, batch_id, fmt, **more), list(frames), fmt, sources)
    return batch_id


def commits(spark: SparkSession, base: str) -> DataFrame:
    """The current commit of each batch: batch, attempt, at, format, tables, sources."""
    try:
        every = spark.read.schema(_SCHEMA).json(f"{base}/{COMMITS}")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        every = spark.createDataFrame([], _SCHEMA)
    last = F.max_by(F.struct("attempt", "at", "format", "tables", "sources"), F.struct("at", "attempt"))
    return every.groupBy("batch").agg(last.alias("c")).select("batch", "c.*")


def read_committed(
    spark: SparkSession,
    base: str,
    name: str,
    *,
    batch_id: str | None = None,
    options: Mapping[str, str] | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """A published table's rows and their ``batch_date``.

    ``schema`` (without ``batch_date``) serves a table without files."""
    found = commits(spark, base).where(F.array_contains("tables", name))
    if batch_id is not None:
        found = found.where(F.col("batch") == batch_id)
    by_format: dict[str, list[str]] = {}
    for r in found.orderBy("batch").collect():  # one row per batch
        by_format.setdefault(r["format"], []).append(f"{batch_path(base, name, r['batch'])}/{ATTEMPT}={r['attempt']}")
    parts = []
    for fmt, paths in by_format.items():
        opts = {"basePath": f"{base}/{name}"}
        if fmt == "csv":
            # published values come back as written: line breaks and padding included
            opts |= {"header": "true", "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        known = None if schema is None else StructType(schema.fields).add(BATCH_COLUMN, "string").add(ATTEMPT, "string")
        try:
            parts.append(read_table(spark, paths, fmt, options=opts | dict(options or {}), schema=known).drop(ATTEMPT))
        except AnalysisException as e:
            if schema is not None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    if not parts:
        if schema is None:
            raise FileNotFoundError(f"no published rows of {name} under {base}")
        return spark.createDataFrame([], StructType(schema.fields).add(BATCH_COLUMN, "string"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def committed_sources(spark: SparkSession, base: str) -> DataFrame:
    """``path`` of every source file that a current commit covers."""
    return commits(spark, base).select(F.explode("sources").alias("path")).distinct()


def drop_uncommitted(spark: SparkSession, base: str, name: str, batch_id: str) -> int:
    """Remove a batch's attempts of one table that its current commit does not
    name (left by crashes, or replaced); call it when no reader uses them."""
    current = {r["attempt"] for r in commits(spark, base).where(F.col("batch") == batch_id).select("attempt").collect()}
    folder = batch_path(base, name, batch_id)
    try:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0
    attempts = listed.select(F.regexp_extract("path", f"{ATTEMPT}=([0-9a-zA-Z_-]+)", 1).alias("a")).distinct()
    stale = [r["a"] for r in attempts.collect() if r["a"] and r["a"] not in current]
    for attempt in stale:
        remove_path(spark, f"{folder}/{ATTEMPT}={attempt}")
    return len(stale)

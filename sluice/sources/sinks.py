"""Sinks (K1-K6): batch-partitioned publication and quarantine.

A batch is a Hive-style folder ``<base>/<name>/batch_date=<id>``. A rerun of the
same batch id replaces that folder only, also by an empty frame, and sibling
batches are kept. Spark's commit protocol makes the write all-or-nothing
per task, and a lost executor's tasks are simply re-run. An empty frame (a
quarantine without rows) writes an empty batch, without a check before.

Readers of these folders may meet a batch that is being replaced, or a
quarantine whose result is still missing; ``sluice.sources.commits`` publishes
several tables at one point instead.

Published text may hold line breaks, so it is read in multi-line mode, where a
file is one task. Text files are therefore bounded when written, by
``TEXT_RECORDS_PER_FILE`` records each. ``COMPRESSED_TEXT`` writes them
compressed, which costs no parallel reading of files that are one task anyway;
Spark's readers take them as they are.
"""

from __future__ import annotations

import datetime as _dt
import posixpath
from typing import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .readers import read_table

WRITE_FORMATS = ("csv", "json", "parquet", "orc")

# Batch partition column, batch id format, quarantine folder,
# and the per-format write options of the published files.
BATCH_COLUMN = "batch_date"
BATCH_ID_FORMAT = "%Y%m%d_%H%M%S"
QUARANTINE_DIR = "invalid"
TEXT_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
TEXT_DATE_FORMAT = "yyyy-MM-dd"
TEXT_RECORDS_PER_FILE = 500_000
FORMAT_WRITE_OPTIONS: dict[str, dict[str, str]] = {
    "csv": {
        "header": "true",
        "nullValue": "",
        "quote": '"',
        "escape": '"',
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "timestampFormat": TEXT_TIMESTAMP_FORMAT,
        "dateFormat": TEXT_DATE_FORMAT,
        "maxRecordsPerFile": str(TEXT_RECORDS_PER_FILE),
    },
    "json": {
        "ignoreNullFields": "false",
        "timestampFormat": TEXT_TIMESTAMP_FORMAT,
        "dateFormat": TEXT_DATE_FORMAT,
    },
    "parquet": {},
    "orc": {},
}
# Text published compressed: such a file is one task, so its records are bounded.
# The fastest level costs a third of the default's time for a little more volume.
COMPRESSED_TEXT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(TEXT_RECORDS_PER_FILE)}


def new_batch_id(now: _dt.datetime | None = None) -> str:
    """``YYYYMMDD_HHMMSS`` from the driver clock (pass a fixed id for reruns)."""
    return (now or _dt.datetime.now()).strftime(BATCH_ID_FORMAT)


def write_options(fmt: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    f = fmt.lower()
    if f not in WRITE_FORMATS:
        raise ValueError(f"unsupported output format {fmt!r}; supported: {WRITE_FORMATS}")
    opts = dict(FORMAT_WRITE_OPTIONS[f])
    if extra:
        opts.update({k: str(v) for k, v in extra.items()})
    return opts


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    mode: str = "overwrite",
    options: Mapping[str, str] | None = None,
    partition_by: list[str] | None = None,
) -> None:
    """Plain format dispatch (K3, K4): one write job."""
    writer = df.write.format(fmt.lower()).mode(mode).options(**write_options(fmt, options))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """``df`` as a parquet table in ``buckets`` files' worth of key hashes,
    sorted by key, with rows of null keys left out: a join on these keys needs no
    exchange of it. ``buckets`` should be no fewer than the session's shuffle
    partitions, or Spark may shuffle both sides to gain tasks."""
    spark = df.sparkSession
    known = df.where(" and ".join(f"`{k}` is not null" for k in keys)).repartition(buckets, *keys)
    known.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


def batch_path(base: str, name: str, batch_id: str) -> str:
    return posixpath.join(base, name, f"{BATCH_COLUMN}={batch_id}")


def write_batch(
    df: DataFrame,
    base: str,
    name: str,
    batch_id: str | None = None,
    fmt: str = "csv",
    *,
    options: Mapping[str, str] | None = None,
    observation: Observation | None = None,
) -> str:
    """Publish ``df`` as batch ``batch_id`` of table ``<base>/<name>`` (K1).

    Returns the batch id. Only that batch's folder is replaced, also by an
    empty frame: a rerun never leaves rows of an earlier run behind.
    ``observation`` (if given) collects its metrics during this same write.
    """
    batch_id = batch_id or new_batch_id()
    out = df.drop(BATCH_COLUMN)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    (
        out.write.format(fmt.lower())
        .mode("overwrite")
        .options(**write_options(fmt, options))
        .save(batch_path(base, name, batch_id))
    )
    return batch_id


def write_quarantine(
    invalid: Mapping[str, DataFrame],
    base: str,
    batch_id: str | None = None,
    fmt: str = "csv",
    *,
    options: Mapping[str, str] | None = None,
    observations: Mapping[str, Observation] | None = None,
) -> str:
    """Write each invalid frame to ``<base>/invalid/<name>/batch_date=<id>`` (K2).

    Earlier batches are kept; an empty frame writes an empty batch.
    """
    batch_id = batch_id or new_batch_id()
    for name, df in invalid.items():
        obs = (observations or {}).get(name)
        write_batch(
            df, posixpath.join(base, QUARANTINE_DIR), name, batch_id, fmt, options=options, observation=obs
        )
    return batch_id


def read_batches(
    spark: SparkSession,
    base: str,
    name: str,
    fmt: str = "csv",
    *,
    batch_id: str | None = None,
    options: Mapping[str, str] | None = None,
    schema=None,
) -> DataFrame:
    """Read a published table back (K6); ``batch_date`` is discovered from the
    directory names as text. Filtering on it prunes partitions at the scan.

    A table without rows in any batch reads as an empty frame when ``schema``
    is given.
    """
    opts = {"basePath": posixpath.join(base, name)}
    f = fmt.lower()
    if f == "csv":
        # published values come back as written: line breaks and padding included
        opts.update(
            {"header": "true", "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        )
    if options:
        opts.update(options)
    try:
        df = read_table(spark, posixpath.join(base, name), f, options=opts, schema=schema)
    except AnalysisException as e:
        if schema is None or "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    if batch_id is not None:
        df = df.where(F.col(BATCH_COLUMN) == F.lit(batch_id))
    return df

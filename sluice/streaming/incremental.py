"""The rule-driven job, run incrementally over files as they arrive.

A Structured Streaming file source picks up new raw files; every
micro-batch goes through the same operators as the batch job (header
conformance, verdicts, quarantine, transform) inside ``foreachBatch`` and is
published as its own batch. ``max_files_per_trigger`` bounds what one epoch
holds.

``start_incremental_job`` has all files under one header. Its batches are
``batch_date=<prefix><epoch>``: a replayed epoch replaces its own folders, so a
crash between the two writes cannot duplicate a batch. The micro-batch is
persisted for the duration of the epoch only, so the quarantine and the result
share one read of the new files. Epochs count from the checkpoint: without it
they start at 0 again.

``start_file_job`` streams the files' names and reads them by name, so headers
may differ. Quarantine and result of an epoch appear at one commit, whose record
names the files; its batch id is a digest of the names. An epoch leaves out
files that a commit covers already, so neither a replayed epoch nor a lost
checkpoint publishes a file twice.
"""

from __future__ import annotations

import hashlib
import posixpath
from typing import Callable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.validate import annotate, split_annotated
from ..rules import TableRules
from ..session import ship_package
from ..sources.commits import committed_sources, publish
from ..sources.readers import csv_options, read_by_name
from ..sources.sinks import QUARANTINE_DIR, write_batch


def text_schema(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> StructType:
    """All-string schema named by the header of the files already under ``path``
    (reads the header line only)."""
    opts = csv_options()
    if options:
        opts.update(options)
    names = spark.read.options(**opts).csv(path).columns
    return StructType([StructField(n, StringType(), True) for n in names])


def start_incremental_job(
    spark: SparkSession,
    source_dir: str,
    rules: TableRules,
    transform: Callable[[DataFrame], DataFrame],
    *,
    output_base: str,
    output_name: str,
    checkpoint: str,
    schema: StructType | None = None,
    fmt: str = "csv",
    batch_prefix: str = "e",
    on_unknown: str = "quarantine",
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    write_options: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Start the stream; returns the running query.

    ``transform`` maps the valid, cast rows of one micro-batch to the rows to
    publish (it may join static tables). ``available_now`` processes what is
    there and stops; otherwise ``processing_time`` sets the trigger.
    ``write_options`` go to the writer of both tables.
    """
    ship_package(spark)  # foreachBatch and any UDF in the transform import this package
    schema = schema or text_schema(spark, source_dir)
    reader = spark.readStream.schema(schema).options(**csv_options())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    raw = reader.csv(source_dir)

    def publish(batch: DataFrame, epoch_id: int) -> None:
        batch_id = f"{batch_prefix}{epoch_id:08d}"
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            split = split_annotated(annotate(batch, rules, on_unknown=on_unknown), rules)
            write_batch(split.invalid, posixpath.join(output_base, QUARANTINE_DIR), rules.name, batch_id, fmt, options=write_options)
            write_batch(transform(split.valid), output_base, output_name, batch_id, fmt, options=write_options)
        finally:
            batch.unpersist()

    writer = raw.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_file_job(
    spark: SparkSession,
    source_dir: str,
    rules: TableRules,
    transform: Callable[[DataFrame], DataFrame],
    *,
    output_base: str,
    output_name: str,
    checkpoint: str,
    fmt: str = "csv",
    on_unknown: str = "quarantine",
    evidence: bool = False,
    reject_malformed: bool = False,
    max_files_per_trigger: int | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Start the stream of files; returns the running query. Its tables are
    read with ``read_committed``; an epoch without new files commits nothing."""
    ship_package(spark)
    reader = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    names = reader.load(source_dir).select("path")

    def run(batch: DataFrame, _epoch: int) -> None:
        paths = sorted(r["path"] for r in batch.collect())  # bounded by max_files_per_trigger
        files = spark.createDataFrame([(p,) for p in paths], "path string")
        paths = sorted(r["path"] for r in files.join(committed_sources(spark, output_base), "path", "left_anti").collect())
        if not paths:
            return
        raw = read_by_name(spark, spark.createDataFrame([(p,) for p in paths], "path string"), rules, evidence=evidence)
        raw = raw.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            split = split_annotated(annotate(raw, rules, on_unknown=on_unknown, reject_malformed=reject_malformed), rules)
            frames = {f"{QUARANTINE_DIR}/{rules.name}": split.invalid, output_name: transform(split.valid)}
            batch_id = hashlib.sha256("\n".join(paths).encode()).hexdigest()[:16]
            publish(frames, output_base, f"f{batch_id}", fmt, sources=paths)
        finally:
            raw.unpersist()

    writer = names.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

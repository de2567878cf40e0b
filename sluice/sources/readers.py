"""Sources (S1-S6): read a table by format with the dialect options applied.

CSV is read with every column as text and names taken from the header: a
user schema would bind by position and hide a reordered file. Each file's
header is checked (``enforceSchema=false``), so a file whose columns are in
another order is an error instead of wrong columns; ``read_by_name`` reads
such files together, one scan per header. With ``evidence`` a malformed line
(too few or too many fields, an open quote) keeps its text in ``raw_record``,
which the quarantine carries. Column
selection and filters on the result reach the scan through Catalyst, so a
parquet or ORC source only reads what the job uses.
"""

from __future__ import annotations

import re
from functools import reduce
from typing import Iterator, Mapping

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.header import conform_header
from ..rules import TableRules
from ..session import ship_package

# CSV dialect of the input files.
CSV_READ_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "enforceSchema": "false",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
}

RAW_RECORD = "raw_record"
READ_FORMATS = ("csv", "json", "parquet", "orc")

# Keys of an application config's "csv_options" block and the
# Spark reader option each one sets.
CONFIG_CSV_KEYS = {
    "delimiter": "sep",
    "quote_char": "quote",
    "escape_char": "escape",
    "header": "header",
    "mode": "mode",
    "multiline": "multiLine",
}


def csv_options_from_config(config: Mapping[str, object]) -> dict[str, str]:
    """Reader options from a config's ``csv_options`` block (unknown keys ignored)."""
    block = config.get("csv_options", {}) or {}
    return {CONFIG_CSV_KEYS[k]: str(v).lower() if isinstance(v, bool) else str(v)
            for k, v in dict(block).items() if k in CONFIG_CSV_KEYS}


def csv_options(multiline: bool = False, **overrides: str) -> dict[str, str]:
    """The CSV read options. ``multiline`` is opt-in: it makes every file a
    single unsplittable task, so only turn it on for quoted line breaks."""
    opts = dict(CSV_READ_OPTIONS)
    opts["multiLine"] = "true" if multiline else "false"
    opts.update({k: str(v) for k, v in overrides.items()})
    return opts


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    *,
    options: Mapping[str, str] | None = None,
    schema: StructType | str | None = None,
    multiline: bool = False,
    evidence: bool = False,
) -> DataFrame:
    """Read ``path`` as ``fmt`` (csv, json, parquet, orc).

    A missing path raises FileNotFoundError; an unknown format ValueError.
    ``evidence`` (csv) adds ``raw_record``: the line's text where it is
    malformed, else null. Other values are as without it.
    """
    f = fmt.lower()
    if f not in READ_FORMATS:
        raise ValueError(f"unsupported input format {fmt!r}; supported: {READ_FORMATS}")
    opts: dict[str, str] = csv_options(multiline) if f == "csv" else {}
    if options:
        opts.update({k: str(v) for k, v in options.items()})
    reader = spark.read.format(f).options(**opts)
    if schema is not None:
        reader = reader.schema(schema)
    try:
        if evidence and f == "csv":
            known = reader.load(path).schema if schema is None else spark.createDataFrame([], schema).schema
            if RAW_RECORD in known.names:
                raise ValueError(f"the input has a column {RAW_RECORD!r} of its own")
            reader = reader.schema(known.add(RAW_RECORD, StringType())).options(
                # with fewer columns parsed, a line's missing fields would go unnoticed
                columnNameOfCorruptRecord=RAW_RECORD, columnPruning="false"
            )
        return reader.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        raise


def read_sources(
    spark: SparkSession,
    sources: Mapping[str, str],
    fmt: str = "csv",
    **kwargs,
) -> dict[str, DataFrame]:
    """Read several named inputs; every path is resolved before any data is read."""
    return {name: read_table(spark, path, fmt, **kwargs) for name, path in sources.items()}


def list_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``path`` of every file under the path(s), listed by Spark; no content is read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    try:
        return spark.read.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").load(path).select("path")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        raise


_HEADER_BYTES = 1 << 16


def _open(path: str):
    from pyarrow import fs

    if local := re.fullmatch(r"(?:file:(?://)?)?(/.*)", path):
        return fs.LocalFileSystem().open_input_file(local[1])
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        lines = []
        for path in pdf["path"]:
            with _open(path) as f:
                raw = b""
                while b"\n" not in raw and (block := f.read(_HEADER_BYTES)):
                    raw += block
            lines.append(raw.partition(b"\n")[0].decode("utf-8-sig", "replace").rstrip("\r"))
        yield pd.DataFrame({"path": pdf["path"], "header": lines})


def files_by_header(files: DataFrame) -> list[tuple[str, list[str]]]:
    """(header line, its files) of the non-empty files. Tasks read the first
    line of each file; the driver gets the paths, as for any read of them."""
    ship_package(files.sparkSession)
    headers = files.mapInPandas(_first_lines, "path string, header string").where("header <> ''")
    found = headers.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths"))
    return sorted((r["header"], r["paths"]) for r in found.collect())


def read_by_name(
    spark: SparkSession,
    path: str | list[str] | DataFrame,
    rules: TableRules,
    *,
    options: Mapping[str, str] | None = None,
    multiline: bool = False,
    evidence: bool = False,
) -> DataFrame:
    """CSV files with differing headers as one frame of the rule columns.

    Files are grouped by their header line; each group is one scan, conformed
    by name (order, aliases and further columns may differ) and united. A
    header that lacks a rule column is an error that names its files.
    """
    files = path if isinstance(path, DataFrame) else list_files(spark, path)
    parts = []
    for header, paths in files_by_header(files):
        df = read_table(spark, paths, "csv", options=options, multiline=multiline, evidence=evidence)
        try:
            parts.append(conform_header(df, rules, (RAW_RECORD,)))
        except ValueError as e:
            raise type(e)(f"{e} (header {header!r} of {len(paths)} files, first {paths[0]})") from e
    if not parts:
        names = [*rules.names, *([RAW_RECORD] if evidence else [])]
        return spark.createDataFrame([], StructType([StructField(n, StringType()) for n in names]))
    return reduce(DataFrame.unionByName, parts)

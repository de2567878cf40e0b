"""sluice: rule-driven validate, conform, enrich and publish on Spark DataFrames."""

from .functions.columns import (
    default_if_blank,
    load_timestamp,
    map_prefix,
    map_values,
    parse_date,
    parse_timestamp,
    strip_cast,
    to_type,
)
from .functions.digest import digest, surrogate_id
from .operators.enrich import (
    BreakerOpen,
    Calls,
    HttpJsonResolver,
    KeyStore,
    Retry,
    TransientError,
    distinct_keys,
    enrich_by_key,
    resolve_keys,
)
from .operators.header import HeaderError, check_header, conform_header
from .operators.joins import SkewSalt, left_join_on_keys, lookup_join
from .operators.keys import ForeignKey, KeySet, duplicate_keys, foreign_key, orphan_keys, reject_duplicates, reject_orphans
from .operators.validate import (
    Validated,
    annotate,
    cast_declared,
    column_verdict,
    failed_message,
    quality_report,
    split_annotated,
    validate,
)
from .plans.job import JobResult, run_job
from .rules import ColumnRule, TableRules
from .session import ship_package, shared_dir
from .sources.commits import commits, drop_uncommitted, publish, read_committed
from .sources.readers import csv_options_from_config, read_by_name, read_sources, read_table
from .sources.sinks import read_batches, write_batch, write_bucketed, write_quarantine, write_table

__all__ = [name for name in dir() if not name.startswith("_")]

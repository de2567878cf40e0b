"""Job template (L1, L2): extract -> validate -> quarantine -> transform -> publish.

Actions per run: one write per non-empty quarantine table's job plus one
write for the result (optionally one staging write per input). Quality
counts ride on the quarantine or staging writes as :class:`Observation`
metrics. Where neither write happens (``on_invalid`` is None or a callable and
nothing is staged), one aggregate per input counts instead.

Staging (``stage="table"``) writes each annotated input once as parquet
under the shared checkpoint folder, partitioned by the row verdict. The raw
text is then parsed once; the quarantine write and the transform read their
half back by partition pruning, and the written table cuts the lineage so
a lost executor costs a re-read of parquet, not a re-parse of CSV. With
``stage="recompute"`` both branches re-scan the source, which is the
cheaper choice for columnar sources. ``stage="persist"`` keeps the
annotated input in executor memory and local disk (MEMORY_AND_DISK) for the
two writes and releases it afterwards: no extra files, but a lost executor
means recomputing its blocks from the source.

``unique`` and ``references`` turn on the declared keys: rows that pass their
column rules but share a primary key, and then rows whose foreign key no valid
row of the parent has, are quarantined with that reason. The annotated inputs
that take part are written once before, as the checks read them several times.

The counts of every combination of failed columns come from the same metrics:
a bit mask per row, counted exactly by a frequent-items aggregate as long as
fewer combinations occur than it tracks.

With ``commit`` the quarantine and the result appear at one point (see
``sluice.sources.commits``); a job that fails before leaves neither.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Any, Callable, Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.keys import ForeignKey, reject_duplicates, reject_orphans
from ..operators.validate import MASK_COLUMN, VALID_FLAG, annotate, mask_names, split_annotated
from ..rules import TableRules
from ..session import scratch, staged, staging_path
from ..sources.commits import commit as commit_batch
from ..sources.commits import write_attempt
from ..sources.sinks import QUARANTINE_DIR, new_batch_id, write_batch, write_quarantine

log = logging.getLogger(__name__)

STAGES = ("recompute", "table", "persist")


@dataclass
class JobResult:
    batch_id: str
    output_path: str
    quality: dict[str, dict[str, float]] = field(default_factory=dict)
    published_rows: int | None = None
    # per input: (failed columns, rows) of each combination that failed, the commonest first
    failures: dict[str, list[tuple[tuple[str, ...], int]]] = field(default_factory=dict)


TRACKED = 1 << 17


def _quality_observation(name: str) -> Observation:
    return Observation(f"quality_{name}")


def _quality_metrics(annotated: DataFrame) -> list:
    flag = F.col(VALID_FLAG)
    masks = [F.expr(f"approx_top_k({MASK_COLUMN}, {TRACKED // 2}, {TRACKED})").alias("masks")] if MASK_COLUMN in annotated.columns else []
    return [
        *masks,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(flag).alias("valid"),
        F.count_if(~flag).alias("invalid"),
        F.count_if(flag.isNull()).alias("unknown"),
    ]


def stage_annotated(
    spark: SparkSession,
    annotated: DataFrame,
    name: str,
    observation: Observation | None = None,
    path: str | None = None,
) -> DataFrame:
    """Write an annotated frame once (parquet, partitioned by verdict) and read it back.

    ``observation`` collects the quality counts during this write, which
    passes every row anyway; later reads then only touch their own half.
    """
    path = path or staging_path(spark, name)
    if observation is not None:
        annotated = annotated.observe(observation, *_quality_metrics(annotated))
    annotated.write.mode("overwrite").partitionBy(VALID_FLAG).parquet(path)
    # partition values come back as text; the filter on the cast still prunes directories
    schema = StructType([f for f in annotated.schema.fields if f.name != VALID_FLAG]).add(VALID_FLAG, "string")
    staged = spark.read.schema(schema).parquet(path)  # an empty frame writes no file to infer from
    return staged.withColumn(VALID_FLAG, F.col(VALID_FLAG).cast("boolean"))


def check_keys(
    annotated: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    unique: Iterable[str] = (),
    references: Mapping[str, Iterable[ForeignKey]] | None = None,
) -> dict[str, DataFrame]:
    """The annotated inputs with their key verdicts; parents before children.

    An input that is checked is written once before its first check."""
    references = {name: list(keys) for name, keys in (references or {}).items()}
    unique = set(unique)
    used = unique | set(references) | {fk.parent for keys in references.values() for fk in keys}
    if unknown := used - set(annotated):
        raise ValueError(f"no inputs for the keys of: {sorted(unknown)}")
    out = dict(annotated)
    for name in sorted(unique | set(references)):
        out[name] = staged(out[name], "annotated")
    for name in unique:
        out[name] = reject_duplicates(out[name], rules[name])
    left = dict(references)
    while left:
        ready = [n for n, keys in left.items() if not any(fk.parent in left and fk.parent != n for fk in keys)]
        if not ready:
            raise ValueError(f"references in a circle: {sorted(left)}")
        for name in ready:
            for fk in left.pop(name):
                parent = out[fk.parent].where(VALID_FLAG).select(*fk.parent_columns)
                out[name] = reject_orphans(out[name], parent, fk)
    return out


def run_job(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    rules: Mapping[str, TableRules],
    transform: Callable[[dict[str, DataFrame]], DataFrame],
    *,
    output_base: str,
    output_name: str = "TRANSACTIONS",
    fmt: str = "csv",
    batch_id: str | None = None,
    on_invalid: str | Callable[[dict[str, DataFrame]], Any] | None = "write",
    on_unknown: str = "quarantine",
    stage: str = "recompute",
    quarantine_cast: bool = False,
    cleanup: bool = True,
    unique: Iterable[str] = (),
    references: Mapping[str, Iterable[ForeignKey]] | None = None,
    reject_malformed: bool = False,
    commit: bool = False,
    write_options: Mapping[str, str] | None = None,
) -> JobResult:
    """Run one batch of a rule-driven job and publish it.

    ``on_invalid``: ``"write"`` quarantines to ``<output_base>/invalid/<name>``;
    a callable receives the invalid frames instead; None ignores them.
    ``cleanup`` removes the staged tables once the batch is published (or the
    job failed). ``unique`` names the inputs whose primary key is checked,
    ``references`` the foreign keys per input. ``reject_malformed`` makes lines
    with a ``raw_record`` invalid. ``commit`` publishes the quarantine and the
    result at one point, to be read with ``read_committed``. ``write_options``
    go to the writer of both (for instance ``COMPRESSED_TEXT``).
    Any error aborts the job and propagates.
    """
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}")
    missing = set(sources) - set(rules)
    if missing:
        raise ValueError(f"no rules for inputs: {sorted(missing)}")
    batch_id = batch_id or new_batch_id()

    with scratch(spark, keep=not cleanup):
        return _run(
            spark, sources, rules, transform, output_base, output_name, fmt, batch_id, on_invalid, on_unknown, stage,
            quarantine_cast, unique, references, reject_malformed, commit, write_options,
        )


def _run(
    spark, sources, rules, transform, output_base, output_name, fmt, batch_id, on_invalid, on_unknown, stage,
    quarantine_cast, unique, references, reject_malformed, commit, write_options,
) -> JobResult:
    valid: dict[str, DataFrame] = {}
    invalid: dict[str, DataFrame] = {}
    observations: dict[str, Observation] = {}
    uncounted: dict[str, DataFrame] = {}
    persisted: list[DataFrame] = []
    annotated_all = {
        n: annotate(df, rules[n], on_unknown=on_unknown, with_mask=len(rules[n]) < 64, reject_malformed=reject_malformed)
        for n, df in sources.items()
    }
    checked = check_keys(annotated_all, rules, unique, references)
    for name, annotated in checked.items():
        tr = rules[name]
        obs = _quality_observation(name)
        if stage == "table":
            annotated = stage_annotated(spark, annotated, name, obs).select(*annotated.columns)
            observed = annotated
            observations[name] = obs
        else:
            if stage == "persist":
                annotated = annotated.persist(StorageLevel.MEMORY_AND_DISK)
                persisted.append(annotated)
            observed = None
            if on_invalid == "write":
                # the quarantine job evaluates every row's verdict anyway: count there
                observed = annotated.observe(obs, *_quality_metrics(annotated))
                observations[name] = obs
            else:
                uncounted[name] = annotated
            if stage == "recompute":
                # Catalyst moves no filter below a metric, so a verdict, and a text that
                # the source derives, is formed once per row: not in the filter and again
                # in the columns
                annotated = annotated.observe(f"read_{name}", F.count(F.lit(1)).alias("rows"))
            observed = annotated if observed is None else observed
        v = split_annotated(annotated, tr, cast=True)
        iv = split_annotated(observed, tr, cast=True, cast_invalid=quarantine_cast)
        valid[name] = v.valid
        invalid[name] = iv.invalid

    try:
        attempt, tables = None, [output_name]
        if on_invalid == "write" and commit:
            named = {f"{QUARANTINE_DIR}/{n}": df for n, df in invalid.items()}
            attempt, tables = write_attempt(named, output_base, batch_id, fmt, options=write_options), [*tables, *named]
        elif on_invalid == "write":
            write_quarantine(invalid, output_base, batch_id, fmt, options=write_options)
        elif callable(on_invalid):
            on_invalid(invalid)
        elif on_invalid is not None:
            raise ValueError("on_invalid must be 'write', a callable or None")

        result = transform(valid)
        out_obs = Observation("published")
        if commit:
            attempt = write_attempt(
                {output_name: result}, output_base, batch_id, fmt, options=write_options, observations={output_name: out_obs}, attempt=attempt
            )
            commit_batch(spark, output_base, batch_id, attempt, tables, fmt)
        else:
            write_batch(result, output_base, output_name, batch_id, fmt, options=write_options, observation=out_obs)
        counts = {name: df.agg(*_quality_metrics(df)).first().asDict() for name, df in uncounted.items()}
    finally:
        for df in persisted:
            df.unpersist()

    counts |= {name: dict(obs.get) for name, obs in observations.items()}
    quality: dict[str, dict[str, float]] = {}
    failures: dict[str, list[tuple[tuple[str, ...], int]]] = {}
    for name in sources:
        q = counts[name]
        masks = q.pop("masks", None) or []
        failures[name] = [(tuple(mask_names(m["item"], rules[name])), m["count"]) for m in masks if m["item"]]
        if len(masks) >= TRACKED // 2:
            log.warning("%s: more than %d combinations of failed columns; their counts are bounds", name, TRACKED // 2)
        q["invalid_rate"] = (q["invalid"] / q["rows"]) if q["rows"] else 0.0
        quality[name] = q
        log.info("%s: %s", name, quality[name])
    published = out_obs.get.get("rows")
    return JobResult(batch_id, f"{output_base}/{output_name}", quality, published, failures)

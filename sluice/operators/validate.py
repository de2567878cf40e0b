"""Row validation against declarative rules.

Every rule becomes a Catalyst expression; nothing here runs a job. The
verdicts are evaluated inside one projection/filter per branch, so they stay
in whole-stage codegen and need no shuffle: validation is a narrow,
map-only step whose cost grows linearly with the input.

Three-valued logic: an ``allowed_values`` list that holds ``null`` makes
``c IN (...)`` NULL for a miss, and a NULL verdict would fall through both
``where(v)`` and ``where(~v)``. By default (``on_unknown="quarantine"``) each
column verdict is coalesced to false, so such a row is quarantined and the
column is named. ``on_unknown="drop"`` keeps the raw three-valued verdicts:
those rows then appear on neither side.
"""

from __future__ import annotations

import logging
import re
from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..rules import ColumnRule, TableRules
from .header import conform_header

log = logging.getLogger(__name__)

# The quarantined row's message column and its format.
ERROR_COLUMN = "validation_error"
FAILED_PREFIX = "Failed columns: "
FAILED_SEPARATOR = ", "
FAILED_FALLBACK = "Validation failed"
MALFORMED_REASON = "Malformed record"

FAILED_LIST_COLUMN = "failed_columns"
VALID_FLAG = "is_valid"
MASK_COLUMN = "failed_mask"
EVIDENCE_COLUMN = "raw_record"  # as the reader names it

ON_UNKNOWN = ("quarantine", "drop")


def _text(name: str) -> Column:
    # Rules are text rules; a typed source is checked on its string form.
    return F.col(name).cast("string")


def _optional(pred: Column, c: Column) -> Column:
    # pred OR c IS NULL OR c = '', with one reference to c
    return pred | F.coalesce(c == F.lit(""), F.lit(True))


def _present(c: Column) -> Column:
    # c IS NOT NULL AND c <> '' (never NULL), with one reference to c
    return F.coalesce(c != F.lit(""), F.lit(False))


def cast_type(cast_to: str | None) -> str | None:
    """Spark type name for a rule's ``cast_to``, or None if not supported."""
    if cast_to is None:
        return None
    t = cast_to.strip().lower()
    if t in ("long", "bigint"):
        return "bigint"
    if t in ("int", "integer"):
        return "int"
    if t.startswith("decimal"):
        return t
    return None


# Texts of these forms parse in whatever month, year and time zone, so the parser
# (four times the price of the expression) is left the others: days 29 to 31,
# far years, and what is no date.
_SURE = {
    "dd": "(?:0[1-9]|1[0-9]|2[0-8])",
    "MM": "(?:0[1-9]|1[0-2])",
    "yyyy": "(?:19|20)[0-9]{2}",
    "HH": "(?:[01][0-9]|2[0-3])",
    "mm": "[0-5][0-9]",
    "ss": "[0-5][0-9]",
}
_SURE_FORMATS = [{"dd", "MM", "yyyy"}, {"dd", "MM", "yyyy", "HH", "mm"}, {"dd", "MM", "yyyy", "HH", "mm", "ss"}]


def sure_pattern(fmt: str) -> str | None:
    """A regular expression of texts that the datetime pattern surely parses, or
    None for patterns other than two- and four-digit fields between separators."""
    parts = re.split("([ .:/-]+)", fmt)
    fields, marks = parts[::2], parts[1::2]
    if set(fields) not in _SURE_FORMATS or len(set(fields)) != len(fields):
        return None
    return "^" + "".join(_SURE[f] + re.escape(m) for f, m in zip(fields, [*marks, ""])) + r"\z"


def _parses(c: Column, fmt: str, parsed: Column) -> Column:
    sure = sure_pattern(fmt)
    return parsed.isNotNull() if sure is None else c.rlike(sure) | parsed.isNotNull()


def column_checks(rule: ColumnRule) -> list[Column]:
    """The rule's predicates (V1-V6), three-valued exactly as written."""
    c = _text(rule.name)
    checks: list[Column] = []
    if rule.required:
        checks.append(_present(c))
    preds: list[Column] = []
    if rule.regex is not None:
        preds.append(c.rlike(rule.regex))
    if rule.allowed_values is not None:
        preds.append(c.isin(*rule.allowed_values))
    if rule.checks_date:
        preds.append(_parses(c, rule.date_format, F.try_to_date(c, rule.date_format)))
    if rule.checks_timestamp:
        preds.append(_parses(c, rule.timestamp_format, F.try_to_timestamp(c, F.lit(rule.timestamp_format))))
    if rule.extra.get("castable") and cast_type(rule.cast_to):
        preds.append(F.nullif(c, F.lit("")).try_cast(cast_type(rule.cast_to)).isNotNull())
    for p in preds:
        checks.append(p if rule.required else _optional(p, c))
    return checks


def column_verdict(rule: ColumnRule, on_unknown: str = "quarantine") -> Column:
    """AND of the column's checks (V7); no checks -> true."""
    checks = column_checks(rule)
    if not checks:
        return F.lit(True)
    v = reduce(and_, checks)
    return v if on_unknown == "drop" else F.coalesce(v, F.lit(False))


def verdicts(rules: TableRules, on_unknown: str = "quarantine") -> list[tuple[str, Column]]:
    if on_unknown not in ON_UNKNOWN:
        raise ValueError(f"on_unknown must be one of {ON_UNKNOWN}, got {on_unknown!r}")
    return [(r.name, column_verdict(r, on_unknown)) for r in rules]


def row_verdict(col_verdicts: list[tuple[str, Column]]) -> Column:
    """AND over all column verdicts (V8)."""
    if not col_verdicts:
        return F.lit(True)
    return reduce(and_, [v for _, v in col_verdicts])


def failed_columns(col_verdicts: list[tuple[str, Column]]) -> Column:
    """array<string> of failed column names, in rule order."""
    return F.array_compact(F.array(*[F.when(~v, F.lit(n)) for n, v in col_verdicts]))


def failed_mask(col_verdicts: list[tuple[str, Column]]) -> Column:
    """Bit i is set if the i-th rule column fails (63 columns at most)."""
    if len(col_verdicts) > 63:
        raise ValueError(f"a mask holds 63 columns, not {len(col_verdicts)}")
    bits = [F.when(~v, F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, (_, v) in enumerate(col_verdicts)]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0).cast("long"))


def mask_names(mask: int, rules: TableRules) -> list[str]:
    return [n for i, n in enumerate(rules.names) if mask >> i & 1]


def failed_message(col_verdicts: list[tuple[str, Column]]) -> Column:
    """``"Failed columns: A, B"`` in rule order, else ``"Validation failed"``."""
    if not col_verdicts:
        return F.lit(FAILED_FALLBACK)
    joined = F.concat_ws(FAILED_SEPARATOR, *[F.when(~v, F.lit(n)) for n, v in col_verdicts])
    return F.when(joined != F.lit(""), F.concat(F.lit(FAILED_PREFIX), joined)).otherwise(
        F.lit(FAILED_FALLBACK)
    )


def cast_declared(df: DataFrame, rules: TableRules) -> DataFrame:
    """Cast rule columns to their ``cast_to`` type with try_cast.

    Unknown cast targets are logged and left unchanged. try_cast gives the
    same result with ANSI mode on and off: an unparsable or overflowing value
    becomes null.
    """
    by_name = {r.name: r for r in rules}
    text_cols = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    exprs = []
    for name in df.columns:
        rule = by_name.get(name)
        if rule is None or rule.cast_to is None:
            exprs.append(F.col(name))
            continue
        t = cast_type(rule.cast_to)
        if t is None:
            log.warning("unknown cast type %r for column %s; left unchanged", rule.cast_to, name)
            exprs.append(F.col(name))
        elif name in text_cols:
            # '' casts to null anyway; mapping it first skips Spark's per-row
            # exception path for unparsable text, which dominates optional columns
            exprs.append(F.nullif(F.col(name), F.lit("")).try_cast(t).alias(name))
        else:
            exprs.append(F.col(name).try_cast(t).alias(name))
    return df.select(*exprs)


class Validated(NamedTuple):
    valid: DataFrame
    invalid: DataFrame


def annotate(
    df: DataFrame,
    rules: TableRules,
    *,
    on_unknown: str = "quarantine",
    conform: bool = True,
    with_failed_list: bool = False,
    with_mask: bool = False,
    reject_malformed: bool = False,
) -> DataFrame:
    """Rule columns + ``is_valid`` + ``validation_error`` (null on valid rows).

    One projection, so both sides of the split can come from one scan (for
    instance one write partitioned by ``is_valid``). A ``raw_record`` column
    (the text of malformed lines) is carried along to the invalid rows; with
    ``reject_malformed`` a line that has one is invalid for that. ``with_mask``
    adds ``failed_mask``, the failed columns as bits.
    """
    if conform:
        df = conform_header(df, rules, (EVIDENCE_COLUMN,))
    evidence = EVIDENCE_COLUMN in df.columns and EVIDENCE_COLUMN not in rules.names
    cv = verdicts(rules, on_unknown)
    ok, message = row_verdict(cv), failed_message(cv)
    if reject_malformed and evidence:
        malformed = F.col(EVIDENCE_COLUMN).isNotNull()
        message = F.concat_ws("; ", F.when(~ok, message), F.when(malformed, F.lit(MALFORMED_REASON)))
        ok = ok & ~malformed
    cols = [F.col(n) for n in rules.names]
    cols.append(ok.alias(VALID_FLAG))
    cols.append(F.when(~ok, message).alias(ERROR_COLUMN))
    if with_failed_list:
        cols.append(F.when(~ok, failed_columns(cv)).alias(FAILED_LIST_COLUMN))
    if with_mask:
        cols.append(failed_mask(cv).alias(MASK_COLUMN))
    if evidence:
        cols.append(F.col(EVIDENCE_COLUMN))
    return df.select(*cols)


def split_annotated(
    annotated: DataFrame,
    rules: TableRules,
    *,
    cast: bool = True,
    cast_invalid: bool = False,
) -> Validated:
    """Split an :func:`annotate` result into (valid, invalid)."""
    flag = F.col(VALID_FLAG)
    valid = annotated.where(flag).select(*rules.names)
    extra = [c for c in (ERROR_COLUMN, FAILED_LIST_COLUMN, EVIDENCE_COLUMN) if c in annotated.columns and c not in rules.names]
    invalid = annotated.where(~flag).select(*rules.names, *extra)
    if cast:
        valid = cast_declared(valid, rules)
    if cast_invalid:
        invalid = cast_declared(invalid, rules)
    return Validated(valid, invalid)


def validate(
    df: DataFrame,
    rules: TableRules,
    *,
    on_unknown: str = "quarantine",
    cast: bool = True,
    cast_invalid: bool = False,
    conform: bool = True,
    with_failed_list: bool = False,
) -> Validated:
    """Split ``df`` into valid rows (declared columns, cast) and invalid rows.

    Invalid rows keep the raw values (casting would turn the evidence into
    nulls) plus ``validation_error``; ``cast_invalid=True`` casts them too.
    Both frames are lazy and share one plan prefix; no job is run.
    """
    annotated = annotate(
        df, rules, on_unknown=on_unknown, conform=conform, with_failed_list=with_failed_list
    )
    return split_annotated(annotated, rules, cast=cast, cast_invalid=cast_invalid)


def failure_combinations(annotated: DataFrame, rules: TableRules) -> DataFrame:
    """failed_columns (in rule order, comma-joined; '' if none) and n_rows of
    every combination that occurs in an ``annotate(..., with_mask=True)`` frame."""
    counted = annotated.groupBy(MASK_COLUMN).agg(F.count(F.lit(1)).alias("n_rows"))
    names = [F.when(F.col(MASK_COLUMN).bitwiseAND(F.lit(1 << i)) != 0, F.lit(n)) for i, n in enumerate(rules.names)]
    return counted.select(F.concat_ws(",", *names).alias("failed_columns"), "n_rows")


ROW_ENTRY = "__row__"


def quality_report(
    df: DataFrame,
    rules: TableRules,
    *,
    on_unknown: str = "quarantine",
    conform: bool = True,
) -> DataFrame:
    """One row per rule column plus one for the whole row.

    Columns: table_name, ordinal, column_name, n_rows, n_failed, failed_rate.
    A single global aggregate: each task folds its rows into a handful of
    counters (map-side partial aggregation), so only one tiny row per task
    crosses the shuffle, whatever the skew of the data.
    """
    if conform:
        df = conform_header(df, rules)
    cv = verdicts(rules, on_unknown)
    entries = [*cv, (ROW_ENTRY, row_verdict(cv))]
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(~v).alias(f"_f{i}") for i, (_, v) in enumerate(entries)]
    totals = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(name).alias("column_name"),
                F.col(f"_f{i}").alias("n_failed"),
            )
            for i, (name, _) in enumerate(entries)
        ]
    )
    return totals.select(F.lit(rules.name).alias("table_name"), "n_rows", F.inline(rows)).select(
        "table_name",
        "ordinal",
        "column_name",
        "n_rows",
        "n_failed",
        F.try_divide(F.col("n_failed"), F.col("n_rows")).alias("failed_rate"),
    )

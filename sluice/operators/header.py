"""Header conformance (H2-H5): schema-on-read by column name.

All checks run on ``df.columns`` only, so they cost no Spark job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..rules import TableRules


class HeaderError(ValueError):
    """The input's header cannot be matched to the rule set."""


def check_header(columns: list[str], rules: TableRules) -> dict[str, str]:
    """Return the renames ``{found_name: rule_name}`` needed to conform ``columns``.

    Raises HeaderError on a malformed header (a quote inside a name), on any
    rule column missing under its own name and all its aliases (all missing
    names reported together), or when a column and one of its aliases are
    both present.
    """
    if any('"' in c for c in columns):
        raise HeaderError(f"invalid CSV format: malformed header in {rules.name}: {columns}")
    present = set(columns)
    renames: dict[str, str] = {}
    missing: list[str] = []
    for rule in rules:
        found = [n for n in (rule.name, *rule.aliases) if n in present]
        if not found:
            missing.append(rule.name)
        elif len(found) > 1:
            raise HeaderError(
                f"column {rule.name!r} of {rules.name} is present under several names: {found}"
            )
        elif found[0] != rule.name:
            renames[found[0]] = rule.name
    if missing:
        raise HeaderError(f"invalid CSV format: missing required columns in {rules.name}: {missing}")
    return renames


def conform_header(df: DataFrame, rules: TableRules, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename header variants to rule names and keep only rule columns, in rule
    order, and those of ``keep`` that are there."""
    renames = check_header(df.columns, rules)
    more = [c for c in keep if c in df.columns and c not in rules.names]
    if renames:
        df = df.withColumnsRenamed(renames)
    return df.select(*rules.names, *more)

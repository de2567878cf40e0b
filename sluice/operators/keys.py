"""Declared keys: uniqueness of primary keys, presence of foreign keys.

Rule files name the columns of a table's primary key and of its foreign keys
(``"role": "primary_key"`` / ``"foreign_key"``). Both checks work on distinct
keys with their numbers of rows, which are partially aggregated where the rows
are, so a key that holds a third of all rows crosses the shuffle as one row per
task. The verdict goes back to the rows by the keys that fail (``KeySet``). Few
failing keys are broadcast. Of many, a Bloom filter is, and with it the keys it
wrongly holds, found once among the distinct keys it lets through: the rows are
not shuffled. Where the filter or its errors are too many, the failing keys with
the most rows are broadcast (their number is bounded by the share of rows each
must have), and of the other rows those the filter lets through are joined by
shuffle, where no key is hot. Shuffled joins compare a hash of the key first:
texts that begin alike would be sorted by whole comparisons.

A foreign key first meets a Bloom filter of the parent's keys: one 64-bit word
per four parent keys, four bits of a key's word set, built by a partially
aggregated ``bit_or`` over word numbers. Its size follows the counted parent
keys. Child keys that the filter denies are orphans at once, before any
exchange; the rest are compared exactly. Beyond ``bloom_words`` the filter is
left out and all distinct child keys are compared exactly.

A key with a null part (or an empty text) is not checked: the required rule
names such a column already.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import TableRules
from ..session import staged
from .joins import hot_from
from .validate import ERROR_COLUMN, FAILED_LIST_COLUMN, VALID_FLAG

PRIMARY, FOREIGN = "primary_key", "foreign_key"
BROADCAST_KEYS = 1_000_000
HOT_ROWS = 1_000_000
BLOOM_WORDS = 4_000_000
KEYS_PER_WORD = 4

DUPLICATE_PREFIX = "Duplicate key: "
ORPHAN_PREFIX = "Missing parent: "
REASON_SEPARATOR = "; "


def key_columns(rules: TableRules, role: str = PRIMARY) -> list[str]:
    """The rule columns with that role, in rule order."""
    return [r.name for r in rules if r.role == role]


def _present(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c).cast("string") != F.lit(""))


def _whole(keys: Sequence[str]) -> Column:
    return reduce(and_, [_present(k) for k in keys])


def _may_hold(df: DataFrame, columns: Sequence[str], bloom: DataFrame, words: int, out: str) -> DataFrame:
    """``df`` and ``out``: false only if the filter's keys do not include the row's."""
    seen = df.withColumn("__word", _word(columns, words)).withColumn("__bits", _bits(columns))
    seen = seen.join(F.broadcast(bloom), "__word", "left")
    maybe = F.coalesce(F.col("__set").bitwiseAND(F.col("__bits")) == F.col("__bits"), F.lit(False))
    return seen.withColumn(out, maybe).drop("__word", "__bits", "__set")


@dataclass(frozen=True)
class KeySet:
    """A stored table of distinct keys (``keys``) and ``n``, the rows of each."""

    table: DataFrame
    keys: tuple[str, ...]

    def mark(
        self,
        df: DataFrame,
        out: str,
        *,
        broadcast_keys: int = BROADCAST_KEYS,
        hot_rows: int = HOT_ROWS,
        max_words: int = BLOOM_WORDS,
        keys_per_word: int = KEYS_PER_WORD,
    ) -> DataFrame:
        """``df`` (with the same key columns) and ``out``: is the row's key in the set?"""
        names = [f"__key{i}" for i in range(len(self.keys))]
        named = self.table.select(*[F.col(k).alias(n) for k, n in zip(self.keys, names, strict=True)], "n", F.lit(True).alias("__in"))

        def flagged(rows: DataFrame, found: DataFrame, *first: Column) -> DataFrame:
            on = reduce(and_, [*first, *[rows[k] == found[n] for k, n in zip(self.keys, names, strict=True)]])
            return rows.join(found.drop("n"), on, "left").drop(*names)

        size = self.table.count()
        if not size:
            return df.withColumn(out, F.lit(False))
        if size <= broadcast_keys:
            whole = flagged(df, F.broadcast(named))
            return whole.withColumn(out, F.coalesce("__in", F.lit(False))).drop("__in")
        # hashes agree only between equal types; the join itself would cast
        alike = all(df.schema[k].dataType == self.table.schema[k].dataType for k in self.keys)
        words, bloom = -(-size // keys_per_word), None
        if alike and words <= max_words:
            bloom = staged(bloom_words(self.table, self.keys, words), "failing_bloom")
            seen = _may_hold(df, self.keys, bloom, words, "__maybe")
            known = reduce(and_, [F.col(k).isNotNull() for k in self.keys])
            hits = seen.where(F.col("__maybe") & known).select(*[F.col(k).alias(n) for k, n in zip(self.keys, names, strict=True)])
            hashed = F.xxhash64(*names)
            wrong = hits.distinct().withColumn("__hash", hashed).join(named.withColumn("__hash", hashed), ["__hash", *names], "left_anti")
            wrong = staged(wrong.select(*names), "cleared_keys")
            if wrong.count() <= broadcast_keys:
                cleared = flagged(seen, F.broadcast(wrong.withColumn("__cleared", F.lit(True))))
                return cleared.withColumn(out, F.col("__maybe") & known & F.col("__cleared").isNull()).drop("__maybe", "__cleared")
        least = hot_from(self.table, "n", hot_rows, broadcast_keys)
        first = flagged(df, F.broadcast(named.where(F.col("n") >= least)))
        aside = F.col("__in").isNotNull() | reduce(or_, [F.col(k).isNull() for k in self.keys])
        cold = named.where(F.col("n") < least)
        if bloom is not None:
            first = _may_hold(first, self.keys, bloom, words, "__maybe")
            aside = aside | ~F.col("__maybe")
        stay = first.where(aside).drop("__maybe")
        rest = first.where(~aside).drop("__in", "__maybe")
        if alike:
            rest, cold = rest.withColumn("__h", F.xxhash64(*self.keys)), cold.withColumn("__hash", F.xxhash64(*names))
            rest = flagged(rest, cold, rest["__h"] == cold["__hash"]).drop("__h", "__hash")
        else:
            rest = flagged(rest, cold)
        return stay.unionByName(rest).withColumn(out, F.coalesce("__in", F.lit(False))).drop("__in")


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct whole keys and ``n``, their numbers of rows."""
    return df.where(_whole(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> KeySet:
    """Keys that more than one row of ``df`` has."""
    return KeySet(staged(key_counts(df, keys).where("n > 1"), "duplicate_keys"), tuple(keys))


@dataclass(frozen=True)
class ForeignKey:
    """``columns`` of a table hold a key of ``parent``'s ``parent_columns``."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


def foreign_key(child: TableRules, parent: TableRules) -> ForeignKey:
    """The child's foreign-key columns, in order, as the parent's primary key."""
    columns, target = key_columns(child, FOREIGN), key_columns(parent, PRIMARY)
    if not columns or len(columns) != len(target):
        raise ValueError(f"{child.name}: {columns} cannot refer to {parent.name}: {target}")
    return ForeignKey(tuple(columns), parent.name, tuple(target))


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words))


def _bits(keys: Sequence[str]) -> Column:
    """Four of the 64 bits, by six-bit pieces of a second hash."""
    h = F.xxhash64(F.lit("bits"), *keys)
    return reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(4)],
    )


def bloom_words(keys: DataFrame, columns: Sequence[str], words: int) -> DataFrame:
    """The filter as rows (``__word``, ``__set``): at most ``words`` rows."""
    return keys.select(_word(columns, words).alias("__word"), _bits(columns).alias("__bits")).groupBy("__word").agg(
        F.bit_or("__bits").alias("__set")
    )


def orphan_keys(
    child: DataFrame,
    parent: DataFrame,
    fk: ForeignKey,
    *,
    max_words: int = BLOOM_WORDS,
    keys_per_word: int = KEYS_PER_WORD,
) -> KeySet:
    """The child's keys that no parent row has.

    Keys are compared as text, so a conformed parent (ids cast to numbers) fits
    a raw child whose texts are written alike."""
    names = [f"__p{i}" for i in range(len(fk.columns))]
    parents = parent.where(_whole(fk.parent_columns)).select(
        *[F.col(c).cast("string").alias(n) for c, n in zip(fk.parent_columns, names, strict=True)]
    )
    parents = staged(parents.distinct(), "parent_keys")
    n = parents.count()
    found = key_counts(child, fk.columns)
    texts = [F.col(c).cast("string").alias(x) for c, x in zip(fk.columns, names, strict=True)]
    keys = found.select(*fk.columns, "n", *texts)
    words = -(-n // keys_per_word)
    if n and words <= max_words:
        keys = _may_hold(keys, names, staged(bloom_words(parents, names, words), "bloom"), words, "__maybe")
    else:
        keys = keys.withColumn("__maybe", F.lit(n > 0))
    keys = staged(keys, "child_keys")
    denied = keys.where(~F.col("__maybe"))
    hashed = F.xxhash64(*names)
    absent = keys.where(F.col("__maybe")).withColumn("__hash", hashed).join(parents.withColumn("__hash", hashed), ["__hash", *names], "left_anti")
    orphans = denied.unionByName(absent.select(*denied.columns)).select(*fk.columns, "n")
    return KeySet(staged(orphans, "orphan_keys"), fk.columns)


def _reject(annotated: DataFrame, flag: str, reason: str, columns: Sequence[str]) -> DataFrame:
    """Rows with the flag become invalid, with the reason after any other."""
    hit = F.col(flag)
    message = F.concat_ws(REASON_SEPARATOR, F.col(ERROR_COLUMN), F.when(hit, F.lit(reason)))
    out = annotated.withColumn(ERROR_COLUMN, F.when(hit, message).otherwise(F.col(ERROR_COLUMN)))
    out = out.withColumn(VALID_FLAG, F.col(VALID_FLAG) & ~hit)
    if FAILED_LIST_COLUMN in annotated.columns:
        named = F.array_union(F.coalesce(FAILED_LIST_COLUMN, F.array().cast("array<string>")), F.array(*map(F.lit, columns)))
        out = out.withColumn(FAILED_LIST_COLUMN, F.when(hit, named).otherwise(F.col(FAILED_LIST_COLUMN)))
    return out.drop(flag)


def reject_duplicates(annotated: DataFrame, rules: TableRules, **sizes) -> DataFrame:
    """Rows that passed their column rules but share their primary key with
    another such row become invalid, all of them: which one is right is not
    the job's to guess. Rows that failed before neither count nor change."""
    keys = key_columns(rules)
    if not keys:
        return annotated
    fine = F.coalesce(VALID_FLAG, F.lit(False))
    marked = duplicate_keys(annotated.where(fine), keys).mark(annotated, "__duplicate", **sizes)
    marked = marked.withColumn("__duplicate", F.col("__duplicate") & fine)
    return _reject(marked, "__duplicate", DUPLICATE_PREFIX + ", ".join(keys), keys)


def reject_orphans(
    annotated: DataFrame, parent: DataFrame, fk: ForeignKey, *, max_words: int = BLOOM_WORDS, **sizes
) -> DataFrame:
    """Rows that passed so far and whose foreign key no row of ``parent`` (its
    valid rows) has become invalid."""
    fine = F.coalesce(VALID_FLAG, F.lit(False))
    orphans = orphan_keys(annotated.where(fine), parent, fk, max_words=max_words)
    marked = orphans.mark(annotated, "__orphan", **sizes)
    marked = marked.withColumn("__orphan", F.col("__orphan") & fine)
    reason = f"{ORPHAN_PREFIX}{', '.join(fk.columns)} in {fk.parent}"
    return _reject(marked, "__orphan", reason, fk.columns)

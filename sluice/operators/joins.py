"""Joins (J1-J3).

``left_join_on_keys`` is a plain equi-join: Catalyst chooses broadcast
(right side below ``spark.sql.autoBroadcastJoinThreshold`` by its size
statistics, or by AQE from the real shuffle size) or sort-merge. No hint is
forced, so a right side that grows with the data is never broadcast blindly.

Skew: when one key holds a large share of the left rows, AQE's skew-join
handling splits the oversized left partition (left outer joins allow
splitting the left side). ``SkewSalt`` adds an explicit alternative that
does not depend on runtime statistics. A right side of counted, few rows is
broadcast, and no left row moves. Otherwise the keys are counted (one partially
aggregated pass, stored), then the rows go three ways:

* Rows of hot keys never meet the shuffle of their key. The list of hot keys
  is broadcast: a key is hot from ``min_rows`` rows, or from the share of all
  rows that keeps the list within ``broadcast_rows`` keys, so the list is
  bounded whatever the data. If the right rows of the hot keys, which are
  counted, are as few, they are broadcast too and the rows stay where they
  were read. Otherwise the rows are written once with a salt that numbers them
  within their task, so equal rows spread and a repeated read finds the same
  salts, and the right rows are replicated per salt.
* Rows with a null key match nothing and pass beside the join.
* All other rows take the plain join, in which no key is hot.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import default_if_blank
from ..session import staged

_KEEPS_LEFT = ("left", "left_outer", "leftouter", "full", "full_outer", "fullouter", "outer")
_RIGHT_MAY_BE_BROADCAST = ("inner", "left", "left_outer", "leftouter", "left_semi", "semi", "leftsemi", "left_anti", "anti", "leftanti")
_INNER = {"right": "inner", "right_outer": "inner", "rightouter": "inner", "full": "left", "full_outer": "left",
          "fullouter": "left", "outer": "left"}


@dataclass(frozen=True)
class SkewSalt:
    """A key is hot from ``min_rows`` left rows; a salt takes about as many,
    and a hot key has ``buckets`` salts at least. At most ``broadcast_rows``
    right rows, hot keys, or right rows of hot keys, are broadcast."""

    buckets: int = 32
    min_rows: int = 1_000_000
    broadcast_rows: int = 1_000_000


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def _on(left: DataFrame, lkeys: Sequence[str], right: DataFrame, rkeys: Sequence[str]) -> Column:
    return reduce(and_, [left[a] == right[b] for a, b in zip(lkeys, rkeys, strict=True)])


def hot_from(counts: DataFrame, n: str, min_rows: int, broadcast_rows: int) -> int:
    """The number of rows from which a key is hot: fewer than
    ``broadcast_rows`` keys can have that many of the counted rows each."""
    total = counts.agg(F.sum(n).alias("rows")).first()["rows"] or 0
    return max(min_rows, total // max(1, broadcast_rows) + 1)


def _hot_keys(left: DataFrame, lkeys: Sequence[str], salt: SkewSalt) -> DataFrame:
    """Every hot key with its number of salts, as a stored table."""
    counts = left.where(~any_null(lkeys)).groupBy(*lkeys).agg(F.count(F.lit(1)).alias("__n"))
    counts = staged(counts.where(F.col("__n") >= F.lit(min(salt.min_rows, 1 << 62))), "hot_keys")
    least = hot_from(counts, "__n", salt.min_rows, salt.broadcast_rows)
    salts = F.greatest(F.lit(salt.buckets), F.ceil(F.col("__n") / salt.min_rows)).cast("int")
    named = [F.col(k).alias(f"__hot{i}") for i, k in enumerate(lkeys)]
    return counts.where(F.col("__n") >= least).select(*named, salts.alias("__salts"))


def _join_salted(left: DataFrame, right: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str], how: str) -> DataFrame:
    """Hot rows dealt over ``__salts`` by their number, which the write fixes."""
    numbered = left.withColumn("__salt", F.pmod(F.monotonically_increasing_id(), F.col("__salts")).cast("int"))
    spread = staged(numbered.drop("__salts"), "salted")
    r = right.withColumn("__salt_r", F.explode(F.sequence(F.lit(0), F.col("__salts") - 1))).drop("__salts")
    cond = _on(spread, lkeys, r, rkeys) & (spread["__salt"] == r["__salt_r"])
    return spread.join(r, cond, how).drop("__salt", "__salt_r")


def _split_join(left: DataFrame, r: DataFrame, lkeys: Sequence[str], rkeys: Sequence[str], how: str, skew: SkewSalt) -> DataFrame:
    if how in _RIGHT_MAY_BE_BROADCAST and r.limit(skew.broadcast_rows + 1).count() <= skew.broadcast_rows:
        return left.join(F.broadcast(r), _on(left, lkeys, r, rkeys), how)
    hot = F.broadcast(_hot_keys(left, lkeys, skew))
    names = [f"__hot{i}" for i in range(len(lkeys))]
    marked = left.join(hot, _on(left, lkeys, hot, names), "left").drop(*names)
    is_hot, nulls = F.col("__salts").isNotNull(), any_null(lkeys)
    hot_right = r.join(hot, _on(r, rkeys, hot, names), "inner").drop(*names)
    # every right row of a hot key has left partners: the kind of join keeps left rows at most
    beside = _INNER.get(how, how)
    if hot_right.limit(skew.broadcast_rows + 1).count() <= skew.broadcast_rows:
        stay, few = marked.where(is_hot | nulls).drop("__salts"), F.broadcast(hot_right.drop("__salts"))
        out = stay.join(few, _on(stay, lkeys, few, rkeys), beside)
    else:
        out = _join_salted(marked.where(is_hot), hot_right, lkeys, rkeys, beside)
        stay, none = marked.where(nulls).drop("__salts"), F.broadcast(r.limit(0))
        out = out.unionByName(stay.join(none, _on(stay, lkeys, none, rkeys), beside))
    rest = marked.where(~is_hot & ~nulls).drop("__salts")
    rest_right = r.join(hot, _on(r, rkeys, hot, names), "left_anti")
    return out.unionByName(rest.join(rest_right, _on(rest, lkeys, rest_right, rkeys), how))


def left_join_on_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    *,
    right_columns: Mapping[str, str] | None = None,
    how: str = "left",
    skew: SkewSalt | None = None,
    split_nulls: bool = False,
) -> DataFrame:
    """``left ⟕ right`` on ``left[lk] = right[rk]`` for each ``(lk, rk)``.

    Only ``right_columns`` (``{right_name: output_name}``) of the right side
    are kept, so the right side is pruned before the exchange and no name
    can clash. Null keys never match; duplicate right keys fan out. The join
    is a plain equi-join, so later filters reach the left scan. With
    ``split_nulls`` the null-key rows of a join that keeps left rows pass
    beside the join instead of being shuffled to one partition. With ``skew``
    the right rows, and beyond a bound the left keys, are counted by a job at
    once (see the module's notes).
    """
    rkeys = [f"__rk{i}" for i in range(len(keys))]
    rsel = [F.col(rk).alias(rkeys[i]) for i, (_, rk) in enumerate(keys)]
    rcols = dict(right_columns or {})
    rsel += [F.col(src).alias(dst) for src, dst in rcols.items()]
    r = right.select(*rsel)
    lkeys = [lk for lk, _ in keys]
    if skew is not None:
        return _split_join(left, r, lkeys, rkeys, how, skew).drop(*rkeys)
    nulls = any_null(lkeys)
    inner = left.where(~nulls) if split_nulls and how in _KEEPS_LEFT else left
    joined = inner.join(r, _on(inner, lkeys, r, rkeys), how).drop(*rkeys)
    if inner is left:
        return joined
    empty = [F.lit(None).cast(r.schema[c].dataType).alias(c) for c in rcols.values()]
    return joined.unionByName(left.where(nulls).select(*left.columns, *empty))


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    lookup_value: str,
    out: str,
    *,
    default: str = "UNKNOWN",
    unique: bool = True,
    skew: SkewSalt | None = None,
) -> DataFrame:
    """Key -> value lookup with a default.

    A missing key, a null key, and a null or empty value all give
    ``default``. With ``unique=True`` the lookup is reduced to one value per
    key first (like a dictionary), so the lookup can never multiply rows; the
    reduction is hash-partitioned on the key, which the join then reuses.
    """
    lk = lookup.select(F.col(lookup_key).alias("__lk"), F.col(lookup_value).cast("string").alias("__lv"))
    if unique:
        lk = lk.where(F.col("__lk").isNotNull()).groupBy("__lk").agg(F.max("__lv").alias("__lv"))
    joined = left_join_on_keys(df, lk, [(key, "__lk")], right_columns={"__lv": "__lv"}, skew=skew)
    return joined.withColumn(out, default_if_blank(F.col("__lv"), default)).drop("__lv")

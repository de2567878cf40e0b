"""Quality filter by a learned decision list, in DataFrame expressions only.

Base counts are per-document array expressions. The list is learned by
sequential covering: a conjunction of thresholds grows by information gain on
one part of the labelled documents, is pruned on the other part, and joins
the list if its precision there is high enough; what it covers is set aside
and the next one grows. The result is an ordered conditional expression that
Catalyst compiles into the scan of the documents.

Labels are read from at most about `max_labelled` documents (by hash of the
id; a parameter). Features become quantile bins, and the counts per distinct
vector of bins are what the driver gets: as many rows as labelled documents
at most.

Edge cases: a null or empty text has no words and fails the base rule; a null
label or id is not used for learning; contradictory or repeated labels count
each; without labels, or with one class only, the list is empty and only the
base rules decide; an empty table gives an empty result; other columns are
kept or ignored as the functions say.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

BASE_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SPACES = r"[\x20\x09-\x0D]+"
MIN_WORDS = 50
MAX_LABELLED = 20_000
BINS = 16
FEATURES = ("n_words", "mean_word", "symbols", "marks", "capitals", "digits", "dup_lines", "repeats", "distinct_words")


_OWN = {*BASE_COUNTS, "_f", "_text", "_words", "_lines", "_grams", "_sorted", "_marks", "_capitals", "_digits", "_distinct", "_n_lines"}


def _matched(pattern: str) -> Column:
    return (F.length("_text") - F.length(F.regexp_replace("_text", pattern, ""))).cast("long")


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the base counts of the whole text, n_words .. n_repeat_words, and
    the column _f (a struct of FEATURES); columns of these names give way."""
    if {c.lower() for c in docs.columns} & _OWN:
        # the columns ride along in a struct, out of the way of the names used here
        held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{text_col}`").alias("text"))
        others = [F.col(f"_row.`{c}`").alias(c) for c in docs.columns if c.lower() not in (*BASE_COUNTS, "_f")]
        return with_counts(held).select(*others, *BASE_COUNTS, "_f")
    t = docs.withColumn("_text", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    t = t.withColumn("_words", F.array_remove(F.split("_text", SPACES), ""))
    t = t.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    t = t.withColumn("n_words", F.size("_words").cast("long"))
    t = t.withColumn(
        "_grams",
        F.expr("transform(slice(_words, 1, greatest(n_words - 2, 0L)), (w, i) -> xxhash64(w, get(_words, i + 1), get(_words, i + 2)))"),
    )
    # equal windows are neighbours once sorted; only texts that have some are sorted
    t = t.withColumn(
        "_sorted",
        F.expr(
            "CASE WHEN size(array_distinct(_grams)) < size(_grams) "
            "THEN sort_array(transform(_grams, (h, i) -> struct(h AS h, i AS i))) END"
        ),
    )
    twice = F.expr(
        "transform(filter(_sorted, (x, i) -> x.h <=> get(_sorted, i - 1).h OR x.h <=> get(_sorted, i + 1).h), "
        "x -> array(x.i, x.i + 1, x.i + 2))"
    )
    t = t.withColumns(
        {
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": _matched(r"[#*$%&|<>]+"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(F.flatten(twice)))).cast("long"),
            "_marks": _matched("[!?]+"),
            "_capitals": _matched("[A-Z]+"),
            "_digits": _matched("[0-9]+"),
            "_distinct": F.size(F.array_distinct("_words")),
            "_n_lines": F.size("_lines"),
        }
    )
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    values = {
        "n_words": F.col("n_words"),
        "mean_word": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / chars,
        "marks": F.col("_marks") / chars,
        "capitals": F.col("_capitals") / chars,
        "digits": F.col("_digits") / chars,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("_n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "distinct_words": F.col("_distinct") / words,
    }
    t = t.withColumn("_f", F.struct(*[values[f].cast("double").alias(f) for f in FEATURES]))
    # a generator of one row: later filters stay above it, instead of being
    # pushed down with the array expressions written out again inside
    return t.select(*[F.col(f"`{c}`") for c in docs.columns], F.inline(F.array(F.struct(*BASE_COUNTS, "_f"))))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        f = F.col(f"_f.{self.feature}")
        return f >= self.threshold if self.at_least else f < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered conjunctions; a document is rejected by the first it meets."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def rule_number(self) -> Column:
        """The number of the first rule met, from 1; null if none."""
        out = F.lit(None).cast("int")
        for k in range(len(self.rules), 0, -1):
            out = F.when(reduce(lambda a, b: a & b, [c.column() for c in self.rules[k - 1]]), F.lit(k)).otherwise(out)
        return out

    def __str__(self) -> str:
        return "\n".join(" and ".join(map(str, r)) for r in self.rules)


def _sample(labels: DataFrame, label_col: str, max_labelled: int) -> DataFrame:
    known = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label_col).cast("int").alias("_y")).where(
        "_id is not null and _y is not null"
    )
    share = min(1.0, max_labelled / max(1, known.count()))
    part = known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return stored(part, "quality_labels")


def _cells(docs: DataFrame, labels: DataFrame, label_col: str, max_labelled: int):
    """Thresholds per feature, and (bins, bad, good, part) of labelled documents."""
    sample = _sample(labels, label_col, max_labelled)
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text")).join(sample, "_id")
    rows = stored(with_counts(rows).select("_f", "_y", F.pmod(F.xxhash64("_id", F.lit(7)), F.lit(3)).alias("_part")), "quality_features")
    # thresholds at quantiles of either class, its extremes included
    points = [k / BINS for k in range(BINS + 1)]
    found = rows.groupBy("_y").agg(*[F.percentile_approx(f"_f.{f}", points, 10_000).alias(f) for f in FEATURES]).collect()
    cuts = {f: sorted({x for r in found for x in r[f]}) for f in FEATURES}
    binned = [_bin(f, cuts[f]).alias(f) for f in FEATURES]
    counted = rows.select(*binned, "_y", (F.col("_part") == 0).alias("_prune")).groupBy(*FEATURES, "_prune").agg(
        F.sum((F.col("_y") == 0).cast("long")).alias("bad"), F.sum((F.col("_y") != 0).cast("long")).alias("good")
    )
    cells = [(tuple(r[f] for f in FEATURES), r["bad"], r["good"], r["_prune"]) for r in counted.collect()]
    return cuts, cells


def _bin(feature: str, cuts: list[float]) -> Column:
    """How many of the ascending thresholds the feature reaches."""
    out = F.lit(0)
    for c in cuts:
        out = out + (F.col(f"_f.{feature}") >= float(c)).cast("int")
    return out


def _holds(bins: tuple[int, ...], rule) -> bool:
    return all((bins[f] >= b) == up for f, up, b in rule)


def _totals(cells) -> tuple[int, int]:
    return sum(c[1] for c in cells), sum(c[2] for c in cells)


def _precision(bad: int, good: int) -> float:
    return (bad + 1) / (bad + good + 2)


def _grow(cells, cuts, min_bad: int):
    """Add the condition of the highest information gain until no good document is left or none gains."""
    rule, inside = [], cells
    while True:
        bad, good = _totals(inside)
        if not good or bad < min_bad:
            return rule
        before, best = log2(bad / (bad + good)), (0.0, None)
        for f, name in enumerate(FEATURES):
            per_bin: dict[int, list[int]] = {}
            for c in inside:
                x = per_bin.setdefault(c[0][f], [0, 0])
                x[0] += c[1]
                x[1] += c[2]
            p = n = 0
            for b in range(1, len(cuts[name]) + 1):
                p, n = p + per_bin.get(b - 1, (0, 0))[0], n + per_bin.get(b - 1, (0, 0))[1]
                for up, (x, y) in ((False, (p, n)), (True, (bad - p, good - n))):
                    if x >= min_bad and (gain := x * (log2(x / (x + y)) - before)) > best[0] + 1e-9:
                        best = (gain, (f, up, b))
        if best[1] is None:
            return rule
        rule.append(best[1])
        inside = [c for c in inside if _holds(c[0], [best[1]])]


def _prune(rule, cells):
    """Drop final conditions while that does not lower the precision on the other part."""
    worth = lambda r: _precision(*_totals([c for c in cells if _holds(c[0], r)]))
    while len(rule) > 1 and worth(rule[:-1]) >= worth(rule):
        rule = rule[:-1]
    return rule


def learn(
    docs: DataFrame, labels: DataFrame, *, label_col: str = "quality", max_labelled: int = MAX_LABELLED, min_precision: float = 0.9, min_bad: int = 5
) -> DecisionList:
    """A decision list that rejects documents labelled 0."""
    cuts, cells = _cells(docs, labels, label_col, max_labelled)
    rules = []
    while True:
        grown = _grow([c for c in cells if not c[3]], cuts, min_bad)
        if not grown:
            break
        rule = _prune(grown, [c for c in cells if c[3]])
        # judged on the part that it was not grown on
        judged = _totals([c for c in cells if c[3] and _holds(c[0], rule)])
        if _precision(*judged) < min_precision or judged[0] < min_bad:
            break
        rules.append(tuple(Condition(FEATURES[f], up, float(cuts[FEATURES[f]][b - 1])) for f, up, b in rule))
        cells = [c for c in cells if not _holds(c[0], rule)]
    return DecisionList(tuple(rules))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, rule (number of the rejecting rule) and kept."""
    found = learn(docs, labels)
    out = with_counts(docs.select("doc_id", "text")).withColumn("base_failed", base_failed()).withColumn("rule", found.rule_number())
    return out.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "rule",
        (~F.col("base_failed") & F.col("rule").isNull()).alias("kept"),
    )


def quality_filter(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass the base rules and the learned list, columns unchanged."""
    found = learn(docs, labels)
    # the columns ride along in a struct, so their names cannot clash with the counts
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text"))
    kept = with_counts(rows).where(~base_failed() & found.rule_number().isNull())
    return kept.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])

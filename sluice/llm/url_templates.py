"""URL filter by path templates, in DataFrame expressions only.

Each host has a tree of path segments. Segments that vary by form (numbers,
hex strings, mixed ids) become wildcards at once; a branch point with more than
24 different children (counted exactly) becomes one wildcard child, down to the
deepest path. Branches whose share of blocked pages does not differ
significantly from their siblings' are merged into a wildcard too, at every
depth that has siblings, the deepest first; jobs run for such depths only. Every url that an explicit rule judges is a labelled
example. A template is rejected if its purity, the share of blocked examples
smoothed towards the same template over all hosts (a host without examples
keeps literal names, so merged branches count under theirs too) and then towards the whole
table, is above one half. Urls without a rule get their template's verdict.

Statistics are partially aggregated per (host, template); a host that holds a
third of the pages costs a row per template and task. They come back by joins
of stored tables, which the adaptive skew join can split.

Edge cases: a null url, or one without `://`, has empty host and path and the
template of the empty path; hosts and paths are never null; repeated urls
count each; without any labelled url everything else is allowed; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: (verdict, host and path); fixed values of the query
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MANY_CHILDREN = 24
SMOOTHING = 8.0
_Z = 1.96


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, _UPPER, _LOWER), path


def matching_rule(rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits `host` and `path`, and its verdict; else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: len(r[1])):
        h, _, p = rule.partition("/")
        fits = ((F.col("host") == h) | F.col("host").endswith(f".{h}")) & F.col("path").startswith(f"/{p}")
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


# wildcards of segments that vary by form; a file's suffix stays
_STEM = "substring(s, 1, length(s) - length(regexp_extract(s, '([.][A-Za-z]{2,5})$', 1)))"
_TAIL = "regexp_extract(s, '([.][A-Za-z]{2,5})$', 1)"
_FORM_SQL = (
    f"CASE WHEN {_STEM} RLIKE '^[0-9]+$' THEN concat('{{n}}', {_TAIL}) "
    f"WHEN {_STEM} RLIKE '^[0-9a-fA-F-]{{8,}}$' THEN concat('{{hex}}', {_TAIL}) "
    f"WHEN {_STEM} RLIKE '[0-9]' AND length({_STEM}) >= 6 THEN concat('{{id}}', {_TAIL}) ELSE s END"
)


def _segments() -> Column:
    return F.expr(f"transform(filter(split(path, '/'), s -> s != ''), s -> {_FORM_SQL})")


def _paths(pages: DataFrame) -> DataFrame:
    """Distinct (host, segments) with the number of pages, examples and blocked examples."""
    return pages.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("rule").isNotNull().cast("long")).alias("examples"),
        F.sum((F.coalesce(F.col("rule_verdict"), F.lit("")) == "block").cast("long")).alias("blocked"),
    )


def _wide_depths(paths: DataFrame) -> list[int]:
    """Depths at which some host has more than MANY_CHILDREN different segments:
    no branch point elsewhere can have as many."""
    each = paths.select("host", F.posexplode("segments").alias("depth", "segment")).distinct()
    found = each.groupBy("host", "depth").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MANY_CHILDREN)
    return sorted(r["depth"] for r in found.select("depth").distinct().collect())


def _generalise(paths: DataFrame) -> DataFrame:
    """`template` (segments) of every path: from the first segments down, the
    children of a branch point with many become a wildcard. Only depths that can
    have such a point are looked at, whatever the length of the paths."""
    out = paths.withColumn("template", F.col("segments"))
    for depth in _wide_depths(paths):
        prefix = F.expr(f"slice(template, 1, {depth})")
        below = out.where(F.size("template") > depth).select("host", prefix.alias("prefix"), F.get("segments", F.lit(depth)).alias("child"))
        points = below.distinct().groupBy("host", "prefix").agg(F.count(F.lit(1)).alias("children"))
        points = stored(points.where(F.col("children") > MANY_CHILDREN).select("host", "prefix", F.lit(True).alias("wide")), "url_points")
        general = F.expr(f"concat(slice(template, 1, {depth}), array('*'), slice(template, {depth + 2}, size(template)))")
        out = stored(
            out.withColumn("prefix", prefix)
            .join(points, ["host", "prefix"], "left")
            .withColumn("template", F.when(F.col("wide") & (F.size("template") > depth), general).otherwise(F.col("template")))
            .drop("prefix", "wide"),
            "url_paths",
        )
    return out


def _joined(template: str) -> Column:
    return F.concat_ws("/", F.lit(""), F.col(template))


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "examples", "blocked")])


def _merge_level(stats: DataFrame, depth: int) -> DataFrame:
    """host, merged, general: the templates whose literal segment at `depth`
    becomes a wildcard, as their share of blocked examples does not differ
    from that of their siblings."""
    general = F.expr(f"concat(slice(merged, 1, {depth}), array('*'), slice(merged, {depth + 2}, size(merged)))")
    literal = ~F.coalesce(F.get("merged", F.lit(depth)), F.lit("*")).rlike(r"^([*]$|\{(n|hex|id)\})")
    # a branch without examples of its own keeps its literal name, and adds nothing to its siblings' sums
    branches = _sums(stats.where(literal & (F.col("examples") > 0)), "host", "merged").withColumn("general", general)
    branches = stored(branches, "url_branches")
    pooled = _sums(branches, "host", "general").select(
        "host", "general", F.col("examples").alias("all_examples"), F.col("blocked").alias("all_blocked")
    )
    both = branches.join(stored(pooled, "url_pooled"), ["host", "general"])
    rest_n, rest_b = F.col("all_examples") - F.col("examples"), F.col("all_blocked") - F.col("blocked")
    share = F.col("all_blocked") / F.col("all_examples")
    gap = F.col("blocked") / F.col("examples") - rest_b / F.greatest(rest_n, F.lit(1))
    error = F.sqrt(share * (1 - share) * (1 / F.col("examples") + 1 / F.greatest(rest_n, F.lit(1))))
    # nor does a branch change that has no siblings to compare
    return both.where((rest_n > 0) & (F.abs(gap) <= _Z * error)).select("host", "merged", "general")


def _sibling_depths(stats: DataFrame) -> list[int]:
    """Depths at which two templates with examples, of one host and length and
    alike before, differ: elsewhere a segment has no siblings to merge with."""
    some = stats.where("examples > 0").select("host", F.size("template").alias("size"), "template")
    each = some.select("host", "size", "template", F.posexplode("template").alias("depth", "segment"))
    # equal hashes of different beginnings can only add a depth to look at
    before = F.expr("xxhash64(slice(template, 1, depth))")
    found = each.groupBy("host", "size", "depth", before.alias("before")).agg(F.min("segment").alias("a"), F.max("segment").alias("b"))
    return sorted(r["depth"] for r in found.where("a <> b").select("depth").distinct().collect())


def _merge(stats: DataFrame) -> DataFrame:
    """`merged` template per (host, template): from the deepest segments up,
    literal branches join their similar siblings as wildcards."""
    out = stats.withColumn("merged", F.col("template"))
    for depth in reversed(_sibling_depths(stats)):
        step = stored(_merge_level(out, depth), "url_step")
        if step.isEmpty():
            continue
        out = out.join(step, ["host", "merged"], "left").withColumn("merged", F.coalesce("general", "merged")).drop("general")
        out = stored(out, "url_merged")
    return out


def template_verdicts(pages: DataFrame) -> DataFrame:
    """host, segments, template, purity of every distinct path."""
    paths = _generalise(stored(_paths(pages), "url_paths"))
    merged = stored(
        _merge(stored(_sums(paths, "host", "template"), "url_templates")).withColumns({c: _joined(c) for c in ("template", "merged")}),
        "url_merged",
    )
    by_host = _sums(merged, "host", "merged")
    # a template's examples over all hosts; what a host merged still counts under its literal name for hosts that did not
    named = merged.unionByName(merged.where("template <> merged").withColumn("merged", F.col("template")))
    everywhere = stored(
        _sums(named, "merged").select("merged", F.col("examples").alias("g_examples"), F.col("blocked").alias("g_blocked")), "url_general"
    )
    total = merged.agg(F.sum("examples").alias("t_examples"), F.sum("blocked").alias("t_blocked")).first()
    prior = (total["t_blocked"] or 0) / max(total["t_examples"] or 0, 1)
    general = (F.col("g_blocked") + SMOOTHING * prior) / (F.col("g_examples") + SMOOTHING)
    purity = (F.col("blocked") + SMOOTHING * general) / (F.col("examples") + SMOOTHING)
    scored = stored(by_host.join(everywhere, "merged").select("host", "merged", purity.alias("purity")), "url_purity")
    paths = paths.withColumn("template", _joined("template"))
    named = paths.select("host", "segments", "template").join(merged.select("host", "template", "merged"), ["host", "template"])
    return named.join(scored, ["host", "merged"]).select("host", "segments", F.col("merged").alias("template"), "purity")


def judge_urls(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", rules=RULES, cut: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity."""
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("_url"))
    host, path = host_and_path(F.col("_url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("rule_verdict"), _segments().alias("segments"))
    known = stored(template_verdicts(rows), "url_verdicts")
    learned = F.when(F.col("purity") > cut, "block").otherwise("allow")
    return rows.join(known, ["host", "segments"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", learned).alias("verdict"), "template", "purity"
    )

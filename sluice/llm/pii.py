"""Personal data: fixed-form entities, and more by bootstrapped contexts.

One narrow scan finds the base entities (email, ip, card, phone) of whole
texts and the identifier-like tokens beside them (four or more characters, one
of them a digit). Both are instances, with the one and the two words to their
left on the line, alone and with the form of the instance, as patterns. Every
base entity is a seed. Spark then works on the graph of patterns and instances:
a pattern's confidence is the smoothed share of its occurrences that are known
instances, an instance's score is the noisy-or of its confident patterns; both
alternate until a round makes no pattern confident and no instance known that
was not. Tokens in confident patterns, and confident instances anywhere, are
the discovered spans. Base spans always stay.

Pattern and instance statistics are partially aggregated sums over all
documents; scores return by joins of stored tables. Only the token graph is
shuffled, never the texts.

Edge cases: a null or empty text has no spans; spans are in code points of
the whole text; a discovered span never meets a base span; equal rows get
equal results; a null doc_id is an ordinary value; without seeds or candidates
nothing is discovered; an empty table gives an empty result; other columns are
kept by `redact`, whatever their names, and ignored by `find_pii`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import prepare, stored

KINDS = ("email", "ip", "card", "phone")
_EMAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match starts with a whole digit run: from inside one, the rest would match or fail alike
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<![A-Za-z0-9@._%+-])(?=[A-Za-z@._%+-]*[0-9])[A-Za-z0-9@._%+-]{4,}")
_LEFT = re.compile(r"[^\W\d_]+|[=:#]")
LEAST_CHARS = 4

MIN_SUPPORT = 5
MIN_CONFIDENCE = 0.8
SMOOTHING = 1.0
KNOWN = 0.5


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Each address found from its @: the local part reaches back to the last match or other character."""
    floor, at = 0, text.find("@")
    while at >= 0:
        if m := _EMAIL.match(text, at):
            start = at
            while start > floor and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                yield start, m.end()
                floor = m.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        x = int(d) * (1 + k % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base entities by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _digits(m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _form(token: str) -> str:
    """What a token is made of, and its length up to a power of two."""
    kinds = "".join(
        n for n, r in (("d", "[0-9]"), ("l", "[a-z]"), ("u", "[A-Z]"), ("@", "@"), (".", r"\."), ("-", "[-_%+]")) if re.search(r, token)
    )
    return f"{kinds}{len(token).bit_length()}"


def _instances(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int, str | None]]:
    """Base entities and identifier-like tokens that meet none, by start."""
    out: list[tuple[int, int, str | None]] = [(a, b, k) for k, a, b in base]
    # base spans as one ascending list of covered stretches
    covered: list[list[int]] = []
    for a, b, _ in sorted(out):
        if covered and a < covered[-1][1]:
            covered[-1][1] = max(covered[-1][1], b)
        else:
            covered.append([a, b])
    at = 0
    for m in _TOKEN.finditer(text):
        start, end = m.start(), m.end()
        while end > start and text[end - 1] in ".-%+":
            end -= 1
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if end - start >= LEAST_CHARS and (at == len(covered) or covered[at][0] >= end):
            out.append((start, end, None))
    return sorted(out, key=lambda x: x[:2])


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Instances with their patterns; kind is null where it is not known."""
    out = []
    seen, left = 0, []  # the words of the line before `seen`
    for start, end, kind in _instances(text, base):
        if start > seen:
            line = text.rfind("\n", seen, start) + 1
            if line:
                seen, left = line, []
            left = (left + _LEFT.findall(text, seen, start))[-2:]
            seen = start
        if left:
            token = text[start:end]
            words = {left[-1].lower(), " ".join(left).lower()}
            form = _form(token)
            patterns = sorted(words | {f"{w} <{form}>" for w in words})
            out.append({"start": start, "end": end, "token": token, "patterns": patterns, "kind": kind})
    return out


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_CANDIDATES = "array<struct<start:long,end:long,token:string,patterns:array<string>,kind:string>>"
_ARROW_CANDIDATES = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), ("token", pa.string()), ("patterns", pa.list_(pa.string())), ("kind", pa.string())])
)


def _scan(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, 1024):
            part = batch.slice(i, 1024)
            base, found = [], []
            for t in part.column("text"):
                text = t.as_py() or ""
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                found.append(candidates(text, spans))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("k1"), part.column("k2"), pa.array(base, _ARROW_SPANS), pa.array(found, _ARROW_CANDIDATES)],
                names=["doc_id", "k1", "k2", "base", "candidates"],
            )


KEY = ["k1", "k2"]


def _key(id_col: str, text_col: str) -> list[Column]:
    """128 bits of id and text: equal rows have one key, others their own."""
    row = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    return [F.xxhash64(*row).alias("k1"), F.xxhash64(F.lit("k2"), *row).alias("k2")]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, k1, k2, base spans and candidates of every row, stored."""
    prepare(docs)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *_key(id_col, text_col))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, k1 long, k2 long, base {_SPANS.simpleString()}, candidates {_CANDIDATES}"
    return stored(rows.mapInArrow(_scan, schema), "pii_scan")


def bootstrap(scanned: DataFrame, *, min_support: int = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """k1, k2 and spans (kind, start, end) of the discovered entities."""
    each = scanned.select(*KEY, F.explode("candidates").alias("c")).select(*KEY, "c.*").distinct()
    tokens = stored(each, "pii_candidates")
    edges = tokens.select(F.explode("patterns").alias("pattern"), "token", "kind").groupBy("pattern", "token").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("kind").isNotNull().cast("double")).alias("score"), F.max("kind").alias("kind")
    )
    edges, patterns, before = stored(edges, "pii_edges"), None, None
    while True:
        known = F.col("score") >= KNOWN
        scored = edges.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / (F.sum("n") + SMOOTHING)).alias("confidence"),
            F.sum(known.cast("long")).alias("support"),
            F.max(F.when(known, F.col("kind"))).alias("pattern_kind"),
        )
        patterns = stored(
            scored.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)).drop("support"), "pii_patterns"
        )
        # scores never fall, so equal numbers are equal sets
        state = (patterns.count(), edges.where(known).count())
        if state == before or not state[0]:
            break
        before = state
        miss = F.greatest(1 - F.col("confidence"), F.lit(1e-6))
        reached = edges.join(patterns, "pattern").groupBy("token").agg(
            (1 - F.exp(F.sum(F.log(miss)))).alias("reached"), F.max("pattern_kind").alias("reached_kind")
        )
        reached = stored(reached, "pii_instances")
        edges = stored(
            edges.join(reached, "token", "left").select(
                "pattern",
                "token",
                "n",
                F.greatest("score", F.coalesce("reached", F.lit(0.0))).alias("score"),
                F.coalesce("kind", "reached_kind").alias("kind"),
            ),
            "pii_edges",
        )
    new = tokens.where("kind is null").drop("kind")
    place = [*KEY, "start", "end"]
    by_pattern = new.select(*place, F.explode("patterns").alias("pattern")).join(patterns, "pattern").select(*place, F.col("pattern_kind").alias("kind"))
    instances = stored(
        edges.where(F.col("score") >= min_confidence).groupBy("token").agg(F.max("kind").alias("kind")), "pii_instances"
    )
    by_token = new.select(*place, "token").join(instances, "token").select(*place, "kind")
    spans = by_pattern.unionByName(by_token).groupBy(*place).agg(F.max("kind").alias("kind"))
    found = F.struct(F.concat(F.lit("found_"), F.col("kind")).alias("kind"), "start", "end")
    return stored(spans.groupBy(*KEY).agg(F.array_sort(F.collect_list(found)).alias("found")), "pii_found")


def _joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, spans (base, then found)."""
    scanned = scan(docs, id_col, text_col)
    out = scanned.select("doc_id", *KEY, "base").join(bootstrap(scanned), KEY, "left")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    everything = F.concat("base", F.coalesce("found", F.array().cast(_SPANS)))
    return out.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(everything).alias("spans"))


def _replace(batches):
    for batch in batches:
        out = []
        for text, more in zip(batch.column("text"), batch.column("found").to_pylist(), strict=True):
            t = text.as_py()
            if not t:
                out.append(t)
                continue
            spans = sorted([(a, b, k) for k, a, b in base_spans(t)] + [(s["start"], s["end"], s["kind"]) for s in more or ()])
            parts, at = [], 0
            for a, b, k in spans:
                if a >= at:
                    parts += [t[at:a], f"[{k.removeprefix('found_').upper()}]"]
                at = max(at, b)
            out.append("".join([*parts, t[at:]]) if spans else t)
        yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(out, pa.string())], names=["kept", "text"])


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with every span replaced by its kind in brackets; other columns unchanged."""
    columns = docs.columns
    others = [F.col(f"`{c}`") for c in columns if c != text_col]
    found = bootstrap(scan(docs, id_col, text_col))
    # the columns ride along one level down, beside a field that is there in any case
    row = F.struct(F.lit(0).alias("pad"), *([F.struct(*others).alias("row")] if others else []))
    rows = docs.select(row.alias("kept"), F.col(f"`{text_col}`").alias("text"), *_key(id_col, text_col)).join(found, KEY, "left")
    done = rows.select("kept", "text", "found").mapInArrow(_replace, T.StructType(rows.select("kept", "text").schema.fields))
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"kept.row.`{c}`").alias(c) for c in columns])

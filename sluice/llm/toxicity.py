"""Toxicity score by a weighted lexicon.

Texts are folded first: lower case, look-alike letters and digits to Latin
letters, marks and invisible characters dropped, everything else a space. The
lexicon holds word beginnings and whole words, learned from labelled
documents: candidates are those in enough toxic documents, weighted by the
log ratio of their document shares; the shortest precise beginning stands for
all that start with it. Words that start like an entry, and pairs of words
with one that an entry hits, become exceptions if commoner in clean documents
than in toxic ones; they are counted over the whole sample once the entries
are known. A pair must be so by its smoothed weight, as most pairs are rare.
All documents are scanned
with one Aho-Corasick automaton of entries and exceptions; an entry inside an
exception does not count. The weight of what is left, and that weight by the
text's length, go through a logistic curve fitted on the labelled sample.

Labels are read from about `max_labelled` documents at most (by hash of the
id; a parameter), of those whose crc32(doc_id as text) mod 5 is not 0. Two
candidate counts and one of exceptions are taken over that sample in Spark;
the driver gets the entries, the exceptions and two numbers per sampled
document.

Edge cases: a null or empty text has no words and scores the curve's value at
zero; null labels or ids are not used for learning and a null id counts as
held out; several labels of a document count as toxic if one is; without
labels of both kinds the score is 0; repeated rows stay; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import unicodedata
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare, stored

MAX_LABELLED = 20_000
SHORTEST, LONGEST = 3, 8
MIN_DOCS = 4
MIN_SHARE = 0.001
MIN_PRECISION = 0.85

#: Look-alikes of Latin letters, digits and signs used for letters (fixed values)
LOOKALIKES = dict(
    zip(
        "абвгеікмнорстухѕјԁһӏ" + "αβεηικνορτυχ" + "0134578@$",
        "abbreikmhopctyxsjdhl" + "abenikvoptux" + "oieastbas",
        strict=True,
    )
)
_ASCII = {c: " " for c in range(128)} | {c: chr(c) for c in range(97, 123)} | {c: chr(c + 32) for c in range(65, 91)}
_ASCII |= {ord(k): v for k, v in LOOKALIKES.items() if k.isascii()}


class _Folding(dict):
    """Folded form of each code point, worked out once per worker."""

    def __missing__(self, code: int) -> str:
        out = []
        for c in unicodedata.normalize("NFKD", chr(code).lower()):
            c = LOOKALIKES.get(c, c)
            kind = unicodedata.category(c)
            if kind[0] == "L":
                out.append(c)
            elif kind not in ("Mn", "Cf"):
                out.append(_ASCII.get(ord(c), " "))
        self[code] = value = "".join(out)
        return value


_FOLD = _Folding(_ASCII)


def fold(text: str) -> str:
    """Folded words, each with a space before it, and one space at the end."""
    return f" {text.translate(_FOLD)} "


def _features(text: str) -> set[str]:
    """Beginnings and whole words (marked by a space) of a text's distinct words."""
    words = set(fold(text).split())
    out = {f"{w} " for w in words if len(w) >= SHORTEST}
    for n in range(SHORTEST, LONGEST + 1):
        out.update(w[:n] for w in words if len(w) >= n)
    return out


def _count_features(among):
    def run(batches):
        wanted = among.value if among is not None else None
        for batch in batches:
            counts: Counter = Counter()
            for t in batch.column("text"):
                found = _features(t.as_py() or "")
                counts.update(found if wanted is None else found & wanted)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["feature", "n"]
            )

    return run


def _document_counts(texts: DataFrame, among=None) -> DataFrame:
    return texts.mapInArrow(_count_features(among), "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


class Lexicon:
    def __init__(self, entries: dict[str, float], exceptions: set[str]):
        self.entries, self.exceptions = entries, exceptions
        self._automaton = None

    def __getstate__(self):
        return {"entries": self.entries, "exceptions": self.exceptions, "_automaton": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            found = ahocorasick.Automaton()
            for e, w in self.entries.items():
                found.add_word(f" {e}", (len(e) + 1, w))
            for e in self.exceptions:
                found.add_word(f" {e} ", (len(e) + 2, None))
            found.make_automaton()
            self._automaton = found
        return self._automaton

    def weigh(self, text: str) -> tuple[float, int]:
        """Weight of the hits outside exceptions, and the number of words."""
        words = fold(text).split()
        folded, n = f" {' '.join(words)} ", len(words)
        if not self.entries:
            return 0.0, n
        hits, skip = [], []
        for last, (size, weight) in self.automaton().iter(folded):
            (hits if weight is not None else skip).append((last + 1 - size, last + 1, weight))
        if skip:
            skip.sort(key=lambda s: s[0])
            # the furthest end of the exceptions that start no later
            starts, ends = [s[0] for s in skip], list(accumulate((s[1] for s in skip), max))
            hits = [h for h in hits if not ((i := bisect_right(starts, h[0])) and h[1] <= ends[i - 1])]
        return sum(h[2] for h in hits), n


def _phrases(text: str, entries, known: dict[str, tuple[bool, bool]]) -> set[str]:
    """A text's distinct words that start with an entry, and its pairs of words with one that an entry hits."""
    out, before, hit_before = set(), "", False
    for w in fold(text).split():
        if (found := known.get(w)) is None:
            starts = any(w[:k] in entries for k in range(SHORTEST, min(len(w), LONGEST) + 1))
            found = known[w] = (starts, starts or f"{w} " in entries)
        starts, hit = found
        if starts:
            out.add(w)
        if before and (hit or hit_before):
            out.add(f"{before} {w}")
        before, hit_before = w, hit
    return out


def _count_phrases(entries):
    def run(batches):
        among, known = entries.value, {}
        for batch in batches:
            counts: Counter = Counter()
            for t, y in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                counts.update((p, y) for p in _phrases(t.as_py() or "", among, known))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in counts], pa.string()),
                    pa.array([n if y else 0 for (_, y), n in counts.items()], pa.int64()),
                    pa.array([0 if y else n for (_, y), n in counts.items()], pa.int64()),
                ],
                names=["phrase", "toxic", "clean"],
            )

    return run


def learn_exceptions(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int, entries: dict[str, float]) -> set[str]:
    """Words and pairs of words that hold an entry's hit and are commoner in clean documents."""
    texts = toxic.select("text", F.lit(1).alias("toxic")).unionByName(clean.select("text", F.lit(0).alias("toxic")))
    among = toxic.sparkSession.sparkContext.broadcast(frozenset(entries))
    counts = texts.mapInArrow(_count_phrases(among), "phrase string, toxic long, clean long").groupBy("phrase")
    counts = counts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    pair = F.instr("phrase", " ") > 0
    half = F.when(pair, 0.5).otherwise(0.0)  # the weights' smoothing
    commoner = (F.col("clean") + half) / max(n_clean, 1) > (F.col("toxic") + half) / n_toxic
    found = {r["phrase"] for r in counts.where(commoner).select("phrase").collect()}

    def needed(phrase: str) -> bool:
        """Whether a pair takes out a hit that its words do not."""
        return any(
            w not in found and (f"{w} " in entries or any(w[:k] in entries for k in range(SHORTEST, min(len(w), LONGEST) + 1)))
            for w in phrase.split()
        )

    return {p for p in found if " " not in p or needed(p)}


def learn_lexicon(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> Lexicon:
    """Entries and exceptions from documents with a column `text`."""
    sc = toxic.sparkSession.sparkContext
    least = max(MIN_DOCS, math.ceil(MIN_SHARE * n_toxic))
    rows = _document_counts(toxic).where(F.col("n") >= least).collect()
    seen = {r["feature"]: r["n"] for r in rows}
    among = sc.broadcast(frozenset(seen))
    other = {r["feature"]: r["n"] for r in _document_counts(clean, among).collect()}
    # compare shares of documents, so the precision does not hang on how many of each are labelled
    share = {f: (n / n_toxic, other.get(f, 0) / max(n_clean, 1)) for f, n in seen.items()}
    entries: dict[str, float] = {}
    for f in sorted(seen, key=lambda f: (len(f.strip()), f)):
        a, b = share[f]
        if any(f[:k] in entries for k in range(SHORTEST, len(f))) or seen[f] / (seen[f] + other.get(f, 0) + 0.5) < MIN_PRECISION:
            continue
        entries[f] = math.log((a + 0.5 / n_toxic) / (b + 0.5 / max(n_clean, 1)))
    entries = {f: w for f, w in entries.items() if w > 0}
    return Lexicon(entries, learn_exceptions(toxic, clean, n_toxic, n_clean, entries) if entries else set())


def _weigh(lexicon):
    def run(batches):
        lex = lexicon.value
        for batch in batches:
            found = [lex.weigh(t.as_py() or "") for t in batch.column("text")]
            keep = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in keep], pa.array([f[0] for f in found], pa.float64()), pa.array([f[1] for f in found], pa.int64())],
                names=[*keep, "weight", "n_words"],
            )

    return run


def _inputs(weight, n_words):
    """The weight, and the weight per hundred words, both damped."""
    return [F.log1p(weight), F.log1p(100 * weight / F.greatest(n_words, F.lit(1)))]


def _fit_curve(rows) -> list[float]:
    """Logistic coefficients by Newton steps with a small ridge."""
    x = np.array([[1.0, r["a"], r["b"]] for r in rows])
    y = np.array([r["toxic"] for r in rows], dtype=float)
    c = np.zeros(3)
    ridge = np.diag([1e-3, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ c)
        c += step
        if np.abs(step).max() < 1e-8:
            break
    return c.tolist()


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0, F.lit(True))


def _labelled(labels: DataFrame, max_labelled: int) -> DataFrame:
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, max_labelled / max(1, known.count()))
    return stored(known.where(F.pmod(F.xxhash64("_id"), F.lit(1_000_000)) < int(share * 1_000_000)), "toxicity_labels")


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED):
    """(lexicon, coefficients) from the labelled documents outside the held-out fold."""
    sc = prepare(docs).sparkContext
    sample = _labelled(labels, max_labelled)
    # the sample is bounded by `max_labelled`, two numbers a row
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("_id"), "text").join(F.broadcast(sample), "_id"), "toxicity_texts")
    counts = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts.get(1) or not counts.get(0):
        return Lexicon({}, set()), None
    split = {y: texts.where(F.col("toxic") == y).select("text") for y in (0, 1)}
    lexicon = learn_lexicon(split[1], split[0], counts[1], counts[0])
    weighed = texts.select("toxic", "text").mapInArrow(_weigh(sc.broadcast(lexicon)), "toxic int, weight double, n_words long")
    a, b = _inputs(F.col("weight"), F.col("n_words"))
    return lexicon, _fit_curve(weighed.select("toxic", a.alias("a"), b.alias("b")).collect())


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", max_labelled: int = MAX_LABELLED
) -> DataFrame:
    """doc_id, held_out, score, predicted, weight, n_words."""
    spark = prepare(docs)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    lexicon, curve = fit(rows, labels, max_labelled)
    found = rows.mapInArrow(_weigh(spark.sparkContext.broadcast(lexicon)), "doc_id long, weight double, n_words long")
    if curve is None:
        score = F.lit(0.0)
    else:
        a, b = _inputs(F.col("weight"), F.col("n_words"))
        score = 1 / (1 + F.exp(-(F.lit(curve[0]) + curve[1] * a + curve[2] * b)))
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "weight", "n_words")

"""Toxicity scores against a plain scan, and on labels that were not learned from."""

import math
import zlib

import pytest

from sluice.llm import toxicity

from .test_operators import EDGE_TEXTS, SF, same


def _plain(text, lexicon, curve):
    words = toxicity.fold(text or "").split()
    folded = f" {' '.join(words)} "
    spans = lambda term: [(i, i + len(term)) for i in range(len(folded)) if folded.startswith(term, i)]
    skip = [s for e in lexicon.exceptions for s in spans(f" {e} ")]
    weight = sum(
        w for e, w in lexicon.entries.items() for a, b in spans(f" {e}") if not any(x <= a and b <= y for x, y in skip)
    )
    a, b = math.log1p(weight), math.log1p(100 * weight / max(len(words), 1))
    return 1 / (1 + math.exp(-(curve[0] + curve[1] * a + curve[2] * b)))


def test_scores_equal_a_plain_scan(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    some = [tuple(r) for r in docs.limit(150).collect()]
    lexicon, curve = toxicity.fit(docs, labels)
    assert lexicon.entries and curve
    entry = sorted(lexicon.entries)[0]
    lexicon.exceptions.add(f"{entry.strip()}ish ok")
    more = [*EDGE_TEXTS, entry * 3, f"{entry}ish ok", f"{entry}ish no {entry}ish ok {entry}", f"x{entry}"]
    rows = some + [(50_000 + i, t) for i, t in enumerate(more)] + [(None, entry)]
    broadcast = spark.sparkContext.broadcast(lexicon)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = df.mapInArrow(toxicity._weigh(broadcast), "doc_id long, weight double, n_words long").collect()
    assert len(found) == len(rows)
    scores = {}
    for r in found:
        a, b = math.log1p(r.weight), math.log1p(100 * r.weight / max(r.n_words, 1))
        scores.setdefault(r.doc_id, 1 / (1 + math.exp(-(curve[0] + curve[1] * a + curve[2] * b))))
    for doc, text in rows:
        assert math.isclose(scores[doc], _plain(text, lexicon, curve), rel_tol=1e-9), (doc, text)


def test_the_query_s_columns_follow_from_its_weights(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lexicon, curve = toxicity.fit(docs.select("doc_id", "text"), labels)
    want = []
    for r in docs.select("doc_id", "text").collect():
        score = _plain(r.text, lexicon, curve) if curve else 0.0
        want.append((r.doc_id, zlib.crc32(str(r.doc_id).encode()) % 5 == 0, score, int(score >= 0.5)))
    same(toxicity.toxicity_scores(docs, labels).select("doc_id", "held_out", "score", "predicted"), want, digits=9)


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out_labels(spark, sf):
    """Of the labelled documents outside the learning sample: nearly all alarms are right, and most toxic ones are found."""
    path = SF.replace("sf0.001", sf)
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.toxicity_scores(docs, labels).where("held_out").join(labels.where("toxic is not null"), "doc_id")
    n = {(r.toxic, r.predicted): r["count"] for r in found.groupBy("toxic", "predicted").count().collect()}
    assert n[1, 1] >= 0.7 * (n[1, 1] + n[1, 0]) and n.get((0, 1), 0) <= 0.01 * (n.get((0, 1), 0) + n[0, 0])

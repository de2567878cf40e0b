"""The pipeline against a chain of plain versions, stage by stage and whole; the learned quality list against a plain one."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm import pii, quality_rules

from . import brute
from .test_operators import EDGE_TEXTS, SF, _passages, _tiktoken, same


def _quality_kept(rows, found):
    def meets(text):
        x = brute.quality_features(text)
        return any(all((x[c.feature] >= c.threshold) == c.at_least for c in rule) for rule in found.rules)

    return [r for r in rows if not brute.quality_counts(r[1])[-1] and not meets(r[1])]


def _decontaminated(rows, items):
    out = []
    for (doc, text), hit in zip(rows, brute.hit_words(rows, items), strict=True):
        places = [m.span() for m in brute.ALNUM.finditer(brute.lower(text))]
        if len(hit) > 0.5 * len(places):
            continue
        parts, at = [], 0
        for k in sorted(hit):
            if k - 1 not in hit:
                parts.append(text[at : places[k][0]])
            at = places[k][1]
        out.append((doc, "".join([*parts, text[at:]]) if hit else text))
    return out


def _redacted(text, spans):
    parts, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2], s[0])):
        if a >= at:
            parts += [text[at:a], f"[{kind.removeprefix('found_').upper()}]"]
        at = max(at, b)
    return "".join([*parts, text[at:]]) if spans else text


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """The sample tables with edge rows: nulls, repeated rows, two texts under one id."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(2)
    prose = " ".join(f"{rng.choice('abcdefgh')}{rng.randint(0, 999)}word" for _ in range(90))
    other = " ".join(f"{rng.choice('stuvwxyz')}{rng.randint(0, 999)}word" for _ in range(90))
    more = [(10_000 + i, t) for i, t in enumerate(_passages()[:20] + EDGE_TEXTS)]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    more += [(None, prose), (None, None), (20_000, prose), (20_000, other), (20_001, prose), (20_002, other), (20_002, other)]
    more += [(20_003, f"{other} {items[0][1]} {prose}"), (20_004, f"{prose} mail to someone@example.org now {other}")]
    extra = spark.createDataFrame(more, "doc_id long, text string")
    for c in docs.columns[2:]:
        extra = extra.withColumn(c, F.lit(None).cast(docs.schema[c].dataType))
    docs.unionByName(extra).repartition(3).write.parquet(f"{path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    return path, sample + more, items


def _pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_every_stage_and_the_whole_equal_the_plain_chain(spark, sf_dir):
    path, rows, items = sf_dir
    docs = spark.read.parquet(f"{path}/documents.parquet")
    labels = spark.read.parquet(f"{path}/labels.parquet")
    stage = dict(corpus_pipeline.STAGES)
    assert list(stage) == ["quality rules", "SimHash near-dedup", "benchmark decontamination", "PII", "byte-level BPE"]

    def step(name, docs):
        out = stage[name](spark, docs, path)
        assert out.columns == docs.columns
        return corpus_pipeline.stored(out, "pipeline_test")

    kept = step("quality rules", docs)
    rows = _quality_kept(rows, quality_rules.learn(docs, labels))
    assert _pairs(kept) == sorted(rows, key=str) and len(rows) < docs.count()

    single = step("SimHash near-dedup", kept)
    want = brute.simhash_kept(rows)
    assert _pairs(single) == sorted(want, key=str) and len(want) < len(rows)

    clean = step("benchmark decontamination", single)
    rows = _decontaminated(want, items)
    assert _pairs(clean) == sorted(rows, key=str) and rows != want

    private = step("PII", clean)
    found = {}
    for r in pii.find_pii(clean).collect():
        found.setdefault(r.doc_id, []).append([(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)])
    redacted = []
    for doc, text in rows:
        base = brute.pii(text)
        spans = next(s for s in found[doc] if {x for x in s if not x[0].startswith("found_")} == set(base))
        redacted.append((doc, _redacted(text, spans)))
    assert _pairs(private) == sorted(redacted, key=str) and any("[EMAIL]" in t for _, t in redacted)

    enc = _tiktoken()
    tokens = [(d, enc.encode_ordinary(t)) for d, t in redacted]
    want = [(d, i, len(i), brute.sha(t)) for (d, i), (_, t) in zip(tokens, redacted, strict=True)]
    same(stage["byte-level BPE"](spark, private, path), want)
    whole = corpus_pipeline.run(spark, path)
    assert whole.columns == ["doc_id", "ids", "n_tokens", "decoded_sha256"]
    same(whole, want)


def test_an_empty_table(spark, sf_dir, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir[0]}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("table", ["sample", "made"])
def test_the_learned_list_equals_a_plain_one(spark, table):
    if table == "sample":
        sf = SF.replace("sf0.001", "sf0.01")
        docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
        labels = spark.read.parquet(f"{sf}/labels.parquet")
    else:
        rng = random.Random(6)
        bad = lambda i: i % 4 == 0 or i % 9 == 0
        noise = lambda i: ("#%" * rng.randint(1, 3)) if i % 4 == 0 else ("!!" if i % 9 == 0 else "")
        texts = [(i, " ".join(rng.choice(["Alpha", "beta", "gamma7"]) + str(rng.random())[2:4] + noise(i) for _ in range(60))) for i in range(900)]
        docs = spark.createDataFrame(texts, "doc_id long, text string")
        labels = spark.createDataFrame([(i, int(not bad(i))) for i in range(900)], "doc_id long, quality int")
    found = quality_rules.learn(docs, labels)
    part = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) == 0
    rows = docs.join(labels.where("quality is not null"), "doc_id").select("text", "quality", part.alias("p")).collect()
    plain = brute.quality_list([(brute.quality_features(r.text), r.quality, r.p) for r in rows], quality_rules.BINS)
    assert [[(c.feature, c.at_least, c.threshold) for c in rule] for rule in found.rules] == plain and plain
    # and the report applies it
    kept = {r.doc_id: r.kept for r in quality_rules.quality_report(docs, labels).collect()}
    texts = [tuple(r) for r in docs.collect()]
    assert {d for d, k in kept.items() if k} == {d for d, _ in _quality_kept(texts, found)}


def test_the_pipeline_swallows_no_import_error():
    with open(corpus_pipeline.__file__) as f:
        assert not re.search(r"except\s+(Import|ModuleNotFound)", f.read())

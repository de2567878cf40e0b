"""Each operator against its plain version, on sample rows and on edge cases."""

import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluice.llm import byte_bpe, decontaminate, kneser_ney, minhash, pii, quality_rules, simhash, substring_dedup, token_store, toxicity, url_templates

from . import brute

public_tokenizers = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def _passages():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(rng.randint(40, 130)) for _ in range(6)]
    out = []
    for _ in range(60):
        out.append("\n".join(rng.choice([text(rng.randint(0, 60)), rng.choice(shared)]) for _ in range(rng.randint(1, 4))))
    return out


EDGE_TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "one two",
    "Tie tie TIE tie",
    "same same same same same same " * 30,
    "same same same same same same " * 30,
    "x" * 30_000,
    "long " * 20_000,
    "mail a.b@c.de, 4111 1111 1111 1111 and +1 (555) 123-4567 at 10.0.0.256 or 10.0.0.25",
    "é中😀\x0b\x0cÀ'll don't  'tis '''s 12٣ \u00a0",
    "a@b@c.d e@f..g x+y@z-1.co.uk 1.2.3.4.5.6.7.8 +49(0)30--12 34",
]


@pytest.fixture(scope="module")
def rows(spark):
    sample = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    more = [(10_000 + i, t) for i, t in enumerate(_passages() + EDGE_TEXTS)]
    # a null id, a repeated row, and two texts under one id
    return [*sample, *more, (None, "null id"), (None, None), more[3], (10_004, "other text")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns whose names the operators use themselves
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return df.withColumns({c: F.lit("extra") for c in ("n_words", "spans", "kept", "fp", "_f", "row_key", "ids", "held_out")})


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _key(row):
    return tuple((x is None, 0 if x is None else x) for x in row)


def same(df, expected, digits=None):
    got = sorted((tuple(r) for r in df.collect()), key=_key)
    expected = sorted(expected, key=_key)
    if digits:
        assert len(got) == len(expected)
        for g, e in zip(got, expected, strict=True):
            assert all(math.isclose(a, b, rel_tol=10**-digits, abs_tol=1e-9) if isinstance(a, float) else a == b for a, b in zip(g, e, strict=True)), (g, e)
    else:
        assert got == expected


def test_substring_dedup(docs, rows, empty):
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    for size in (50, 7):
        same(substring_dedup.substring_dedup(docs, size).select(cols), brute.substring_dedup(rows, size))
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_substring_dedup_of_repeats_inside_a_document(spark):
    """A document that holds the shared passage several times loses every copy whole."""
    p, a, x, y = (" ".join(f"{c}{i}" for i in range(n)) for c, n in (("p", 100), ("a", 30), ("x", 30), ("y", 30)))
    cases = {"P P P": " ".join([p, p, p]), "(A P) x 4": " ".join([a, p] * 4)}
    cols = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    for case, removed in (("P P P", 300), ("(A P) x 4", 400)):
        rows = [(1, f"{x} {p} {y}"), (2, cases[case]), (2, f"{cases[case]} {x}")]
        want = brute.substring_dedup(rows)
        assert want[1][2] == removed
        same(substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).select(cols), want)


def test_substring_dedup_speakers_by_all_bits():
    rng = np.random.default_rng(3)
    for high in (4, 1 << 62):
        x = rng.integers(0, high, 500, dtype=np.uint64)
        for width in (1, 2, 7, 26):
            want = [i + int(np.argmin(x[i : i + width])) for i in range(len(x) - width + 1)]
            assert substring_dedup._sliding_first_min(x, width).tolist() == want


def test_token_store(docs, rows, empty, spark):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)  # as it comes: a special token's string is that token
    more = [(20_000, "a <|endoftext|>"), (20_001, "<|endoftext|><|endoftext|> b\n"), (None, "x <|endoftext|> y")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    rows = [*rows, *more]
    manifest = token_store.write_token_store(docs, path)
    got = token_store.read_token_store(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d or 0))
    ids = [(d, [*t.encode(x or "", add_special_tokens=False).ids, 0]) for d, x in rows]
    assert [i for d, i in ids if d == 20_000] == [[64, 220, 50256, 0]]
    key = lambda r: (r[0] is not None, *(x or 0 for x in r))
    want = sorted(((d, len(i), zlib.crc32(b"".join(x.to_bytes(4, "little") for x in i))) for d, i in ids), key=key)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=key) == want
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    every = token_store.token_documents(spark, manifest).collect()
    assert sorted(((r.doc_id, list(r.ids)) for r in every), key=str) == sorted(ids, key=str)
    assert token_store.read_token_store(token_store.write_token_store(empty, path)).count() == 0


def test_words_reach_the_library_once_whatever_their_mark():
    encoder = token_store.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    given = []

    class Recorder:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **kw):
            given.extend(texts)
            return self.tokenizer.encode_batch_fast(texts, **kw)

    texts = ["a glorbn, glorbn. glorbn! glorbn\nquaxen; glorbn", "b glorbn? it's glorbn.\nQuaxen, 7glorbn", "c straßö: é, ×a. a÷b,\nglorbn"]
    want = [e.ids for e in encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    encoder.words, encoder.tokenizer = Recorder(encoder.words), Recorder(encoder.tokenizer)
    assert [np.frombuffer(x, encoder.dtype).tolist() for x in encoder.encode(texts)] == want
    assert sum(t.count("glorbn") for t in given) == 3  # itself, after a digit, and in a piece with two sorts of marks


def test_token_store_reads_by_select_alone(spark, monkeypatch):
    """One id on all rows is spread over shards, and no table of all ends is made."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([(7, f"text {i}") for i in range(400)], "doc_id long, text string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        manifest = token_store.write_token_store(df, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert manifest.count() > 1
    monkeypatch.delattr(token_store.EliasFano, "all")
    rows = manifest.toPandas().to_dict("records")
    read = [b.to_pylist() for b in token_store._read([pa.RecordBatch.from_pylist(rows)])]
    assert sum(map(len, read)) == 400 and {r["doc_id"] for b in read for r in b} == {7}


def test_pieces_match_the_library():
    rng = random.Random(5)
    parts = [" ", "  ", "\n", "\t", "\u3000", "\x85", "\x1c", "a", "it's", "'ll", "\u00e9", "\u65e5\u672c", "12", "#$", "<|endoftext|>", "\x00", "."]
    for plain in (False, True):
        encoder = token_store.PieceEncoder(public_tokenizers.path("byte_bpe_50k.json"), special_as_text=plain)
        seen = 0
        for _ in range(50):
            texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(40)]
            want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
            assert encoder.encode(texts) == [np.array(e.ids, dtype=encoder.dtype).tobytes() for e in want]
            seen += sum(50256 in e.ids for e in want)
        assert bool(seen) != plain


def test_elias_fano():
    rng = random.Random(5)
    for _ in range(60):
        values, at = [], 0
        for _ in range(rng.randint(0, 1500)):
            at += rng.randint(0, rng.choice([1, 8, 10**6]))
            values.append(at)
        f = token_store.EliasFano.build(values)
        assert f.all().tolist() == values
        assert all(f.get(i) == values[i] for i in range(0, len(values), 31))
        for _ in range(8):
            i = rng.randint(0, len(values))
            j = rng.randint(i, len(values) + 3)
            assert f.select(i, j).tolist() == values[i:j]


def _tiktoken():
    import tiktoken

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_bpe(docs, rows, empty):
    enc, path = _tiktoken(), public_tokenizers.path("byte_bpe_50k.tiktoken")
    want = []
    for d, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((d, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(t or "")))
    same(byte_bpe.round_trip(docs, path), want)
    assert byte_bpe.round_trip(empty, path).count() == 0
    one, two = byte_bpe.encode_and_decode(docs, path, keep=["doc_id"]), byte_bpe.decode(byte_bpe.encode(docs, path, keep=["doc_id"]), path)
    assert one.schema == two.schema and one.exceptAll(two).count() == 0
    ends = byte_bpe.encode(docs, path, keep=["doc_id"], with_offsets=True).where("kept.doc_id = 10063").first()
    assert ends.slice_ends[-1:] == [len((dict(rows[:-2])[10063] or "").encode())] or not ends.slice_ends


def test_byte_bpe_random_text():
    enc, model = _tiktoken(), byte_bpe.BytePairs(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    rng = random.Random(9)
    alphabet = [*"aZbstmdrevl''  \n\t\x0b\x1c1٣é!?.<|_中😀́", "'s", "'re", "'ll", "\r\n"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for t, ids in zip(texts, model.encode(texts)[0], strict=True):
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == enc.encode_ordinary(t), repr(t)


def test_url_templates(spark):
    odd = [None, "", "no scheme", "http://", "HTTP://EXAMPLE.com", "http://a.Example.COM/en/1", "http://www.example.com/en/x?y=/es/", "x://net/es/1", "http://b.net/fr/é#z", "http://h.org//a///b", "http://com/", "http://acom/en/", "http://é.example.com/en/", "a://b://c/d"]
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect()]
    pages += [(90_000 + i, u) for i, u in enumerate(odd)] + [(90_000, None), (None, "http://a.net/es/")]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumns({c: F.lit("x") for c in ("host", "segments", "purity")})
    got = url_templates.judge_urls(df)
    same(got.select("page_id", "host", "path", "rule"), [(i, *brute.url(u)[:3]) for i, u in pages])
    for r in got.collect():
        assert r.verdict in ("allow", "block")
    fixed = {(i, brute.url(u)[3]) for i, u in pages if brute.url(u)[3]}
    assert fixed <= {(r.page_id, r.verdict) for r in got.collect()}
    assert url_templates.judge_urls(df.limit(0)).count() == 0


def test_url_templates_learn(spark):
    """Rules label one section of a host; another host's like section follows."""
    rules = (("block", "a.com/buy/"), ("allow", "a.com/read/"))
    urls = [f"http://a.com/{s}/{i}" for s in ("buy", "read") for i in range(50)] + ["http://b.org/buy/7", "http://b.org/read/7"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    verdict = {r.path: r.verdict for r in url_templates.judge_urls(df, rules=rules).where("host = 'b.org'").collect()}
    assert verdict == {"/buy/7": "block", "/read/7": "allow"}


def test_url_templates_deep_paths(spark):
    """Urls that differ from the fifth segment on have templates and verdicts of their own."""
    rules = (("block", "a.com/q/r/s/t/buy/"), ("allow", "a.com/q/r/s/t/read/"))
    urls = [f"http://a.com/q/r/s/t/{s}/{i}" for s in ("buy", "read") for i in range(50)]
    urls += ["http://b.org/q/r/s/t/buy/7", "http://b.org/q/r/s/t/read/7"] + [f"http://b.org/q/r/s/t/u/v/page{chr(97 + i)}/x" for i in range(26)]
    urls += ["http://c.org/" + "/".join(["loop"] * 300), "http://c.org"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.host, r.path): r for r in url_templates.judge_urls(df, rules=rules).collect()}
    assert got["b.org", "/q/r/s/t/buy/7"].verdict == "block" and got["b.org", "/q/r/s/t/read/7"].verdict == "allow"
    assert got["b.org", "/q/r/s/t/buy/7"].template == "/q/r/s/t/buy/{n}"
    assert got["b.org", "/q/r/s/t/u/v/pagea/x"].template == "/q/r/s/t/u/v/*/x"
    assert got["c.org", "/loop" * 300].template == "/loop" * 300 and got["c.org", ""].template == ""


def test_url_templates_jobs_do_not_follow_the_length_of_paths(spark, monkeypatch):
    """A labelled url of a thousand segments costs no more stored tables than one of five."""
    rules = (("block", "a.com/"),)
    stored, tables = url_templates.stored, []
    monkeypatch.setattr(url_templates, "stored", lambda df, name: tables.append(name) or stored(df, name))
    urls = [f"http://a.com/x/{i}" for i in range(30)] + ["http://a.com/y/z"]
    counts, deep = [], {}
    for n in (5, 1000):
        tables.clear()
        df = spark.createDataFrame(list(enumerate([*urls, "http://a.com/" + "/".join(f"s{k}x" for k in range(n))])), "page_id long, url string")
        deep[n] = {r.path: r for r in url_templates.judge_urls(df, rules=rules).collect()}
        counts.append(len(tables))
    assert counts[0] == counts[1]
    assert all(r.verdict == "block" for r in deep[1000].values())


def test_url_templates_count_children_exactly(spark):
    for children, template in ((24, "/p/c3/x"), (25, "/p/*/x")):
        urls = [f"http://h.org/p/c{i}/x" for i in range(children)] + ["http://h.org/p/c3/y/deep"]
        df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        got = {r.path: r.template for r in url_templates.judge_urls(df).collect()}
        assert got["/p/c3/x"] == template


@pytest.mark.parametrize("seed", range(3))
def test_url_verdicts_equal_the_plain_version(spark, seed):
    rng = random.Random(seed)
    names = ["buy", "read", "shop", "news", "a", "b", "7", "42", "deadbeef01", "item99x", "x.html", "5.html"]
    hosts = ["a.com", "b.com", "c.org", "d.net"]
    urls = [f"http://{rng.choice(hosts)}/" + "/".join(rng.choice(names) for _ in range(rng.randint(0, 5))) for _ in range(500)]
    urls += [f"http://c.org/wide/w{chr(97 + i % 26)}{chr(97 + i // 26)}/{rng.choice(names)}" for i in range(40)] + [None, "x", "http://"]
    rules = (("block", "a.com/buy/"), ("allow", "a.com/"), ("block", "b.com/shop/"), ("allow", "b.com/news/"), ("block", "a.com/shop/a/"))
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = url_templates.judge_urls(df, rules=rules).select("page_id", "template", "verdict")
    same(got, [(i, *x) for i, x in enumerate(brute.url_verdicts(urls, rules))])


def test_url_templates_merge_at_every_depth(spark):
    """Similar branches below the first segment share a template; one that differs stays apart."""
    rules = (("block", "a.com/shop/"), ("allow", "a.com/shop/cart/"), ("block", "a.com/shop/cart/z/"))
    urls = [f"http://a.com/shop/{s}/{t}/{i}" for s in ("one", "two", "cart") for t in "xy" for i in range(40)]
    urls += [f"http://a.com/shop/cart/z/{i}" for i in range(40)] + ["http://b.org/shop/one/x/7", "http://b.org/shop/cart/y/7"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {(r.host, r.path): r for r in url_templates.judge_urls(df, rules=rules).collect()}
    assert {got["a.com", f"/shop/{s}/{t}/1"].template for s in ("one", "two") for t in "xy"} == {"/shop/*/*/{n}"}
    assert got["a.com", "/shop/cart/z/1"].template == "/shop/cart/z/{n}"
    assert got["a.com", "/shop/cart/x/1"].template == "/shop/cart/x/{n}"
    # a host without examples still learns from branches that another host merged
    assert got["b.org", "/shop/one/x/7"].verdict == "block" and got["b.org", "/shop/cart/y/7"].verdict == "allow"


def test_quality_counts(spark, docs, rows, empty):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = quality_rules.quality_report(docs, labels)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(out.select(cols), [(d, *brute.quality_counts(t)) for d, t in rows])
    assert out.where("base_failed and kept").count() == 0
    assert quality_rules.quality_report(empty, labels.limit(0)).count() == 0


def test_quality_learns(spark):
    """Documents full of symbols are labelled 0: the list finds them and leaves the rest."""
    rng = random.Random(1)
    text = lambda bad: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) + str(rng.random())[2:5] + ("%%%" if bad else "") for _ in range(80))
    df = spark.createDataFrame([(i, text(i % 5 == 0)) for i in range(400)], "doc_id long, text string")
    labels = df.select("doc_id", (F.col("doc_id") % 5 != 0).cast("int").alias("quality")).unionByName(
        spark.createDataFrame([(None, 0), (3, None)], "doc_id long, quality int")
    )
    kept = {r.doc_id for r in quality_rules.quality_filter(df, labels).collect()}
    assert kept == {i for i in range(400) if i % 5}
    assert str(quality_rules.learn(df, labels.where("quality = 1"))) == ""


def test_pii_base(docs, rows, empty):
    found = pii.find_pii(docs)
    want = []
    for d, t in rows:
        s = brute.pii(t)
        want.append((d, *(sum(k == x for x, *_ in s) for k in pii.KINDS), brute.sha(",".join(f"{k}:{a}:{b}" for k, a, b in s))))
    same(found.drop("spans"), want)
    assert pii.find_pii(empty).count() == 0
    assert pii.redact(empty).columns == empty.columns


def _spans(df):
    return {r.doc_id: r.spans for r in pii.find_pii(df).collect()}


def _at(text, part, kind):
    return f"{kind}:{text.index(part)}:{text.index(part) + len(part)}"


def test_pii_discovers_by_context(spark):
    """Seeds share a left context with identifiers of another form."""
    rows = [(i, f"note {i}. call phone: +1 555 123-{1000 + i} today") for i in range(20)]
    more = [(100, "call phone: 555-123-4444 today"), (101, "room 555-123-4444 and x77-999-1234")]
    df = spark.createDataFrame(rows + more, "doc_id long, text string")
    got = _spans(df)
    assert got[0] == _at(rows[0][1], "+1 555 123-1000", "phone")
    # by its context, and then anywhere by itself; the other token has neither
    assert got[100] == _at(more[0][1], "555-123-4444", "found_phone")
    assert got[101] == _at(more[1][1], "555-123-4444", "found_phone")
    out = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert out[0] == "note 0. call phone: [PHONE] today" and out[100] == "call phone: [PHONE] today"
    assert out[101] == "room [PHONE] and x77-999-1234"


def test_pii_seeds_are_all_base_entities(spark):
    """Emails without a digit and cards in groups of four seed contexts of one word."""
    names = ["ann", "bob", "cid", "dan", "eve", "fay", "gus", "hal", "ida", "jon"]
    rows = [(i, f"{n} writes mailto {n}.doe@example.com") for i, n in enumerate(names)]
    cards = []
    for i in range(12):
        digits = f"4{i:03d}0000{7 * i:07d}"
        check = next(c for c in "0123456789" if pii._luhn(digits + c))
        cards.append(" ".join((digits + check)[k : k + 4] for k in range(0, 16, 4)))
    rows += [(50 + i, f"w{i} karte {c}") for i, c in enumerate(cards)]
    rows += [(90, "other words before mailto user77.local"), (91, "x karte 4999-8888")]
    got = _spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[0] == _at(rows[0][1], "ann.doe@example.com", "email")
    assert got[90] == _at("other words before mailto user77.local", "user77.local", "found_email")
    assert all(got[50 + i] == _at(f"w{i} karte {c}", c, "card") for i, c in enumerate(cards))
    assert got[91] == _at("x karte 4999-8888", "4999-8888", "found_card")
    found = pii.candidates("mail to: john.doe@example.com today, card 4111 1111 1111 1111", pii.base_spans("mail to: john.doe@example.com today, card 4111 1111 1111 1111"))
    assert [(c["token"], c["kind"]) for c in found] == [("john.doe@example.com", "email"), ("4111 1111 1111 1111", "card")]
    assert "card" in found[1]["patterns"] and "today card" in found[1]["patterns"]


def test_pii_goes_on_until_nothing_is_new(spark):
    """Each context is learned from the identifiers that the one before discovered: five rounds."""
    rows, n = [], 0
    for i in range(48):
        rows.append((n := n + 1, f"alpha user{i}@mail.org"))
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    for k, (w, v) in enumerate(zip(words, words[1:])):
        for i in range(6):
            # each token stands once under its own word, and often under the next
            rows.append((n := n + 1, f"{w} id{k}-{i}777"))
            rows += [(n := n + 1, f"{v} id{k}-{i}777") for _ in range(6)]
    rows.append((last := n + 1, "zeta lone-90210"))
    got = _spans(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got[last] == _at("zeta lone-90210", "lone-90210", "found_email")
    assert all("found_email" in s or s.startswith("email") for s in got.values())


def test_pii_left_words_are_those_of_the_whole_line():
    filler = "-" * 5000
    one = pii.candidates(f"first second {filler} tok1234 {filler} tok5678\nthird tok9999 tok8888", [])
    assert [(c["token"], [p for p in c["patterns"] if "<" not in p]) for c in one] == [
        ("tok1234", ["first second", "second"]),
        ("tok5678", ["second tok", "tok"]),
        ("tok9999", ["third"]),
        ("tok8888", ["third tok", "tok"]),
    ]
    # many base entities may lie before a token, and one may hold it
    text = " ".join(f"1.2.3.{i}" for i in range(9)) + " a 10.0.0.1:8080 z9999"
    base = pii.base_spans(text)
    assert all(c["kind"] == "ip" or c["token"] in ("8080", "z9999") for c in pii.candidates(text, base))


def test_clashing_names_pass_through(spark):
    text = "one two three four five six seven eight nine ten eleven a@b.example"
    df = spark.createDataFrame([(1, text, "x", "y", "z", "w", "v", "u")], "doc_id long, text string, _stay string, _ string, _pad string, _words string, n_words string, row string")
    bench = spark.createDataFrame([(1, "other words here")], "item_id long, text string")
    for out in (simhash.simhash_near_dedup(df), minhash.minhash_near_dedup(df), decontaminate.decontaminate(df, bench), pii.redact(df)):
        row = out.first()
        assert out.columns == df.columns and tuple(row[2:]) == ("x", "y", "z", "w", "v", "u")
    kept = byte_bpe.encode(df, public_tokenizers.path("byte_bpe_50k.tiktoken")).select("kept.*").first()
    assert (kept["_pad"], kept["_"], kept["_words"]) == ("z", "y", "w")
    counted = quality_rules.with_counts(df)
    assert counted.columns == ["doc_id", "text", "_stay", "_", "_pad", "_words", "row", *quality_rules.BASE_COUNTS, "_f"]
    assert counted.first()["_words"] == "w" and counted.first()["n_words"] == 12


def test_simhash_near_dedup_judges_texts_under_one_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(40)) for x in "abc")
    near = b.replace("b39", "b39 b40 b41")
    link = brute.simhash([(0, b), (1, near)])
    assert len({x[2] for x in link}) == 1, "the near copy must link"
    rows = [(3, b, "p"), (5, a, "q"), (5, near, "r"), (5, c, "s"), (5, c, "s2"), (None, b, "t"), (9, a, "u")]
    df = spark.createDataFrame(rows, "doc_id long, text string, more string")
    got = sorted(((r.doc_id, r.text, r.more) for r in simhash.simhash_near_dedup(df).collect()), key=str)
    # both texts of 5 that repeat no other stay, once each; so does the row without an id
    assert [(d, t) for d, t, _ in got] == sorted([(3, b), (5, a), (5, c), (None, b)], key=str)
    same(simhash.simhash_groups(df), brute.simhash([r[:2] for r in rows]))


def test_kneser_ney(docs, rows, empty):
    cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(kneser_ney.lm_scores(docs).select(cols), brute.kneser_ney(rows), digits=9)
    assert kneser_ney.lm_scores(empty).count() == 0


@pytest.mark.parametrize("shard", [6_000_000, 2000])
def test_kneser_ney_order_3(docs, rows, empty, monkeypatch, shard):
    real = kneser_ney.fit
    monkeypatch.setattr(kneser_ney, "fit", lambda t, order: real(t, tokens_per_shard=shard, order=order))
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", shard)
    monkeypatch.setattr(kneser_ney, "ROWS_PER_FILE", max(50, shard // 20))
    same(kneser_ney.lm_scores(docs, order=3).select("doc_id", "score"), brute.kneser_ney_3(rows), digits=9)
    assert kneser_ney.lm_scores(empty, order=3).count() == 0


def test_distinct_words_are_numbered_in_order():
    rng = np.random.default_rng(3)
    for x in (rng.integers(-(1 << 62), 1 << 62, 50)[rng.integers(0, 50, 2000)], np.zeros(0, np.int64), np.array([7, -7, 7])):
        for got, want in zip(kneser_ney._distinct(x), np.unique(x, return_inverse=True), strict=True):
            assert got.tolist() == want.tolist()


def test_kneser_ney_many_shards(docs, rows, monkeypatch):
    """The same scores when counts are dealt over many shards and flushed often."""
    real = kneser_ney.fit
    monkeypatch.setattr(kneser_ney, "fit", lambda t: real(t, tokens_per_shard=2000))
    monkeypatch.setattr(kneser_ney, "FLUSH_TOKENS", 5000)
    cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same(kneser_ney.lm_scores(docs).select(cols), brute.kneser_ney(rows), digits=9)


@pytest.mark.parametrize("order", [2, 3])
@pytest.mark.parametrize("shard", [5, 10_000])
def test_kneser_ney_sums_to_one(spark, order, shard):
    """Over all words and the unknown one, after every context: the fitted model's own probabilities."""
    texts = spark.createDataFrame([("a b a c a b",), ("b c",), ("a a b d",), (None,)], "text string")
    model = kneser_ney.fit(texts, tokens_per_shard=shard, order=order)
    size = len(model.words)
    assert size == 5
    ids = np.arange(-1, size)
    low = model.unigram(ids)
    assert math.isclose(low.sum(), 1)
    for v in range(-1, size + 1):
        p = model.pair(np.full(size + 1, v), ids, low)
        assert (p > 0).all() and math.isclose(p.sum(), 1), v
        for u in range(-1, size + 1) if order == 3 else ():
            q = model.triple(np.full(size + 1, u), np.full(size + 1, v), ids, p)
            assert (q > 0).all() and math.isclose(q.sum(), 1), (u, v)


def test_kneser_ney_counts_beyond_32_bits(tmp_path):
    big = np.array([3, (1 << 32) + 5, 1 << 50])
    v, u, w = np.array([1, 1, 7]), np.array([0, 0, (1 << 32) - 2]), np.array([2, 9, 4])
    back = kneser_ney.unpack(kneser_ney.pack(v, u, w, big))
    assert all((x == y).all() for x, y in zip(back, (v, u, w, big), strict=True))
    *_, n = kneser_ney._summed(*(np.concatenate([x, y]) for x, y in zip(back, (v, u, w, big), strict=True)))
    assert n.tolist() == [6, 2 * ((1 << 32) + 5), 1 << 51]
    kneser_ney._save(str(tmp_path), "f", *kneser_ney._thin_counts(n), kneser_ney._thin_ids(u[u.argsort()]), np.zeros(0, np.int64))
    with kneser_ney.Mapped(str(tmp_path), "f") as (*counts, ids, c):
        assert kneser_ney._counts_at(np.array([2, 0, 1]), *counts).tolist() == [n[2], n[0], n[1]] and len(c) == 0
        hit, p = kneser_ney._Ids(ids, 3).find(np.array([(1 << 32) - 2, 5, 0]), np.zeros(3, int), np.full(3, 3))
        assert hit.tolist() == [True, False, True] and p.tolist() == [2, 0]
    with kneser_ney.Mapped(str(tmp_path), "none") as none:
        assert none is None


def test_decontaminate(spark, docs, rows, empty):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, None), (901, ""), (902, "One"), (903, "tie  TIE"), (904, "same " * 12), (902, "one"), (None, "w1 w2"), (905, "...")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    want = brute.decontaminate(rows, [("" if i is None else i, t) for i, t in items])
    same(decontaminate.contamination_report(docs, bench), want)
    # the same hits when the benchmark is taken in several blocks
    blocks = decontaminate.find_contamination(docs, bench, keep=["doc_id"], block_windows=500)
    same(blocks.select("kept.doc_id", F.size("items")), [(w[0], w[3]) for w in want])
    same(blocks.select("kept.doc_id", decontaminate._covered()), [(w[0], w[2]) for w in want])
    whole = decontaminate.decontaminate(docs, bench)
    assert whole.columns == docs.columns
    pieces = decontaminate.decontaminate(docs, bench, block_windows=500)
    same(pieces.select("doc_id", "text"), [(r.doc_id, r.text) for r in whole.collect()])
    assert decontaminate.contamination_report(empty, bench).count() == 0
    assert decontaminate.contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0


def test_decontaminate_removes_spans(spark):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], "item_id long, text string")
    rest = " ".join(f"x{i}" for i in range(30))
    text = f"{rest}, One two three four five six seven eight nine ten. {rest}"
    df = spark.createDataFrame([(1, text, "s"), (2, rest, "s"), (3, "one two three four five six seven eight nine ten", "s"), (4, None, "s")], "doc_id long, text string, source string")
    out = {r.doc_id: r.text for r in decontaminate.decontaminate(df, bench).collect()}
    assert out == {1: f"{rest}, . {rest}", 2: rest, 4: None}


def test_simhash(docs, rows, empty):
    same(simhash.simhash_groups(docs), brute.simhash(rows))
    assert simhash.simhash_groups(empty).count() == 0
    kept = [(r.doc_id, r.text) for r in simhash.simhash_near_dedup(docs).collect()]
    assert sorted(kept, key=str) == sorted(brute.simhash_kept(rows), key=str)


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(3, list(range(64)), seed=1)
    rng = random.Random(2)
    for _ in range(20_000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not m & x for m in masks)


def test_simhash_splits_large_buckets(spark):
    """Dense balls and chains of fingerprints, with buckets far above the limit."""
    rng = random.Random(4)
    prints = set()
    for _ in range(4):
        center = rng.getrandbits(64)
        for _ in range(150):
            prints.add(center ^ sum(1 << b for b in rng.sample(range(12), rng.randint(0, 8))))
    prints |= {rng.getrandbits(64) for _ in range(50)}
    nodes = [(i, p - (1 << 64) if p >> 63 else p) for i, p in enumerate(sorted(prints))]
    df = spark.createDataFrame(nodes, "node long, fp long")
    edges = simhash.similarity_edges(df, radius=1, bucket_limit=16)
    got = dict(tuple(r) for r in simhash.connected_components(edges).collect())
    root = {i: i for i, _ in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, p in nodes:
        for j, q in nodes[:i]:
            if ((p ^ q) & (1 << 64) - 1).bit_count() <= 1:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert {i: got.get(i, i) for i, _ in nodes} == {i: find(i) for i, _ in nodes}


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    got = dict(tuple(r) for r in simhash.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 100 for i in range(101, 161)}, **{i: 7 for i in range(200, 260)}}


def test_toxicity(spark, docs, rows, empty):
    rng = random.Random(6)
    neutral = [f"word{c}{d}" for c in "abcdef" for d in "ghijkl"]
    text = lambda toxic: " ".join(rng.choice(neutral) for _ in range(rng.randint(5, 60))) + (" You 1d10t" + rng.choice(["", "ic", "s"]) if toxic else rng.choice(["", " idol", " idiom"]))
    data = [(i, text(i % 7 == 0), int(i % 7 == 0)) for i in range(1500)]
    df = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (3, None)], "doc_id long, toxic int")
    out = {r.doc_id: r for r in toxicity.toxicity_scores(df, labels).collect()}
    assert all(out[i].predicted == y for i, _, y in data)
    assert all(0 <= r.score <= 1 for r in out.values())
    assert all(out[i].held_out == brute.held(i, 5) for i, *_ in data)
    assert toxicity.toxicity_scores(docs, labels).count() == len(rows)
    assert toxicity.toxicity_scores(empty, labels).count() == 0
    assert {r.score for r in toxicity.toxicity_scores(df, labels.limit(0)).collect()} == {0.0}


def test_toxicity_learns_exceptions_of_clean_documents(spark):
    """Innocent words that start like an entry, in clean documents only, and pairs with an entry."""
    rng = random.Random(8)
    neutral = [f"word{c}{d}" for c in "abcdef" for d in "ghijkl"]
    text = lambda *more: " ".join([*(rng.choice(neutral) for _ in range(20)), *more])
    toxic = [text("scumbag"), *(text(f"scum{x}") for x in ("", "my", "s")), *[text("you", "vermin")] * 5] * 20
    clean = [text() for _ in range(400)] + [text("scumble,")] * 3 + [text("Crop vermin.")] * 8
    frames = [spark.createDataFrame([(t,) for t in x], "text string") for x in (toxic, clean)]
    lex = toxicity.learn_lexicon(*frames, len(toxic), len(clean))
    assert lex.weigh("a scumble")[0] == 0 and lex.weigh("scumbag")[0] > 0
    assert lex.weigh("crop - vermin")[0] == 0 and lex.weigh("you vermin")[0] > 0 and lex.weigh("the vermin")[0] > 0


def test_folding_and_exceptions():
    assert toxicity.fold("Ѕс0rе, ÉTÉ a\u200bb").split() == ["score", "ete", "ab"]
    lex = toxicity.Lexicon({"scum": 2.0, "rat": 1.0}, {"rather", "lab rat"})
    assert lex.weigh("Rather a lab rat than 5cum!")[0] == 2.0
    assert lex.weigh("rats")[0] == 1.0
    assert toxicity.Lexicon({}, set()).weigh("x y") == (0.0, 2)



"""MinHash near-dedup, token alignment and vector codes against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import minhash, token_alignment, vector_codes
from sluice.llm.queries import _vocabulary

from . import brute
from .test_operators import SF, docs, empty, rows, same  # noqa: F401

A, B = "byte_bpe_50k.json", "piece_bpe_32k.model"


# ---------------------------------------------------------------- MinHash


def _near_copies():
    """Chains and families around the limit of 0.8, exact copies, and short texts."""
    rng = random.Random(11)
    words = [f"v{i}" for i in range(900)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(20, 160))]
        for _ in range(rng.randint(1, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 16))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
            if rng.random() < 0.4:
                base = copy
    return out


def test_minhash_equals_plain_version(spark, docs, rows):  # noqa: F811
    same(minhash.minhash_groups(docs), brute.minhash(rows))


def test_minhash_chains_and_families(spark):
    sample = list(enumerate(_near_copies()))
    random.Random(1).shuffle(sample)
    df = spark.createDataFrame(sample, "doc_id long, text string").repartition(4)
    expected = brute.minhash(sample)
    assert len({c for _, _, c, _ in expected}) < len(sample)
    same(minhash.minhash_groups(df), expected)


@pytest.mark.parametrize("block", [300, 3000])
def test_minhash_families_of_several_blocks(spark, monkeypatch, block):
    """Keys of one minhash tie families that do not link; their sets are searched block by block."""
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    sample = list(enumerate(_near_copies()))
    df = spark.createDataFrame(sample, "doc_id long, text string")
    texts = minhash._rows(df, "doc_id", "text")
    got = minhash._groups(texts, 4, 80, rows=1, width=6).select("doc_id", "component_id")
    same(got, [(d, c) for d, _, c, _ in brute.minhash(sample)])


def test_minhash_search_finds_every_connection():
    rng = np.random.default_rng(9)

    def components(n, edges):
        group = list(range(n))
        for a, b in edges:
            old, new = group[a], group[b]
            group = [new if g == old else g for g in group]
        return [group.index(g) for g in group]

    for trial in range(30):
        base = rng.integers(0, 1 << 40, 60, dtype=np.uint64)
        sets = []
        for _ in range(rng.integers(2, 60)):
            x = base[: rng.integers(3, 60)].copy()
            x[rng.random(len(x)) < rng.choice([0.02, 0.08, 0.2])] = rng.integers(0, 1 << 40, dtype=np.uint64)
            sets.append(np.unique(np.r_[x, rng.integers(0, 1 << 40, rng.integers(0, 8), dtype=np.uint64)]))
        n = len(sets)
        alike = [(a, b) for a in range(n) for b in range(a) if 100 * (k := len(np.intersect1d(sets[a], sets[b]))) >= 80 * (len(sets[a]) + len(sets[b]) - k)]
        flat, offs = np.concatenate(sets), np.r_[0, np.cumsum([len(s) for s in sets])]
        links = minhash.search(flat, offs, np.arange(n), np.full(n, -1), 80)
        assert set(links) <= {*alike, *((b, a) for a, b in alike)} and len(links) < n
        assert components(n, links) == components(n, alike)
        # between two sides, given what each has by itself
        side = rng.integers(0, 2, n)
        inner = [(a, b) for a, b in alike if side[a] == side[b]]
        across = minhash.search(flat, offs, np.array(components(n, inner)), side, 80)
        assert all(side[a] != side[b] for a, b in across)
        assert components(n, inner + across) == components(n, alike)


def test_minhash_half_keys_meet_as_often_as_computed():
    """Pairs of similarity 0.8 and 0.5: share with a common table."""
    rng = np.random.default_rng(3)
    met = {0.8: 0, 0.5: 0}
    for s in met:
        for _ in range(60):
            both = int(round(2 * s * 300 / (1 + s)))
            x = rng.integers(0, 1 << 63, 600 - both, dtype=np.uint64)
            pair = [np.sort(x[:300]), np.sort(x[300 - both :])]
            keys = minhash.half_keys(np.concatenate(pair), np.array([0, 300, 600]), minhash.ROWS, minhash.WIDTH)
            hit = keys[0] == keys[1]
            met[s] += bool(hit[: minhash.WIDTH].any() and hit[minhash.WIDTH :].any())
    assert met[0.8] == 60 and met[0.5] < 60


def test_minhash_near_dedup_judges_texts_under_one_id(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    sample = [(3, b, "p"), (5, a, "q"), (5, b, "r"), (None, b, "s"), (None, "alone here", "t"), (9, None, "u")]
    df = spark.createDataFrame(sample, "doc_id long, text string, `d1` string")
    same(minhash.minhash_near_dedup(df), [sample[0], sample[1], sample[4], sample[5]])


def test_minhash_empty(empty):  # noqa: F811
    assert minhash.minhash_groups(empty).collect() == []


# ---------------------------------------------------------------- alignment


def _texts(rows):  # noqa: F811
    odd = ["<s> </s> <unk> <0x41> <|endoftext|>", "▁under", "  two  spaces ", "à b", "\n\n\ttab", "日本語 テキスト 😀😀", "1234567890 " * 50]
    return [*rows, *((20_000 + i, t) for i, t in enumerate(odd))]


def test_alignment_equals_plain_version(spark, rows):  # noqa: F811
    sample = _texts(rows)
    df = spark.createDataFrame(sample, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "pairs", "n_a")})
    expected = brute.alignment(sample, _vocabulary(A), _vocabulary(B))
    assert any(not n for _, n, *_ in expected if _) and any(g < min(a, b) for _, a, b, g, *_ in expected)
    same(token_alignment.alignment_report(df.repartition(3), _vocabulary(A), _vocabulary(B)), expected)


def test_alignment_beyond_the_broadcast_bound(spark, rows):  # noqa: F811
    sample = _texts(rows)[-40:]
    df = spark.createDataFrame(sample, "doc_id long, text string")
    got = token_alignment.alignment_report(df, _vocabulary(A), _vocabulary(B), broadcast_pairs=50)
    same(got, brute.alignment(sample, _vocabulary(A), _vocabulary(B)))


def test_lockstep_is_the_same_for_any_lane_length():
    rng = np.random.default_rng(8)
    a, b, first, total = [], [], [0], 0
    for _ in range(30):
        n = int(rng.integers(0, 200))
        for ends in (a, b):
            cuts = np.flatnonzero(rng.random(max(n - 1, 0)) < 0.4) + 1
            ends += (total + np.append(cuts, n)).tolist() if n else []
        first.append(len(a))
        total += n
    args = np.array(a), np.array(b), np.array(first)
    want = []
    for i in range(len(a)):
        low = a[i - 1] if i else 0
        want += [(i, j, a[i] == b[j]) for j in range(len(b)) if b[j] > low and (b[j - 1] if j else 0) < a[i]]
    for lane in (1, 3, 64, 10_000):
        assert list(zip(*(x.tolist() for x in token_alignment.lockstep(*args, lane)), strict=True)) == want


def test_alignment_empty(empty):  # noqa: F811
    assert token_alignment.alignment_report(empty, _vocabulary(A), _vocabulary(B)).collect() == []


# ---------------------------------------------------------------- vector codes

VECTORS = "vec_id long, embedding array<float>, label int, v string, code string"


def _vectors(n=330, dims=8, seed=2):
    rng = random.Random(seed)
    centres = [[rng.uniform(-0.5, 0.5) for _ in range(dims)] for _ in range(9)]
    out = []
    for i in range(n):
        c = rng.choice(centres)
        out.append((i * 3 % 1000, [round(x + rng.gauss(0, 0.05), 3) for x in c], rng.choice([None, 1, 2]), "v", "c"))
    return out


def _float32(rows):
    return [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], label) for i, v, label, *_ in rows]


def test_vector_codes_equal_plain_version(spark):
    sample = _vectors()
    sample += [sample[0], sample[5], (4, sample[9][1], 7, "", ""), (None, sample[3][1], 1, "", "")]
    sample += [(2000, None, 1, "", ""), (2001, [None] * 8, 1, "", ""), (2002, [float("nan")] * 8, 2, "", "")]
    sample += [(2003, [float("inf")] * 8, 2, "", ""), (2004, [0.5] * 7, 8, "", ""), (2005, [1e30] + [0.0] * 7, 1, "", "")]
    sample += [(2006, [], 9, "", ""), (2007, [100.0, -100.0] * 4, 2, "", "")]
    df = spark.createDataFrame(sample, VECTORS).repartition(3)
    same(vector_codes.vector_codes(df), brute.vector_codes(_float32(sample)))


def test_vector_codes_of_the_sample_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    sample = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    same(vector_codes.vector_codes(df), brute.vector_codes(sample))


@pytest.mark.parametrize("sample", [_vectors(5), [(1, [0.5] * 8, None, "", "")] * 3, [(1, [], None, "", "")]])
def test_vector_codes_of_few_vectors(spark, sample):
    df = spark.createDataFrame(sample, VECTORS)
    same(vector_codes.vector_codes(df), brute.vector_codes(_float32(sample)))


def test_vector_codes_empty(spark):
    df = spark.createDataFrame([(1, None, 1, "", "")], VECTORS)
    assert vector_codes.vector_codes(df).collect() == []
    assert vector_codes.vector_codes(df.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_grid_cells_remember_and_forget():
    rng = np.random.default_rng(1)
    entries = rng.integers(-500, 500, (64, 4))
    parts = rng.integers(-500, 500, (3000, 4)) // 40 * 40
    far = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    for cached in (10, 100_000):
        grid = vector_codes.GridCells(entries, 32, cached)
        for block in (parts, parts[::-1], parts[:500]):
            codes, errors = grid.nearest(block)
            want = far if block is parts else far[::-1] if len(block) == 3000 else far[:500]
            assert (codes == want.argmin(axis=1)).all() and (errors == want.min(axis=1)).all()
        if cached > 10:
            assert grid.judged == len(np.unique(parts // 32, axis=0)) and grid.asked == 6500


def test_grid_cells_with_colliding_hashes():
    rng = np.random.default_rng(4)
    entries, parts = rng.integers(-300, 300, (20, 3)), rng.integers(-300, 300, (400, 3))
    grid = vector_codes.GridCells(entries, 64)
    grid.weights[:] = 0
    want = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    for block in (slice(0, 100), slice(100, 400), slice(0, 400)):
        codes, _ = grid.nearest(parts[block])
        assert (codes == want[block].argmin(axis=1)).all()

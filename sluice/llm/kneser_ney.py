"""Interpolated modified Kneser-Ney model of order 2 or 3, counted in Spark.

1. Training tokens are counted by 64-bit word hash. The counts are ranged by
   hash and written as sorted arrays; a word's id is its place in them.
2. Each task counts its triples (u, v, w) locally and deals them to shards by
   the middle word v, packed: ids sorted and delta-coded, in byte planes,
   compressed. So a shard holds all of v's contexts (u, v) and pairs (v, w), and
   writes both with their statistics; nothing of them travels again. (At order
   2 there is no u.)
3. A word v that holds more than a shard's share of tokens (fewer than 4 per
   shard, by counting) is dealt by the whole triple instead, so no context is
   too large for a shard. The statistics of such contexts and pairs are partial
   in a shard; they go out as rows that Spark sums, and into files of their own.
4. Continuation counts (distinct words before a word) are rows that Spark sums,
   in dense arrays by ranges of ids.
5. Documents are scored where they are: workers memory-map the files, look
   the distinct words, pairs and triples of a batch up by binary search, one
   file after the other, whose pages are given back after it, and add log10
   probabilities up.

Files lie in the shared folder under names that follow from the shard, written
whole (a repeated task writes the same file again), so no list of files passes
through the driver: it gets sums only, the word files' sizes and the hot words.
The number of shards follows the token count, so a task holds a bounded part of
the corpus at any size. Counts have 64 bits. `D(c)`, the discounts, come from
the counts of counts at each order.

    p(w | u v) = max(c(uvw) - D''(c(uvw)), 0) / c(uv.) + gamma(u v) p(w | v)
    p(w | v)   = max(n(.vw) - D(n(.vw)), 0) / n(.v.) + gamma(v) p(w)
    p(w)       = max(n(.w) - D'(n(.w)), 0) / n(..) + gamma' / (V + 1)

n(.vw) are the distinct words before a pair; after the start mark, where nothing
comes before, and at order 2 it is the pair's plain count. A text's first word
has the start mark alone as its context. Ids are compared themselves, not
hashes of them; the 64-bit word hash alone stands for a word's text.

Tokens are the words of the A-Z lower-cased text, then one end; the first
word's context is a start mark that is never predicted. A word or context not
seen in training has count 0 and falls back to p(w) or the uniform share.

Edge cases: a null or empty text is the end alone; a null doc_id counts as
held out; repeated rows count each time; with no training rows every token has
probability 1 / (V + 1) = 1; an empty table gives an empty result; other
columns are ignored. More than 2**32 - 2 distinct words are refused.
"""

from __future__ import annotations

import mmap

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import map_file, prepare, shared_folder, stored, write_file
from .text import LOWER, SPACED, U64, combine, find_words, hash_words, mix, row_chunks, signed, text_buffer

TOKENS_PER_SHARD = 2_000_000
ROWS_PER_FILE = 1_000_000
FLUSH_TOKENS = 1_000_000
_END = np.int64(-0x61C8864680B583EB)  # the end token, beside the word hashes


def _tokens(batch: pa.RecordBatch):
    """Parts of a batch: token hashes (words, then one end per text) and the texts' token ends."""
    data, offs = text_buffer(batch.column("text"))
    data = LOWER[data]
    for i, j in row_chunks(offs, 4 << 20):
        part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        starts, ends, first = find_words(part, o, SPACED)
        words = signed(hash_words(part, starts, ends))
        yield i, j, np.insert(words, first[1:], _END), first[1:] + np.arange(1, j - i + 1)


def _count_words(batches):
    for batch in batches:
        for *_, tokens, _ in _tokens(batch):
            w, c = np.unique(tokens, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(w), pa.array(c.astype(np.int64))], names=["w", "c"])


_WORD_FILES = "part int, name string, n long, first long, last long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


def _save(folder: str, name: str, *arrays: np.ndarray) -> str:
    """Arrays in one file: their number, then kinds and lengths, then the data, each on 8 bytes."""

    def write(out):
        out.write(np.array([len(arrays)], "<i8").tobytes())
        for x in arrays:
            out.write(x.dtype.str[1:].ljust(8).encode() + np.array([x.size], "<i8").tobytes())
        for x in arrays:
            raw = np.ascontiguousarray(x).tobytes()
            out.write(raw + bytes(-len(raw) % 8))

    return write_file(folder, write, name)


_MAPPED: dict[str, np.ndarray | None] = {}


class Mapped:
    """A file's arrays for the time of a `with`; its pages are given back after it."""

    def __init__(self, folder: str, name: str):
        self.uri = f"{folder}/{name}"

    def __enter__(self) -> list[np.ndarray] | None:
        if self.uri not in _MAPPED:
            try:
                _MAPPED[self.uri] = map_file(self.uri)
            except FileNotFoundError:  # a shard without rows
                _MAPPED[self.uri] = None
        self.raw = _MAPPED[self.uri]
        if self.raw is None:
            return None
        raw = self.raw.view(np.ndarray)
        n = int(raw[:8].view("<i8")[0])
        out, at = [], 8 + 16 * n
        for k in range(n):
            head = raw[8 + 16 * k : 24 + 16 * k].tobytes()
            kind, size = np.dtype("<" + head[:8].decode().strip()), int.from_bytes(head[8:], "little")
            out.append(raw[at : at + size * kind.itemsize].view(kind))
            at += -(-size * kind.itemsize // 8) * 8
        return out

    def __exit__(self, *_) -> None:
        whole = getattr(self.raw, "_mmap", None)
        if whole is not None:
            whole.madvise(mmap.MADV_DONTNEED)


def _write_words(folder: str):
    def run(batches):
        from pyspark import TaskContext

        w, c = [], []
        for batch in batches:
            w.append(batch.column("w").to_numpy())
            c.append(batch.column("c").to_numpy())
        if not w or not sum(map(len, w)):
            return
        w, c = np.concatenate(w), np.concatenate(c)
        part = TaskContext.get().partitionId()
        name = _save(folder, f"words-{part}", w, *_thin_counts(c))
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "name": name, "n": len(w), "first": int(w[0]), "last": int(w[-1])}], schema=_arrow(_WORD_FILES)
        )

    return run


class Vocabulary:
    """Sorted word hashes in memory-mapped files; a word's id is its rank."""

    def __init__(self, folder: str, files: list[dict]):
        self.folder, self.files = folder, files
        self.base = np.concatenate([[0], np.cumsum([f["n"] for f in files])]).astype(np.int64)

    def __len__(self) -> int:
        return int(self.base[-1])

    def find(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and training counts of ascending distinct hashes."""
        ids, counts = np.full(len(words), -1, np.int64), np.zeros(len(words), np.int64)
        for f, base in zip(self.files, self.base.tolist(), strict=False):
            a, b = np.searchsorted(words, f["first"]), np.searchsorted(words, f["last"], side="right")
            if a == b:
                continue
            with Mapped(self.folder, f["name"]) as (known, *c):
                at = np.searchsorted(known, words[a:b])
                hit = known[at] == words[a:b]
                ids[a:b][hit], counts[a:b][hit] = at[hit] + base, _counts_at(at[hit], *c)
        return ids, counts


class Sharding:
    """Which shard counts a triple: by its middle word, hot ones by the whole triple."""

    def __init__(self, shards: int, hot: np.ndarray):
        self.shards, self.hot = shards, hot

    def is_hot(self, v: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
        return self.hot[at] == v

    def of(self, v: np.ndarray, u: np.ndarray, w: np.ndarray) -> np.ndarray:
        out = _part(mix(v.astype(U64)), self.shards)
        hot = self.is_hot(v)
        out[hot] = _part(combine(*(x[hot].astype(U64) for x in (v, u, w))), self.shards)
        return out


def _part(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> U64(32)) % U64(parts)).astype(np.int64)


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """`np.unique(x, return_inverse=True)`, by hashing: only the distinct values are sorted."""
    number, some = pd.factorize(x)
    order = np.argsort(some)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    return some[order], rank[number]


def _previous(ids: np.ndarray, ends: np.ndarray, start: int) -> np.ndarray:
    """The id before each token; the start mark at a text's first."""
    out = np.empty_like(ids)
    out[1:] = ids[:-1]
    out[np.r_[0, ends[:-1]]] = start
    return out


def _high(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return v.astype(U64) << U64(32) | w.astype(U64)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """The first row of each run of equal keys."""
    new = np.zeros(len(keys[0]), dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def _sums(counts: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.add.reduceat(counts, at) if len(at) else counts[:0]


def _summed(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray | None = None):
    """Triples in order of (v, u, w), each once, with the sums of n (none: their numbers)."""
    context = _high(v, u)
    order = np.argsort(context)
    known = context[order]
    new = np.r_[True, known[1:] != known[:-1]] if len(known) else np.zeros(0, dtype=bool)
    rank = np.empty(len(order), dtype=np.uint64)
    rank[order] = np.cumsum(new) - 1
    known = known[new]
    key = rank << U64(32) | w.astype(U64)
    if n is None:
        key = np.sort(key)
        at = _starts(key)
        n = np.diff(np.r_[at, len(key)])
        key = key[at]
    else:
        key, n = _by_key(key, n)
    context = known[key >> U64(32)]
    return (context >> U64(32)).astype(np.int64), _low(context), _low(key), n


def _low(key: np.ndarray) -> np.ndarray:
    return (key & U64(0xFFFFFFFF)).astype(np.int64)


def _by_key(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key)
    key, n = key[order], n[order]
    at = _starts(key)
    return key[at], _sums(n, at)


def _planes(x: np.ndarray) -> bytes:
    """The bytes of 64-bit numbers by significance: the high ones are mostly zero."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def pack(v: np.ndarray, u: np.ndarray, w: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted triples as contexts with run lengths, words and counts of any size."""
    at = _starts(v, u)
    runs = np.diff(np.r_[at, len(v)])
    middle = np.diff(v[at], prepend=0)
    raw = b"".join(map(_planes, (middle, u[at], runs, w, n)))
    return np.array([len(at), len(v)], "<i8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    m, n = np.frombuffer(packed[:16], "<i8").tolist()
    raw = np.frombuffer(pa.decompress(packed[16:], 8 * (3 * m + 2 * n), codec="zstd", asbytes=True), np.uint8)
    out, at = [], 0
    for size in (m, m, m, n, n):
        out.append(np.ascontiguousarray(raw[at : at + 8 * size].reshape(8, size).T).view("<i8").ravel())
        at += 8 * size
    middle, u, runs, w, count = out
    return np.repeat(np.cumsum(middle), runs), np.repeat(u, runs), w, count


def _count_triples(vocab, sharding, order: int):
    def run(batches):
        words, deal = vocab.value, sharding.value
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush():
            v, u, w = (np.concatenate([h[k] for h in held]) for k in range(3))
            v, u, w, n = _summed(v, u, w)
            shard = deal.of(v, u, w)
            by = np.argsort(shard, kind="stable")
            shard, v, u, w, n = (x[by] for x in (shard, v, u, w, n))
            at = _starts(shard)
            rows = [(int(shard[a]), pack(v[a:b], u[a:b], w[a:b], n[a:b])) for a, b in zip(at, np.r_[at[1:], len(v)], strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], names=["shard", "triples"]
            )

        for batch in batches:
            for *_, tokens, ends in _tokens(batch):
                distinct, back = _distinct(tokens)
                ids = words.find(distinct)[0][back]
                v = _previous(ids, ends, len(words))
                held.append((v, _previous(v, ends, len(words)) if order == 3 else np.zeros_like(v), ids))
                size += len(tokens)
                if size >= FLUSH_TOKENS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _stats(counts: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Per run: tokens, and types of count 1, 2, 3 or more."""
    return [_sums(x.astype(np.int64), at) for x in (counts, counts == 1, counts == 2, counts >= 3)]


def _thin_ids(x: np.ndarray) -> np.ndarray:
    """Ids in as many byte planes as the largest needs, the low one first."""
    width = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T)


def _least(x: np.ndarray) -> np.ndarray:
    """In the least number of bytes that holds the largest."""
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _thin_counts(n: np.ndarray) -> list[np.ndarray]:
    """A byte a count; 255 stands for a larger one, found by its place."""
    large = np.flatnonzero(n >= 255)
    return [np.minimum(n, 255).astype(np.uint8), large.astype("<u4" if len(n) < 1 << 32 else "<u8"), n[large].astype("<u8")]


def _thin_stats(stats: list[np.ndarray]) -> list[np.ndarray]:
    """The distinct rows of statistics, one after the other, and each row's number among them."""
    rows = np.stack(stats, axis=1)
    hashed = combine(*(s.astype(U64) for s in stats))
    _, first, back = np.unique(hashed, return_index=True, return_inverse=True)
    if (rows[first][back] != rows).any():  # two rows of one hash
        distinct, back = np.unique(rows, axis=0, return_inverse=True)
    else:
        distinct = rows[first]
    return [distinct.ravel(), back.astype(np.min_scalar_type(max(len(distinct) - 1, 0)))]


class _Ids:
    """Reads `_thin_ids`."""

    def __init__(self, planes: np.ndarray, n: int):
        self.planes = planes.reshape(-1, n) if n else planes.reshape(1, 0)

    def at(self, p: np.ndarray) -> np.ndarray:
        out = self.planes[0][p].astype(np.int64)
        for k in range(1, len(self.planes)):
            out |= self.planes[k][p].astype(np.int64) << (8 * k)
        return out

    def find(self, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted are in their ascending stretch [low, high), and where."""
        found = low.copy()
        on = np.flatnonzero(low < high)
        a, b, want = low[on], high[on], wanted[on]
        while len(on):
            middle = (a + b) >> 1
            less = self.at(middle) < want
            a, b = np.where(less, middle + 1, a), np.where(less, b, middle)
            open_ = a < b
            if not open_.all():
                found[on[~open_]] = a[~open_]
                on, a, b, want = on[open_], a[open_], b[open_], want[open_]
        inside = np.flatnonzero(found < high)
        hit = np.zeros(len(wanted), dtype=bool)
        hit[inside] = self.at(found[inside]) == wanted[inside]
        return hit, found[hit]


def _stretch(start: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return start[p].astype(np.int64), start[p + 1].astype(np.int64)


def _counts_at(p: np.ndarray, counts: np.ndarray, large: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = counts[p].astype(np.int64)
    more = np.flatnonzero(out == 255)
    out[more] = values[np.searchsorted(large, p[more])]
    return out


def _stats_at(p: np.ndarray, distinct: np.ndarray, number: np.ndarray) -> np.ndarray:
    return distinct.reshape(-1, 4)[number[p]]


_MERGED = "kind string, a long, b long, n long, n1 long, n2 long, n3 long"


def _rows(kind: str, *columns) -> pa.RecordBatch:
    fields = _arrow(_MERGED)
    size = len(columns[0])
    given = [pa.array([kind] * size, pa.string()), *(pa.array(np.asarray(c).astype(np.int64)) for c in columns)]
    return pa.RecordBatch.from_arrays(given + [pa.nulls(size, pa.int64())] * (len(fields) - len(given)), schema=fields)


def _counts_of_counts(kind: str, counts: np.ndarray) -> pa.RecordBatch:
    return _rows(kind, *([x] for x in (0, 0, *((counts == k).sum() for k in (1, 2, 3, 4)))))


def _merge(folder: str, sharding, order: int, start: int):
    """One shard: its files of triples and pairs, and rows of what is partial here."""

    def run(key, table):
        deal, shard = sharding.value, key[0].as_py()
        v, u, w, n = _summed(*map(np.concatenate, zip(*map(unpack, table.column("triples").to_pylist()), strict=True)))
        # a first word has no context of two words: its plain count is the pair's
        inner = (u != start) | (v != start) if order == 3 else np.zeros(len(v), dtype=bool)
        out = []
        if order == 3:
            x, y, z, count = v[inner], u[inner], w[inner], n[inner]
            at = _starts(x, y)
            stats = _stats(count, at)
            middle = _starts(x[at])
            _save(
                folder,
                f"triples-{shard}",
                _least(x[at][middle]),
                _least(np.r_[middle, len(at)]),
                _thin_ids(y[at]),
                *_thin_stats(stats),
                _thin_ids(np.r_[at, len(z)]),
                _thin_ids(z),
                *_thin_counts(count),
            )
            hot = deal.is_hot(x[at])
            out.append(_rows("context", x[at][hot], y[at][hot], *(s[hot] for s in stats)))
            out.append(_counts_of_counts("triples", count))
        key, n = _by_key(_high(v, w), np.where(inner, 1, n))
        v, w = (key >> U64(32)).astype(np.int64), _low(key)
        hot = deal.is_hot(v)
        out.append(_rows("pair", v[hot], w[hot], n[hot]))
        v, w, n = v[~hot], w[~hot], n[~hot]
        at = _starts(v)
        _save(folder, f"pairs-{shard}", _least(v[at]), _least(np.r_[at, len(v)]), *_thin_stats(_stats(n, at)), _thin_ids(w), *_thin_counts(n))
        out.append(_counts_of_counts("pairs", n))
        word, before = np.unique(w, return_counts=True)
        out.append(_rows("word", word, np.zeros(len(word)), before))
        return pa.Table.from_batches(out)

    return run


def _save_group(folder: str, name: str, make):
    """A group of rows as one file; a row of its size comes back."""

    def run(key, table):
        part = key[0].as_py()
        _save(folder, f"{name}-{part}", *make(part, *(table.column(c).to_numpy() for c in table.column_names if c != "part")))
        return pa.table({"rows": pa.array([table.num_rows], pa.int64())})

    return run


def _sorted_contexts(part, a, b, *stats):
    key = _high(a, b)
    by = np.argsort(key)
    return key[by], *_thin_stats([s[by] for s in stats])


def _sorted_pairs(part, a, b, n):
    key = _high(a, b)
    by = np.argsort(key)
    return key[by], *_thin_counts(n[by])


def _sorted_stats(part, a, *stats):
    by = np.argsort(a)
    return a[by], *(s[by] for s in stats)


def _dense(size: int):
    def make(part, a, n):
        first = part * size
        total = np.zeros(size, dtype=np.int64)
        total[a - first] = n
        return (_least(total),)

    return make


def _in_files(rows: DataFrame, part, folder: str, name: str, make) -> None:
    columns = rows.columns
    parts = rows.select(part.alias("part"), *columns).groupBy("part").applyInArrow(_save_group(folder, name, make), "rows long")
    parts.agg(F.sum("rows")).first()


def _hash_part(parts: int):
    """The file of a key of two ids, in Spark as in `_hash_part_of`."""
    return F.pmod(F.col("a") * 31 + F.col("b"), F.lit(parts)).cast("int")


def _hash_part_of(a: np.ndarray, b: np.ndarray, parts: int) -> np.ndarray:
    return (a * 31 + b) % parts


def _discounts(n: list[int]) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts 1 to 4;
    half a count where they give none."""
    y = n[0] / (n[0] + 2 * n[1]) if n[0] + 2 * n[1] else 0.0
    out = []
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] else 0.0
        out.append(d if 0 < d < k else 0.5)
    return out


class Model:
    """The scorer's view: sums and file names; arrays are mapped when needed."""

    def __init__(self, folder: str, words: Vocabulary, sharding: Sharding, order: int, tokens: int, sums: dict):
        self.folder, self.words, self.sharding, self.order, self.tokens = folder, words, sharding, order, tokens
        self.sums = sums
        self.d = {k: np.array([0.0, *_discounts(sums[k])]) for k in ("words", "pairs", "triples")}

    def unigram(self, ids: np.ndarray) -> np.ndarray:
        """p(w) of ids; -1 is an unknown word."""
        size, types = len(self.words), self.sums["types"]
        if not types:
            return np.full(len(ids), 1 / (size + 1))
        cont = np.zeros(len(ids), dtype=np.int64)
        rows = self.sums["rows_per_file"]
        part = np.where(ids >= 0, ids // rows, -1)
        for k in np.unique(part[part >= 0]).tolist():
            with Mapped(self.folder, f"follow-{k}") as found:
                if found:
                    cont[part == k] = found[0][ids[part == k] - k * rows]
        ones, twos, d = self.sums["words"][0], self.sums["words"][1], self.d["words"]
        # every training word follows a word or the start, so all `size` words have a count
        gamma = (d[1] * ones + d[2] * twos + d[3] * (size - ones - twos)) / types
        return np.maximum(cont - d[np.minimum(cont, 3)], 0) / types + gamma / (size + 1)

    def _by_file(self, rows: np.ndarray, part: np.ndarray, v: np.ndarray, name: str):
        """(rows, arrays) of each file that some of the rows are in; by v, as the arrays are."""
        by = np.argsort(part << 32 | v[rows])
        rows, part = rows[by], part[by]
        at = _starts(part) if len(part) else []
        for a, b in zip(at, np.r_[at[1:], len(part)].astype(int) if len(part) else [], strict=True):
            with Mapped(self.folder, f"{name}-{part[a]}") as found:
                if found and len(found[0]):
                    yield rows[a:b], found

    @staticmethod
    def _at(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the wanted are there, and the places of those."""
        p = np.minimum(np.searchsorted(known, wanted), max(len(known) - 1, 0))
        hit = known[p] == wanted if len(known) else np.zeros(len(wanted), dtype=bool)
        return hit, p[hit]

    def _interpolated(self, d: np.ndarray, stats: np.ndarray, count: np.ndarray, low: np.ndarray) -> np.ndarray:
        total = np.maximum(stats[:, 0], 1)
        gamma = np.where(stats[:, 0] > 0, (stats[:, 1:] * d[1:]).sum(axis=1) / total, 1.0)
        return np.maximum(count - d[np.minimum(count, 3)], 0) / total + gamma * low

    def pair(self, v: np.ndarray, w: np.ndarray, low: np.ndarray) -> np.ndarray:
        """p(w | v) of pairs of ids, given p(w); -1 is unknown."""
        stats, count = np.zeros((len(v), 4), np.int64), np.zeros(len(v), np.int64)
        hot = self.sharding.is_hot(v)
        cold = np.flatnonzero(~hot & (v >= 0))
        for rows, (known, start, *own, words, n, large, values) in self._by_file(cold, _part(mix(v[cold].astype(U64)), self.sharding.shards), v, "pairs"):
            hit, p = self._at(known, v[rows])
            rows = rows[hit]
            stats[rows] = _stats_at(p, *own)
            # an unknown word is in no stretch
            hit, p = _Ids(words, len(n)).find(w[rows], *_stretch(start, p))
            count[rows[hit]] = _counts_at(p, n, large, values)
        warm = np.flatnonzero(hot)
        with Mapped(self.folder, "hot-0") as found:
            if found and len(warm):
                hit, p = self._at(found[0], v[warm])
                for k, s in enumerate(found[1:]):
                    stats[warm[hit], k] = s[p]
        warm = warm[w[warm] >= 0]
        for rows, (keys, *n) in self._by_file(warm, _hash_part_of(v[warm], w[warm], self.sums["pair_files"]), v, "hotpairs"):
            hit, p = self._at(keys, _high(v[rows], w[rows]))
            count[rows[hit]] = _counts_at(p, *n)
        return self._interpolated(self.d["pairs"], stats, count, low)

    def triple(self, u: np.ndarray, v: np.ndarray, w: np.ndarray, low: np.ndarray) -> np.ndarray:
        """p(w | u v) of triples of ids, given p(w | v); -1 is unknown."""
        begin = len(self.words)
        stats, count = np.zeros((len(v), 4), np.int64), np.zeros(len(v), np.int64)
        known = (u >= 0) & (v >= 0) & ((u != begin) | (v != begin))
        hot = self.sharding.is_hot(v) & known
        # of an unknown word the context's statistics alone count; a hot context has them elsewhere
        rows = np.flatnonzero(known & (~hot | (w >= 0)))
        shard = self.sharding.of(v[rows], u[rows], np.maximum(w[rows], 0))
        for rows, (middle, start, before, *own, first, words, n, large, values) in self._by_file(rows, shard, v, "triples"):
            hit, p = self._at(middle, v[rows])
            rows = rows[hit]
            hit, p = _Ids(before, len(own[1])).find(u[rows], *_stretch(start, p))
            rows = rows[hit]
            stats[rows] = _stats_at(p, *own)
            first = _Ids(first, len(own[1]) + 1)
            hit, q = _Ids(words, len(n)).find(w[rows], first.at(p), first.at(p + 1))
            count[rows[hit]] = _counts_at(q, n, large, values)
        warm = np.flatnonzero(hot)
        stats[warm] = 0
        for rows, (ctx, *own) in self._by_file(warm, _hash_part_of(v[warm], u[warm], self.sums["context_files"]), v, "contexts"):
            hit, p = self._at(ctx, _high(v[rows], u[rows]))
            stats[rows[hit]] = _stats_at(p, *own)
        return self._interpolated(self.d["triples"], stats, count, low)

    def score(self, tokens: np.ndarray, ends: np.ndarray):
        """Per text: n_tokens, n_known, base_score, score."""
        size = len(self.words)
        distinct, back = _distinct(tokens)
        ids, counts = self.words.find(distinct)
        base = np.log10((counts + 0.1) / (self.tokens + 0.1 * (size + 1)))
        low = self.unigram(ids)
        before = _previous(ids[back], ends, size)
        # one lookup per distinct (context, word) of the batch
        code = (before + 1) * len(distinct) + back
        some, again = np.unique(code, return_inverse=True)
        v, d = some // len(distinct) - 1, some % len(distinct)
        p = self.pair(v, ids[d], low[d])
        if self.order == 3:
            code = (_previous(before, ends, size) + 1) * len(some) + again
            again3, some3 = pd.factorize(code)  # in any order: the lookups sort by file
            u, pair = some3 // len(some) - 1, some3 % len(some)
            p, again = self.triple(u, v[pair], ids[d][pair], p[pair]), again3
        p = np.log10(p)
        starts = np.r_[0, ends[:-1]]
        return (
            np.diff(np.r_[0, ends]),
            np.add.reduceat((counts[back] > 0).astype(np.int64), starts),
            np.add.reduceat(base[back], starts),
            np.add.reduceat(p[again], starts),
        )


def _score(model):
    def run(batches):
        m = model.value
        for batch in batches:
            for i, j, tokens, ends in _tokens(batch):
                n, known, base, score = m.score(tokens, ends)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(i, j - i),
                        batch.column("held_out").slice(i, j - i),
                        pa.array(n.astype(np.int64)),
                        pa.array(known),
                        pa.array(base),
                        pa.array(score),
                    ],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )

    return run


def _of_counts(rows: DataFrame, n: str = "n") -> list[int]:
    """How many counts are 1, 2, 3 and 4."""
    return list(rows.agg(*[F.count_if(F.col(n) == k).alias(f"n{k}") for k in (1, 2, 3, 4)]).first())


def fit(texts: DataFrame, tokens_per_shard: int = TOKENS_PER_SHARD, order: int = 2) -> Model:
    """Count the training texts (column `text`) and write the model's files."""
    if order not in (2, 3):
        raise ValueError(f"order is 2 or 3, not {order}")
    spark = prepare(texts)
    sc = spark.sparkContext
    folder = shared_folder(spark, "kneser_ney")
    texts = texts.select("text")
    counts = stored(texts.mapInArrow(_count_words, "w long, c long").groupBy("w").agg(F.sum("c").alias("c")), "lm_words")
    tokens = counts.agg(F.sum("c")).first()[0] or 0
    ranged = counts.repartitionByRange("w").sortWithinPartitions("w")
    files = [r.asDict() for r in stored(ranged.mapInArrow(_write_words(folder), _WORD_FILES), "lm_word_files").orderBy("part").collect()]
    vocab = Vocabulary(folder, files)
    if len(vocab) >= (1 << 32) - 1:
        raise ValueError(f"{len(vocab)} distinct words; ids have 32 bits")
    shards = int(tokens // tokens_per_shard) + 1
    # a shard's share: fewer than 4 * shards words can exceed a quarter of it
    heavy = counts.where(F.col("c") > max(1, tokens // (4 * shards))).select("w")
    words = np.sort(np.array([r.w for r in heavy.collect()], dtype=np.int64))
    hot = np.sort(np.r_[vocab.find(words)[0] if len(words) else np.zeros(0, np.int64), len(vocab)])
    sharding = sc.broadcast(Sharding(shards, hot))
    dealt = texts.mapInArrow(_count_triples(sc.broadcast(vocab), sharding, order), "shard int, triples binary")
    merged = stored(dealt.groupBy("shard").applyInArrow(_merge(folder, sharding, order, len(vocab)), _MERGED), "lm_merged")
    stats = [F.sum(c).alias(c) for c in ("n", "n1", "n2", "n3")]
    plain = {r["kind"]: [r[c] or 0 for c in ("n", "n1", "n2", "n3")] for r in merged.where("kind in ('triples', 'pairs')").groupBy("kind").agg(*stats).collect()}

    contexts = stored(merged.where("kind = 'context'").groupBy("a", "b").agg(*stats), "lm_contexts")
    context_files = int(contexts.count() // ROWS_PER_FILE) + 1
    _in_files(contexts, _hash_part(context_files), folder, "contexts", _sorted_contexts)
    pairs = stored(merged.where("kind = 'pair'").groupBy("a", "b").agg(F.sum("n").alias("n")), "lm_pairs")
    pair_files = int(pairs.count() // ROWS_PER_FILE) + 1
    _in_files(pairs, _hash_part(pair_files), folder, "hotpairs", _sorted_pairs)
    of_hot = pairs.groupBy("a").agg(
        F.sum("n").alias("n"), *[F.count_if(F.col("n") == k).alias(f"n{k}") for k in (1, 2)], F.count_if(F.col("n") >= 3).alias("n3")
    )
    _in_files(of_hot, F.lit(0), folder, "hot", _sorted_stats)
    before = merged.where("kind = 'word'").select("a", "n").unionByName(pairs.groupBy(F.col("b").alias("a")).agg(F.count(F.lit(1)).alias("n")))
    follow = stored(before.groupBy("a").agg(F.sum("n").alias("n")), "lm_follow")
    _in_files(follow, F.expr(f"cast(a div {ROWS_PER_FILE} as int)"), folder, "follow", _dense(ROWS_PER_FILE))
    sums = {
        "types": follow.agg(F.sum("n")).first()[0] or 0,
        "words": _of_counts(follow),
        "pairs": [a + b for a, b in zip(plain.get("pairs", [0] * 4), _of_counts(pairs), strict=True)],
        "triples": plain.get("triples", [0] * 4),
        "context_files": context_files,
        "pair_files": pair_files,
        "rows_per_file": ROWS_PER_FILE,
    }
    return Model(folder, vocab, sharding.value, order, int(tokens), sums)


def held_out(id_col: str = "doc_id", folds: int = 10):
    """Whether crc32 of the id as text leaves remainder 0; a null id is held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % folds == 0, F.lit(True))


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", folds: int = 10, order: int = 2) -> DataFrame:
    """Fit on the rows that are not held out, score all: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score, perplexity."""
    spark = prepare(docs)
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), held_out(id_col, folds).alias("held_out")
    )
    train = rows.where(~F.col("held_out"))
    model = fit(train) if order == 2 else fit(train, order=order)
    scored = rows.mapInArrow(
        _score(spark.sparkContext.broadcast(model)),
        "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double",
    )
    return scored.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )

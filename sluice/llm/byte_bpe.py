"""Byte-level BPE encoding and decoding from a rank file.

Pre-tokenisation finds the matches of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

without a regex engine. Each code point becomes one of nine symbols (its class
and what follows it), and a small automaton says where tokens start. Its
transition functions compose associatively, so a batch is scanned in blocks:
all start states through every block at once, a doubling scan over the
blocks' functions, then one pass with the known start states.

The byte slices feed pair merging behind a bounded cache. The ids keep the
slices' byte ends if asked for; decoding looks the ids up in a byte table.

Edge cases: a null or empty text has no ids; any valid UTF-8 text round-trips;
a long slice is merged with a heap, so its time is n log n; repeated rows stay;
an empty table gives an empty result; other columns are kept untouched.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free_name, prepare
from .text import row_chunks, text_buffer

# symbols
_L, _N, _O, _Q2, _Q3, _P, _W, _V, _END = range(9)
# states: fresh, in letters, in numbers, in others, after a leading space, in white space, one or two more of a contraction
_FRESH, _IN_L, _IN_N, _IN_O, _LEAD, _IN_W, _SKIP1, _SKIP2 = range(8)
_STATES = 8
_BLOCK = 64
_GAP = "\ud800"  # between documents; never part of valid text
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, whether a token starts) by symbol and state."""
    to = np.zeros((9, _STATES), dtype=np.uint8)
    new = np.ones((9, _STATES), dtype=bool)
    runs = {_L: _IN_L, _N: _IN_N, _O: _IN_O}
    for s in range(_STATES):
        for sym, state in runs.items():
            to[sym, s], new[sym, s] = state, s not in (state, _LEAD)
        for sym, state in ((_Q2, _SKIP1), (_Q3, _SKIP2)):
            inside = s in (_IN_O, _LEAD)
            to[sym, s], new[sym, s] = (_IN_O, False) if inside else (state, True)
        to[_P, s] = _LEAD
        to[_W, s], new[_W, s] = _IN_W, s != _IN_W
        to[_V, s] = _IN_W
        to[_END, s] = _FRESH
    to[:, _SKIP1], new[:, _SKIP1] = _FRESH, False
    to[:, _SKIP2], new[:, _SKIP2] = _SKIP1, False
    return to, new


_TO, _NEW = _automaton()
_CLASSES: list[np.ndarray] = []


def _classes() -> np.ndarray:
    """Letter, number, white space or other, by code point."""
    if not _CLASSES:
        kind = {"L": _L, "N": _N}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], _O) for c in range(0x110000)), dtype=np.uint8)
        table[_WHITE] = _W
        table[ord(_GAP)] = _END
        _CLASSES.append(table)
    return _CLASSES[0]


def _symbols(cp: np.ndarray) -> np.ndarray:
    sym = _classes()[cp]
    nxt = np.full(len(sym), _END, dtype=np.uint8)
    nxt[:-1] = sym[1:]
    solid = (nxt != _W) & (nxt != _END)
    white = (sym == _W) & solid
    out = sym.copy()
    out[white] = np.where(cp[white] == 0x20, _P, _V)
    for at in np.flatnonzero(cp[:-1] == 0x27).tolist():
        tail = cp[at + 1 : at + 3].tolist()
        if chr(tail[0]) in "stmd":
            out[at] = _Q2
        elif len(tail) == 2 and chr(tail[0]) + chr(tail[1]) in ("re", "ve", "ll"):
            out[at] = _Q3
    return out


def token_starts(cp: np.ndarray) -> np.ndarray:
    """Whether a token starts, by code point (and at each gap)."""
    n = len(cp)
    sym = _symbols(cp)
    blocks = -(-n // _BLOCK)
    padded = np.full(blocks * _BLOCK, _END, dtype=np.uint8)
    padded[:n] = sym
    grid = np.ascontiguousarray(padded.reshape(blocks, _BLOCK).T)
    flat = _TO.ravel()
    # every start state through every block
    state = np.repeat(np.arange(_STATES, dtype=np.uint8)[:, None], blocks, axis=1)
    for k in range(_BLOCK):
        state = flat[grid[k].astype(np.int16) * _STATES + state]
    # doubling scan: state[:, b] becomes the function of blocks 0..b
    step, cols = 1, np.arange(blocks)
    while step < blocks:
        later = state[state[:, : blocks - step], cols[step:]]
        state = np.concatenate([state[:, :step], later], axis=1)
        step *= 2
    now = np.empty(blocks, dtype=np.uint8)
    now[0] = _FRESH
    now[1:] = state[_FRESH, :-1]
    starts = np.empty((_BLOCK, blocks), dtype=bool)
    begins = _NEW.ravel()
    for k in range(_BLOCK):
        at = grid[k].astype(np.int16) * _STATES + now
        starts[k] = begins[at]
        now = flat[at]
    return np.ascontiguousarray(starts.T).ravel()[:n]


def slices(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """UTF-8 of the texts with a gap after each, byte starts of all tokens and
    gaps, and the index of each text's gap among them."""
    joined = _GAP.join([*texts, ""])
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    width = 1 + (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    at = np.flatnonzero(token_starts(cp))
    begin = np.cumsum(width) - width
    return joined.encode("utf-8", "surrogatepass"), begin[at], np.flatnonzero(cp[at] == ord(_GAP))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs:
    CACHED = 250_000
    LONG = 48

    def __init__(self, path: str):
        self.ranks = load_ranks(path)
        self.cache: dict[bytes, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one slice: the lowest-ranked adjacent pair merges first, the leftmost of equals."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        if len(piece) > 64:
            return self._merge_long(piece)
        parts = [piece[i : i + 1] for i in range(len(piece))]
        get = ranks.get
        pairs = [get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
        while pairs and (low := min(pairs)) < 1 << 60:
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                pairs[i - 1] = get(parts[i - 1] + parts[i], 1 << 60)
        return [ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        end, prev, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = end[i]
            if j < n and (r := ranks.get(piece[i : end[j]])) is not None:
                heap.append((r, i, end[j])) if not ready else heapq.heappush(heap, (r, i, end[j]))

        ready = False
        for i in range(n):
            offer(i)
        heapq.heapify(heap)
        ready = True
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                prev[stop] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[np.ndarray]]:
        """Per text: its ids as little-endian 32-bit integers, and the byte end of each slice."""
        raw, begin, gaps = slices(texts)
        at = begin.tolist()
        parts = [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)], strict=True)]
        get, new, again = self.cache.get, {}, []
        out, ends, first = [], [], 0
        for k, g in enumerate(gaps.tolist()):
            ids = list(map(get, parts[first:g]))
            if None in ids:
                new.update((p, None) for p, x in zip(parts[first:g], ids, strict=True) if x is None)
                again.append((k, first))
                out.append(ids)
            else:
                out.append(b"".join(ids))
            ends.append(begin[first + 1 : g + 1] - begin[first])
            first = g + 1
        for p in new:
            self.cache[p] = np.array(self.merge(p), dtype="<i4").tobytes()
        for k, first in again:
            ids = out[k]
            out[k] = b"".join([x if x is not None else get(p) for p, x in zip(parts[first : first + len(ids)], ids, strict=True)])
        if len(self.cache) > self.CACHED:
            self.cache.clear()
        else:
            for p in new:
                if len(p) > self.LONG:
                    del self.cache[p]
        return out, ends


_MODELS: dict[str, BytePairs] = {}
_TABLES: dict[str, list[bytes]] = {}


def _model(path: str) -> BytePairs:
    if path not in _MODELS:
        _MODELS[path] = BytePairs(path)
    return _MODELS[path]


def _list_array(chunks: list[bytes], dtype, arrow_type) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(c) // 4 for c in chunks])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(chunks), dtype=dtype), arrow_type))


def _encode(path: str, with_offsets: bool):
    def run(batches):
        model = _model(path)
        for batch in batches:
            _, offs = text_buffer(batch.column("text"))
            for i, j in row_chunks(offs, 1 << 20):
                part = batch.slice(i, j - i)
                ids, ends = model.encode([t or "" for t in part.column("text").to_pylist()])
                cols = [*(c for n, c in zip(part.schema.names, part.columns, strict=True) if n != "text")]
                names = [n for n in part.schema.names if n != "text"]
                cols.append(_list_array(ids, "<i4", pa.int32()))
                if with_offsets:
                    cols.append(_list_array([e.astype("<i4").tobytes() for e in ends], "<i4", pa.int32()))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, "ids", *(["slice_ends"] if with_offsets else [])])

    return run


def _decode(path: str):
    def run(batches):
        if path not in _TABLES:
            ranks = load_ranks(path)
            table = [b""] * (max(ranks.values()) + 1)
            for token, rank in ranks.items():
                table[rank] = token
            _TABLES[path] = table
        token = _TABLES[path].__getitem__
        for batch in batches:
            ids = batch.column("ids")
            values, offs = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy().tolist()
            out = [b"".join(map(token, values[a:b].tolist())) for a, b in zip(offs, offs[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, "decoded"])

    return run


def _schema(df: DataFrame, drop: list[str], **more) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in drop] + [T.StructField(k, v) for k, v in more.items()])


def _rows(docs: DataFrame, text_col: str, keep: list[str] | None) -> DataFrame:
    keep = [c for c in (keep if keep is not None else docs.columns) if c != text_col]
    pad = F.lit(0).alias(free_name(keep))
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in keep], pad).alias("kept"), F.col(f"`{text_col}`").alias("text"))


def encode(docs: DataFrame, ranks: str, *, text_col: str = "text", keep: list[str] | None = None, with_offsets: bool = False) -> DataFrame:
    """`kept` (a struct of the kept columns), ids (array of int) and, if asked
    for, slice_ends: the byte end of every pre-token."""
    prepare(docs)
    rows = _rows(docs, text_col, keep)
    more = {"ids": T.ArrayType(T.IntegerType())} | ({"slice_ends": T.ArrayType(T.IntegerType())} if with_offsets else {})
    return rows.mapInArrow(_encode(ranks, with_offsets), _schema(rows, ["text"], **more))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Adds `decoded`: the bytes of `ids`."""
    prepare(encoded)
    return encoded.mapInArrow(_decode(ranks), _schema(encoded, [], decoded=T.BinaryType()))


def encode_and_decode(docs: DataFrame, ranks: str, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`kept`, ids and the bytes `decoded` from them, as of `encode` and then
    `decode`, but one Python worker a task runs both."""
    prepare(docs)
    rows = _rows(docs, text_col, keep)
    there, back = _encode(ranks, False), _decode(ranks)
    schema = _schema(rows, ["text"], ids=T.ArrayType(T.IntegerType()), decoded=T.BinaryType())
    return rows.mapInArrow(lambda batches: back(there(batches)), schema)


def round_trip(docs: DataFrame, ranks: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 per document."""
    both = encode_and_decode(docs, ranks, keep=["doc_id"])
    return both.select(
        F.col("kept.doc_id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

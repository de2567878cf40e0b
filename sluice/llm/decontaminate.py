"""Benchmark decontamination by a broadcast set of normalised n-grams.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the A-Z lower-cased text. A
benchmark item's windows are its runs of `n` words; an item of fewer words
(but not none) is one window. Each executor holds one block of the
benchmark's windows (sorted hashes plus the words) and scans whole documents:
hash lookups propose hits, the words are then compared. The scan is narrow;
no document is shuffled.

The block is bounded: `block_windows` windows at most are broadcast at a time.
A larger benchmark is taken in several blocks, one scan each, whose hits are
joined per document.

Edge cases: a null or empty text has no words and is clean; a null item text
gives no window; repeated items count once per item_id; null item_ids are
named as the empty string; empty tables give empty results; other columns of
either table are ignored (or kept, see `decontaminate`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free_name, prepare, stored
from .text import ALNUM, LOWER, Grams, find_words, hash_words, row_chunks, text_buffer

BLOCK_WINDOWS = 2_000_000
_BITS = 22


class WindowBlock:
    """Windows of some benchmark items: sorted hashes, words and item ids."""

    def __init__(self, items: list[tuple[str, list[bytes]]], n: int):
        self.n = n
        seen: dict[tuple[bytes, ...], set[str]] = {}
        for item, words in items:
            size = min(n, len(words))
            for i in range(len(words) - size + 1) if size else ():
                seen.setdefault(tuple(words[i : i + size]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, list]] = {}
        for size in sorted({len(w) for w in seen}):
            windows = [w for w in seen if len(w) == size]
            flat = b" ".join(b" ".join(w) for w in windows)
            data = np.frombuffer(flat, dtype=np.uint8)
            s, e, _ = find_words(data, np.array([0, len(data)]), ALNUM)
            grams = Grams(hash_words(data, s, e)).every(size)[::size]
            order = np.argsort(grams, kind="stable")
            mask = np.zeros(1 << _BITS, dtype=bool)
            mask[grams >> np.uint64(64 - _BITS)] = True
            self.by_length[size] = (grams[order], mask, [(windows[i], frozenset(seen[windows[i]])) for i in order])

    def hits(self, data, starts, ends, first, words):
        """(word position, window length, item ids) of each verified hit."""
        grams = Grams(words)
        raw = None
        for size, (known, mask, entries) in self.by_length.items():
            here = grams.every(size)
            maybe = np.flatnonzero(mask[here >> np.uint64(64 - _BITS)])
            if not len(maybe):
                continue
            at = np.searchsorted(known, here[maybe])
            ok = at < len(known)
            ok[ok] = known[at[ok]] == here[maybe][ok]
            for p, k in zip(maybe[ok].tolist(), at[ok].tolist(), strict=True):
                row = int(np.searchsorted(first, p, side="right")) - 1
                if p + size > first[row + 1]:
                    continue  # runs over the end of its document
                if raw is None:
                    raw = data.tobytes()
                found = tuple(raw[starts[q] : ends[q]] for q in range(p, p + size))
                while k < len(known) and known[k] == here[p]:
                    if entries[k][0] == found:
                        yield row, p - int(first[row]), size, entries[k][1]
                        break
                    k += 1


def _scan(block_value, finish=None):
    """Adds n_words, merged spans and items; what an earlier block found is in
    `before`. `finish` goes on with the batches in the same Python worker."""

    def run(batches):
        block = block_value.value
        for batch in batches:
            text = batch.column("text")
            rows = {"n_words": [], "spans": [], "items": []}
            data, offs = text_buffer(text)
            data = LOWER[data]
            for i, j in row_chunks(offs):
                part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
                starts, ends, first = find_words(part, o, ALNUM)
                words = hash_words(part, starts, ends)
                spans: list[list[dict]] = [[] for _ in range(j - i)]
                items: list[set] = [set() for _ in range(j - i)]
                for row, p, size, ids in block.hits(part, starts, ends, first, words):
                    spans[row].append({"first": p, "last": p + size})
                    items[row] |= ids
                rows["n_words"] += np.diff(first).tolist()
                rows["spans"] += [_merged(s) for s in spans]
                rows["items"] += [sorted(x) for x in items]
            if "before" in batch.schema.names:
                for k, b in enumerate(batch.column("before").to_pylist()):
                    rows["spans"][k] = _merged(rows["spans"][k] + b["spans"])
                    rows["items"][k] = sorted({*rows["items"][k], *b["items"]})
                batch = batch.select(["kept", "text"])
            extra = [
                pa.array(rows["n_words"], pa.int64()),
                pa.array(rows["spans"], pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
                pa.array(rows["items"], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, *rows])

    return run if finish is None else lambda batches: finish(run(batches))


def _merged(spans: list[dict]) -> list[dict]:
    out: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["first"], s["last"])):
        if out and s["first"] <= out[-1]["last"]:
            out[-1]["last"] = max(out[-1]["last"], s["last"])
        else:
            out.append(dict(s))
    return out


def _blocks(benchmark: DataFrame, n: int, block_windows: int, item_col: str, text_col: str):
    """Blocks of benchmark items, each of about `block_windows` words, and
    whether each is the last. Items are dealt to blocks in Spark; the driver
    holds one block at a time."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
    ).distinct()
    size = items.agg(F.sum(F.length("text") / 2 + 1)).first()[0] or 0
    count = int(size // block_windows) + 1
    for b in range(count):
        part = items if count == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == b)
        rows = []
        for item, text in part.toLocalIterator():
            data = LOWER[np.frombuffer(text.encode(), dtype=np.uint8)]
            s, e, _ = find_words(data, np.array([0, len(data)]), ALNUM)
            raw = data.tobytes()
            rows.append((item, [raw[x:y] for x, y in zip(s.tolist(), e.tolist(), strict=True)]))
        yield WindowBlock(rows, n), b == count - 1


_SPAN = T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(_SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _found(docs, benchmark, n, keep, text_col, item_col, item_text_col, block_windows, finish=None, schema=None) -> DataFrame:
    """kept, text, n_words, spans and items; or what `finish` makes of them."""
    spark = prepare(docs)
    out = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep if c != text_col], F.lit(0).alias(free_name(keep))).alias("kept"),
        F.col(f"`{text_col}`").alias("text"),
    )
    plain = T.StructType([*out.schema.fields, *_FOUND.fields])
    for block, last in _blocks(benchmark, n, block_windows, item_col, item_text_col):
        value = spark.sparkContext.broadcast(block)
        if last:
            return out.mapInArrow(_scan(value, finish), schema or plain)
        found = stored(out.mapInArrow(_scan(value), plain), "contamination")
        out = found.select("kept", "text", F.struct("spans", "items").alias("before"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    *,
    text_col: str = "text",
    keep: list[str] | None = None,
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Per document: the kept columns, its text, n_words, merged hit spans
    (word positions, end exclusive) and the ids of the items found (sorted)."""
    return _found(docs, benchmark, n, keep if keep is not None else docs.columns, text_col, item_col, item_text_col, block_windows)


def _covered():
    """Words inside any of the merged spans."""
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def contamination_report(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(docs, benchmark, n, keep=["doc_id"])
    return found.select(
        F.col("kept.doc_id").alias("doc_id"),
        "n_words",
        _covered().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    n: int = 10,
    *,
    drop_share: float = 0.5,
    text_col: str = "text",
    block_windows: int = BLOCK_WINDOWS,
) -> DataFrame:
    """Remove hit spans from the text; drop documents of which more than
    `drop_share` of the words are hit. Clean documents pass unchanged."""
    columns = docs.columns
    schema = T.StructType(
        [
            T.StructField("kept", T.StructType([f for f in docs.schema.fields if f.name != text_col] + [T.StructField(free_name(columns), T.IntegerType())])),
            T.StructField("text", T.StringType()),
        ]
    )
    cut = _found(docs, benchmark, n, columns, text_col, "item_id", "text", block_windows, _cut(drop_share), schema)
    return cut.select(*[F.col("text").alias(c) if c == text_col else F.col(f"kept.`{c}`").alias(c) for c in columns])


def _cut(drop_share: float):
    def run(batches):
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            n_words = batch.column("n_words").to_pylist()
            stay = [sum(x["last"] - x["first"] for x in s) <= drop_share * n for s, n in zip(spans, n_words, strict=True)]
            batch = batch.select(["kept", "text"]).filter(pa.array(stay, pa.bool_()))
            spans = [s for s, x in zip(spans, stay, strict=True) if x]
            if not any(spans):
                yield batch
                continue
            texts = batch.column("text").to_pylist()
            for k, s in enumerate(spans):
                if s:
                    texts[k] = _without(texts[k].encode(), s)
            yield pa.RecordBatch.from_arrays([batch.column("kept"), pa.array(texts, pa.string())], names=["kept", "text"])

    return run


def _without(raw: bytes, spans: list[dict]) -> str:
    starts, ends, _ = find_words(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]), ALNUM)
    out, at = [], 0
    for x in spans:
        out.append(raw[at : starts[x["first"]]])
        at = int(ends[x["last"] - 1])
    return b"".join([*out, raw[at:]]).decode()

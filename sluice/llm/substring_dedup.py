"""Substring dedup by level-wise doubling of repeated windows.

Goal: remove every word covered by a window of `min_words` consecutive words
whose word sequence also starts in a document with a smaller doc_id.

Level 1 takes windows of half that length. Only the window that is the
minimum (by hash) among the half-windows inside a full window speaks for it:
equal full windows choose the same one, so about 2 of 27 positions are
counted. The counts are a map-side combined min/max of doc_id per hash.
Half-windows seen in one document only are dropped; their full windows
cannot repeat.

Level 2 extends the survivors to twice the length. The full windows that one
half-window speaks for are a run, hashed first as one segment: an equal
segment in a smaller document settles the whole run with one row. Only the
first copy of each distinct segment, and only where a half-window has several
distinct segments, is taken apart into single windows; what they lose, every
run of that segment in the same document loses. The doubling ends when
no candidate survives or the target length is reached (longer repeats are
unions of target windows, so going on would change nothing).

Keys held by a third of the documents cost one row per task before the
shuffle; verdicts return by a plain equi-join of two stored tables, which the
adaptive skew join can split. Nothing is compared pairwise.

Window identity is the pair (half-window hash, window hash), 128 bits in all.

Edge cases: a null or empty text has no words; a document below `min_words`
words loses nothing; a null doc_id is never smaller, so it is no source, and
its document loses nothing; rows that share a doc_id do not affect each other;
repeated rows give repeated results; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare, stored
from .text import SPACED, U64, Grams, combine, find_words, hash_words, mix, row_chunks, signed, text_buffer

_PREFIX_BITS = 24


def _chunks(batch: pa.RecordBatch):
    """(doc ids, word hashes, word offsets by row, row keys) of batch parts."""
    data, offs = text_buffer(batch.column("text"))
    ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
    for i, j in row_chunks(offs, 4 << 20):
        part, o = data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        starts, ends, first = find_words(part, o, SPACED)
        yield ids[i:j].astype(np.int64), hash_words(part, starts, ends), first, (i, j)


def _sliding_first_min(x: np.ndarray, width: int) -> np.ndarray:
    """The position of the smallest of each `width` values in a row, the leftmost of equals."""
    at, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)
        right = x[step:] < x[: len(x) - step]
        at = np.where(right, at[step:], at[: len(at) - step])
        x = np.where(right, x[step:], x[: len(x) - step])
        have += step
    return at


def _runs(words: np.ndarray, first: np.ndarray, size: int, half: int):
    """The half-windows that speak for full windows: their positions, hashes,
    row, and the first and last full window of each one's run."""
    n = len(words) - size + 1
    if n <= 0:
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, U64), z, z, z, None
    grams = Grams(words)
    halves = grams.every(half)
    # by all 64 bits, so equal windows choose alike whatever the chunk's length
    chosen = _sliding_first_min(mix(halves), size - half + 1)
    row = np.searchsorted(first, np.arange(n), side="right") - 1
    inside = np.flatnonzero(np.arange(n) + size <= first[row + 1])
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, np.zeros(0, U64), z, z, z, None
    c = chosen[inside]
    begin = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (inside[1:] != inside[:-1] + 1)])
    lo, hi = inside[begin], inside[np.r_[begin[1:] - 1, len(inside) - 1]]
    anchor = c[begin]
    return anchor, halves[anchor], row[lo], lo, hi, grams


def _level_one(size: int, half: int):
    def run(batches):
        for batch in batches:
            for ids, words, first, _ in _chunks(batch):
                _, h, row, *_ = _runs(words, first, size, half)
                if not len(h):
                    continue
                order = np.argsort(h, kind="stable")
                h, d = h[order], ids[row][order]
                at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(h[at])),
                        pa.array(np.minimum.reduceat(d, at)),
                        pa.array(np.maximum.reduceat(d, at)),
                    ],
                    names=["h", "lo_doc", "hi_doc"],
                )

    return run


def _level_two(size: int, half: int, prefixes):
    """One row per surviving run; its single window hashes ride along for the
    smallest document of each distinct segment of a chunk."""

    def run(batches):
        words_of = prefixes.value
        for batch in batches:
            texts_key = batch.column("text_key").to_numpy(zero_copy_only=False)
            for ids, words, first, (i, j) in _chunks(batch):
                anchor, h, row, lo, hi, grams = _runs(words, first, size, half)
                top = h >> U64(64 - _PREFIX_BITS)
                keep = np.flatnonzero((words_of[(top >> U64(6)).astype(np.int64)] >> (top & U64(63))) & U64(1)) if len(h) else []
                if not len(keep):
                    continue
                anchor, h, row, lo, hi = anchor[keep], h[keep], row[keep], lo[keep], hi[keep]
                seg = combine(grams.span(lo, hi + size), (anchor - lo).astype(U64), (hi - lo).astype(U64))
                doc, key = ids[row], texts_key[i:j][row]
                order = np.lexsort((doc, seg, h))
                lead = np.zeros(len(h), dtype=bool)
                lead[order[np.flatnonzero(np.r_[True, (h[order][1:] != h[order][:-1]) | (seg[order][1:] != seg[order][:-1])])]] = True
                every = grams.every(size)
                windows = [every[a : b + 1].tobytes() if x else None for a, b, x in zip(lo.tolist(), hi.tolist(), lead.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(h)),
                        pa.array(signed(seg)),
                        pa.array(doc),
                        pa.array(key),
                        pa.array((lo - first[row]).astype(np.int32)),
                        pa.array((hi - lo).astype(np.int32)),
                        pa.array((anchor - lo).astype(np.int32)),
                        pa.array(windows, pa.binary()),
                    ],
                    names=["h", "seg", "doc", "text_key", "lo", "more", "off", "windows"],
                )

    return run


def _single_windows(batches):
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        raw = batch.column("windows").to_pylist()
        count = np.array([len(x) // 8 for x in raw])
        rep = np.repeat(np.arange(n), count)
        k = np.arange(len(rep)) - np.repeat(np.cumsum(count) - count, count)
        col = lambda c: batch.column(c).to_numpy(zero_copy_only=False)[rep]  # noqa: E731, B023
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(col("h")),
                pa.array(col("seg")),
                pa.array(signed(combine(np.frombuffer(b"".join(raw), dtype=U64), (col("off") - k).astype(np.int64).view(U64)))),
                pa.array(col("doc")),
                pa.array(k.astype(np.int32)),
            ],
            names=["h", "seg", "window", "doc", "k"],
        )


def _prefix_words(repeated: DataFrame) -> np.ndarray:
    """A bitmap over the leading 24 bits of the surviving hashes: 2**18 words
    at most, whatever the size of the corpus."""
    top = F.shiftrightunsigned("h", 64 - _PREFIX_BITS)
    words = repeated.groupBy(F.shiftright(top, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - _PREFIX_BITS}) & 63 as int))")).alias("bits")
    )
    out = np.zeros(1 << (_PREFIX_BITS - 6), dtype=np.int64)
    for batch in words.toArrow().to_batches():
        out[batch.column("w").to_numpy(zero_copy_only=False)] = batch.column("bits").to_numpy(zero_copy_only=False)
    return out.view(U64)


def duplicate_spans(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """doc, text_key (hash of the text) and spans: word positions [first, last)
    to remove, for the documents that have any. `docs`: doc_id, text."""
    spark = prepare(docs)
    half = (min_words + 1) // 2
    source = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", F.xxhash64("text").alias("text_key")
    )
    ones = source.select("doc_id", "text").mapInArrow(_level_one(min_words, half), "h long, lo_doc long, hi_doc long")
    repeated = stored(
        ones.groupBy("h")
        .agg(F.min("lo_doc").alias("lo_doc"), F.max("hi_doc").alias("hi_doc"))
        .where("lo_doc < hi_doc")
        .select("h"),
        "dedup_halves",
    )
    prefixes = spark.sparkContext.broadcast(_prefix_words(repeated))
    runs = source.mapInArrow(
        _level_two(min_words, half, prefixes),
        "h long, seg long, doc long, text_key long, lo int, more int, off int, windows binary",
    )
    runs = stored(runs.join(repeated, "h", "left_semi"), "dedup_runs")
    segments = runs.groupBy("h", "seg").agg(F.min("doc").alias("source_doc"))
    segments = stored(segments, "dedup_segments")
    whole = (
        runs.select("h", "seg", "doc", "text_key", "lo", "more")
        .join(segments, ["h", "seg"])
        .where("source_doc < doc")
        .select("doc", "text_key", F.col("lo").alias("first"), (F.col("lo") + F.col("more") + F.lit(min_words)).alias("last"))
    )
    # seeds with several distinct segments: compare single windows of each segment's first document
    several = segments.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    leads = (
        runs.where("windows is not null")
        .join(segments.join(several, "h", "left_semi").withColumnRenamed("source_doc", "doc"), ["h", "seg", "doc"])
        .select("h", "seg", "doc", "off", "windows")
    )
    single = stored(leads.mapInArrow(_single_windows, "h long, seg long, window long, doc long, k int"), "dedup_windows")
    sources = stored(
        single.groupBy("h", "window").agg(F.min("doc").alias("source_doc"), F.max("doc").alias("last_doc")).where("source_doc < last_doc"),
        "dedup_sources",
    )
    # all windows of a run hold its half-window, so those found overlap: they cover one span
    found = (
        single.join(sources, ["h", "window"])
        .where("source_doc < doc")
        .groupBy("h", "seg", "doc")
        .agg(F.min("k").alias("low"), F.max("k").alias("high"))
    )
    # the lead speaks for all runs of its segment in its document, and in others of the same doc_id
    parts = (
        runs.select("h", "seg", "doc", "text_key", "lo")
        .join(found, ["h", "seg", "doc"])
        .select("doc", "text_key", (F.col("lo") + F.col("low")).alias("first"), (F.col("lo") + F.col("high") + F.lit(min_words)).alias("last"))
    )
    return (
        whole.unionByName(parts)
        .distinct()
        .groupBy("doc", "text_key")
        .agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("spans"))
    )


def _keep_words(batches):
    for batch in batches:
        texts = batch.column("text")
        n_words, n_removed, digests, kept_texts = [], [], [], []
        for text, spans in zip(texts, batch.column("spans"), strict=True):
            words = (text.as_py() or "").encode().split()
            kept, at = [], 0
            for s in spans.as_py() or ():
                if s["last"] > at:
                    kept += words[at : max(at, s["first"])]
                    at = s["last"]
            kept += words[at:]
            out = b" ".join(kept)
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(out).hexdigest())
            kept_texts.append(out)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(n_words, pa.int64()),
                pa.array(n_removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept_texts, pa.binary()).cast(pa.string()),
            ],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def substring_dedup(docs: DataFrame, min_words: int = 50, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 and kept_text (the
    kept words joined by one space)."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    spans = duplicate_spans(rows, min_words)
    joined = rows.withColumn("text_key", F.xxhash64("text")).join(
        spans.withColumnRenamed("doc", "doc_id"), ["doc_id", "text_key"], "left"
    )
    return joined.select("doc_id", "text", "spans").mapInArrow(
        _keep_words, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"
    )

"""SimHash near-dedup with covering locality-sensitive hashing.

A document's fingerprint is the majority of its word-shingle hashes, bit by
bit. Fingerprints link when at most `radius` bits differ. Each bit position i
gets a vector m(i) of radius + 1 bits; table v (a non-zero vector) masks the
positions with an odd <m(i), v>. The vectors of the differing bits of a linked
pair span at most `radius` dimensions, so some v is orthogonal to all of them:
the pair agrees on that table's mask and collides there. No link is missed.

Equal fingerprints are one node, so copies never meet pairwise. A bucket
holds distinct fingerprints; inside it a search from node to node removes
whatever it reaches from the rest and emits one edge per node it adds, so a
bucket of b fingerprints gives fewer than b edges. Buckets above
`bucket_limit` are split by a second covering family over the positions that
their mask leaves free, again without missing a linked pair; each split
halves the free positions, so no bucket stays large. Bucket sizes are counted
first (map-side combined), and the members of large buckets are selected by a
join of two stored tables that the adaptive skew join can split.

Edge cases: null and empty texts have fingerprint zero and link like any
other; fewer than `shingle` words are one shingle; ties of a bit count give 0;
a null doc_id is a row of its own group's members but never names a component
(null if all ids of the component are null); different texts under one id have
a component each; repeated rows stay; an empty table gives an empty result;
other columns are ignored by `simhash_groups` and kept by `simhash_near_dedup`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .shared import prepare, stored
from .text import LOWER, row_chunks, text_buffer

BITS = 64
SEED = 42
BUCKET_LIMIT = 1024


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Majority of the bits of XXH64 over the word shingles of a lower-cased text."""
    words = text.split()
    if not words:
        return 0
    flat = b" ".join(words)
    digest, seed = xxhash.xxh64_intdigest, SEED
    if len(words) <= shingle:
        return digest(flat, seed)
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.cumsum(size + 1) - size - 1
    ends = (starts + size)[shingle - 1 :].tolist()
    hashes = np.fromiter(
        (digest(flat[a:b], seed) for a, b in zip(starts.tolist(), ends, strict=False)), dtype=np.uint64, count=len(ends)
    )
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        block = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += block.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches):
        for batch in batches:
            data, offs = text_buffer(batch.column("text"))
            out = np.zeros(batch.num_rows, dtype=np.uint64)
            for i, j in row_chunks(offs):
                raw = LOWER[data[offs[i] : offs[j]]].tobytes()
                for k in range(i, j):
                    out[k] = fingerprint(raw[offs[k] - offs[i] : offs[k + 1] - offs[i]], shingle)
            more = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in more), pa.array(out.view(np.int64))], names=[*more, "fp"])

    return run


def covering_masks(radius: int, positions: list[int], seed: int) -> list[int]:
    """2**(radius+1) - 1 masks over the positions; any `radius` of them miss one mask."""
    rng = np.random.default_rng(seed)
    codes = [1 + k % ((1 << (radius + 1)) - 1) for k in range(len(positions))]
    rng.shuffle(codes)
    return [
        sum(1 << p for p, c in zip(positions, codes, strict=True) if (c & v).bit_count() & 1)
        for v in range(1, 1 << (radius + 1))
    ]


def _as_long(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _links(radius: int):
    """Edges inside buckets. Rows come sorted by (mask, key); a bucket is at
    most BUCKET_LIMIT long, or has no free positions left to split by."""

    def edges(nodes: np.ndarray, fps: np.ndarray):
        left = np.argsort(nodes, kind="stable")
        while len(left):
            front, left = [left[0]], left[1:]
            while front and len(left):
                x = front.pop()
                near = np.bitwise_count(fps[left] ^ fps[x]) <= radius
                for y in left[near]:
                    yield nodes[x], nodes[y]
                front += left[near].tolist()
                left = left[~near]

    def run(batches):
        kept: list[tuple] = []

        def flush():
            nodes = np.concatenate([k[2] for k in kept])
            return list(edges(nodes, np.concatenate([k[3] for k in kept]))) if len(nodes) > 1 else []

        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "key", "node", "fp")]
            at = np.flatnonzero(np.r_[True, (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1])])
            found = []
            for a, b in zip(at.tolist(), [*at[1:].tolist(), batch.num_rows], strict=True):
                if kept and (kept[0][0], kept[0][1]) != (cols[0][a], cols[1][a]):
                    found += flush()
                    kept.clear()
                kept.append((cols[0][a], cols[1][a], cols[2][a:b], cols[3][a:b].view(np.uint64)))
            if found:
                yield _edge_batch(found)
        if kept and (found := flush()):
            yield _edge_batch(found)

    return run


def _edge_batch(found):
    x = np.array(found, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], names=["a", "b"])


def _tables(nodes: DataFrame, masks: list[int]) -> DataFrame:
    each = F.explode(F.array(*[F.lit(_as_long(m)) for m in masks])).alias("mask")
    return nodes.select("node", "fp", each).withColumn("key", F.expr("fp & mask"))


def similarity_edges(nodes: DataFrame, radius: int = 3, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """Edges (a, b) that connect all `nodes` (node, fp; one row per distinct
    fingerprint) with at most `radius` differing bits, directly or through
    others: the same components as all linked pairs, without listing them."""
    first = covering_masks(radius, list(range(BITS)), seed=1)
    level = stored(_tables(nodes, first), "simhash_tables")
    out = None
    free = {_as_long(m): [i for i in range(BITS) if not m >> i & 1] for m in first}
    while True:
        large = stored(
            level.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_limit).select("mask", "key"),
            "simhash_large",
        )
        split = {m for m, f in free.items() if 1 << len(f) > bucket_limit}
        last = not split or large.isEmpty()
        small = level if last else level.join(large.where(F.col("mask").isin(list(split))), ["mask", "key"], "left_anti")
        found = (
            small.repartition("mask", "key")
            .sortWithinPartitions("mask", "key")
            .mapInArrow(_links(radius), "a long, b long")
        )
        found = stored(found, "simhash_edges")
        out = found if out is None else out.unionByName(found)
        if last:
            return out
        # finer masks: the old mask plus a covering family over its free positions
        finer = {m: [_as_long((m % (1 << 64)) | x) for x in covering_masks(radius, free[m], seed=2)] for m in split}
        hot = level.join(large, ["mask", "key"]).where(F.col("mask").isin(list(split)))
        pick = F.create_map(*[y for m, xs in finer.items() for y in (F.lit(m), F.array(*map(F.lit, xs)))])
        level = stored(
            hot.select("node", "fp", F.explode(pick[F.col("mask")]).alias("mask"))
            .withColumn("key", F.expr("fp & mask"))
            .distinct(),
            "simhash_tables",
        )
        free = {x: [i for i in range(BITS) if not (x % (1 << 64)) >> i & 1] for xs in finer.values() for x in xs}


def _groups(rows: DataFrame, shingle: int, radius: int) -> DataFrame:
    """The rows' columns but `text`, and fp, c (the component's number) and component_id."""
    prepare(rows)
    kept = T.StructType([f for f in rows.schema.fields if f.name != "text"]).add("fp", "long")
    prints = stored(rows.mapInArrow(_fingerprints(shingle), kept), "simhash_fingerprints")
    # a fingerprint is a node by itself, so rows that share an id keep their own components
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "simhash_nodes")
    edges = similarity_edges(nodes.select(F.col("fp").alias("node"), "fp"), radius)
    named = nodes.join(connected_components(edges), F.col("fp") == F.col("node"), "left")
    named = stored(named.select("fp", "low", F.coalesce("component", "fp").alias("c")), "simhash_named")
    lowest = named.groupBy("c").agg(F.min("low").alias("component_id"))
    component = stored(named.select("fp", "c").join(lowest, "c"), "simhash_components")
    return prints.join(component, "fp")


def simhash_groups(
    docs: DataFrame, shingle: int = 3, radius: int = 3, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest
    doc_id reachable over links."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    groups = _groups(rows, shingle, radius)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def simhash_near_dedup(
    docs: DataFrame, shingle: int = 3, radius: int = 3, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each component: the one with the smallest id, of several
    texts under that id the one with the smallest digest, of rows that repeat
    id and text one. Another text under the id of a row that goes or stays is
    judged by its own component; rows without an id are always kept."""
    number = docs[f"`{id_col}`"].cast("long")
    digest = F.sha2(F.coalesce(docs[f"`{text_col}`"], F.lit("")), 256)
    rows = docs.select(number.alias("doc_id"), docs[f"`{text_col}`"].alias("text"), digest.alias("digest"))
    groups = stored(_groups(rows, shingle, radius).where("doc_id = component_id").groupBy("c", "doc_id", "digest").agg(F.count(F.lit(1)).alias("n")), "simhash_firsts")
    first = groups.groupBy("c").agg(F.min(F.struct("doc_id", "digest", "n")).alias("s")).select("s.*")
    first = stored(first, "simhash_stay")
    once, more = first.where("n = 1"), first.where("n > 1")

    def staying(these: DataFrame) -> DataFrame:
        return docs.join(these, (number == these["doc_id"]) & (digest == these["digest"]), "left_semi")

    out = staying(once).unionByName(docs.where(number.isNull()))
    if more.isEmpty():
        return out
    # rows that repeat id and text: one of each
    whole = staying(more)
    columns = whole.columns
    held = whole.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), number.alias("i"), digest.alias("d"))
    one = held.dropDuplicates(["i", "d"])
    return out.unionByName(one.select(*[F.col("row").getField(c).alias(c) for c in columns]))

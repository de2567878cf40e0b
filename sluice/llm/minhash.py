"""MinHash near-dedup with tensored banding.

A document's set holds its distinct word shingles (64-bit hashes). Two
collections of `width` keys are computed, each key joins `rows` minhashes. Table
(i, j) is keyed by key i of the first collection and key j of the second, so
width**2 tables need 2 * width * rows minhashes instead of 2 * width**2 * rows.
A pair of similarity s shares a table with probability
(1 - (1 - s**rows)**width)**2; at 0.8 with 3 rows and a width of 16 that is
0.99998, for closer pairs more. Whatever shares a table is compared on the full
sets, so no link is wrong.

Equal sets are one node, so copies never meet. A half key that one node alone
has cannot meet in any table; such halves go before the tables are formed, and
most documents send nothing further. The nodes of a table's bucket are tied to
its smallest node; what is tied together is a family, and only nodes of one
family can link.

Pairs are not listed. A family's sets are dealt to blocks by the number of
their shingles, one task's memory each, and a block is searched from node to
node: what a node links with leaves the rest and is searched from in turn, so
a family of copies costs one search per node over the few that are left. The
rest is indexed by shingle. A node asks its rarest shingles first (two sets of
that similarity share one among the rarest fifth of each) and counts whole
overlaps only if some answer. A node with too many shingles of its own in the
block links with none there. A family of several blocks is searched again for
every two blocks, between them only and only across the components found so
far. Sets are read from the texts of family nodes alone.

Edge cases: null texts and texts without words have an empty set, link with
nothing and are their own component; fewer words than a shingle make one
shingle; a null doc_id takes the component of its group but does not name it
(null if all ids of it are null); different texts under one id are judged each
by its own set; repeated rows stay rows of one node; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import connected_components
from .shared import prepare, stored
from .text import LOWER, SPACED, U64, Grams, combine, find_words, hash_words, mix, row_chunks, signed, text_buffer

ROWS = 3
WIDTH = 16
BLOCK_SHINGLES = 1 << 20
NODE_WEIGHT = 32
BROADCAST_ROWS = 200_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All documents' distinct shingle hashes, ascending in each, and their offsets."""
    starts, ends, first = find_words(data, offsets, SPACED)
    grams = Grams(hash_words(data, starts, ends))
    every = grams.every(size)
    n = first[1:] - first[:-1]
    short = np.flatnonzero((n > 0) & (n < size))
    whole = grams.span(first[short], first[short + 1])
    few = dict(zip(short.tolist(), whole, strict=True))
    sets = []
    for k in range(len(n)):
        if n[k] >= size:
            sets.append(np.unique(every[first[k] : first[k + 1] - size + 1]))
        else:
            sets.append(np.array([few[k]] if k in few else [], dtype=U64))
    return np.concatenate([*sets, np.zeros(0, U64)]), np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _digests(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums that name each set."""
    out = []
    for salt in (0x51, 0xA7):
        total = np.concatenate([np.zeros(1, U64), np.cumsum(mix(hashes + U64(salt)), dtype=U64)])
        out.append(total[offsets[1:]] - total[offsets[:-1]])
    return out[0], out[1]


def half_keys(hashes: np.ndarray, offsets: np.ndarray, rows: int, width: int) -> np.ndarray:
    """Documents x (2 * width) keys of `rows` minhashes each; the sets are not empty."""
    rng = np.random.default_rng(11)
    keys = []
    for _ in range(2 * width):
        least = []
        for _ in range(rows):
            flip, odd = rng.integers(0, 1 << 64, 2, dtype=np.uint64)
            x = (hashes ^ flip) * (odd | U64(1))
            x ^= x >> U64(32)
            x *= U64(0xD6E8FEB86659FD93)
            least.append(np.minimum.reduceat(x, offsets[:-1]))
        keys.append(combine(*least))
    return np.stack(keys, axis=1)


def _texts(batches, size: int):
    for batch in batches:
        data, offs = text_buffer(batch.column("text"))
        for i, j in row_chunks(offs):
            lowered = LOWER[data[offs[i] : offs[j]]]
            yield batch.slice(i, j - i), *shingle_sets(lowered, offs[i : j + 1] - offs[i], size)


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(signed(values)))


def _prints(size: int, rows: int, width: int):
    def run(batches):
        for batch, hashes, offs in _texts(batches, size):
            n = offs[1:] - offs[:-1]
            some = n > 0
            keys = np.zeros((len(n), 2 * width), dtype=U64)
            if some.any():
                keys[some] = half_keys(hashes, np.concatenate([offs[:-1][some], offs[-1:]]), rows, width)
            d1, d2 = _digests(hashes, offs)
            ends = np.arange(len(n) + 1, dtype=np.int64) * 2 * width
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(signed(d1)), pa.array(signed(d2)), _lists(ends, keys.ravel())],
                names=["doc_id", "n_shingles", "d1", "d2", "halves"],
            )

    return run


def _full_sets(size: int):
    def run(batches):
        for batch, hashes, offs in _texts(batches, size):
            d1, d2 = _digests(hashes, offs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(d1)), pa.array(signed(d2)), _lists(offs, hashes)], names=["d1", "d2", "hashes"]
            )

    return run


def _with_digests(size: int):
    def run(batches):
        for batch, hashes, offs in _texts(batches, size):
            d1, d2 = _digests(hashes, offs)
            columns = [batch.column("row"), batch.column("doc_id"), pa.array(signed(d1)), pa.array(signed(d2))]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "d1", "d2"])

    return run


class _Index:
    """Which of the nodes hold a code, by code."""

    def __init__(self, codes: np.ndarray, nodes: np.ndarray, size: int):
        order = np.argsort(codes, kind="stable")
        self.nodes = nodes[order]
        self.start = np.searchsorted(codes[order], np.arange(size + 1))

    def holders(self, codes: np.ndarray) -> np.ndarray:
        """Nodes with each of the codes, one after the other."""
        first, n = self.start[codes], self.start[codes + 1] - self.start[codes]
        total = int(n.sum())
        return self.nodes[np.repeat(first - np.cumsum(n) + n, n) + np.arange(total)]


def search(hashes: np.ndarray, offsets: np.ndarray, group: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links (positions) that connect all sets of enough similarity, directly or
    through others, given sets that are connected already (same `group`).
    Sets of one `side` are not compared unless it is negative."""
    n = np.diff(offsets)
    owner = np.repeat(np.arange(len(n)), n)
    _, codes, spread = np.unique(hashes, return_inverse=True, return_counts=True)
    # codes by rarity: the rarest of a set come first
    rank = np.empty(len(spread), np.int64)
    rank[np.argsort(spread, kind="stable")] = np.arange(len(spread))
    own = np.bincount(owner, spread[codes] == 1, len(n)).astype(np.int64)
    codes = rank[codes]
    order = np.lexsort((codes, owner))
    codes = codes[order]
    head = n - (percent * n + 99) // 100 + 1
    nth = np.arange(len(codes)) - offsets[:-1][owner]
    rare = nth < head[owner]
    left = 100 * (n - own) >= percent * n

    def indexed():
        at = left[owner]
        return _Index(codes[at & rare], owner[at & rare], len(spread)), _Index(codes[at], owner[at], len(spread)), int(left.sum())

    by_group: dict[int, list[int]] = {}
    for k, g in enumerate(group.tolist()):
        if left[k]:
            by_group.setdefault(g, []).append(k)
    if len(by_group) < 2:
        return []
    rarest, whole, size = indexed()
    remain = size
    links: list[tuple[int, int]] = []
    for g in sorted(by_group, key=lambda g: -len(by_group[g])):
        front = by_group.pop(g, None)
        if front is None:
            continue
        left[front] = False
        remain -= len(front)
        while front and by_group:
            x = front.pop()
            mine = codes[offsets[x] : offsets[x + 1]]
            near = rarest.holders(mine[: head[x]])
            near = near[left[near]]
            if side[x] >= 0:
                near = near[side[near] != side[x]]
            if not len(near):
                continue
            near = np.unique(near)
            both = np.bincount(whole.holders(mine), minlength=len(n))[near]
            for y in near[100 * both >= percent * (n[x] + n[near] - both)].tolist():
                if left[y]:
                    links.append((x, y))
                    joined = by_group.pop(int(group[y]))
                    left[joined] = False
                    remain -= len(joined)
                    front += joined
            if 2 * remain < size:
                rarest, whole, size = indexed()
    return links


def _search_blocks(percent: int):
    """Links in each block; rows come sorted by (family, part, node)."""

    def run(batches):
        rows: list[tuple] = []
        at = None

        def found():
            lists = [r[3] for r in rows]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            group, side = (np.array([r[k] for r in rows], dtype=np.int64) for k in (1, 2))
            return [(rows[x][0], rows[y][0]) for x, y in search(np.concatenate(lists), offsets, group, side, percent)]

        def batch_of(links):
            x = np.array(links, dtype=np.int64)
            return pa.RecordBatch.from_arrays([pa.array(x[:, 0].copy()), pa.array(x[:, 1].copy())], names=["a", "b"])

        for batch in batches:
            lists = batch.column("hashes")
            ends = np.asarray(lists.offsets).astype(np.int64)
            flat = lists.values.to_numpy(zero_copy_only=False).view(U64)
            keys = zip(batch.column("family").to_pylist(), batch.column("part").to_pylist(), strict=True)
            others = (batch.column(c).to_pylist() for c in ("node", "c", "side"))
            for k, (key, node, c, side) in enumerate(zip(keys, *others, strict=True)):
                if key != at:
                    if rows and (links := found()):
                        yield batch_of(links)
                    rows, at = [], key
                rows.append((node, c, side, flat[ends[k] : ends[k + 1]].copy()))
        if rows and (links := found()):
            yield batch_of(links)

    return run


def _small(df: DataFrame) -> DataFrame:
    """A stored table, broadcast if its counted rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _ties(nodes: DataFrame, width: int) -> DataFrame:
    """(node, the smallest node of a table's bucket that it is in)."""
    half = nodes.select("node", F.posexplode("halves").alias("slot", "half"))
    met = half.groupBy("slot", "half").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = half.join(met.select("slot", "half"), ["slot", "half"], "left_semi")
    sides = stored(
        shared.groupBy("node").agg(F.collect_list(F.struct("slot", "half")).alias("s")).select(
            "node",
            F.filter("s", lambda x: x["slot"] < width).alias("left"),
            F.filter("s", lambda x: x["slot"] >= width).alias("right"),
        ),
        "minhash_halves",
    )
    tables = F.flatten(
        F.transform("left", lambda x: F.transform("right", lambda y: F.xxhash64(x["slot"], y["slot"], x["half"], y["half"])))
    )
    rows = sides.select("node", F.explode(tables).alias("key"))
    met = rows.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high")
    ties = rows.join(met.select("key", "low"), "key").where("node != low")
    return stored(ties.select(F.col("node").alias("a"), F.col("low").alias("b")).distinct(), "minhash_ties")


def _linked(rows: DataFrame, percent: int) -> DataFrame:
    """Links among rows (family, part, node, c, side, hashes)."""
    dealt = rows.repartition("family", "part").sortWithinPartitions("family", "part", "node")
    return stored(dealt.mapInArrow(_search_blocks(percent), "a long, b long"), "minhash_links")


def _families(nodes: DataFrame, width: int, block: int) -> DataFrame:
    """node, family, blocks, block of every node that shares a table with another."""
    ties = _ties(nodes, width)
    tied = stored(connected_components(ties), "minhash_families")
    named = tied.select("node", F.col("component").alias("family")).unionByName(
        tied.select(F.col("component").alias("node"), F.col("component").alias("family")).distinct()
    )
    named = stored(named.join(nodes.select("node", "n"), "node"), "minhash_families")
    sizes = named.groupBy("family").agg(F.ceil(F.sum(F.col("n") + NODE_WEIGHT) / block).alias("blocks"))
    dealt = named.join(_small(stored(sizes, "minhash_sizes")), "family")
    return stored(
        dealt.select("node", "family", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block")),
        "minhash_blocks",
    )


def similar_nodes(nodes: DataFrame, sets_of, *, width: int = WIDTH, percent: int = 80) -> DataFrame:
    """(node, component) of all nodes (node, n, halves) that link with another.

    `sets_of(members)` adds the members' hashes."""
    families = _families(nodes, width, BLOCK_SHINGLES)
    sets = sets_of(families)
    alone = sets.select("family", F.col("block").alias("part"), "node", F.col("node").alias("c"), F.lit(-1).cast("long").alias("side"), "hashes")
    links = _linked(alone, percent)
    found = stored(connected_components(links), "minhash_components")
    wide = sets.where("blocks > 1")
    if families.where("blocks > 1").isEmpty():
        return found
    # every two blocks of a family: a node goes to the pairs that its block is in
    named = wide.join(found, "node", "left").withColumn("c", F.coalesce("component", "node"))
    pairs = named.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).where("other != block")
    pairs = pairs.withColumn("part", F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    across = _linked(pairs.select("family", "part", "node", "c", F.col("block").alias("side"), "hashes"), percent)
    links = found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(across)
    return stored(connected_components(links), "minhash_components")


def _groups(texts: DataFrame, shingle: int, percent: int, rows: int, width: int) -> DataFrame:
    """doc_id, n_shingles, d1, d2 (the set's digests) and component_id of every row."""
    prepare(texts)
    prints = stored(
        texts.mapInArrow(_prints(shingle, rows, width), "doc_id long, n_shingles long, d1 long, d2 long, halves array<long>"),
        "minhash_prints",
    )
    sets = prints.where("n_shingles > 0").groupBy("d1", "d2")
    nodes = sets.agg(F.min("doc_id").alias("low_id"), F.first("n_shingles").alias("n"), F.first("halves").alias("halves"))
    # the node's number is fixed by the write
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "minhash_nodes")

    def sets_of(members: DataFrame) -> DataFrame:
        wanted = stored(nodes.select("node", "d1", "d2", "low_id").join(members, "node"), "minhash_wanted")
        ids = wanted.where("low_id is not null").select(F.col("low_id").alias("doc_id")).distinct()
        some = texts.join(_small(ids), "doc_id", "left_semi").unionByName(texts.where("doc_id is null"))
        full = some.mapInArrow(_full_sets(shingle), "d1 long, d2 long, hashes array<long>")
        found = stored(full.join(_small(wanted.drop("low_id")), ["d1", "d2"]).drop("d1", "d2"), "minhash_sets")
        # rows repeated under one id give a set twice
        return found if found.count() == wanted.count() else stored(found.dropDuplicates(["node"]), "minhash_sets")

    found = similar_nodes(nodes.select("node", "n", "halves"), sets_of, width=width, percent=percent)
    named = nodes.select("node", "d1", "d2", "low_id").join(found, "node", "left")
    named = stored(named.select("d1", "d2", "low_id", F.coalesce("component", "node").alias("c")), "minhash_named")
    lowest = named.groupBy("c").agg(F.min("low_id").alias("component_id"))
    by_set = stored(named.join(lowest, "c").select("d1", "d2", "component_id"), "minhash_groups")
    own = prints.where("n_shingles = 0").drop("halves").withColumn("component_id", F.col("doc_id"))
    linked = prints.where("n_shingles > 0").drop("halves").join(by_set, ["d1", "d2"])
    return linked.unionByName(own)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))


def minhash_groups(
    docs: DataFrame,
    shingle: int = 4,
    percent: int = 80,
    *,
    rows: int = ROWS,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links of at least `percent` similarity) and kept (it is its own)."""
    groups = _groups(_rows(docs, id_col, text_col), shingle, percent, rows, width)
    return groups.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def minhash_near_dedup(
    docs: DataFrame, shingle: int = 4, percent: int = 80, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` without those whose own text is in a component that a
    smaller id names. A row goes by its id and its set, so another text under
    the same id is judged by its own component; rows without an id go if their
    component has one."""
    texts = _rows(docs, id_col, text_col)
    groups = _groups(texts, shingle, percent, ROWS, WIDTH)
    gone = stored(
        groups.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "d1", "d2").distinct(), "minhash_gone"
    )
    fields = [f"`{f.name}`" for f in docs.schema.fields]
    whole = docs.select(F.struct(*fields).alias("row"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType([*whole.schema.fields[:2], T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType())])
    marked = whole.mapInArrow(_with_digests(shingle), schema)
    g = _small(gone.select(F.col("doc_id").alias("gone_id"), "d1", "d2"))
    left = marked.join(g, F.col("doc_id").eqNullSafe(F.col("gone_id")) & (marked["d1"] == g["d1"]) & (marked["d2"] == g["d2"]), "left_anti")
    return left.select(*[F.col("row").getField(f.name).alias(f.name) for f in docs.schema.fields])

"""Vector code compression by product quantisation with memoised grid cells.

A component x becomes the integer floor(1024 * x), and a vector is cut into
equal consecutive parts. Each part position has a codebook, first that part of
the vectors with the smallest ids; a round assigns every part to its nearest
entry (squared distance, ties to the lower index) and moves each entry to the
floored mean of its parts.

The nearest entry is found through a grid. A part's cell is its components
floor-divided by `step`; the cell is a box. For a box, each entry has a least
and a greatest distance, sums over components, so both come from one table per
component with a row per grid coordinate. An entry whose least distance exceeds
the smallest greatest distance is nowhere nearest in the box. The entries left
are remembered under the cell's hash (the cell itself is compared, so a hash
collision is computed anew), and only they are evaluated exactly. A cell shared
by copies or close vectors is judged once per task. The memory of a task's
cells is bounded (`CACHED`); what is forgotten is computed again.

Spark reads the integer vectors once a round; a task folds its rows into sums
per entry and component, so what is shuffled does not grow with the rows of a
task, and the driver gets at most entries * components sums. Label totals are
pre-aggregated and joined back.

Edge cases: vectors that are null or hold null or non-finite components are
dropped. Vectors whose length is not a multiple of the parts or not that of the
smallest id's (regular) vector, or with a component of 2**17 or more in
magnitude (beyond exact 64-bit sums), stay out of the codebooks and have null
code and error; a label of such rows alone has a null total. Fewer than 256
vectors give as many entries. Equal ids are ordered by their components, null
ids come last; repeated rows count each. Labels may be null (one group). An
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import prepare, stored
from .text import U64, mix

SCALE = 1024
LIMIT = 1 << 27
CACHED = 1 << 16
BLOCK = 256
BROADCAST_LABELS = 100_000


def grid_step(entries: np.ndarray) -> int:
    """A quarter of the entries' mean spread, as a power of two."""
    spread = float(entries.std(axis=0).mean()) if entries.size else 0.0
    return 1 << max(0, int(np.log2(spread / 4))) if spread >= 4 else 1


class GridCells:
    """Nearest entries of one part position's codebook, by memoised cells."""

    def __init__(self, entries: np.ndarray, step: int, cached: int = CACHED):
        self.entries, self.step, self.cached = entries, step, cached
        rng = np.random.default_rng(13)
        self.weights = rng.integers(1, 1 << 63, entries.shape[1], dtype=np.uint64) | U64(1)
        self._forget()
        self.judged = self.asked = 0

    def _forget(self) -> None:
        k, d = self.entries.shape
        self.keys = np.zeros(0, dtype=np.uint64)
        self.cells = np.zeros((0, d), dtype=np.int64)
        self.masks = np.zeros((0, (k + 7) // 8), dtype=np.uint8)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Packed bits of the entries that may be nearest somewhere in each cell."""
        out = [np.zeros((0, self.masks.shape[1]), dtype=np.uint8)]
        for i in range(0, len(cells), 1024):
            block = cells[i : i + 1024]
            near = np.zeros((len(block), len(self.entries)), dtype=np.int64)
            far = np.zeros_like(near)
            for j in range(cells.shape[1]):
                coords, at = np.unique(block[:, j], return_inverse=True)
                low = coords[:, None] * self.step
                below, above = low - self.entries[:, j], self.entries[:, j] - (low + self.step - 1)
                gap = np.maximum(np.maximum(below, above), 0)
                reach = np.maximum(-below, -above)
                near += (gap * gap)[at]
                far += (reach * reach)[at]
            out.append(np.packbits(near <= far.min(axis=1, keepdims=True), axis=1))
        self.judged += len(cells)
        return np.concatenate(out)

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        cells = parts // self.step
        hashed = mix((cells.astype(np.uint64) * self.weights).sum(axis=1, dtype=np.uint64))
        keys, first, back = np.unique(hashed, return_index=True, return_inverse=True)
        own = cells[first]
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        taken = known.copy()
        known[known] = (self.cells[at[known]] == own[known]).all(axis=1)
        masks = np.empty((len(keys), self.masks.shape[1]), dtype=np.uint8)
        masks[known] = self.masks[at[known]]
        masks[~known] = self.undominated(own[~known])
        fresh = ~taken
        if fresh.any():
            if len(self.keys) + int(fresh.sum()) > self.cached:
                self._forget()
            both = np.concatenate([self.keys, keys[fresh]])
            order = np.argsort(both, kind="stable")
            self.keys = both[order]
            self.cells = np.concatenate([self.cells, own[fresh]])[order]
            self.masks = np.concatenate([self.masks, masks[fresh]])[order]
        rows = masks[back]
        other = (cells != own[back]).any(axis=1)
        if other.any():
            rows[other] = self.undominated(cells[other])
        self.asked += len(parts)
        return rows

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each part's nearest entry."""
        codes = np.empty(len(parts), dtype=np.int64)
        errors = np.empty(len(parts), dtype=np.int64)
        masks = self.candidates(parts)
        for i in range(0, len(parts), BLOCK):
            x = parts[i : i + BLOCK]
            row, entry = np.nonzero(np.unpackbits(masks[i : i + BLOCK], axis=1, count=len(self.entries)))
            apart = x[row] - self.entries[entry]
            far = np.einsum("ij,ij->i", apart, apart)
            start = np.searchsorted(row, np.arange(len(x)))
            least = np.minimum.reduceat(far, start)
            hit = np.flatnonzero(far == least[row])
            codes[i : i + BLOCK] = entry[hit[np.searchsorted(row[hit], np.arange(len(x)))]]
            errors[i : i + BLOCK] = least
        return codes, errors


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _assign(books: np.ndarray, step: list[int]):
    """For batches of integer vectors: codes (rows x parts) and errors."""
    grids = [GridCells(book, s) for book, s in zip(books, step, strict=True)]
    width = books.shape[2]

    def run(vectors: np.ndarray):
        found = [g.nearest(vectors[:, p * width : (p + 1) * width]) for p, g in enumerate(grids)]
        return np.stack([c for c, _ in found], axis=1), np.sum([e for _, e in found], axis=0)

    return run


def _partial_sums(books: np.ndarray, step: list[int]):
    parts, size, width = books.shape

    def run(batches):
        assign = _assign(books, step)
        total = np.zeros(books.shape, dtype=np.int64)
        count = np.zeros((parts, size), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), parts * width)
            if not len(x):
                continue
            codes, _ = assign(x)
            for p in range(parts):
                count[p] += np.bincount(codes[:, p], minlength=size)
                for j in range(width):
                    # exact: below 2**53 for any batch of fewer than 2**26 rows
                    total[p, :, j] += np.bincount(codes[:, p], x[:, p * width + j], size).astype(np.int64)
        used = count > 0
        p, e = np.nonzero(used)
        n, sums = count[used], total[used]
        cells = np.tile(np.arange(width, dtype=np.int32), len(p))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(p, width).astype(np.int32)),
                pa.array(np.repeat(e, width).astype(np.int32)),
                pa.array(cells),
                pa.array(sums.ravel()),
                pa.array(np.repeat(n, width)),
            ],
            names=["part", "entry", "pos", "total", "n"],
        )

    return run


def _codes(books: np.ndarray, step: list[int]):
    parts, _, width = books.shape

    def run(batches):
        assign = _assign(books, step)
        for batch in batches:
            v = batch.column("v")
            regular = v.is_valid()
            x = _matrix(v.filter(regular), parts * width)
            mask = ~regular.to_numpy(zero_copy_only=False)
            code = np.full(batch.num_rows, None, dtype=object)
            error = np.zeros(batch.num_rows, dtype=np.int64)
            if len(x):
                codes, errors = assign(x)
                text = codes.astype(np.uint8).tobytes().hex()
                code[~mask] = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                error[~mask] = errors
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code, pa.string()), pa.array(error, mask=mask)],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def integer_vectors(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label and v, the kept vectors' integer components."""
    x = F.col(f"`{vector_col}`")
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    kept = df.where(x.isNotNull() & F.coalesce(fine, F.lit(False)))
    return kept.select(
        F.col(f"`{id_col}`").alias("vec_id"),
        F.col(f"`{label_col}`").alias("label"),
        F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v"),
    )


def compress(
    df: DataFrame,
    *,
    parts: int = 4,
    entries: int = 256,
    rounds: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error of every kept vector, and the codebooks
    (parts x entries x components). At most 256 entries: a code byte each."""
    if not 0 < entries <= 256:
        raise ValueError("entries must be between 1 and 256")
    spark = prepare(df)
    rows = integer_vectors(df, id_col, vector_col, label_col)
    near = F.forall("v", lambda c: F.abs(c) < F.lit(LIMIT))
    rows = stored(
        rows.withColumn("v", F.when((F.size("v") % parts == 0) & near, F.transform("v", lambda c: c.cast("int")))),
        "vector_integers",
    )
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    schema = T.StructType([*rows.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    regular = rows.where("v is not null")
    head = regular.orderBy(*order).select(F.size("v").alias("dims")).first()
    if head is None:
        empty = rows.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), dtype=np.int64)
    dims = head["dims"]
    regular = regular.where(F.size("v") == dims)
    first = regular.orderBy(*order).limit(entries).select("v").collect()
    books = np.array([r["v"] for r in first], dtype=np.int64).reshape(len(first), parts, dims // parts).transpose(1, 0, 2).copy()
    step = [grid_step(book) for book in books]
    for _ in range(rounds):
        sums = regular.select("v").mapInArrow(
            _partial_sums(books, step), "part int, entry int, pos int, total long, n long"
        )
        means = sums.groupBy("part", "entry", "pos").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        books = books.copy()
        for r in means.collect():  # at most entries * dims rows
            books[r["part"], r["entry"], r["pos"]] = r["total"] // r["n"]
    same = rows.withColumn("v", F.when(F.size("v") == dims, F.col("v")))
    return stored(same.mapInArrow(_codes(books, step), schema), "vector_codes"), books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(df: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256."""
    coded, books = compress(df, **options)
    totals = stored(coded.groupBy("label").agg(F.try_sum("error").alias("label_error")), "vector_labels")
    totals = totals.withColumnRenamed("label", "_label")
    if totals.count() <= BROADCAST_LABELS:
        totals = F.broadcast(totals)
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )

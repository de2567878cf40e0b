"""Cross-tokenizer alignment by lockstep vectorised merging.

Both token sequences of a document spell the same bytes, so their byte ends
are two ascending lists with the same last element. All documents of a chunk
are merged at once: a state vector holds one lane per document (a long
document has a lane per `LANE` tokens of A, its B pointer found by binary
search), each with an A and a B pointer. A step emits the link (A token, B
token) of every lane, a cut where both tokens end together, and advances the
pointer of the earlier end, or both. Finished lanes are compacted away. A
step costs a few numpy calls for all lanes; the number of steps is bounded by
the longest lane, not the longest document.

The links of an id pair are counted over the corpus: a task sends a document's
distinct pairs with their numbers, Spark sums them. The counts return to the
documents by a join: pairs with at least 1/`BROADCAST_PAIRS` of all links (so at
most that many, whatever the corpus) are broadcast, the rest are joined by
shuffle, where no pair has more rows than that share. The best count of each B
id has at most one row per id of B's vocabulary and is broadcast.

Edge cases: null and empty texts, and texts whose joined A or B token bytes are
not space + text (such as those with U+2581), have no tokens: all figures 0
and the digest ''. Strings of special tokens are plain text. Ids may be null
or repeat; every row gives one result row. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import prepare, stored
from .text import row_chunks, text_buffer
from .token_store import PieceEncoder

LANE = 256
CHUNK_BYTES = 1 << 19
BROADCAST_PAIRS = 1 << 19


class _Pieces(PieceEncoder):
    CACHED = 700_000


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a letter: printable bytes as
    themselves, the others as the letters from U+0100 on, in order."""
    shown = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the bytes of each id."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = _Pieces(a_path, special_as_text=True)
        letters = _byte_letters()
        vocab = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            plain = all(c in letters for c in token)
            self.a_bytes[i] = bytes(letters[c] for c in token) if plain else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_size = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_size = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_text, self.b_text = _digits(len(self.a_bytes)), _digits(len(self.b_bytes))

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and B of every text; both empty where they do not spell space + text."""
        some = [i for i, t in enumerate(texts) if t]
        spaced = [" " + texts[i] for i in some]
        a: list[np.ndarray] = [np.zeros(0, np.int64)] * len(texts)
        b = list(a)
        if not some:
            return a, b
        raws = self.a.encode(spaced)
        pieces = self.b.encode([texts[i] for i in some], num_threads=1)
        for i, whole, raw, y in zip(some, spaced, raws, pieces, strict=True):
            x = np.frombuffer(raw, dtype=self.a.dtype).astype(np.int64)
            want = whole.encode()
            if b"".join(map(self.b_bytes.__getitem__, y)) == want and b"".join(map(self.a_bytes.__getitem__, x.tolist())) == want:
                a[i], b[i] = x, np.array(y, dtype=np.int64)
        return a, b


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 .. n-1, left-aligned, and their lengths."""
    width = len(str(max(n - 1, 0)))
    text = np.array([str(i) for i in range(n)], dtype=f"S{width}")
    return text.view(np.uint8).reshape(n, width), np.array([len(str(i)) for i in range(n)], dtype=np.int64)


def lockstep(a_end: np.ndarray, b_end: np.ndarray, first: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links (A index, B index) and whether both end there, in order.

    `a_end`, `b_end`: byte ends over all documents, `first`: the first A index
    of each document, and the number of A tokens at its end."""
    n = first[1:] - first[:-1]
    lanes = (n + lane - 1) // lane
    doc = np.repeat(np.arange(len(n)), lanes)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    a = first[:-1][doc] + nth * lane
    stop = np.minimum(a + lane, first[1:][doc])
    begin = np.where(a > 0, a_end[a - 1], 0) if len(a) else np.zeros(0, np.int64)
    b = np.searchsorted(b_end, begin, side="right")
    who = np.arange(len(a))
    steps = np.zeros(len(a), dtype=np.int64)
    out: list[tuple] = []
    step = 0
    while len(a):
        x, y = a_end[a], b_end[b]
        out.append((who, a, b, x == y))
        a, b = a + (x <= y), b + (y <= x)
        step += 1
        on = a < stop
        if not on.all():
            steps[who[~on]] = step
            a, b, stop, who = a[on], b[on], stop[on], who[on]
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none.astype(bool)
    at = (np.cumsum(steps) - steps)[np.concatenate([w for w, *_ in out])]
    at += np.repeat(np.arange(len(out)), [len(w) for w, *_ in out])
    links = []
    for k in (1, 2, 3):
        column = np.concatenate([o[k] for o in out])
        placed = np.empty_like(column)
        placed[at] = column
        links.append(placed)
    return links[0], links[1], links[2]


def _group_text(tools: Tokenizers, a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray):
    """The groups of all documents as one byte string `a1,a2|b1;`..., and the
    end of each group in it."""
    n = int(a_group[-1]) + 1 if len(a_group) else 0
    na, nb = np.bincount(a_group, minlength=n), np.bincount(b_group, minlength=n)
    start = np.cumsum(na + nb) - na - nb
    place_a = np.arange(len(a)) + (np.cumsum(nb) - nb)[a_group]
    place_b = np.arange(len(b)) + np.cumsum(na)[b_group]
    width = max(tools.a_text[0].shape[1], tools.b_text[0].shape[1]) + 1
    letters = np.zeros((len(a) + len(b), width), dtype=np.uint8)
    sizes = np.empty(len(a) + len(b), dtype=np.int64)
    for place, ids, (text, size) in ((place_a, a, tools.a_text), (place_b, b, tools.b_text)):
        letters[place, : text.shape[1]] = text[ids]
        sizes[place] = size[ids]
    mark = np.full(len(sizes), ord(","), dtype=np.uint8)
    mark[start + na - 1] = ord("|")
    mark[start + na + nb - 1] = ord(";")
    letters[np.arange(len(sizes)), sizes] = mark
    flat = letters[np.arange(width) <= sizes[:, None]]
    return flat.tobytes(), np.cumsum(sizes + 1)[start + na + nb - 1]


def align(tools: Tokenizers, texts: list[str], lane: int = LANE) -> dict:
    """Per text: n_a, n_b, n_groups, n_links, groups_sha256 and the distinct
    linked id pairs (a * size of B + b) with their numbers of links."""
    a_ids, b_ids = tools.encode(texts)
    rows = len(texts)
    n_a = np.array([len(x) for x in a_ids], dtype=np.int64)
    n_b = np.array([len(x) for x in b_ids], dtype=np.int64)
    a = np.concatenate([*a_ids, np.zeros(0, np.int64)])
    b = np.concatenate([*b_ids, np.zeros(0, np.int64)])
    first = np.concatenate([[0], np.cumsum(n_a)])
    link_a, link_b, cut = lockstep(np.cumsum(tools.a_size[a]), np.cumsum(tools.b_size[b]), first, lane)
    doc = np.repeat(np.arange(rows), n_a)[link_a]
    group = np.cumsum(cut) - cut
    a_group, b_group = np.empty(len(a), np.int64), np.empty(len(b), np.int64)
    a_group[link_a], b_group[link_b] = group, group
    n_groups = np.bincount(doc[cut], minlength=rows)
    text, ends = _group_text(tools, a, b, a_group, b_group)
    digests, last = [], np.cumsum(n_groups)
    begin = 0
    for k in range(rows):
        if not n_groups[k]:
            digests.append("")
            continue
        end = int(ends[last[k] - 1])
        digests.append(hashlib.sha256(text[begin : end - 1]).hexdigest())
        begin = end
    size_b = len(tools.b_bytes)
    span = len(tools.a_bytes) * size_b
    pairs, n = np.unique(doc * span + a[link_a] * size_b + b[link_b], return_counts=True)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": np.bincount(doc, minlength=rows),
        "groups_sha256": digests,
        "pairs": pairs % span,
        "pair_n": n,
        "pair_ends": np.searchsorted(pairs, np.arange(rows + 1) * span),
    }


_TOOLS: dict[tuple[str, str], Tokenizers] = {}
_ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, pair_n array<long>"


def _run(a_path: str, b_path: str):
    def run(batches):
        tools = _TOOLS.get((a_path, b_path)) or _TOOLS.setdefault((a_path, b_path), Tokenizers(a_path, b_path))
        for batch in batches:
            _, offs = text_buffer(batch.column("text"))
            for i, j in row_chunks(offs, CHUNK_BYTES):
                part = batch.slice(i, j - i)
                out = align(tools, [t or "" for t in part.column("text").to_pylist()])
                ends = pa.array(out["pair_ends"].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *(pa.array(out[c]) for c in ("n_a", "n_b", "n_groups", "n_links")),
                        pa.array(out["groups_sha256"], pa.string()),
                        pa.ListArray.from_arrays(ends, pa.array(out["pairs"])),
                        pa.ListArray.from_arrays(ends, pa.array(out["pair_n"])),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "pair_n"],
                )

    return run


def align_documents(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per document with its figures, its distinct id pairs
    and their numbers, and `row`, which names the row."""
    prepare(docs)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # `row` is fixed by the write: whatever attempt is committed is read from then on
    return stored(rows.mapInArrow(_run(a_path, b_path), _ALIGNED).withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """pair, links (over the corpus), best (no pair of its B id has more)."""
    each = aligned.select(F.explode(F.arrays_zip("pairs", "pair_n")).alias("p")).select("p.pairs", "p.pair_n")
    counts = stored(each.groupBy(F.col("pairs").alias("pair")).agg(F.sum("pair_n").alias("links")), "pair_counts")
    most = counts.groupBy((F.col("pair") % b_size).alias("b")).agg(F.max("links").alias("most"))
    joined = counts.join(F.broadcast(most), F.col("pair") % b_size == F.col("b"))
    return stored(joined.select("pair", "links", (F.col("links") == F.col("most")).alias("best")), "pair_best")


def alignment_report(
    docs: DataFrame, a_path: str, b_path: str, *, broadcast_pairs: int = BROADCAST_PAIRS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    import sentencepiece

    b_size = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    aligned = align_documents(docs, a_path, b_path, id_col=id_col, text_col=text_col)
    counts = pair_counts(aligned, b_size)
    size = counts.agg(F.count(F.lit(1)).alias("pairs"), F.sum("links").alias("links")).first()
    each = aligned.select("row", F.explode(F.arrays_zip("pairs", "pair_n")).alias("p")).select(
        "row", F.col("p.pairs").alias("pair"), F.col("p.pair_n").alias("n")
    )
    if size["pairs"] <= broadcast_pairs:
        found = each.join(F.broadcast(counts), "pair")
    else:
        # at most `broadcast_pairs` pairs can have this many of all links
        least = -(-size["links"] // broadcast_pairs)
        hot = stored(counts.where(F.col("links") >= least), "pair_hot")
        rest = each.join(F.broadcast(hot.select("pair")), "pair", "left_anti")
        found = each.join(F.broadcast(hot), "pair").unionByName(rest.join(counts.where(F.col("links") < least), "pair"))
    sums = found.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"),
        F.sum(F.col("n") * F.col("links")).alias("count_sum"),
    )
    zero = F.lit(0).cast("long")
    return aligned.drop("pairs", "pair_n").join(sums, "row", "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"),
        "groups_sha256",
    )

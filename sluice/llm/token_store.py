"""Token-id shards with Elias-Fano document boundaries.

Documents are ranged by doc_id, each task encodes its range in order and
writes one shard: the concatenated ids (16 bits each while the vocabulary
allows it), the document ends and the doc_ids as Elias-Fano sequences, and a
trailer. An Elias-Fano sequence of n ascending values below u takes about
2 + log2(u / n) bits a value; `EliasFano.get` finds value i with a sampled
select on the upper bits, without a table of 64-bit offsets.

Every task attempt writes a file of its own name, and only the names in the
manifest that Spark commits are read, so lost executors and repeated tasks
cannot mix shards.

Texts are encoded by the `tokenizers` library. Text is cut before single
spaces that a non-space follows, which no token crosses, and the library is
called once per distinct piece while the piece stays in a bounded cache.

Edge cases: a null or empty text is the end id alone; null doc_ids come first;
rows that share a doc_id follow each other in order of their text's hash; an
empty table writes no shard and reads as an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import map_file, prepare, shared_folder, stored, write_file

MAGIC = b"TOKSHRD1"
SAMPLE = 256


class EliasFano:
    """An ascending sequence of integers >= 0."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        top = int(values[-1]) + 1 if n else 1
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(0, np.uint8)
        if bits and n:
            shifts = np.arange(bits, dtype=np.uint64)
            low = np.concatenate(
                [
                    np.packbits(((values[i : i + 65536, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
                    for i in range(0, n, 65536)
                ]
            )
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        flags = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        flags[ones] = 1
        return cls(n, bits, low, np.packbits(flags, bitorder="little"), ones[::SAMPLE].astype(np.uint32))

    def _low(self, i: int, j: int) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(j - i, np.uint64)
        a, b = i * self.low_bits, j * self.low_bits
        bits = np.unpackbits(self.low[a // 8 : (b + 7) // 8], bitorder="little")[a % 8 : a % 8 + b - a]
        weights = np.uint64(1) << np.arange(self.low_bits, dtype=np.uint64)
        return (bits.reshape(-1, self.low_bits).astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)

    def get(self, i: int) -> int:
        """Value i: select the i-th set upper bit from the nearest sample on."""
        at = int(self.samples[i // SAMPLE])
        need, byte = i % SAMPLE, at // 8
        first = np.unpackbits(self.high[byte : byte + 1], bitorder="little")
        need += int(first[: at % 8].sum())
        while True:
            block = self.high[byte : byte + 64]
            counts = np.cumsum(np.bitwise_count(block))
            if need < counts[-1]:
                k = int(np.searchsorted(counts, need, side="right"))
                need -= int(counts[k - 1]) if k else 0
                bit = np.flatnonzero(np.unpackbits(block[k : k + 1], bitorder="little"))[need]
                return (((byte + k) * 8 + int(bit) - i) << self.low_bits) | int(self._low(i, i + 1)[0])
            need -= int(counts[-1])
            byte += len(block)

    def select(self, i: int, j: int) -> np.ndarray:
        """Values i .. j-1: the upper bits from the sample before i on, as far as needed."""
        j = min(j, self.n)
        if i >= j:
            return np.zeros(0, np.int64)
        at = int(self.samples[i // SAMPLE])
        skip, byte, found, ones = i % SAMPLE, at // 8, 0, []
        while found < skip + j - i:
            bits = np.flatnonzero(np.unpackbits(self.high[byte : byte + 1024], bitorder="little")) + 8 * byte
            bits = bits[bits >= at]
            ones.append(bits)
            found, byte = found + len(bits), byte + 1024
        upper = np.concatenate(ones)[skip : skip + j - i] - np.arange(i, j)
        return ((upper.astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i, j)).astype(np.int64)

    def all(self) -> np.ndarray:
        out = np.empty(self.n, np.uint64)
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        for i in range(0, self.n, 65536):
            j = min(i + 65536, self.n)
            out[i:j] = ((ones[i:j] - np.arange(i, j)).astype(np.uint64) << np.uint64(self.low_bits)) | self._low(i, j)
        return out

    def parts(self) -> tuple[dict, list[bytes]]:
        data = [self.low.tobytes(), self.high.tobytes(), self.samples.astype("<u4").tobytes()]
        return {"n": self.n, "low_bits": self.low_bits, "sizes": [len(x) for x in data]}, data

    @classmethod
    def load(cls, head: dict, data: np.ndarray) -> EliasFano:
        a, b, c = head["sizes"]
        return cls(head["n"], head["low_bits"], data[:a], data[a : a + b], np.frombuffer(data[a + b : a + b + c].tobytes(), "<u4"))


class Shard:
    """One shard file, memory-mapped."""

    def __init__(self, uri: str):
        raw = map_file(uri)
        if raw[:8].tobytes() != MAGIC:
            raise ValueError(f"not a token shard: {uri}")
        size = struct.unpack("<Q", raw[-8:].tobytes())[0]
        head = json.loads(raw[-8 - size : -8].tobytes())
        at = 8 + head["ids_bytes"]
        self.ids = raw[8:at].view(head["dtype"])
        self.ends = EliasFano.load(head["ends"], raw[at : at + sum(head["ends"]["sizes"])])
        at += sum(head["ends"]["sizes"])
        self.keys = EliasFano.load(head["keys"], raw[at : at + sum(head["keys"]["sizes"])])
        self.nulls, self.first_key = head["nulls"], head["first_key"]

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends.get(i - 1) if i else 0 : self.ends.get(i)]

    def bounds(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of documents i .. j-1, by select."""
        ends = self.ends.select(i, j)
        return np.concatenate([[self.ends.get(i - 1) if i else 0], ends[:-1]]), ends

    def doc_ids(self, i: int, j: int) -> list[int | None]:
        """Ids of documents i .. j-1; null ids come first."""
        some = self.keys.select(max(i - self.nulls, 0), max(j - self.nulls, 0)) + self.first_key
        return [None] * (min(j, self.nulls) - min(i, self.nulls)) + some.tolist()


def _byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()


class PieceEncoder:
    """tokenizers' ids of whole texts, through a bounded cache of pieces. A text
    that holds a special token's string goes to the library whole, unless such
    strings are to be plain text."""

    CACHED = 1_800_000
    LONG = 48
    LINE = 1024
    MARKS = ".,:;!?"
    # letters below U+0250 are letters to any Unicode version; longer words are not kept
    _word = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]{1,47})([.,:;!?]?)")
    _odd = re.compile(r" (?=\s|\Z)")
    _cut = re.compile(r" (?=\S)")
    _pairs = ("  ", " \n", " \t", " \r", " \v", " \f", " \x1c", " \x1d", " \x1e", " \x1f")

    def __init__(self, path: str, special_as_text: bool = False):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        line = self._ids(["\n"])[0]
        self.line = line[0] if len(line) == 1 else None
        self.words = self._word_encoder()
        self.marks = {c: np.array(ids, dtype=self.dtype).tobytes() for c, ids in zip(self.MARKS, self._ids(list(self.MARKS)), strict=True)}
        self.first: dict[str, bytes] = {}
        self.inner: dict[str, bytes] = {}

    def _word_encoder(self):
        """The library's model behind a plain split at line breaks, for words that
        the pattern leaves whole; None if the file's own steps are others."""
        from tokenizers import Tokenizer, pre_tokenizers

        steps = self.tokenizer.pre_tokenizer
        if self.line is None or self.tokenizer.normalizer is not None or not isinstance(steps, pre_tokenizers.ByteLevel):
            return None
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if steps.add_prefix_space or not steps.use_regex or any(t.replace(" ", "").isalpha() for t in added):
            return None
        words = Tokenizer(self.tokenizer.model)
        words.pre_tokenizer = pre_tokenizers.Split(_BYTE_CHARS[10], "isolated")
        return words if words.token_to_id(_BYTE_CHARS[10]) == self.line else None

    def _learn_pairs(self, pieces: list[str]) -> list[str]:
        """Ids of new pieces of two such words with a line break between, which is
        a token of its own before a letter; returns the other pieces."""
        pairs, other = [], []
        for p in pieces:
            a, line, b = p.partition("\n")
            pair = line and self._word.fullmatch(a) and self._word.fullmatch(b)
            (pairs if pair else other).append((p, a, b) if pair else p)
        self._learn_words({a for _, a, _ in pairs if a not in self.inner}, self.inner, _BYTE_CHARS[32])
        self._learn_words({b for *_, b in pairs if b not in self.first}, self.first, "")
        line = np.array([self.line], dtype=self.dtype).tobytes()
        for p, a, b in pairs:
            if a in self.inner and b in self.first:
                self.inner[p] = self.inner[a] + line + self.first[b]
            else:
                other.append(p)
        return other

    def _learn_words(self, pieces, known: dict[str, bytes], lead: str) -> list[str]:
        """Ids of new words of letters and at most one mark, which is a token of
        its own after a letter; returns the other pieces."""
        other, marked, new = [], [], {}
        match = self._word.fullmatch
        for p in pieces:
            found = match(p)
            if found is None:
                other.append(p)
                continue
            word, mark = found.groups()
            if mark:
                marked.append((p, word, mark))
            if word not in known:
                new[word] = None
        words = list(new)
        shown = [w if w.isascii() else w.encode().decode("latin-1").translate(_BYTE_CHARS) for w in words]
        line = _BYTE_CHARS[10]
        for i in range(0, len(words), self.LINE):
            text = lead + (line + lead).join(shown[i : i + self.LINE])
            ids = self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids
            if not self._cut_line(ids, words[i : i + self.LINE], known):
                other += words[i : i + self.LINE]
        late = []
        for p, word, mark in marked:
            if word in known:
                known[p] = known[word] + self.marks[mark]
            else:
                late.append(p)
        return other + late

    def _cut_line(self, ids: list[int], part: list[str], known: dict[str, bytes]) -> bool:
        """The ids of a line of pieces, cut at the line breaks' ids."""
        ids = np.array(ids, dtype=self.dtype)
        cuts = np.flatnonzero(ids == self.line).tolist()
        if len(cuts) != len(part) - 1:
            return False
        raw, width, at = ids.tobytes(), ids.itemsize, 0
        for p, cut in zip(part, [*cuts, len(ids)], strict=True):
            known[p] = raw[width * at : width * cut]
            at = cut + 1
        return True

    def _learn(self, pieces, known: dict[str, bytes], lead: str) -> None:
        """Ids of new pieces. Those without white space go in lines of many:
        no token crosses a line break before a space, and its id is in no such
        piece, so the ids are cut at it."""
        pieces = list(pieces)
        if self.words is not None:
            pieces = self._learn_words(pieces, known, _BYTE_CHARS[32] if lead else "")
            if lead:
                pieces = self._learn_pairs(pieces)
        if lead and self.line is not None:
            plain = [p for p in pieces if p.split() == [p]]
            pieces = [p for p in pieces if p.split() != [p]]
            for i in range(0, len(plain), self.LINE):
                part = plain[i : i + self.LINE]
                if not self._cut_line(self._ids([lead + f"\n{lead}".join(part)])[0], part, known):
                    pieces += part
        for i in range(0, len(pieces), 4096):
            part = pieces[i : i + 4096]
            for p, ids in zip(part, self._ids([lead + p for p in part]), strict=True):
                known[p] = np.array(ids, dtype=self.dtype).tobytes()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _split(self, text: str) -> list[str]:
        plain = text.isascii() and not any(x in text for x in self._pairs) and text[-1:] != " "
        return text.split(" ") if plain or not self._odd.search(text) else self._cut.split(text)

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [k for k, t in enumerate(texts) if any(s in t for s in self.special)]
        if not whole:
            return self._encode(texts)
        apart = set(whole)
        out = self._encode(["" if k in apart else t for k, t in enumerate(texts)])
        for k, ids in zip(whole, self._ids([texts[k] for k in whole]), strict=True):
            out[k] = np.array(ids, dtype=self.dtype).tobytes()
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        cut = [self._split(t) for t in texts]
        heads = [c[0] for c in cut]
        self._learn({h for h in heads if h not in self.first}, self.first, "")
        get, new, again = self.inner.get, {}, []
        out: list = []
        for k, c in enumerate(cut):
            ids = list(map(get, c))
            ids[0] = self.first[c[0]]
            if None in ids:
                new.update(dict.fromkeys([p for p, x in zip(c, ids, strict=True) if x is None]))
                again.append(k)
            else:
                ids = b"".join(ids)
            out.append(ids)
        self._learn(new, self.inner, " ")
        for k in again:
            out[k] = b"".join([x if x is not None else get(p) for p, x in zip(cut[k], out[k], strict=True)])
        if len(self.first) > self.CACHED // 10:
            self.first.clear()
        if len(self.inner) > self.CACHED:
            self.inner.clear()
        else:
            for p in new:
                if len(p) > self.LONG:
                    del self.inner[p]
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


_MANIFEST = "shard int, uri string, n_docs long, n_ids long"


def _write(path: str, folder: str, end_id: int):
    def run(batches):
        encoder = _encoder(path)
        end = np.array([end_id], dtype=encoder.dtype).tobytes()
        width = len(end)
        sizes: list[int] = []
        keys: list[int | None] = []

        def write(out):
            out.write(MAGIC)
            for batch in batches:
                keys.extend(batch.column("doc_id").to_pylist())
                column = batch.column("text")
                for i in range(0, len(column), 256):
                    for ids in encoder.encode([t or "" for t in column.slice(i, 256).to_pylist()]):
                        out.write(ids + end)
                        sizes.append(len(ids) // width + 1)
            some = [k for k in keys if k is not None]
            ends_head, ends = EliasFano.build(np.cumsum(np.array(sizes, dtype=np.uint64))).parts()
            first = some[0] if some else 0
            keys_head, values = EliasFano.build(np.array([k - first for k in some], dtype=np.uint64)).parts()
            head = {
                "dtype": encoder.dtype,
                "ids_bytes": sum(sizes) * width,
                "ends": ends_head,
                "keys": keys_head,
                "first_key": first,
                "nulls": len(keys) - len(some),
            }
            trailer = json.dumps(head).encode()
            for part in [*ends, *values, trailer, struct.pack("<Q", len(trailer))]:
                out.write(part)

        uri = write_file(folder, write)
        if sizes:
            yield pa.RecordBatch.from_pylist(
                [{"shard": TaskContext.get().partitionId(), "uri": uri, "n_docs": len(sizes), "n_ids": sum(sizes)}],
                schema=pa.schema([("shard", pa.int32()), ("uri", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]),
            )

    return run


def write_token_store(
    docs: DataFrame, tokenizer: str, *, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None
) -> DataFrame:
    """Write the shards; returns the manifest (shard, uri, n_docs, n_ids,
    start), with the number of ids before each shard."""
    spark = prepare(docs)
    folder = folder or shared_folder(spark, "token_shards")
    rows = (
        docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
        # the rows of one id, or of none, may be more than a shard takes
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    manifest = stored(rows.mapInArrow(_write(tokenizer, folder, end_id), _MANIFEST), "token_manifest")
    # one row per shard, so this window is as small as the list of files
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))


def _read(batches):
    for batch in batches:
        for row in batch.to_pylist():
            shard = Shard(row["uri"])
            for i in range(0, shard.ends.n, 4096):
                starts, ends = shard.bounds(i, i + 4096)
                crcs = [zlib.crc32(shard.ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(shard.doc_ids(i, i + len(ends)), pa.int64()),
                        pa.array(starts + row["start"]),
                        pa.array(ends - starts),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )


def read_token_store(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: doc_id, start (ids of all documents
    before it), n_tokens (with the end id) and the crc32 of its ids as
    little-endian 32-bit integers."""
    shards = max(1, manifest.count())
    spread = manifest.select("uri", "start").repartition(shards)
    return spread.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_documents(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """The stored documents: doc_id, ids (array of int, with the end id)."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                shard = Shard(row["uri"])
                for i in range(shard.ends.n):
                    key = shard.doc_ids(i, i + 1)[0]
                    ids = pa.array([shard.document(i).astype(np.int32)], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), ids], names=["doc_id", "ids"])

    return manifest.select("uri").mapInArrow(run, "doc_id long, ids array<int>")

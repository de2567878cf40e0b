"""Keyed enrichment.

The value for each distinct key is resolved once, on the executors:
``distinct`` (map-side partial dedup, so a hot key is collapsed before the
shuffle) -> anti-join with the answers a ``KeyStore`` holds already ->
resolver calls -> left join back to the rows. Nothing is collected to the
driver and no single task sees all keys.

A ``KeyStore`` is a folder of answers in the shared storage. A task appends
its answers in small files as they come, under its partition's own folder, and
reads that folder first: a task that runs again calls only what its earlier
attempts had not written. Later actions, jobs and sessions read the store and
call only keys without an answer.

``Calls`` bounds what a task asks of the service: so many calls at once, taken
in order, and no more calls after so many failures in a row (the breaker).
"""

from __future__ import annotations

import json
import posixpath
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections import deque
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from typing import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import default_if_blank
from ..session import remove_path, shared_dir, ship_package
from .joins import SkewSalt, left_join_on_keys


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Distinct non-null key values (A2), kept distributed."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.select(*keys).where(cond).distinct()


class TransientError(Exception):
    """A failure worth retrying (for instance an HTTP 5xx answer)."""


@dataclass(frozen=True)
class Retry:
    """Retry policy for a resolver call.

    ``max_attempts`` tries; after a failed attempt ``n`` (0-based) that is
    not the last one, wait ``backoff ** n`` seconds. Exceptions of a type in
    ``retry_on`` are retried; any other exception, or an empty result, gives
    up at once with None.
    """

    max_attempts: int = 3
    backoff: float = 2.0
    retry_on: tuple[type[BaseException], ...] = (TimeoutError, TransientError)
    sleep: Callable[[float], None] = field(default=time.sleep, compare=False)

    def call(self, fn: Callable[[object], object], value: object) -> object | None:
        return self.outcome(fn, value)[1]

    def outcome(self, fn: Callable[[object], object], value: object) -> tuple[bool, object | None]:
        """Whether the call gave an answer (an empty one is one), and the answer."""
        attempts = max(1, int(self.max_attempts))
        for attempt in range(attempts):
            try:
                result = fn(value)
                return True, result if result else None
            except self.retry_on:
                if attempt < attempts - 1:
                    self.sleep(self.backoff**attempt)
            except Exception:
                return False, None
        return False, None


_NO_MORE = object()


class BreakerOpen(Exception):
    """The service failed too often in a row and ``on_open`` is "raise"."""


@dataclass(frozen=True)
class Calls:
    """How a task calls a resolver.

    ``at_once`` calls run at the same time (threads); answers come in the
    order of the keys, so the result is the serial one. After ``max_failures``
    failed keys in a row (None: never) no further key is asked: with
    ``on_open="skip"`` the rest is left without an answer for a later run, with
    ``"raise"`` the task fails. Up to ``at_once - 1`` calls are under way by
    then; their answers are kept.
    """

    retry: Retry = Retry(max_attempts=1)
    at_once: int = 1
    max_failures: int | None = None
    on_open: str = "skip"

    def __post_init__(self) -> None:
        if self.at_once < 1 or self.on_open not in ("skip", "raise"):
            raise ValueError("at_once must be 1 or more and on_open 'skip' or 'raise'")

    def run(self, resolver: Callable[[object], object], keys: Iterable[object]) -> Iterator[tuple[object, bool, object | None]]:
        """(key, answered, answer) of the keys asked, in order."""
        failures, is_open, waiting = 0, False, iter(keys)
        # one call at a time needs no threads
        pool = ThreadPoolExecutor(self.at_once) if self.at_once > 1 else None
        under_way: deque = deque()
        try:
            while True:
                while not is_open and len(under_way) < self.at_once:
                    key = next(waiting, _NO_MORE)
                    if key is _NO_MORE:
                        break
                    call = pool.submit(self.retry.outcome, resolver, key).result if pool else partial(self.retry.outcome, resolver, key)
                    under_way.append((key, call))
                if not under_way:
                    break
                key, call = under_way.popleft()
                answered, value = call()
                yield key, answered, value
                failures = 0 if answered else failures + 1
                is_open = is_open or (self.max_failures is not None and failures >= self.max_failures)
        finally:
            if pool:
                pool.shutdown()
        if is_open and self.on_open == "raise":
            raise BreakerOpen(f"{failures} failures in a row")


def _http_get(url: str, timeout: float) -> tuple[int, bytes]:
    try:
        with urllib.request.urlopen(url, timeout=timeout) as resp:
            return resp.status, resp.read()
    except urllib.error.HTTPError as e:
        return e.code, b""
    except urllib.error.URLError as e:
        if isinstance(e.reason, TimeoutError):
            raise TimeoutError(str(e.reason)) from e
        raise


@dataclass(frozen=True)
class HttpJsonResolver:
    """Resolve a key with ``GET <url_prefix><quoted key>`` and read one JSON field.

    Runs inside the executors' resolver tasks of :func:`enrich_by_key`.
    Time-outs and 5xx answers raise (retryable under :class:`Retry`); a 4xx
    answer, an empty key or an empty field give None (the default value).
    ``get`` is injectable, e.g. for a client with connection pooling.
    """

    url_prefix: str
    field: str = "Digest"
    timeout: float = 5.0
    get: Callable[[str, float], tuple[int, bytes]] = _http_get

    def __call__(self, value: object) -> str | None:
        if value is None or value == "":
            return None
        status, body = self.get(self.url_prefix + urllib.parse.quote(str(value)), self.timeout)
        if status >= 500:
            raise TransientError(f"server error {status}")
        if status >= 400:
            return None
        answer = json.loads(body or b"{}").get(self.field)
        return str(answer) if answer else None


def _resolve_partition(
    resolver: Callable[[object], object], retry: Retry | None, key: str, value: str
) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    policy = retry or Retry(max_attempts=1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf[key].tolist()
            vals = [policy.call(resolver, k) for k in keys]
            yield pd.DataFrame(
                {key: pdf[key], value: pd.Series([None if v is None else str(v) for v in vals], dtype=object)}
            )

    return run


def resolve_keys(
    keys: DataFrame,
    key: str,
    resolver: Callable[[object], object],
    *,
    value: str = "value",
    retry: Retry | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """Run ``resolver`` once per row of a distinct-key frame -> (key, value)."""
    ship_package(keys.sparkSession)  # the resolver runs in the executors' Python workers
    if partitions:
        keys = keys.repartition(partitions, key)
    key_type = keys.schema[key].dataType.simpleString()
    return keys.mapInPandas(
        _resolve_partition(resolver, retry, key, value), f"`{key}` {key_type}, `{value}` string"
    )


ANSWER_SCHEMA = "answered boolean, value string"


_MOST_HELD = 100_000


def _answer_partition(calls: Calls, resolver: Callable[[object], object], folder: str, flush: int, flush_seconds: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        mine = posixpath.join(root, f"{TaskContext.get().partitionId():06d}")
        store.create_dir(mine, recursive=True)
        done: set = set()
        for info in store.get_file_info(fs.FileSelector(mine)):
            if info.base_name.endswith(".parquet") and not info.base_name.startswith("."):
                with store.open_input_file(info.path) as f:
                    done.update(pq.read_table(f, columns=["key"]).column("key").to_pylist())
        kept: list[tuple] = []
        counts = {"called": 0, "failed": 0}
        written = time.monotonic()

        def write(key_type: pa.DataType) -> None:
            if not kept:
                return
            keys, answered, values = zip(*kept, strict=True)
            table = pa.table(
                {"key": pa.array(keys, key_type), "answered": pa.array(answered), "value": pa.array(values, pa.string())}
            )
            name = f"{uuid.uuid4().hex}.parquet"
            with store.open_output_stream(posixpath.join(mine, "." + name)) as f:
                pq.write_table(table, f)
            store.move(posixpath.join(mine, "." + name), posixpath.join(mine, name))  # whole files only
            kept.clear()

        key_type = None

        def keys() -> Iterator[object]:
            nonlocal key_type
            for batch in batches:
                key_type = batch.schema.field(0).type
                yield from (k for k in batch.column(0).to_pylist() if k not in done)

        try:
            for key, answered, value in calls.run(resolver, keys()):
                counts["called"] += 1
                counts["failed"] += not answered
                kept.append((key, answered, None if value is None else str(value)))
                due = time.monotonic() - written >= flush_seconds or len(kept) >= _MOST_HELD
                if len(kept) >= flush and due:
                    write(key_type)
                    written = time.monotonic()
        finally:
            write(key_type)  # also when the task fails: its next attempt goes on from here
        yield pa.RecordBatch.from_pylist([counts])

    return run


class KeyStore:
    """Answers of a resolver by key, in a folder that driver and executors share.

    Without a path the store is private to its session and lies under the
    session's shared folder. A key is asked once; keys whose call failed count
    as asked too, unless ``resolve(..., again=True)``.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, key_type: T.DataType | str = "string"):
        self.spark, self.path = spark, path or shared_dir(spark, "answers")
        kind = key_type if isinstance(key_type, str) else key_type.simpleString()
        self.schema = f"key {kind}, {ANSWER_SCHEMA}"

    def table(self) -> DataFrame:
        """key, answered, value: one row per key (two attempts may have asked one)."""
        try:
            rows = self.spark.read.schema(self.schema).option("recursiveFileLookup", "true").parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = self.spark.createDataFrame([], self.schema)
        best = rows.groupBy("key").agg(F.max(F.struct("answered", "value")).alias("a"))
        return best.select("key", "a.answered", "a.value")

    def resolve(
        self,
        keys: DataFrame,
        key: str,
        resolver: Callable[[object], object],
        *,
        calls: Calls = Calls(),
        partitions: int | None = None,
        flush: int = 100,
        flush_seconds: float = 5.0,
        again: bool = False,
    ) -> dict[str, int]:
        """Ask for the distinct, non-null ``keys`` without an answer, at once.

        Returns how many were called and failed. A task writes its answers when
        it has ``flush`` and ``flush_seconds`` have passed since it last did
        (so a fast resolver does not make a file per hundred keys), and what it
        has when it ends or fails. A killed worker loses what it had not written."""
        ship_package(self.spark)  # the resolver runs in the executors' Python workers
        known = self.table()
        if again:
            known = known.where("answered")
        fresh = keys.select(F.col(f"`{key}`").alias("key")).join(known.select("key"), "key", "left_anti")
        # by key hash: a task that runs again has the same keys
        fresh = fresh.repartition(partitions, "key") if partitions else fresh.repartition("key")
        folder = posixpath.join(self.path, uuid.uuid4().hex)
        run = fresh.mapInArrow(_answer_partition(calls, resolver, folder, flush, flush_seconds), "called long, failed long")
        total = run.agg(F.sum("called").alias("called"), F.sum("failed").alias("failed")).first()
        return {"called": total["called"] or 0, "failed": total["failed"] or 0}


    def compact(self, files: int = 1) -> None:
        """The same answers in ``files`` files; call it while no run writes to
        the store. The new files are there before the old ones go."""
        try:
            listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(self.path).select("path")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return
        old = [r["run"] for r in listed.select(F.regexp_extract("path", "([0-9a-f]{32})/[^/]*(?:/[^/]*)?$", 1).alias("run")).distinct().collect()]
        self.table().repartition(files, "key").write.parquet(posixpath.join(self.path, uuid.uuid4().hex))
        for run in old:
            if run:
                remove_path(self.spark, posixpath.join(self.path, run))


def enrich_by_key(
    df: DataFrame,
    key: str,
    resolver: Callable[[object], object],
    out: str,
    *,
    default: str = "UNKNOWN_HASH",
    retry: Retry | None = None,
    partitions: int | None = None,
    skew: SkewSalt | None = None,
    calls: Calls | None = None,
    store: KeyStore | None = None,
) -> DataFrame:
    """Attach ``out = resolver(key)`` to every row, calling it once per distinct key.

    The keys are resolved here, by a job, into ``store`` (a new private one by
    default); the result only joins its answers, so any number of actions on
    it calls nothing. A null key, a failed call or an empty answer gives
    ``default``. The join back is a plain left join on the key (``skew``
    treats hot keys).
    """
    store = store or KeyStore(df.sparkSession, key_type=df.schema[key].dataType)
    calls = calls or Calls(retry or Retry(max_attempts=1))
    store.resolve(distinct_keys(df, key), key, resolver, calls=calls, partitions=partitions)
    answers = store.table().where("value is not null")
    joined = left_join_on_keys(df, answers, [(key, "key")], right_columns={"value": "__val"}, skew=skew)
    return joined.withColumn(out, default_if_blank(F.col("__val"), default)).drop("__val")

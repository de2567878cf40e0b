"""Keys resolved once, with bounded calls and a breaker."""

import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from sluice.operators.enrich import BreakerOpen, Calls, KeyStore, Retry, enrich_by_key


class Counting:
    """Writes a line per call to a folder, as workers are other processes."""

    def __init__(self, folder, fail=(), crash_on=None):
        self.folder, self.fail, self.crash_on = str(folder), set(fail), crash_on
        os.makedirs(self.folder, exist_ok=True)

    def __call__(self, key):
        if key == self.crash_on and not os.path.exists(f"{self.folder}.crashed"):
            open(f"{self.folder}.crashed", "w").close()
            raise SystemExit("worker lost")
        with open(os.path.join(self.folder, f"{os.getpid()}-{threading.get_ident()}"), "a") as f:
            f.write(f"{key}\n")
        if key in self.fail:
            raise ValueError("no")
        return f"<{key}>"

    def calls(self):
        out = []
        for name in os.listdir(self.folder):
            with open(os.path.join(self.folder, name)) as f:
                out += f.read().split()
        return sorted(out)


def _keys(spark, n):
    return spark.range(n).select(F.format_string("k%03d", "id").alias("k"))


def test_two_actions_call_each_key_once(spark, tmp_path):
    service = Counting(tmp_path / "calls", fail=["k003"])
    df = _keys(spark, 20).unionByName(_keys(spark, 20))
    out = enrich_by_key(df, "k", service, "v", default="?")
    assert out.count() == 40 and out.where("v = '?'").count() == 2
    assert sorted({r.v for r in out.collect()})[:2] == ["<k000>", "<k001>"]
    assert service.calls() == [f"k{i:03d}" for i in range(20)]


def test_a_store_is_shared_by_jobs_and_only_new_keys_are_called(spark, tmp_path):
    service = Counting(tmp_path / "calls", fail=["k001"])
    store = KeyStore(spark, str(tmp_path / "store"))
    assert store.table().count() == 0
    assert store.resolve(_keys(spark, 5), "k", service) == {"called": 5, "failed": 1}
    assert store.resolve(_keys(spark, 8), "k", service) == {"called": 3, "failed": 0}
    other = KeyStore(spark, str(tmp_path / "store"))
    out = enrich_by_key(_keys(spark, 8), "k", service, "v", default="?", store=other)
    assert {r.k: r.v for r in out.collect()}["k001"] == "?" and out.where("v != '?'").count() == 7
    assert len(service.calls()) == 8
    service.fail.clear()
    assert other.resolve(_keys(spark, 8), "k", service, again=True) == {"called": 1, "failed": 0}
    assert {r.key: r.value for r in other.table().collect()}["k001"] == "<k001>"
    assert other.table().count() == 8


def test_a_fast_resolver_writes_few_files_and_a_store_is_compacted(spark, tmp_path):
    store = KeyStore(spark, str(tmp_path / "store"))
    store.compact()  # nothing there yet
    store.resolve(_keys(spark, 900), "k", str.upper, partitions=3, flush=10)
    store.resolve(_keys(spark, 950), "k", str.upper, partitions=3)

    def files():
        return [f for _, _, names in os.walk(tmp_path / "store") for f in names if f.endswith(".parquet") and not f.startswith(".")]

    assert len(files()) <= 6
    before = sorted(map(tuple, store.table().collect()))
    store.compact()
    assert len(files()) == 1 and sorted(map(tuple, store.table().collect())) == before and len(before) == 950
    assert store.resolve(_keys(spark, 950), "k", str.upper) == {"called": 0, "failed": 0}


def test_a_task_that_runs_again_calls_only_the_rest(tmp_path):
    """A worker that dies in the middle: what its task had written is not asked again."""
    import subprocess
    import sys

    code = f"""
import sys
sys.path[:0] = {[os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]!r}
from pyspark.sql import SparkSession, functions as F
from sluice.operators.enrich import KeyStore
from tests.test_keystore import Counting
spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
service = Counting({str(tmp_path / "calls")!r}, crash_on="k030")
keys = spark.range(40).select(F.format_string("k%03d", "id").alias("k"))
store = KeyStore(spark, {str(tmp_path / "store")!r})
store.resolve(keys, "k", service, partitions=1, flush=1, flush_seconds=0)
assert store.table().count() == 40
"""
    done = subprocess.run(["timeout", "200", sys.executable, "-c", code], capture_output=True, text=True)
    assert done.returncode == 0, done.stderr[-2000:]
    assert os.path.exists(tmp_path / "calls.crashed")
    service = Counting(tmp_path / "calls")
    assert service.calls() == [f"k{i:03d}" for i in range(40)]


def test_a_failing_task_keeps_what_it_has(spark, tmp_path):
    service = Counting(tmp_path / "calls", fail=["k004", "k005", "k006"])
    store = KeyStore(spark, str(tmp_path / "store"))
    keys = _keys(spark, 10).coalesce(1).sortWithinPartitions("k")
    with pytest.raises(Exception, match="failures in a row"):
        store.resolve(keys, "k", service, partitions=1, calls=Calls(max_failures=1, on_open="raise"))
    kept = store.table().count()
    assert kept == len(service.calls()) > 0
    service.fail.clear()
    store.resolve(keys, "k", service, partitions=1)
    assert len(service.calls()) == 10


def test_calls_in_order_with_a_limit():
    lock, now, most, seen = threading.Lock(), [0], [0], []

    def slow(key):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            seen.append(key)
        time.sleep(0.02 if key % 3 else 0.06)
        with lock:
            now[0] -= 1
        return None if key == 5 else key * 10

    many = list(Calls(at_once=4).run(slow, range(1, 30)))
    assert most[0] == 4 and sorted(seen) == list(range(1, 30))
    assert many == list(Calls().run(slow, range(1, 30)))
    assert many[4] == (5, True, None)


@pytest.mark.parametrize("at_once", [1, 3])
def test_breaker_stops_the_calls(at_once):
    asked = []

    def down(key):
        asked.append(key)
        if key >= 5:
            raise TimeoutError("down")
        return key

    retry = Retry(max_attempts=2, sleep=lambda s: None)
    got = list(Calls(retry, at_once, max_failures=3).run(down, range(1, 100)))
    assert got[:7] == [(1, True, 1), (2, True, 2), (3, True, 3), (4, True, 4), (5, False, None), (6, False, None), (7, False, None)]
    assert len(got) <= 7 + at_once - 1 and len(asked) <= 4 + 2 * (3 + at_once - 1)
    with pytest.raises(BreakerOpen):
        list(Calls(retry, at_once, 3, "raise").run(down, range(1, 100)))
    # a success in between closes the count
    flaky = Calls(max_failures=2).run(lambda k: k if k % 2 else (_ for _ in ()).throw(ValueError()), range(20))
    assert len(list(flaky)) == 20


def test_skipped_keys_are_asked_by_a_later_run(spark, tmp_path):
    service = Counting(tmp_path / "calls", fail=[f"k{i:03d}" for i in range(50)])
    store = KeyStore(spark, str(tmp_path / "store"))
    first = store.resolve(_keys(spark, 50), "k", service, partitions=1, calls=Calls(at_once=2, max_failures=4))
    assert first["failed"] == first["called"] <= 5
    service.fail.clear()
    second = store.resolve(_keys(spark, 50), "k", service, calls=Calls(at_once=4))
    assert second == {"called": 50 - first["called"], "failed": 0}


def test_integer_keys(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c"), (None, "d")], "k int, v string")
    out = enrich_by_key(df, "k", lambda k: f"n{k}", "name", default="none")
    assert sorted((r.v, r.name) for r in out.collect()) == [("a", "n1"), ("b", "n2"), ("c", "n1"), ("d", "none")]


def test_bad_limits():
    for bad in ({"at_once": 0}, {"on_open": "wait"}):
        with pytest.raises(ValueError):
            Calls(**bad)

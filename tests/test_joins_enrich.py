import pytest
from pyspark.sql import functions as F

from sluice.operators.enrich import Retry, distinct_keys, enrich_by_key
from sluice.operators.joins import SkewSalt, left_join_on_keys, lookup_join

from .helpers import plan_text


def test_left_join_fan_out_nulls_and_unmatched(spark):
    left = spark.createDataFrame([("s", 1, "a"), ("s", 2, "b"), ("t", 1, "c"), (None, 1, "d")], "sys string, id long, v string")
    right = spark.createDataFrame([("s", 1, "x"), ("s", 1, "y"), ("t", 9, "z"), (None, 1, "n")], "sys string, id long, w string")
    out = left_join_on_keys(left, right, [("sys", "sys"), ("id", "id")], right_columns={"w": "w"})
    assert out.columns == ["sys", "id", "v", "w"]
    rows = {(r.v, r.w) for r in out.collect()}
    assert rows == {("a", "x"), ("a", "y"), ("b", None), ("c", None), ("d", None)}
    assert out.count() == 5


def test_salted_join_equals_plain_join_on_a_hot_key(spark):
    n = 3000
    left = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), F.col("id").alias("v")
    )  # a third of all rows share key 7
    right = spark.range(0, 200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w")).unionByName(
        spark.createDataFrame([(7, -1)], "k long, w long")
    )  # key 7 twice on the right: fan-out must survive salting
    plain = left_join_on_keys(left, right, [("k", "k")], right_columns={"w": "w"})
    salted = left_join_on_keys(left, right, [("k", "k")], right_columns={"w": "w"},
                               skew=SkewSalt(buckets=8, min_rows=100, broadcast_rows=50))
    a, b = plain.collect(), salted.collect()
    assert len(a) == len(b) == n + n // 3 + 1  # key 7: 1001 left rows, each matched twice
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_lookup_default_and_uniqueness(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    lk = spark.createDataFrame([(1, "one"), (1, "uno"), (2, ""), (4, "four")], "k int, v string")
    out = lookup_join(df, lk, "k", "k", "v", "name", default="NONE")
    got = {r.k: r.name for r in out.collect()}
    assert out.count() == 4  # a duplicated lookup key never multiplies rows
    assert got[1] in ("one", "uno") and got[2] == "NONE" and got[3] == "NONE" and got[None] == "NONE"


def test_distinct_keys_drops_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "k string")
    assert sorted(r.k for r in distinct_keys(df, "k").collect()) == ["a", "b"]
    assert "HashAggregate" in plan_text(distinct_keys(df, "k"))


class Flaky:
    def __init__(self, fail_times, exc=TimeoutError, result="h"):
        self.calls = 0
        self.fail_times = fail_times
        self.exc = exc
        self.result = result

    def __call__(self, v):
        self.calls += 1
        if self.calls <= self.fail_times:
            raise self.exc("boom")
        return self.result


def test_retry_exhausted_and_recovering():
    waits = []
    r = Retry(max_attempts=2, backoff=2.0, sleep=waits.append)
    f = Flaky(10)
    assert r.call(f, "x") is None and f.calls == 2 and waits == [1.0]
    waits.clear()
    f = Flaky(1)
    assert Retry(max_attempts=3, sleep=waits.append).call(f, "x") == "h" and f.calls == 2 and waits == [1.0]


def test_retry_gives_up_at_once_on_other_errors_and_empty_answers():
    f = Flaky(5, exc=ValueError)
    assert Retry(max_attempts=3, sleep=lambda s: None).call(f, "x") is None and f.calls == 1
    assert Retry(sleep=lambda s: None).call(Flaky(0, result=""), "x") is None
    assert Retry(max_attempts=0, sleep=lambda s: None).call(Flaky(0), "x") == "h"


def _resolver(v):
    if v == "bad":
        raise RuntimeError("no")
    return "" if v == "empty" else f"h:{v}"


def test_enrich_by_key_once_per_key(spark):
    df = spark.createDataFrame([("a",), ("a",), ("bad",), ("empty",), (None,)], "k string")
    out = enrich_by_key(df, "k", _resolver, "id", default="UNKNOWN_HASH", retry=Retry(sleep=lambda s: None))
    assert sorted((r.k or "", r.id) for r in out.collect()) == [
        ("", "UNKNOWN_HASH"), ("a", "h:a"), ("a", "h:a"), ("bad", "UNKNOWN_HASH"), ("empty", "UNKNOWN_HASH")
    ]


@pytest.mark.parametrize("partitions", [None, 3])
def test_enrich_by_key_partitions(spark, partitions):
    df = spark.range(100).select((F.col("id") % 10).cast("string").alias("k"))
    out = enrich_by_key(df, "k", _resolver, "id", partitions=partitions)
    assert out.where(F.col("id") == F.concat(F.lit("h:"), F.col("k"))).count() == 100


def test_lookup_and_enrich_with_salting_match_plain(spark):
    df = spark.range(2000).select(F.when(F.col("id") % 2 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("k"))
    lk = spark.range(40).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    salt = SkewSalt(buckets=4, min_rows=100, broadcast_rows=10)
    a = lookup_join(df, lk, "k", "k", "v", "name").collect()
    b = lookup_join(df, lk, "k", "k", "v", "name", skew=salt).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(b) == 2000
    c = enrich_by_key(df.select(F.col("k").cast("string").alias("k")), "k", _resolver, "id", skew=salt)
    assert c.count() == 2000 and c.where(F.col("id") == "h:1").count() == 1000 + 40


def test_http_json_resolver_statuses_and_retry():
    from sluice.operators.enrich import HttpJsonResolver, TransientError

    calls = []

    def fake_get(answers):
        def get(url, timeout):
            calls.append(url)
            a = answers.pop(0)
            if isinstance(a, BaseException):
                raise a
            return a
        return get

    r = HttpJsonResolver("http://digest.invalid/md4?value=", get=fake_get([(200, b'{"Digest": "abc"}')]))
    assert r("CL 1") == "abc" and calls[-1].endswith("value=CL%201")
    assert HttpJsonResolver("u", get=fake_get([(404, b"")]))("x") is None
    assert HttpJsonResolver("u", get=fake_get([(200, b'{"Digest": ""}')]))("x") is None
    assert HttpJsonResolver("u", get=fake_get([]))("") is None
    with pytest.raises(TransientError):
        HttpJsonResolver("u", get=fake_get([(503, b"")]))("x")
    # server error, then time-out, then success: retried (a 5xx is retried too)
    flaky = HttpJsonResolver("u", get=fake_get([(503, b""), TimeoutError("t"), (200, b'{"Digest": "d"}')]))
    assert Retry(max_attempts=3, sleep=lambda s: None).call(flaky, "x") == "d"


def test_left_join_with_differently_typed_keys(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (3, "y")], "k bigint, w string")
    out = left_join_on_keys(left, right, [("k", "k")], right_columns={"w": "w"})
    assert {(r.v, r.w) for r in out.collect()} == {("a", "x"), ("b", None), ("c", None)}
    rs = spark.createDataFrame([("1", "x")], "k string, w string")
    out2 = left_join_on_keys(left, rs, [("k", "k")], right_columns={"w": "w"})
    assert {(r.v, r.w) for r in out2.collect()} == {("a", "x"), ("b", None), ("c", None)}

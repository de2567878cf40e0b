import datetime as dt
import os

import __spark_entry__ as E
from sluice.sources import sinks
from sluice.sources import sinks


def _tables(spark, path, rows=12):
    stamp = dt.datetime(1996, 3, 4)
    orders = [(k, stamp) for k in range(1, rows + 1)]
    lines = [(k, 7 * k, n, 10.5 * k, "RAN"[k % 3], stamp) for k in range(1, rows + 1) for n in (1, 2)]
    orders = spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_linenumber long, l_extendedprice double, l_returnflag string, l_shipdate timestamp_ntz"
    )
    for name, df in (("orders", orders), ("lineitem", lines)):
        df.coalesce(1).write.parquet(os.path.join(path, f"{name}.parquet"))
    return str(path)


def _files(df):
    return [f.removeprefix("file://") for f in df.inputFiles()]


def test_json_batch_is_compressed(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    got = E.q_json_batch_readback(spark, sf)
    assert all(f.endswith(".json.gz") for f in _files(got))
    assert sorted(got.drop("batch_date").collect(), key=str) == sorted(E.q_claims_transactions(spark, sf).collect(), key=str)


def test_epochs_do_not_shuffle_the_contracts(spark, tmp_path, monkeypatch):
    plans = []
    transform = E.C.claims_transform

    def seen(data, **more):
        out = transform(data, **more)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(E.C, "claims_transform", seen)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = E.q_claims_stream(spark, _tables(spark, tmp_path))
        assert got.count() and all(f.endswith(".csv.gz") for f in _files(got))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the claims move to the buckets of the contracts, which stay
    assert plans and all(p.count("Exchange hashpartitioning") == 1 for p in plans)


def test_epochs_do_not_grow_with_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sinks.FORMAT_WRITE_OPTIONS["csv"], "maxRecordsPerFile", "1")
    got = E.q_claims_file_stream(spark, _tables(spark, tmp_path))
    root = _files(got)[0].split("/out/")[0]
    raw = [f for f in os.listdir(os.path.join(root, "in")) if f.startswith("part-")]
    assert len(raw) == 2  # one task, two headers
    assert got.count() == E.q_claims_transactions(spark, str(tmp_path)).count()


def test_csv_job_batch_is_compressed(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    got = E.q_claims_job_csv(spark, sf)
    files = _files(got)
    assert files and all(f.endswith(".csv.gz") for f in files)
    assert got.count() == E.q_claims_transactions(spark, sf).count()

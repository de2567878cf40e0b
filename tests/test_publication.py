"""Evidence of malformed lines, differing headers, one commit, failure combinations, splittable text."""

import os

import pytest
from pyspark.sql import functions as F

from sluice.operators.header import HeaderError
from sluice.operators.validate import annotate, failure_combinations, split_annotated
from sluice.plans.job import run_job
from sluice.rules import TableRules
from sluice.sources.commits import commits, drop_uncommitted, publish, read_committed
from sluice.sources.readers import read_by_name, read_table
from sluice.sources.sinks import read_batches, write_batch, write_bucketed
from sluice.streaming.incremental import start_file_job

from .helpers import plan_text

SHIP = TableRules.from_dict(
    "ship",
    {"NO": {"required": True, "regex": "^[0-9]+$"}, "PORT": {"required": True, "aliases": ["PROT"]}, "TONS": {"regex": "^[0-9]+$", "cast_to": "int"}},
)


def _write(folder, **files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, f"{name}.csv"), "w") as f:
            f.write(text)
    return str(folder)


# ---------------------------------------------------------------- evidence


def test_malformed_lines_keep_their_text(spark, tmp_path):
    path = _write(tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\n2,Bergen\n3,Turku,7,more\n,,\n\"4,x\n")
    plain = read_table(spark, path, "csv")
    df = read_table(spark, path, "csv", evidence=True)
    assert sorted(map(tuple, df.drop("raw_record").collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    assert {r.NO: r.raw_record for r in df.collect()} == {"1": None, "2": "2,Bergen", "3": "3,Turku,7,more", None: None, "4,x": '"4,x'}
    # a selection that needs no malformed field finds the same lines
    assert len(df.where("raw_record is not null").select("raw_record", "NO").collect()) == 3


def test_evidence_reaches_the_quarantine_and_valid_rows_are_unchanged(spark, tmp_path):
    path = _write(tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\n2,Bergen\nx,Turku,7,more\n5,,\n6\n")
    df = read_table(spark, path, "csv", evidence=True)
    split = split_annotated(annotate(df, SHIP), SHIP)
    assert split.valid.columns == SHIP.names
    assert sorted(map(tuple, split.valid.collect())) == [("1", "Oslo", 5), ("2", "Bergen", None)]
    assert {r.NO: (r.validation_error, r.raw_record) for r in split.invalid.collect()} == {
        "x": ("Failed columns: NO", "x,Turku,7,more"), "5": ("Failed columns: PORT", None), "6": ("Failed columns: PORT", "6"),
    }
    strict = split_annotated(annotate(df, SHIP, reject_malformed=True), SHIP)
    assert [r.NO for r in strict.valid.collect()] == ["1"]
    assert {r.NO: r.validation_error for r in strict.invalid.collect()} == {
        "2": "Malformed record", "x": "Failed columns: NO; Malformed record", "5": "Failed columns: PORT", "6": "Failed columns: PORT; Malformed record",
    }


def test_evidence_in_the_job_and_a_column_of_that_name(spark, tmp_path):
    path = _write(tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\ny,Bergen\n")
    out = str(tmp_path / "out")
    run_job(spark, {"ship": read_table(spark, path, "csv", evidence=True)}, {"ship": SHIP}, lambda v: v["ship"], output_base=out, output_name="S", fmt="parquet", batch_id="b", stage="table")
    assert [r.raw_record for r in read_batches(spark, f"{out}/invalid", "ship", "parquet").collect()] == ["y,Bergen"]
    own = _write(tmp_path / "own", a="NO,raw_record\n1,2\n")
    with pytest.raises(ValueError, match="of its own"):
        read_table(spark, own, "csv", evidence=True)


# ---------------------------------------------------------------- differing headers


def test_files_with_differing_headers_are_read_by_name(spark, tmp_path):
    path = _write(
        tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\n", b="﻿TONS,PROT,NO\r\n6,Bergen,2\r\n", c="NO,PORT,TONS\n3,Turku,7\n",
        d="EXTRA,PORT,NO,TONS\nz,Riga,4,8\n", e="",
    )
    df = read_by_name(spark, path, SHIP)
    assert df.columns == SHIP.names
    assert sorted(map(tuple, df.collect())) == [("1", "Oslo", "5"), ("2", "Bergen", "6"), ("3", "Turku", "7"), ("4", "Riga", "8")]
    assert plan_text(df, "simple").count("FileScan csv") == 3  # one scan per header


def test_a_header_without_a_rule_column_names_its_files(spark, tmp_path):
    path = _write(tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\n", b="NO,TONS\n2,6\n")
    with pytest.raises(HeaderError, match=r"PORT.*1 files, first .*b\.csv"):
        read_by_name(spark, path, SHIP)
    with pytest.raises(FileNotFoundError):
        read_by_name(spark, str(tmp_path / "none"), SHIP)
    assert read_by_name(spark, _write(tmp_path / "empty", a=""), SHIP).count() == 0


# ---------------------------------------------------------------- one commit


def test_a_crash_between_the_writes_shows_neither(spark, tmp_path):
    path = _write(tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\nx,Bergen,6\n")
    src, out = {"ship": read_table(spark, path, "csv")}, str(tmp_path / "out")

    def job(transform, batch):
        return run_job(spark, src, {"ship": SHIP}, transform, output_base=out, output_name="S", fmt="csv", batch_id=batch, commit=True)

    def broken(valid):
        raise RuntimeError("no transform")

    with pytest.raises(RuntimeError):
        job(broken, "b1")
    assert os.path.isdir(f"{out}/invalid/ship/batch_date=b1")  # written, and seen by nobody
    assert commits(spark, out).count() == 0
    with pytest.raises(FileNotFoundError):
        read_committed(spark, out, "invalid/ship")
    result = job(lambda v: v["ship"], "b1")
    assert result.published_rows == 1
    assert [tuple(r) for r in read_committed(spark, out, "S").collect()] == [("1", "Oslo", "5", "b1")]
    assert [r.NO for r in read_committed(spark, out, "invalid/ship").collect()] == ["x"]
    assert drop_uncommitted(spark, out, "invalid/ship", "b1") == 1
    assert [r.NO for r in read_committed(spark, out, "invalid/ship").collect()] == ["x"]


def test_a_rerun_replaces_its_batch_at_its_commit(spark, tmp_path):
    base = str(tmp_path / "out")
    a = spark.createDataFrame([(1, "a\nb"), (2, " x ")], "k int, v string")
    publish({"T": a, "U": a.limit(0)}, base, "b1", "parquet")
    publish({"T": a.limit(1)}, base, "b2", "parquet")
    before = read_committed(spark, base, "T")
    publish({"T": a.where("k = 2"), "U": a}, base, "b1", "parquet")
    assert sorted((r.batch_date, r.k) for r in read_committed(spark, base, "T").collect()) == [("b1", 2), ("b2", 1)]
    # a reader of the earlier commit still finds its files
    assert sorted((r.batch_date, r.k) for r in before.collect()) == [("b1", 1), ("b1", 2), ("b2", 1)]
    assert read_committed(spark, base, "U").count() == 2
    assert [r.k for r in read_committed(spark, base, "T", batch_id="b2").collect()] == [1]
    assert drop_uncommitted(spark, base, "T", "b1") == 1 and drop_uncommitted(spark, base, "T", "none") == 0


def test_committed_text_comes_back_as_written(spark, tmp_path):
    base = str(tmp_path / "out")
    df = spark.createDataFrame([("1", "a\nb,\"c\""), ("2", " x ")], "k string, v string")
    publish({"T": df}, base, "b1", "csv")
    assert sorted((r.k, r.v) for r in read_committed(spark, base, "T").collect()) == [("1", "a\nb,\"c\""), ("2", " x ")]
    empty = read_committed(spark, base, "other", schema=df.schema)
    assert empty.count() == 0 and empty.columns == ["k", "v", "batch_date"]


def _stream(spark, src, out, ckpt, **more):
    q = start_file_job(spark, src, SHIP, lambda v: v, output_base=out, output_name="S", checkpoint=ckpt, max_files_per_trigger=1, **more)
    q.awaitTermination()
    assert q.exception() is None


def test_the_file_stream_survives_a_lost_checkpoint(spark, tmp_path):
    out = str(tmp_path / "out")
    src = _write(tmp_path / "in", a="NO,PORT,TONS\n1,Oslo,5\nq,Oslo,5\n", b="TONS,PROT,NO\n6,Bergen,2\n")
    _stream(spark, src, out, str(tmp_path / "ck1"), evidence=True)
    assert sorted(r.NO for r in read_committed(spark, out, "S").collect()) == ["1", "2"]
    assert [r.NO for r in read_committed(spark, out, "invalid/ship").collect()] == ["q"]
    assert commits(spark, out).count() == 2
    # a new checkpoint sees all files again; only the new one is published
    _write(tmp_path / "in", c="NO,PORT,TONS\n3\n")
    _stream(spark, src, out, str(tmp_path / "ck2"), evidence=True, reject_malformed=True)
    assert sorted(r.NO for r in read_committed(spark, out, "S").collect()) == ["1", "2"]
    assert commits(spark, out).count() == 3
    bad = {r.NO: (r.validation_error, r.raw_record) for r in read_committed(spark, out, "invalid/ship").collect()}
    assert bad["3"] == ("Failed columns: PORT; Malformed record", "3")


# ---------------------------------------------------------------- combinations, buckets, splittable text


@pytest.mark.parametrize("stage,on_invalid", [("table", "write"), ("recompute", "write"), ("recompute", None)])
def test_failure_combinations_ride_on_the_write(spark, tmp_path, stage, on_invalid):
    rows = [("1", "a", "1")] * 3 + [("x", "a", "1")] * 2 + [("x", "", "y")] * 4 + [(None, None, None)]
    df = spark.createDataFrame(rows, "NO string, PORT string, TONS string")
    result = run_job(spark, {"ship": df}, {"ship": SHIP}, lambda v: v["ship"], output_base=str(tmp_path / "o"), fmt="parquet", stage=stage, on_invalid=on_invalid)
    assert sorted(result.failures["ship"]) == [(("NO",), 2), (("NO", "PORT"), 1), (("NO", "PORT", "TONS"), 4)]
    table = failure_combinations(annotate(df, SHIP, with_mask=True), SHIP)
    assert {tuple(r) for r in table.collect()} == {("", 3), ("NO", 2), ("NO,PORT", 1), ("NO,PORT,TONS", 4)}


def test_a_bucketed_side_is_not_exchanged(spark, tmp_path):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        right = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        table = write_bucketed(right.unionByName(spark.createDataFrame([(None, 1)], "k long, w long")), "sluice_buckets_test", ["k"], 4, str(tmp_path / "b"))
        out = spark.range(500).withColumnRenamed("id", "k").join(table, "k", "left")
        plan = plan_text(out, "simple")
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan
        assert out.where("w = 2 * k").count() == 500 and table.count() == 1000
    finally:
        spark.sql("DROP TABLE IF EXISTS sluice_buckets_test")
        for k, v in old.items():
            spark.conf.set(k, v)


def test_published_text_with_line_breaks_is_read_in_several_tasks(spark, tmp_path):
    df = spark.range(4000).select(F.col("id").cast("string").alias("k"), F.lit("two\nlines").alias("v")).coalesce(1)
    write_batch(df, str(tmp_path), "T", "b1", "csv", options={"maxRecordsPerFile": "500"})
    old = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        back = read_batches(spark, str(tmp_path), "T", "csv")
        assert back.rdd.getNumPartitions() == 8
        assert back.where("v = 'two\nlines'").count() == 4000
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", old)

import os

import pytest
from pyspark.sql import functions as F

from sluice.sources.readers import read_table
from sluice.sources.sinks import read_batches, write_batch, write_quarantine, write_table


def test_csv_bom_crlf_header_and_trim(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_bytes("﻿A,B,C\r\n x ,\"q,1\",3\r\n\"\",,\r\n".encode("utf-8"))
    for multiline in (False, True):
        df = read_table(spark, str(p), "csv", multiline=multiline)
        assert df.columns == ["A", "B", "C"]
        assert [tuple(r) for r in df.collect()] == [("x", "q,1", "3"), (None, None, None)]


def test_csv_permissive_missing_and_extra_fields(spark, tmp_path):
    p = tmp_path / "m.csv"
    p.write_text("A,B,C\nx1,b,1\nx5,only\nx6,e,6,extra\n")
    rows = [tuple(r) for r in read_table(spark, str(p), "csv").orderBy("A").collect()]
    assert rows == [("x1", "b", "1"), ("x5", "only", None), ("x6", "e", "6")]


def test_missing_input_and_unknown_format(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_table(spark, str(tmp_path / "nope"), "csv")
    with pytest.raises(ValueError):
        read_table(spark, str(tmp_path), "delta")
    with pytest.raises(ValueError):
        write_table(spark.range(1), str(tmp_path / "x"), "avro2")


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_batches_keep_siblings_and_rerun_replaces(spark, tmp_path, fmt):
    base = str(tmp_path)
    df = spark.range(3).select(F.col("id").cast("string").alias("id"))
    write_batch(df, base, "T", "20240101_000000", fmt)
    write_batch(df.limit(1), base, "T", "20240102_000000", fmt)
    write_batch(df.limit(2), base, "T", "20240101_000000", fmt)  # rerun of the first batch
    back = read_batches(spark, base, "T", fmt)
    got = {r.batch_date: r.n for r in back.groupBy("batch_date").agg(F.count("*").alias("n")).collect()}
    assert got == {"20240101_000000": 2, "20240102_000000": 1}
    assert dict(back.dtypes)["batch_date"] == "string"
    one = read_batches(spark, base, "T", fmt, batch_id="20240102_000000")
    assert one.count() == 1


def test_empty_quarantine_is_an_empty_batch(spark, tmp_path):
    base = str(tmp_path)
    empty = spark.createDataFrame([], "a string, validation_error string")
    some = spark.createDataFrame([("x", "Failed columns: a")], "a string, validation_error string")
    write_quarantine({"claim": empty, "contract": some}, base, "20240101_000000")
    schema = "a string, validation_error string, batch_date string"
    assert read_batches(spark, os.path.join(base, "invalid"), "claim", "csv", schema=schema).count() == 0
    assert os.path.isdir(tmp_path / "invalid" / "contract" / "batch_date=20240101_000000")


def test_text_formats_of_published_values(spark, tmp_path):
    df = spark.sql(
        "SELECT CAST('2022-01-17 14:45:00' AS TIMESTAMP) AS ts, DATE'2021-02-14' AS d, "
        "CAST(523.21 AS DECIMAL(16,5)) AS v, CAST(NULL AS STRING) AS n"
    )
    write_table(df, str(tmp_path / "c"), "csv")
    row = read_table(spark, str(tmp_path / "c"), "csv").first()
    assert (row.ts, row.d, row.v, row.n) == ("2022-01-17T14:45:00.000Z", "2021-02-14", "523.21000", None)
    write_table(df, str(tmp_path / "j"), "json")
    text = "".join(open(os.path.join(tmp_path / "j", f)).read() for f in os.listdir(tmp_path / "j") if f.endswith(".json"))
    assert '"n":null' in text and '"ts":"2022-01-17T14:45:00.000Z"' in text


def test_published_csv_reads_back_as_written(spark, tmp_path):
    values = ['say "hi", ok', "two\nlines", "  pad ", "a\\b", '"', "plain"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    write_quarantine({"t": df}, str(tmp_path), "20240101_000000", "csv")
    back = read_batches(spark, os.path.join(str(tmp_path), "invalid"), "t", "csv")
    assert [r.v for r in sorted(back.collect(), key=lambda r: int(r.i))] == values


def test_empty_rerun_replaces_the_batch(spark, tmp_path):
    base = str(tmp_path)
    for fmt in ("parquet", "csv"):
        name = f"t_{fmt}"
        full = spark.createDataFrame([("x",)], "a string")
        write_batch(full, base, name, "B1", fmt)
        write_batch(full, base, name, "B2", fmt)
        write_batch(full.limit(0), base, name, "B1", fmt)
        back = read_batches(spark, base, name, fmt, schema="a string, batch_date string")
        assert [tuple(r) for r in back.collect()] == [("x", "B2")]
    write_batch(full.limit(0), base, "none", "B1", "parquet")
    assert read_batches(spark, base, "none", "parquet").columns == ["a", "batch_date"]


def test_files_with_reordered_columns_are_an_error(spark, tmp_path):
    for name, text in (("a.csv", "K,V\n1,2\n"), ("b.csv", "V,K\n2,1\n")):
        (tmp_path / name).write_text(text)
    with pytest.raises(Exception, match="header"):
        read_table(spark, str(tmp_path), "csv").collect()

import os

from sluice.plans.claims import CLAIM_RULES
from sluice.sources.sinks import read_batches
from sluice.streaming.incremental import start_incremental_job

HEADER = "SOURCE_SYSTEM,CLAIM_ID,CONTRACT_SOURCE_SYSTEM,CONTRAT_ID,CLAIM_TYPE,DATE_OF_LOSS,AMOUNT,CREATION_DATE\n"


def _file(d, name, rows):
    with open(os.path.join(d, name), "w") as f:
        f.write(HEADER + "".join(r + "\n" for r in rows))


def _run(spark, src, out, ckpt):
    q = start_incremental_job(
        spark, src, CLAIM_RULES, lambda v: v.select("CLAIM_ID", "AMOUNT"),
        output_base=out, output_name="T", checkpoint=ckpt, max_files_per_trigger=1,
    )
    q.awaitTermination()
    assert q.exception() is None


def test_incremental_epochs_publish_once(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    os.makedirs(src)
    _file(src, "a.csv", ["S,CL_1,C,1,1,01.01.2020,10,01.01.2020 10:00", "S,bad,C,1,1,01.01.2020,10,01.01.2020 10:00"])
    _file(src, "b.csv", ["S,CL_2,C,2,,01.01.2020,20.5,01.01.2020 10:00"])
    _run(spark, src, out, ckpt)
    first = read_batches(spark, out, "T", "csv")
    assert sorted(r.CLAIM_ID for r in first.collect()) == ["CL_1", "CL_2"]
    assert first.select("batch_date").distinct().count() == 2  # one batch per file
    quarantined = read_batches(spark, os.path.join(out, "invalid"), "claim", "csv").collect()
    assert [(r.CLAIM_ID, r.validation_error) for r in quarantined] == [("bad", "Failed columns: CLAIM_ID")]
    # a restart reads only the new file and adds exactly one batch
    _file(src, "c.csv", ["S,CX_3,C,3,2,02.01.2020,30,02.01.2020 10:00"])
    _run(spark, src, out, ckpt)
    after = read_batches(spark, out, "T", "csv")
    assert sorted(r.CLAIM_ID for r in after.collect()) == ["CL_1", "CL_2", "CX_3"]
    assert after.select("batch_date").distinct().count() == 3

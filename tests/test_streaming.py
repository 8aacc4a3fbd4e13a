import os
import tempfile

from tallyfold.sources.schemas import SUBMISSIONS
from tallyfold.streaming.form_feed import start_form_intake

HEADER = ",".join(f.name for f in SUBMISSIONS.fields)


def _row(i, day):
    return f"s{i},2022-0{day}-01T10:00:00,LIMA,LIMA,MIRAFLORES,2022-0{day}-01T00:00:00,JUNTOS,Virtual,,Sello Municipal,IAL"


def test_intake_keeps_each_submission_once(spark):
    base = tempfile.mkdtemp(prefix="tf-stream-")
    src, table, ckpt = (os.path.join(base, x) for x in ("in", "table", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "export1.csv"), "w") as f:
        f.write("\n".join([HEADER, _row(1, 5), _row(2, 6)]) + "\n")
    start_form_intake(spark, src, SUBMISSIONS, table, ckpt, once=True).awaitTermination()
    with open(os.path.join(src, "export2.csv"), "w") as f:
        f.write("\n".join([HEADER, _row(1, 5), _row(2, 6), _row(3, 7)]) + "\n")
    start_form_intake(spark, src, SUBMISSIONS, table, ckpt, once=True).awaitTermination()
    # a submission from before everything the table has, first seen now
    with open(os.path.join(src, "export3.csv"), "w") as f:
        f.write("\n".join([HEADER, _row(4, 1), _row(2, 6)]) + "\n")
    start_form_intake(spark, src, SUBMISSIONS, table, ckpt, once=True).awaitTermination()
    got = sorted(r[0] for r in spark.read.parquet(table).select("submission_id").collect())
    assert got == ["s1", "s2", "s3", "s4"]

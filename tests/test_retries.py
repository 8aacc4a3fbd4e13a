"""Failed task attempts are retried to the same results (deterministic recomputation)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import SparkSession, Window, functions as F
from tallyfold.operators.rows import number_rows
from tallyfold.operators.fuzzy import fuzzy_cascade

spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "4").getOrCreate())

@F.pandas_udf("long")
def flaky(x: pd.Series) -> pd.Series:
    # every first attempt of every task fails; the retry must give the same rows
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("injected task failure")
    return x

base = spark.range(0, 3000).select(F.col("id").cast("string").alias("sid"),
                                   (F.col("id") % 11).cast("timestamp").alias("ts"))
noisy = base.withColumn("k", flaky(F.lit(1).cast("long")))
got = number_rows(noisy, "ts", "sid").select("sid", "n_row")
want = base.select("sid", F.row_number().over(Window.orderBy("ts", "sid")).alias("n_row"))
print("NUMBERING", got.exceptAll(want).count() + want.exceptAll(got).count())

gaz = spark.createDataFrame([("01", "lima", "alto", "san juan"), ("02", "puno", "bajo", "la punta")],
                            "ubigeo string, department string, province string, district string")
recs = spark.createDataFrame([(1, "lma", "alto", "sanjuan"), (2, "puno", "baj", "la punta")],
                             "n_row long, department string, province string, district string")
clean = fuzzy_cascade(recs, gaz)
noisy_recs = recs.withColumn("n_row", flaky(F.col("n_row")))
retried = fuzzy_cascade(noisy_recs, gaz)
print("MATCHER", clean.exceptAll(retried).count() + retried.exceptAll(clean).count())
spark.stop()
"""


def test_numbering_and_matcher_survive_task_retries():
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tempfile.mkdtemp(prefix="tf-retry-"),
                         capture_output=True, text=True, timeout=900)
    assert "NUMBERING 0" in out.stdout, out.stdout + out.stderr[-3000:]
    assert "MATCHER 0" in out.stdout, out.stdout + out.stderr[-3000:]

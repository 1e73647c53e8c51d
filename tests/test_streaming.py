"""Incremental ingest: a later file wins across micro-batches."""

import os
import tempfile

from quire.streaming import latest


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_stream_merge(spark):
    root = tempfile.mkdtemp(prefix="quire-stream-")
    items = spark.createDataFrame([("in", "QUEST", 0, "quest01", None, None, []), ("in", "QUEST", 1, "quest02", None, None, [])],
                                  "study string, task string, row_seq long, itemname string, itemdescription string, "
                                  "likert_scale string, levels array<struct<i:int,value:string,description:string>>")
    _write(f"{root}/in/session_a.csv", "id,ses,quest01,quest02\n1,1,5,6\n2,1,7,8\n")
    q = latest.start(spark, f"{root}/in", items, f"{root}/table", f"{root}/ckpt")
    q.awaitTermination(120)
    _write(f"{root}/in/session_b.csv", "id,ses,quest01\n1,1,9\n")
    q = latest.start(spark, f"{root}/in", items, f"{root}/table", f"{root}/ckpt")
    q.awaitTermination(120)
    got = {(r.subject_id, r.item): r.value for r in latest.read_latest(spark, f"{root}/table").collect()}
    assert got == {("sub-001", "QUEST01"): "9", ("sub-002", "QUEST01"): "7", ("sub-002", "QUEST02"): "8"}
    # a late file whose name sorts first does not win (file order is the name)
    _write(f"{root}/in/session_0.csv", "id,ses,quest01,quest02\n1,1,0,0\n")
    q = latest.start(spark, f"{root}/in", items, f"{root}/table", f"{root}/ckpt")
    q.awaitTermination(120)
    again = {(r.subject_id, r.item): r.value for r in latest.read_latest(spark, f"{root}/table").collect()}
    assert again == got
    # a batch that is run again replaces its own rows, and compaction keeps the answer
    n = spark.read.parquet(f"{root}/table").count()
    latest.append_batch(spark.read.parquet(f"{root}/table").filter("batch = 1").drop("batch").checkpoint(), 1, f"{root}/table")
    assert spark.read.parquet(f"{root}/table").count() == n
    latest.compact(spark, f"{root}/table", f"{root}/compact")
    assert {(r.subject_id, r.item): r.value for r in spark.read.parquet(f"{root}/compact").collect()} == got

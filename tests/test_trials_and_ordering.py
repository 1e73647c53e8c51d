"""Program B (FIXTURES.md section 4) and the skew-safe positional index."""

import os
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.operators import gather, trials
from quire.operators.ordering import group_positions
from quire.plans import convert


def test_trial_table(spark):
    answers = spark.createDataFrame(
        [("s", "f1", "quiz", 0, "1", "1", "3"), ("s", "f1", "quiz", 1, "2", "1", "4"), ("s", "f1", "quiz", 2, "1", "2", "5")],
        "study string, file_seq string, task string, row_seq long, id string, ses string, answer string")
    demo = spark.createDataFrame([("1", 0, "1", "34"), ("1", 1, "1", "99"), ("2", 2, "1", "20")],
                                 "id string, row_seq long, ses string, age string")
    out = tempfile.mkdtemp(prefix="quire-trials-")
    parts = convert.convert_trials(spark, answers, out, demo).orderBy("id").collect()
    with open(os.path.join(out, "s", "sub-1_ses-1_task-quiz_beh.tsv"), encoding="utf-8") as fh:
        assert fh.read() == "onset\tduration\ttrial_type\tid\tses\tanswer\n0\t1.0\tresponse\t1\t1\t3\n1\t1.0\tresponse\t1\t2\t5\n"
    with open(os.path.join(out, "s", "sub-2_ses-1_task-quiz_beh.tsv"), encoding="utf-8") as fh:
        assert fh.read().splitlines()[1] == "0\t1.0\tresponse\t2\t1\t4"
    assert [(p.participant_id, p.session, p.age) for p in parts] == [("sub-1", "ses-1", "34"), ("sub-2", "ses-1", "20")]


def test_fill_missing(spark):
    df = spark.createDataFrame([(" ID ", None)], "`Answer ` string, `x` string")
    out = trials.fill_missing(df)
    assert out.columns == ["answer", "x"]
    assert out.first()["x"] == "n/a"


def test_group_positions_of_a_hot_key_with_payload(spark):
    # 240,000 rows, a third of them under one key, with columns that no ordering needs;
    # the answer must not depend on how the rows are partitioned
    rows = spark.range(240_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("g"),
        ((F.col("id") * 7919) % 240_000).alias("o"), F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    w = Window.partitionBy("g").orderBy("o")
    want = rows.withColumn("position", F.row_number().over(w) - 1).withColumn("lead", F.first("payload").over(w))
    want = want.select("g", "o", "payload", "position", "lead")
    for parts in (1, 3, 16):
        got = group_positions(rows.repartition(parts), ["g"], ["o"], first={"lead": F.col("payload")}, width=1000)
        assert got.count() == 240_000
        assert got.exceptAll(want).count() == 0


def test_group_positions_by_split_and_line(spark):
    key = F.struct((F.col("id") % 4).alias("blk"), (F.col("id") * 37 % 5000).alias("mono"))
    rows = spark.range(5000).select(F.lit(1).alias("g"), key.alias("k"))
    got = group_positions(rows, ["g"], ["k"], width=64)
    want = rows.withColumn("position", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert got.exceptAll(want).count() == 0 and got.count() == 5000


def test_gather_override_with_nulls(spark):
    spine = spark.createDataFrame([("sub-1", "01"), ("sub-2", "01")], "subject_id string, session_id string")
    cells = spark.createDataFrame(
        [("sub-1", "01", "a", "p1", 0, 0, "X", "1"), ("sub-1", "01", "b", "p2", 0, 0, "X", None),
         ("sub-1", "01", "a", "p1", 0, 1, "Y", "7"), ("sub-1", "01", "a", "p0", 1, 0, "X", "bad")],
        "subject_id string, session_id string, task string, file_path string, row_index int, col_seq int, column string, value string")
    parts = spark.createDataFrame([(0, 1, "sub-1", "age", "30"), (1, 1, "sub-1", "age", "31"), (2, 1, "sub-2", "age", "20")],
                                  "row_seq long, col_seq int, subject_id string, column string, value string")
    m = {(r.subject_id, r.column): r.value for r in gather.merged_cells(spine, cells, parts, ["a", "b"]).collect()}
    assert m[("sub-1", "X")] is None          # task b overrides task a, null included
    assert m[("sub-1", "Y")] == "7"
    assert m[("sub-1", "age")] == "31"        # last participants row wins
    assert m[("sub-2", "age")] == "20"
    assert m[("sub-1", "session_id")] == "01"

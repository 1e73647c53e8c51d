"""Order, coverage, directories and late materialisation on awkward shapes."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from quire.operators import ordering, quality, responses
from quire.plans import convert, roles
from quire.sinks import bids
from quire.sources import bids_tree, tables


def test_dense_ranks_of_many_names(spark):
    rows = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 5).cast("string"))).alias("study"),
        F.concat(F.lit("f"), (F.col("id") % 40_000).cast("string")).alias("name"))
    got = ordering.dense_ranks(rows.withColumn("study", F.when(F.col("study") != "s4", F.col("study"))), ["study"], "name")
    want = {}
    for i in range(100_000):
        study = "hot" if i % 3 == 0 else f"s{i % 5}"
        want.setdefault(None if study == "s4" else study, set()).add(f"f{i % 40_000}")
    have = {}
    for r in got.collect():
        have.setdefault(r.study, []).append((r.rank, r.name))
    assert {s: [n for _, n in sorted(v)] for s, v in have.items()} == {s: sorted(v) for s, v in want.items()}
    assert all([k for k, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in have.values())
    assert ordering.dense_ranks(rows.where("false"), ["study"], "name").count() == 0
    assert sorted(r.rank for r in ordering.dense_ranks(rows, [], "name").collect()) == list(range(1, 40_001))


def test_positions_do_not_depend_on_the_partitions(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 30), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, v int, i int")
    order = [F.asc_nulls_last("k"), F.desc("v"), F.asc("i")]
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or "", -r[1], r[2]))
    for parts in (1, 7, 40):
        got = sorted((r.position, r.k, r.v, r.i) for r in ordering.sorted_positions(df.repartition(parts), order).collect())
        assert [g[1:] for g in got] == want and [g[0] for g in got] == list(range(3000))


def test_spine_of_many_empty_sessions(spark):
    root = tempfile.mkdtemp(prefix="quire-spine-")
    want = set()
    for s in range(2000):
        for k in range(10):
            os.makedirs(f"{root}/sub-{s:04d}/ses-{k}")
            want.add((f"sub-{s:04d}", str(k)))
    os.makedirs(f"{root}/sub-alone/beh")
    os.makedirs(f"{root}/other/ses-1")
    with open(f"{root}/sub-file", "w") as fh:
        fh.write("no folder")
    for parts in (1, 16):
        got = [(r.subject_id, r.session_id) for r in bids_tree.directory_spine(spark, root, parts).collect()]
        assert len(got) == len(want) + 1 and set(got) == want | {("sub-alone", "1")}
    got = bids_tree.directory_spine(spark, f"file://{root}", 4).count()
    assert got == len(want) + 1


def test_task_trie():
    trie = quality.task_trie(["ads", "AD", "s_x", "ads_x", "ads"])
    assert quality.tasks_within("my ADS_x1", trie) == {"ads", "AD", "s_x", "ads_x"}
    assert quality.tasks_within("a d s", trie) == set() and quality.tasks_within("", trie) == set()
    rng = random.Random(4)
    for _ in range(300):
        names = ["".join(rng.choice("aBc") for _ in range(rng.randint(1, 4))) for _ in range(6)]
        text = "".join(rng.choice("AbCd") for _ in range(12))
        assert quality.tasks_within(text, quality.task_trie(names)) == {n for n in names if n.upper() in text.upper()}


def test_task_columns_by_study(spark):
    heads = spark.createDataFrame([("s", 1, "ADS01"), ("s", 2, "ADS01"), ("t", 1, "ADS01"), ("s", 1, None), (None, 1, "x")],
                                  "study string, file_seq int, item string")
    tasks = spark.createDataFrame([("s", "ads"), ("s", "d"), ("t", "mood"), ("s", None)], "study string, task string")
    got = sorted(map(tuple, quality.task_columns(heads, tasks).collect()))
    assert got == [("s", 1, "ads", "ADS01"), ("s", 1, "d", "ADS01"), ("s", 2, "ads", "ADS01"), ("s", 2, "d", "ADS01")]
    assert quality.task_columns(heads, tasks.where("false")).count() == 0


def test_coverage_classes_beyond_one_bitmap(spark):
    n = 40_000  # more tasks than the 32,768 bits of one bitmap
    tasks = spark.range(n).select(F.lit("s").alias("study"), F.format_string("t%06d", "id").alias("task"))
    files = spark.range(12).select(F.lit("s").alias("study"), F.col("id").cast("int").alias("file_seq"))
    seen = files.where("file_seq < 11").crossJoin(tasks.select("task")).where(
        (F.col("file_seq") % 3 != 0) | (F.col("task") != "t039999")).where((F.col("file_seq") % 2 == 0) | (F.col("task") < "t000002"))
    classes, member = quality.coverage_classes(seen, files, tasks)
    got = {r["class"]: (r.n_files, r.n_without, r.without[-1] if r.without else None) for r in classes.collect()}
    # 0, 6: all but the last; 2, 4, 8, 10: all; odd: two tasks; 11: none at all
    assert got == {0: (2, 1, "t039999"), 2: (4, 0, None), 1: (5, n - 2, "t039999"), 11: (1, n, "t039999")}
    assert {r.file_seq: r["class"] for r in member.collect()} == {
        0: 0, 6: 0, 2: 2, 4: 2, 8: 2, 10: 2, 1: 1, 3: 1, 5: 1, 7: 1, 9: 1, 11: 11}
    per_file = {r.file_seq: r.n_without for r in quality.file_task_coverage(seen, files, tasks).collect()}
    assert per_file == {0: 1, 6: 1, 1: n - 2, 3: n - 2, 5: n - 2, 7: n - 2, 9: n - 2, 11: n}


def test_records_of_rows_equal_records_of_cells(spark):
    root = tempfile.mkdtemp(prefix="quire-late-")
    rng = random.Random(8)
    heads = ["id,ses,ads-01,ADS 02,mood1,adsx", "Ses,ads01,ID,mood 1", "id,ses,other", "name,x"]
    os.makedirs(f"{root}/st")
    for k in range(9):
        head = heads[k % 4]
        with open(f"{root}/st/s{k}.csv", "w") as fh:
            fh.write(head + "\n")
            for _ in range(40):
                row = [str(rng.randint(1, 9)) if c.lower() in ("id", "ses") else rng.choice(["", "a", "b", '"q,r"']) for c in head.split(",")]
                fh.write(",".join(row) + "\n")
    items = spark.createDataFrame([("st", "ads", "ADS01"), ("st", "ads", "ADS02"), ("st", "Mood", "MOOD1"), ("st", "ADS", "ADS01")],
                                  "study string, task string, item_norm string")
    rows, headers = tables.sheet_rows(tables.read_lines(spark, f"{root}/*/*.csv"))
    cols = ["study", "subject_id", "session", "task", "task_lc", "file_seq", "item_seq", "item", "value"]
    late = responses.records_of_rows(responses.with_keys(rows), headers, items).select(*cols)
    cells = responses.task_records(tables.row_cells(rows, headers), items).select(*cols)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, late.collect()), key=key) == sorted(map(tuple, cells.collect()), key=key)
    assert late.count() > 100
    plan = late._jdf.queryExecution().optimizedPlan().toString()
    # keys are aggregated, cells are neither ranked nor sorted; the ranges of the file order are numbered
    assert all("_range" in x for x in plan.splitlines() if "Window [" in x)


def test_a_sixth_event_type_is_a_task(spark):
    root = tempfile.mkdtemp(prefix="quire-sixth-")
    for name in ("events", "benchmark"):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        if name == "events":
            df = df.withColumn("event_type", F.when(F.col("event_id") % 11 == 0, "wave").otherwise(F.col("event_type")))
        df.write.parquet(f"{root}/{name}.parquet")
    from quire.plans.catalog import QUERIES

    assert roles.task_list(spark, root) == ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW", "WAVE"]
    got = QUERIES["latest_record"][0](spark, root)
    assert {r.task for r in got.select("task").distinct().collect()} >= {"WAVE"}
    wide = QUERIES["long_to_wide"][0](spark, root)
    assert {"WAVE01", "WAVE02"} <= set(wide.columns)


def test_gather_csv_parts_and_manifest(spark):
    root = tempfile.mkdtemp(prefix="quire-parts-")
    rows = [(f"sub-{i:04d}", f"0{j}", f'v,"{i}"' if i % 7 == 0 else None) for i in range(300) for j in (1, 2)]
    random.Random(1).shuffle(rows)
    wide = spark.createDataFrame(rows, "subject_id string, session_id string, a string").repartition(5)
    path = convert.write_gather_csv(wide, root, ["x"])
    manifest = sorted((r.file, int(r.first_row), int(r.rows), r.subject_id, r.session_id)
                      for r in spark.read.option("header", True).csv(path + ".manifest").collect())
    keys = sorted(r[:2] for r in rows)
    assert sum(m[2] for m in manifest) == 600
    for _, first, n, subject, session in manifest:
        assert keys[first] == (subject, session)
    part = spark.read.option("header", True).option("escape", '"').csv(f"{root}/{manifest[-1][0]}")
    assert part.count() == manifest[-1][2]
    lines = {r.line_no: r.line for r in convert.gather_csv_lines(wide).collect()}
    assert len(lines) == 600 and lines[0] == 'sub-0000,01,"v,""0"""' and lines[599] == "sub-0299,02,"


def test_records_absent_from_the_written_tree(spark):
    root = tempfile.mkdtemp(prefix="quire out +")
    beh = f"{root}/st/rawdata/sub-a b/ses-01/beh"
    os.makedirs(beh)
    with open(f"{beh}/sub-a b_ses-01_task-x_beh.tsv", "w") as fh:
        fh.write("X01\n1\n")
    recs = spark.createDataFrame([("st", "sub-a b", "01", "x"), ("st", "sub-a b", "02", "x"), ("st", "sub-a b", "02", "x")],
                                 "study string, subject_id string, session string, task_lc string")
    got = convert.unwritten_records(recs, root, "st").collect()
    assert [(r.check, r.object) for r in got] == [("J11.missing_file", "st/rawdata/sub-a b/ses-02/beh/sub-a b_ses-02_task-x_beh.tsv")]


def test_files_of_one_partition_are_written_by_many_tasks(spark):
    root = tempfile.mkdtemp(prefix="quire-files-")
    os.makedirs(f"{root}/sub-1/there")
    paths = [f"sub-{i}/ses-{i % 3}/note.txt" for i in range(60)] + ["top.txt", "sub-1/there/a.txt", "sub-1/b.txt"]
    files = spark.createDataFrame([(p, f"{p} é\n") for p in paths] + [("empty.txt", None)], "path string, content string")
    spark.sparkContext.setJobGroup("files", "files")
    try:
        bids.write_files(files.coalesce(1), root)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for j in tracker.getJobIdsForGroup("files") for s in tracker.getJobInfo(j).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages) >= spark.sparkContext.defaultParallelism
    got = {os.path.relpath(os.path.join(at, n), root): os.path.join(at, n) for at, _, names in os.walk(root) for n in names}
    assert set(got) == {*paths, "empty.txt"}
    for p, full in got.items():
        with open(full, encoding="utf-8", newline="") as fh:
            assert fh.read() == ("" if p == "empty.txt" else f"{p} é\n")

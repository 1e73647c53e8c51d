"""Ordinary but awkward input on the file routes: blanks, damage, names, quotes, line ends."""

import os
import tempfile

from pyspark.sql import functions as F
from test_workbook import write_xlsx

from quire.functions import paths
from quire.plans import convert
from quire.sources import bids_tree, tables, workbook


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _read(path):
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def test_blank_cells_and_rows_of_workbooks(spark):
    root = tempfile.mkdtemp(prefix="quire-blanks-")
    head = ["id", "ses", "calm_day01", "calm_day02"]
    write_xlsx(f"{root}/data/s1.xlsx", [("a", [head, ["p1", 1, 5, None], ["p2", 1, None, None], ["p3", 1, 1, 2],
                                               [None, 1, 4, 4], ["p4", None, 6, 6]])])
    write_xlsx(f"{root}/data/s2.xlsx", [("a", [head, ["p3", 1, None, None]])])
    _write(f"{root}/data/broken.xlsx", "this is no workbook")
    write_xlsx(f"{root}/res/calm_day.xlsx", [
        ("items", [["itemname", "itemdescription"], ["calm_day01", "a"], ["calm_day02", "b"]]), ("t", [["key name", "description"]]),
        ("n", [["key name", "description"]])])
    write_xlsx(f"{root}/res/short.xlsx", [("items", [["itemname", "itemdescription"], ["short01", "a"]])])
    cells = workbook.workbook_cells(spark, f"{root}/data")
    resp = tables.cells_to_responses(workbook.sheet_cells(cells, sheet_idx=0))
    got = {(r.file_name, r.subject_raw, r.session_raw, r.item_raw): r.value for r in resp.collect()}
    assert got["s1.xlsx", "p1", "1", "calm_day02"] is None and got["s1.xlsx", "p2", "1", "calm_day01"] is None
    assert got["s1.xlsx", None, "1", "calm_day01"] == "4" and got["s1.xlsx", "p4", None, "calm_day02"] == "6"
    assert len(got) == 12
    issues = convert.convert_workbooks(spark, f"{root}/data", f"{root}/res", f"{root}/out", "st").collect()
    found = {(r.check, r.object) for r in issues}
    assert ("S1.unreadable", "broken.xlsx") in found and ("V1.sheets", "short.xlsx") in found
    assert ("J11.missing_file", "participants") in found
    base = f"{root}/out/st/rawdata"
    record = lambda s, ses="01": _read(f"{base}/{s}/ses-{ses}/beh/{s}_ses-{ses}_task-calm_day_beh.tsv")
    assert record("sub-p1") == "calm_day01\tcalm_day02\n5\t\n"
    assert record("sub-p2") == "calm_day01\tcalm_day02\n\t\n"
    assert record("sub-p3") == "calm_day01\tcalm_day02\n\t\n"  # the later, blank record wins
    assert record("sub-unknown") == "calm_day01\tcalm_day02\n4\t4\n" and record("sub-p4").endswith("6\t6\n")


def test_trial_workbooks_that_cannot_be_used_are_listed(spark):
    root = tempfile.mkdtemp(prefix="quire-trials-bad-")
    _write(f"{root}/torn.xlsx", "PK")
    write_xlsx(f"{root}/half.xlsx", [("items", [["itemname"]]), ("answers", [["id"], [1]])])
    write_xlsx(f"{root}/fine.xlsx", [("items", [["itemname", "itemdescription"]]), ("answers", [["id", "x"], [1, 2]]),
                                     ("levels", [["itemname"]])])
    got = {(r.check, r.object, r.detail.split(":")[0]) for r in convert.trial_workbook_issues(spark, root, "st").collect()}
    assert got == {("S1.unreadable", "torn.xlsx", "BadZipFile"), ("V1.sheets", "half.xlsx", "levels")}
    convert.convert_trial_workbooks(spark, root, f"{root}/out", "st").collect()
    assert '"Items": {}' in _read(f"{root}/out/st/task-fine_beh.json")  # a document without items


def test_participants_keep_the_sheet_order(spark):
    root = tempfile.mkdtemp(prefix="quire-order-")
    ids = [(k * 17) % 40 + 1 for k in range(40)]
    write_xlsx(f"{root}/data/s.xlsx", [("a", [["id", "ses", "calm01"], *[[i, 1, 1] for i in ids]])])
    write_xlsx(f"{root}/data/demographics.xlsx", [("a", [["id", "ses", "age"], *[[i, 1, 20 + i] for i in ids], [ids[0], 1, 1]])])
    write_xlsx(f"{root}/data/participants_dataset.xlsx", [
        ("v", [["VariableName", "DataType", "Description", "Levels"], ["id", "string", "Name", None],
               ["age", "float", "Years", None], ["pet", "string", "Pet", None]]), ("d", [["k", "v"], ["Name", "St"]])])
    write_xlsx(f"{root}/res/calm.xlsx", [("i", [["itemname", "itemdescription"], ["calm01", "a"]]), ("t", [["key name"]]),
                                         ("n", [["key name"]])])
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        issues = convert.convert_workbooks(spark, f"{root}/data", f"{root}/res", f"{root}/out", "st").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    lines = _read(f"{root}/out/st/rawdata/participants.tsv").splitlines()
    assert [x.split("\t")[0] for x in lines[1:]] == [f"sub-{i:03d}" for i in [*ids, ids[0]]]
    found = {(r.check, r.object) for r in issues}
    assert {("J9.missing_variable", "pet"), ("V4.type_mismatch", "age"), ("V6.duplicate_subject", str(ids[0]))} <= found


def test_tree_with_awkward_names_quotes_and_line_ends(spark):
    root = tempfile.mkdtemp(prefix="quire tree +")  # a space and a plus in the path itself
    beh = f"{root}/sub-P 02/ses-01/beh/sub-P 02_ses-01"
    _write(f"{beh}_task-my_task_beh.tsv", 'MY01\tMY02\r\n1\t"say ""hi"", now"\r\n')
    _write(f"{beh}_task-other_run-1_beh.tsv", 'OTH01\tOTH02\n"two\nlines\tand a tab"\tn/a\n')
    _write(f"{root}/sub-E/ses-02/beh/sub-E_ses-02_task-my_task_beh.tsv", "MY01\tMY02\n7\t\n")
    _write(f"{root}/participants.tsv", 'participant_id\tnote\r\nsub-P 02\t"a ""b"" c"\r\nsub-E\tn/a\r\n')
    _write(f"{root}/task-my_task_beh.json", "{}")
    _write(f"{root}/task-other_beh.json", "{}")
    wide = convert.gather_tree(spark, root)
    got = {r["subject_id"]: r.asDict() for r in wide.collect()}
    assert wide.columns == ["subject_id", "session_id", "note", "MY01", "MY02", "OTH01", "OTH02"]
    assert got["sub-P 02"] == {"subject_id": "sub-P 02", "session_id": "01", "note": 'a "b" c', "MY01": "1",
                               "MY02": 'say "hi", now', "OTH01": "two\nlines\tand a tab", "OTH02": None}
    assert got["sub-E"]["MY01"] == "7" and got["sub-E"]["MY02"] is None and got["sub-E"]["OTH01"] is None


def test_written_tree_reads_back(spark):
    values = [("sub-001", "x_y", 'q "1"\tz'), ("sub-002", "x_y", "plain")]
    root = tempfile.mkdtemp(prefix="quire-back-")
    for s, t, v in values:
        field = '"' + v.replace('"', '""') + '"'
        _write(f"{root}/{s}/ses-01/beh/{s}_ses-01_task-{t}_beh.tsv", f"A\n{field}\n")
    got = bids_tree.record_cells(spark, root, ["x_y", "x"]).select("subject_id", "task", "value").collect()
    assert sorted(map(tuple, got)) == sorted([(s, t, v) for s, t, v in values] + [(s, "x", v) for s, _, v in values])


def test_path_keys_of_awkward_paths(spark):
    df = spark.createDataFrame([("file:/d/sub-A%20b/ses-01/beh/sub-A%20b_ses-01_task-a_b_c_beh.tsv",),
                                ("file:/d+e/sub-1/beh/sub-1_task-x_beh.tsv",)], "p string")
    p = paths.decoded_path(F.col("p"))
    got = df.select(paths.path_subject(p).alias("s"), paths.path_session(p).alias("n"), paths.path_task(p).alias("t"), p.alias("p"))
    assert [tuple(r)[:3] for r in got.collect()] == [("sub-A b", "01", "a_b_c"), ("sub-1", "1", "x")]
    assert got.collect()[1].p.startswith("file:/d+e/")


def test_session_csv_with_doubled_quotes_and_blank_keys(spark):
    root = tempfile.mkdtemp(prefix="quire-csv-")
    _write(f"{root}/st/a.csv", 'id,ses,calm01,calm02\r\np1,1,"say ""hi"", ok",2\r\n,1,3,\r\np2,,4,5\r\n')
    resp = tables.lines_to_responses(tables.read_lines(spark, f"{root}/*/*.csv"))
    got = {(r.subject_raw, r.session_raw, r.item): r.value for r in resp.collect()}
    assert got == {("p1", "1", "CALM01"): 'say "hi", ok', ("p1", "1", "CALM02"): "2", (None, "1", "CALM01"): "3",
                   (None, "1", "CALM02"): None, ("p2", None, "CALM01"): "4", ("p2", None, "CALM02"): "5"}

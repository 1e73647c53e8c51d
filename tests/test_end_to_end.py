"""Golden mini-study (FIXTURES.md section 2): sheets -> BIDS tree -> gather."""

import json
import os
import tempfile

import pytest

from quire.plans import convert
from quire.sources import tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


@pytest.fixture(scope="module")
def study_tree(spark):
    root = tempfile.mkdtemp(prefix="quire-e2e-")
    _write(f"{root}/data/studyA/session1.csv",
           "id,ses,calmness01,calmness02,calmness03,CALMNESS04\nsub-001,1,5,6,8,9\nsub-002,1,7,6,4,9\n")
    # later file repeats sub-001 / ses 1: the whole record wins, nulls included
    _write(f"{root}/data/studyA/session2.csv", "ID,Ses,calmness01,calmness02,calmness03\nsub-001,1,4,,2\n")
    _write(f"{root}/res/studyA/calmness.csv",
           "itemname,itemdescription,likert_scale,levels,leveldescription,levels.1,leveldescription.1\n"
           "calmness01,Breath went evenly,2,0,Never,1,Always\n"
           "calmness02,Hands were still,2,0,Never,1,Always\n"
           "calmness03,Thoughts came slowly,2,0,Never,1,Always\n"
           "example_item,Example,0,,,,\n"
           "calmness05,Only defined,x,,kg,,\n")
    _write(f"{root}/res/studyA/emptytask.csv", "itemname,itemdescription\nemptytask01,Never answered\n")
    _write(f"{root}/meta1/studyA/calmness.csv", "Key Name,Description\nTaskName,Calmness diary\ncalmness02,Replaced\n")
    _write(f"{root}/meta2/studyA/calmness.csv", "key name,description\nTaskName,Later wins\n")
    _write(f"{root}/meta/demographics.csv",
           "id,ses,age,hand,height,shoes,room\nsub-001,1,51,2,163,41,7\nsub-002,1,27,2,171,39,5\n")
    _write(f"{root}/meta/variables.csv",
           "VariableName,DataType,Description,Levels\nid,string,Participant ID,\nage,integer,Years of practice,\n"
           "hand,cat_num,Writing hand,1: Left; 2: Right\n")
    out = os.path.join(root, "out")
    demo = tables.read_table(spark, f"{root}/meta/demographics.csv").drop("row_seq")
    var = tables.read_table(spark, f"{root}/meta/variables.csv").withColumnRenamed("row_seq", "seq")
    meta = spark.createDataFrame([("studyA", 0, "Name", "Mini study"), ("studyA", 1, "Licence", "CC0"),
                                  ("studyA", 2, "Authors", "A. One; B. Two")], "study string, seq long, key string, value string")
    issues = convert.convert_sheets(spark, f"{root}/data/*/*.csv", f"{root}/res/*/*.csv", out, "studyA",
                                    demographics=demo, variables=var, dataset_meta=meta,
                                    meta_globs=(f"{root}/meta1/*/*.csv", f"{root}/meta2/*/*.csv"))
    return out, issues.collect()


def _read(path):
    with open(path, encoding="utf-8") as fh:
        return fh.read()


def test_record_files(study_tree):
    out, _ = study_tree
    base = f"{out}/studyA/rawdata"
    r1 = _read(f"{base}/sub-001/ses-01/beh/sub-001_ses-01_task-calmness_beh.tsv")
    assert r1 == "CALMNESS01\tCALMNESS02\tCALMNESS03\n4\t\t2\n"
    r2 = _read(f"{base}/sub-002/ses-01/beh/sub-002_ses-01_task-calmness_beh.tsv")
    assert r2 == "CALMNESS01\tCALMNESS02\tCALMNESS03\n7\t6\t4\n"


def test_sidecar_and_unused(study_tree):
    out, _ = study_tree
    base = f"{out}/studyA/rawdata"
    text = _read(f"{base}/task-calmness_beh.json")
    assert text.startswith('{\n    "calmness01": {\n        "Description": "Breath went evenly",')  # indent 4
    side = json.loads(text)
    assert list(side)[:3] == ["calmness01", "calmness02", "calmness03"]
    assert side["calmness02"] == "Replaced"          # metadata replaces an item, keeps its position
    assert side["TaskName"] == "Later wins" and list(side)[-1] == "TaskName"
    assert side["calmness01"] == {"Description": "Breath went evenly", "Levels": {"0": "Never", "1": "Always"}}
    assert side["exampleitem"]["Description"] == "Example"
    assert side["calmness05"] == {"Description": "Only defined", "Units": "kg"}
    assert not os.path.exists(f"{base}/task-emptytask_beh.json")


def test_participants(study_tree):
    out, _ = study_tree
    base = f"{out}/studyA/rawdata"
    assert _read(f"{base}/participants.tsv") == "participant_id\tage\thand\nsub-001\t51\t2\nsub-002\t27\t2\n"
    pj = json.loads(_read(f"{base}/participants.json"))
    assert pj["hand"] == {"Description": "Writing hand", "Levels": {"1": "Left", "2": "Right"}}
    assert pj["participant_id"] == {"Description": "Unique participant identifier", "LongName": "Participant ID"}
    assert "id" not in pj
    dd = json.loads(_read(f"{base}/dataset_description.json"))
    assert dd == {"Name": "Mini study", "License": "CC0", "Authors": ["A. One", "B. Two"], "BIDSVersion": "1.8.0",
                  "DatasetType": "raw"}


def test_issues(study_tree):
    _, issues = study_tree
    got = {(r["check"], r["object"], r["detail"]) for r in issues}
    assert ("V3.extra_columns", "CALMNESS", "CALMNESS04") in got
    assert ("V3.missing_items", "CALMNESS", "CALMNESS05") in got
    assert ("J8.unused_task", "EMPTYTASK", "no records") in got
    assert ("V3.nan_values", "CALMNESS02", "1") in got


def test_gather_back(spark, study_tree):
    out, _ = study_tree
    root = f"{out}/studyA/rawdata"
    wide = convert.gather_tree(spark, root)
    rows = {r["subject_id"]: r.asDict() for r in wide.collect()}
    assert wide.columns == ["subject_id", "session_id", "age", "hand", "CALMNESS01", "CALMNESS02", "CALMNESS03"]
    assert rows["sub-002"] == {"subject_id": "sub-002", "session_id": "01", "age": "27", "hand": "2",
                               "CALMNESS01": "7", "CALMNESS02": "6", "CALMNESS03": "4"}
    assert rows["sub-001"]["CALMNESS02"] is None
    path = convert.write_gather_csv(wide, root, ["calmness"], single_file=True)
    assert _read(path).splitlines()[0] == "subject_id,session_id,age,hand,CALMNESS01,CALMNESS02,CALMNESS03"
    parts = convert.write_gather_csv(wide, f"{root}/derivatives/parts", ["calmness"])
    again = spark.read.option("header", True).csv(parts)
    assert again.columns == wide.columns and again.exceptAll(wide).count() == 0 and again.count() == 2


def test_output_roots_that_workers_do_not_share_are_refused(spark):
    from quire.sinks import bids

    files = spark.createDataFrame([("a.txt", "x")], "path string, content string")
    with pytest.raises(ValueError, match="hdfs"):
        bids.write_files(files, "hdfs://host/out")
    writer = bids.NamedFilesWriter("/tmp", "/nowhere/.writing-0")
    with pytest.raises(RuntimeError, match="not shared"):
        writer.write(iter([]))
    root = tempfile.mkdtemp(prefix="quire-sink-")
    with pytest.raises(Exception):
        bids.write_files(spark.createDataFrame([("a.json", "no json")], "path string, content string"), root, json_indent=2)
    assert os.listdir(root) == []

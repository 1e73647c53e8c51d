"""Quality checks and small documents: V4, V5, V7, V9, J9, A3, A7, K8-K10."""

import json

from pyspark.sql import functions as F

from quire.operators import casting, participants, quality, trials


def test_declared_casts_whole_column(spark):
    df = spark.createDataFrame([("1", "1.5", "1", "1", "-999", "-999"), ("x", "x", "2", "a", "3", "3")],
                               "i string, f string, c1 string, c2 string, m string, s string")
    resolved = casting.resolve_types(df, {"i": "integer", "f": "float", "c1": "cat_num", "c2": "cat_num",
                                          "m": "integer", "s": "string"})
    assert resolved == {"i": "long", "f": "double", "c1": "long", "c2": "string", "m": "long", "s": "string"}
    rows = casting.apply_types(df, resolved).collect()
    assert rows[0]["i"] == 1 and rows[1]["i"] is None and rows[0]["f"] == 1.5 and rows[1]["f"] is None
    assert rows[0]["m"] is None and rows[0]["s"] == "-999"       # C10 on numeric only
    frac = casting.resolve_types(spark.createDataFrame([("1",), ("2.5",)], "i string"), {"i": "integer"})
    assert frac == {"i": "keep"}                                   # non-integral: column unchanged


def test_numbers_in_text(spark):
    # what is no number in a sheet is null, NaN and Java's type suffixes too
    cells = [("1d", None), ("2f", None), ("NaN", None), (" 3 ", 3.0), ("1.5", 1.5), ("-2e3", -2000.0), (".5", 0.5),
             ("5.", 5.0), ("", None), ("1_000", None), ("0x10", None), ("inf", float("inf")), (None, None)]
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cells)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(casting.numeric(F.col("v"))).collect()]
    assert got == [want for _, want in cells]
    one = lambda *v: spark.createDataFrame([(x,) for x in v], "c string")
    assert casting.resolve_types(one("1d", "2f", "3"), {"c": "cat_num"}) == {"c": "string"}
    assert casting.resolve_types(one("1", "NaN"), {"c": "integer"}) == {"c": "long"}


def test_missing_and_mismatch(spark):
    demo = spark.createDataFrame([("1", 30.5)], "ID string, age double")
    var = spark.createDataFrame([(0, "id", "string"), (1, "age", "integer"), (2, "sex", "cat_num")],
                                "seq int, VariableName string, DataType string")
    assert participants.missing_variables(demo, var) == ["sex"]


def test_small_checks(spark):
    counts = spark.createDataFrame([("s", "session1", 0), ("s", "session2", 3)], "study string, object string, n_rows long")
    assert [r.object for r in quality.empty_tables(counts).collect()] == ["session1"]
    assert quality.participant_key_columns(["id", "age"]) == ["ses"]
    dup = quality.duplicate_keys(spark.createDataFrame([("a",), ("a",), ("b",)], "k string"), ["k"]).collect()
    assert [(r.k, r.n) for r in dup] == [("a", 2)]
    cells = spark.createDataFrame([("f1", 0), ("f1", 1), ("f2", 0)], "file_path string, row_index int")
    assert [r.file_path for r in quality.rows_per_file(cells).collect()] == ["f1"]
    req = spark.createDataFrame([("s", "participants.tsv"), ("s", "dataset_description.json")], "study string, file_name string")
    present = spark.createDataFrame([("s", "participants.tsv")], "study string, file_name string")
    assert [r.file_name for r in quality.missing_files(req, present).collect()] == ["dataset_description.json"]
    entries = spark.createDataFrame([("s", "T", "item", None)], "study string, task string, kind string, description string")
    assert quality.sidecar_structure(entries).count() == 1


def test_program_b_documents(spark):
    items = spark.createDataFrame([("s", "quiz", 0, "q1", "First"), ("s", "quiz", 1, "q1", "Again"), ("s", "quiz", 2, "", "x")],
                                  "study string, task string, row_seq long, itemname string, itemdescription string")
    doc = json.loads(trials.task_json(items).first()["json"])
    assert doc == {"TaskName": "quiz", "TaskDescription": "Behavioral task: quiz", "BIDSVersion": "1.8.0",
                   "Items": {"q1": {"Description": "Again", "Levels": {}}}}
    p = spark.createDataFrame([("s", "f", "quiz", 0, "1", "sub-1", "ses-1", "34")],
                              "study string, file_seq string, task string, first_row long, id string, participant_id string, "
                              "session string, age string")
    pj = json.loads(trials.participants_json_b(p).first()["json"])
    assert pj["age"] == {"Description": "Participant age", "DataType": "string"}
    dd = json.loads(trials.dataset_description_b(spark.createDataFrame([("studyA",)], "study string")).first()["json"])
    assert dd["Name"] == "studyA" and dd["DatasetType"] == "raw"


def test_casts_do_not_overflow(spark):
    # beyond the long range the column is left as it was (the source's
    # integer cast overflows and keeps the column); nothing raises
    df = spark.createDataFrame([("1e30",), ("2",)], "i string")
    resolved = casting.resolve_types(df, {"i": "integer"})
    assert resolved == {"i": "keep"}
    assert [r.i for r in casting.apply_types(df, resolved).collect()] == ["1e30", "2"]
    assert [r.i for r in casting.apply_types(df, {"i": "long"}).collect()] == [None, 2]


def test_csv_and_tsv_quoting(spark):
    from quire.sinks import bids

    df = spark.createDataFrame([("a, b",), ('say "hi"',), ("plain",), ("x\ny",)], "v string")
    assert [r[0] for r in df.select(bids.csv_field("v")).collect()] == ['"a, b"', '"say ""hi"""', "plain", '"x\ny"']
    assert [r[0] for r in df.select(bids.tsv_field("v")).collect()] == ["a, b", '"say ""hi"""', "plain", '"x\ny"']

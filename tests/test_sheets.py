"""Sheet fleets: per-file headers, key columns, collisions (D10), quoting."""

import os
import tempfile

from quire.sources import tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_lines_to_responses(spark):
    root = tempfile.mkdtemp(prefix="quire-sheets-")
    _write(f"{root}/s1/a.csv", 'id,ses,ads-01,ADS01,note\n1,2,x,y,"p, q"\n')
    _write(f"{root}/s1/b.csv", "Ses,ID,mood\n3,7,ok\n")
    _write(f"{root}/s1/c.csv", "name,score\nz,1\n")
    _write(f"{root}/s1/~$lock.csv", "id,ses,x\n1,1,1\n")
    lines = tables.read_lines(spark, f"{root}/*/*.csv")
    got = sorted((r.file_name, r.subject_raw, r.session_raw, r.item, r.item_raw, r.value)
                 for r in tables.lines_to_responses(lines).collect())
    assert got == [
        ("a.csv", "1", "2", "ADS01", "ADS01", "y"),      # rightmost of the colliding pair
        ("a.csv", "1", "2", "note", "note", "p, q"),     # quoted field kept whole
        ("b.csv", "7", "3", "mood", "mood", "ok"),       # key columns found in any order and case
    ]
    issues = {(r.object, r.detail) for r in tables.sheet_key_issues(tables.cells_from_lines(lines)).collect()}
    assert issues == {("c.csv", "id, ses")}
    cells = tables.cells_to_responses(tables.cells_from_lines(lines))
    assert sorted((r.file_name, r.item, r.value) for r in cells.collect()) == [
        ("a.csv", "ADS01", "y"), ("a.csv", "note", "p, q"), ("b.csv", "mood", "ok")]


def test_sheet_to_long_and_normalize_items(spark):
    from quire.operators import responses

    sheet = spark.createDataFrame([("s", 1, "f.csv", 0, "1", "1", "a", "b", 3.0)],
                                  "study string, file_seq int, file_name string, row_seq long, ID string, Ses string, "
                                  "`ads-01` string, `ADS01` string, `mood` double")
    long = responses.sheet_to_long(sheet)
    got = sorted((r.item_seq, r.item, r.item_raw, r.value) for r in long.collect())
    assert got == [(1, "ADS01", "ADS01", "b"), (2, "mood", "mood", "3")]
    assert {(r.subject_raw, r.session_raw) for r in long.collect()} == {("1", "1")}
    raw = spark.createDataFrame([("s", 1, 0, 0, "ads-01", "a"), ("s", 1, 0, 1, "ADS01", "b"), ("s", 1, 0, 2, "x 2", "c")],
                                "study string, file_seq int, row_seq long, item_seq int, item string, value string")
    norm = sorted((r.item, r.value) for r in responses.normalize_items(raw).collect())
    assert norm == [("ADS01", "b"), ("X2", "c")]

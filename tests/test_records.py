"""Records across quoted line breaks: any split size, any block width, odd quotes."""

import csv
import io
import os
import random
import tempfile

import pytest

from quire.sources import records, tables


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as fh:
        fh.write(text)


def _sheets(seed):
    rng = random.Random(seed)
    bits = ["a", "b c", "\n", "\r\n", '"', '""', ",", "", "é", "1", "\n\n", "x" * 40]
    out = {}
    for k in range(8):
        rows = [["id", "ses", "note", f"q{k % 2}"]]
        for i in range(rng.randint(0, 60)):
            cell = lambda: "".join(rng.choice(bits) for _ in range(rng.randint(0, 5)))
            rows.append([f"p{i}", str(rng.randint(1, 3)), cell() if k % 4 else "plain", cell().strip()])
        buf = io.StringIO()
        csv.writer(buf, lineterminator="\r\n" if k % 3 == 0 else "\n", quoting=csv.QUOTE_ALL if k % 2 else csv.QUOTE_MINIMAL).writerows(rows)
        out[f"s{k}.csv"] = (("﻿" if k == 5 else "") + buf.getvalue(), rows)
    return out


@pytest.mark.parametrize("split, width", [("64", 3), ("1000", 7), ("128m", 1 << 16)])
def test_records_across_splits_and_blocks(spark, split, width):
    root = tempfile.mkdtemp(prefix="quire-records-")
    sheets = _sheets(4)
    for name, (text, _) in sheets.items():
        _write(f"{root}/st/{name}", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        lines = tables.read_lines(spark, f"{root}/st")
        got = {}
        for r in records.records(lines, ",", width).orderBy("file_name", "row_key").collect():
            got.setdefault(r.file_name, []).append([x or "" for x in r.fields])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {name: rows for name, (_, rows) in sheets.items()}


def test_a_file_that_ends_inside_quotes(spark):
    root = tempfile.mkdtemp(prefix="quire-torn-")
    _write(f"{root}/st/torn.csv", 'id,ses,a01\n1,1,"x\ny"\n2,1,"never\n3,1,closed\n')
    _write(f"{root}/st/odd.csv", 'id,ses,a01\n1,1,5" tall\n2,1,"in" side\n\n3,1,""\n')
    lines = tables.read_lines(spark, f"{root}/st")
    for width in (1, 2, 100):
        got = [(r.file_name, r.fields) for r in records.records(lines, ",", width).orderBy("file_name", "row_key").collect()]
        assert got == [
            ("odd.csv", ["id", "ses", "a01"]), ("odd.csv", ["1", "1", '5" tall']), ("odd.csv", ["2", "1", "in side"]),
            ("odd.csv", ["3", "1", None]), ("torn.csv", ["id", "ses", "a01"]), ("torn.csv", ["1", "1", "x\ny"]),
            ("torn.csv", ["2", "1", '"never']), ("torn.csv", ["3", "1", "closed"]),
        ]
    assert [(r.object, r.check) for r in records.open_quote_issues(lines).collect()] == [("torn.csv", "S3")]
    resp = {(r.file_name, r.subject_raw): r.value for r in tables.lines_to_responses(lines).collect()}
    assert resp["torn.csv", "1"] == "x\ny" and resp["odd.csv", "3"] is None and len(resp) == 6


def test_one_parse_per_record_and_no_shuffle_of_whole_files(spark):
    root = tempfile.mkdtemp(prefix="quire-plan-")
    _write(f"{root}/st/a.csv", 'id,ses,x01,x02,x03,x04\n1,1,a,b,c,"d,e"\n')
    lines = tables.read_lines(spark, f"{root}/st")
    recs = records.records(lines)
    resp = tables.lines_to_responses(recs)
    plan = resp._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 0 and plan.count("regexp_extract_all") == 0  # parsed before, and stored
    assert resp.count() == 4


def test_long_quoted_cells(spark):
    root = tempfile.mkdtemp(prefix="quire-long-")
    text = ('say ""hi"",\n' * 40_000)
    _write(f"{root}/st/a.csv", f'id,ses,x01\n1,1,"{text}"\n2,1,{"y" * 300_000}\n')
    recs = records.records(tables.read_lines(spark, f"{root}/st"), ",", 1000).orderBy("row_key").collect()
    assert [len(r.fields) for r in recs] == [3, 3, 3]
    assert recs[1].fields[2] == text.replace('""', '"') and len(recs[2].fields[2]) == 300_000


def test_empty_inputs(spark):
    lines = spark.createDataFrame([], "study string, file_path string, file_name string, row_key struct<blk: bigint, mono: bigint>, line string")
    assert tables.lines_to_responses(lines).count() == 0
    assert tables.cells_from_lines(lines).count() == 0
    assert records.open_quote_issues(lines).count() == 0

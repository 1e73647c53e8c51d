"""Scalar vectors (FIXTURES.md section 3) for the Column functions."""

import time

from conftest import col_values

from quire.functions import ids, levels, text


def test_whitespace_class_matches_python():
    import re

    ws = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    assert len(ws) == 29
    body = text.WS_CLASS_BODY.replace(r"\x{", "\\u{")
    for ch in ws:
        assert re.fullmatch(r"\s", ch)


def test_c1_subject(spark):
    vals = ["1", "12", "1234", "sub-7", "sub---7", "sub-sub-7", "SUB-7", " P01 ", "a_b", None, "　 9\t"]
    got = col_values(spark, ids.subject_id, vals)
    assert got == ["sub-001", "sub-012", "sub-1234", "sub-7", "sub-7", "sub-sub-7", "sub-SUB-7", "sub-P01",
                   "sub-a_b", "sub-unknown", "sub-009"]
    comp = col_values(spark, lambda c: ids.subject_compliant(ids.subject_id(c)), ["a_b", "1"])
    assert comp == [False, True]


def test_c1_idempotent(spark):
    vals = ["1", "sub-7", "x y", "12345", "sub--3"]
    once = col_values(spark, ids.subject_id, vals)
    twice = col_values(spark, ids.subject_id, once)
    assert once == twice


def test_c2_session(spark):
    vals = ["1", "12", "123", "pre", "ses-1", None, " 3 "]
    assert col_values(spark, ids.session_id, vals) == ["01", "12", "123", "pre", "ses-1", "01", "03"]


def test_c3_task(spark):
    vals = ["calm ness.xlsx", "ADS", "a-b_c.CSV", ".csv", None, "x.XLS"]
    assert col_values(spark, ids.task_name, vals) == ["calmness", "ads", "abc", None, None, "x"]
    issues = col_values(spark, ids.task_name_issue, vals)
    assert issues[0] is None and issues[3] is not None and issues[4] is not None


def test_c4_item(spark):
    vals = ["calmness01", "ads-01", "ads 1", "Q_1", "ads--01", "a1b2", "mood", "QUESTIONNAIRE1_item1"]
    assert col_values(spark, ids.item_name, vals) == ["CALMNESS01", "ADS01", "ADS1", "Q1", "ads--01", "a1b2",
                                                      "mood", "QUESTIONNAIRE1_item1"]
    edge = ["ab1\n", "ab1\r\n", "ab1\u2028", "ab 1\n", "ab1\n\n"]
    assert col_values(spark, ids.item_name, edge) == ["AB1", "ab1\r\n", "ab1\u2028", "AB1", "ab1\n\n"]


def test_c5_key(spark):
    assert col_values(spark, ids.sidecar_key, ["ADS-01_x", " a_b "]) == ["ADS01x", "ab"]


def test_c6_clean(spark):
    assert col_values(spark, text.clean_text, ["a,b\n  c", "\t x ", None]) == ["a b c", "x", None]


def test_c7_sanitize(spark):
    vals = ["a,b\tc", "", "NaN", "None", "NULL", None, "n/a", "  x\r\ny "]
    assert col_values(spark, text.sanitize_tsv, vals) == ["a,b c", "n/a", "n/a", "n/a", "n/a", "n/a", "n/a", "x y"]


def test_c6_c7_idempotent(spark):
    vals = ["a,,b\n\n c ", " ,x, ", "p q"]
    once = col_values(spark, text.clean_text, vals)
    assert col_values(spark, text.clean_text, once) == once
    s_once = col_values(spark, text.sanitize_tsv, vals)
    assert col_values(spark, text.sanitize_tsv, s_once) == s_once


def test_c8_integral(spark):
    got = col_values(spark, text.integral_text, [3.0, 2.5, 10000000.0, None, -0.0], dtype="double")
    assert got == ["3", "2.5", "10000000", None, "0"]


def test_c11_levels(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(0, "1: Male; 2:Female;bad;a:b:c"), (1, "1:a;1:b"), (2, "")], "i int, s string")
    rows = df.orderBy("i").select(levels.levels_map("s").alias("m")).collect()
    assert rows[0].m == {"1": "Male", "2": "Female"}
    assert rows[1].m == {"1": "b"}
    assert rows[2].m == {}
    # dict assignment: a duplicate key keeps its first position, last value
    order = spark.createDataFrame([("1:a;2:b;1:c",)], "s string").select(levels.level_entries("s").alias("e")).first().e
    assert [(e.key, e.value, e.pos) for e in order] == [("1", "c", 0), ("2", "b", 1)]


def test_c12_list(spark):
    vals = ["A; B;;C", "A, B", "A, B; C", "", None]
    got = col_values(spark, levels.split_list, vals)
    assert got == [["A", "B", "C"], ["A", "B"], ["A, B", "C"], [], []]


def test_c13_keys(spark):
    keys = ["Licence", "funding", "ReferencesAndLink", " Name ", "Authors"]
    assert col_values(spark, levels.dataset_key, keys) == ["License", "Funding", "ReferencesAndLinks", "Name", "Authors"]
    assert col_values(spark, levels.dataset_key_is_list, keys) == [False, True, True, False, True]


def test_c17_na_tokens(spark):
    vals = ["n/a", "NA", "None", "null", "", "01", "x"]
    assert col_values(spark, text.na_token_to_null, vals) == [None, None, None, None, None, "01", "x"]


def test_c19_likert(spark):
    assert col_values(spark, levels.likert_levels, ["4", "4.0", "x", None]) == [4, 0, 0, 0]
    assert col_values(spark, levels.likert_levels, [4.0], dtype="double") == [4]


def test_long_level_string(spark):
    n = 20_000
    pieces = [f"{i * 7 % (n // 2)}: v{i}" for i in range(n)] + ["a:b:c", "", " : ", "x"]
    want = {}
    for i, p in enumerate(pieces):
        kv = [x.strip() for x in p.strip().split(":")]
        if len(kv) == 2:
            want[kv[0]] = (want.get(kv[0], (i,))[0], kv[1])
    df = spark.createDataFrame([(1, ";".join(pieces)), (2, None), (3, "")], "i int, s string")
    start = time.monotonic()
    got = {r.i: r.e for r in df.select("i", levels.level_entries("s").alias("e")).collect()}
    assert time.monotonic() - start < 60  # every entry against every other took far longer
    assert [tuple(e) for e in got[1]] == [(p, k, v) for k, (p, v) in want.items()]
    assert got[2] is None and got[3] == []


def test_entries_are_evaluated_once(spark):
    from pyspark.sql import functions as F

    # an expression named in a lambda would be evaluated for each element
    plan = spark.range(1).select(levels.level_entries(F.concat(F.lit("mark"), F.col("id").cast("string"))).alias("e"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("concat(mark") == 1

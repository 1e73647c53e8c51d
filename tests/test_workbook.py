"""Xlsx fleets parsed on executors; header promotion and duplicates."""

import os
import tempfile
import zipfile

from quire.sources import tables, workbook


def _col(i):
    s = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        s = chr(65 + r) + s
    return s


def write_xlsx(path, sheets):
    """Minimal workbook writer for fixtures: ``sheets`` = [(name, rows)]."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rns = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        sheet_tags = "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i + 1}"/>' for i, (n, _) in enumerate(sheets))
        z.writestr("xl/workbook.xml", f"<workbook {ns} {rns}><sheets>{sheet_tags}</sheets></workbook>")
        rels = "".join(f'<Relationship Id="rId{i + 1}" Target="worksheets/sheet{i + 1}.xml"/>' for i in range(len(sheets)))
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="x">{rels}</Relationships>')
        for i, (_, rows) in enumerate(sheets):
            body = []
            for r, row in enumerate(rows):
                cells = []
                for c, v in enumerate(row):
                    ref = f"{_col(c)}{r + 1}"
                    if v is None:
                        continue
                    if isinstance(v, (int, float)):
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
                body.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", f"<worksheet {ns}><sheetData>{''.join(body)}</sheetData></worksheet>")


def test_workbook_fleet(spark):
    root = tempfile.mkdtemp(prefix="quire-xlsx-")
    write_xlsx(f"{root}/studyA/session1.xlsx", [("Sheet1", [["id", "ses", "ads-01", "ads 2"], ["sub-001", 1, 3.0, 2.5],
                                                            ["sub-002", 1, None, 4]])])
    write_xlsx(f"{root}/studyA/task.xlsx", [("main", [["itemname", "levels", "levels"], ["a1", 0, 1]]),
                                            ("desc", [["key name", "description"]]), ("nl", [["key name"]])])
    write_xlsx(f"{root}/studyA/~$lock.xlsx", [("x", [["a"]])])
    cells = workbook.workbook_cells(spark, root)
    counts = {r.file_name: r.n_sheets for r in workbook.sheet_counts(cells).collect()}
    assert counts == {"session1.xlsx": 1, "task.xlsx": 3}
    s = workbook.sheet_cells(cells.filter("file_name = 'session1.xlsx'"), sheet_idx=0)
    got = sorted((r.row_key.mono, r.column, r.value) for r in s.collect())
    assert (1, "ads-01", "3") in got and (1, "ads 2", "2.5") in got and (2, "ads 2", "4") in got
    resp = {(r.subject_raw, r.item): r.value for r in tables.cells_to_responses(s).collect()}
    assert resp[("sub-001", "ADS01")] == "3" and resp[("sub-001", "ADS2")] == "2.5"
    main = workbook.sheet_cells(cells.filter("file_name = 'task.xlsx'"), sheet_idx=0)
    assert sorted(r.column for r in main.collect()) == ["itemname", "levels", "levels.1"]


def test_convert_workbooks_mini_study(spark):
    import json

    from quire.plans import convert

    root = tempfile.mkdtemp(prefix="quire-xlsx-study-")
    write_xlsx(f"{root}/data/studyA/session1.xlsx", [("Sheet1", [["id", "ses", "calmness01", "calmness02", "calmness03"],
                                                                 ["sub-001", 1, 5, 6, 8], ["sub-002", 1, 7, 6, 4]])])
    write_xlsx(f"{root}/data/studyA/demographics.xlsx", [("Sheet1", [["id", "ses", "age", "hand", "height"],
                                                                     ["sub-001", 1, 51, 2, 163], ["sub-002", 1, 27, 2, 171]])])
    write_xlsx(f"{root}/data/studyA/participants_dataset.xlsx", [
        ("variables", [["VariableName", "DataType", "Description", "Levels"], ["id", "string", "Participant ID", None],
                       ["age", "integer", "Years of practice", None], ["hand", "cat_num", "Writing hand", "1: Left; 2: Right"]]),
        ("dataset", [["key", "value"], ["Name", "Mini"], ["Licence", "CC0"]]),
    ])
    write_xlsx(f"{root}/resources/calmness.xlsx", [
        ("items", [["itemname", "itemdescription", "likert_scale", "levels", "leveldescription", "levels", "leveldescription"],
                   ["calmness01", "Breath went evenly", 2, 0, "Never", 1, "Always"],
                   ["calmness02", "Hands were still", 2, 0, "Never", 1, "Always"],
                   ["calmness03", "Thoughts came slowly", 2, 0, "Never", 1, "Always"]]),
        ("task", [["Key Name", "Description"], ["TaskName", "Calmness diary"]]),
        ("nonlikert", [["key name", "description"]]),
    ])
    out = f"{root}/out"
    convert.convert_workbooks(spark, f"{root}/data/studyA", f"{root}/resources", out, "studyA").collect()
    base = f"{out}/studyA/rawdata"
    with open(f"{base}/sub-001/ses-01/beh/sub-001_ses-01_task-calmness_beh.tsv", encoding="utf-8") as fh:
        assert fh.read() == "CALMNESS01\tCALMNESS02\tCALMNESS03\n5\t6\t8\n"
    with open(f"{base}/participants.tsv", encoding="utf-8") as fh:
        assert fh.read() == "participant_id\tage\thand\nsub-001\t51\t2\nsub-002\t27\t2\n"
    with open(f"{base}/task-calmness_beh.json", encoding="utf-8") as fh:
        side = json.load(fh)
    assert side["calmness01"]["Levels"] == {"0": "Never", "1": "Always"}
    assert side["TaskName"] == "Calmness diary"
    with open(f"{base}/dataset_description.json", encoding="utf-8") as fh:
        assert json.load(fh) == {"Name": "Mini", "License": "CC0", "BIDSVersion": "1.8.0", "DatasetType": "raw"}


def test_convert_trial_workbooks(spark):
    import json

    from quire.plans import convert

    root = tempfile.mkdtemp(prefix="quire-xlsx-trials-")
    write_xlsx(f"{root}/data/quiz.xlsx", [
        ("items", [["itemname", "itemdescription"], ["q1", "First"], ["q2", None]]),
        ("answers", [["id", "ses", "answer"], [1, 1, 3], [2, 1, 4], [1, 2, None]]),
        ("levels", [["itemname", "leveldescription"]]),
    ])
    write_xlsx(f"{root}/data/Mood.xlsx", [
        ("items", [["itemname", "itemdescription"], ["m1", "Mood"]]),
        ("answers", [["ID", "onset", "mood"], [1, 5, "ok"]]),
        ("levels", [["itemname", "leveldescription"]]),
    ])
    write_xlsx(f"{root}/data/broken.xlsx", [("Sheet1", [["id"], [1]])])
    write_xlsx(f"{root}/data/demographics.xlsx", [("Sheet1", [["id", "ses", "age"], [1, 1, 34], [1, 2, 99], [2, 1, 20]])])
    out = f"{root}/out"
    parts = convert.convert_trial_workbooks(spark, f"{root}/data", out, "st").orderBy("task", "id").collect()

    def read(name):
        with open(f"{out}/st/{name}", encoding="utf-8") as fh:
            return fh.read()

    assert read("sub-1_ses-1_task-quiz_beh.tsv") == (
        "onset\tduration\ttrial_type\tid\tses\tanswer\n0\t1.0\tresponse\t1\t1\t3\n1\t1.0\tresponse\t1\t2\tn/a\n")
    assert read("sub-2_ses-1_task-quiz_beh.tsv").splitlines()[1] == "0\t1.0\tresponse\t2\t1\t4"
    assert read("sub-1_ses-1_task-Mood_beh.tsv") == "onset\tduration\ttrial_type\tid\tmood\n5\t1.0\tresponse\t1\tok\n"
    tj = json.loads(read("task-quiz_beh.json"))
    assert tj["Items"] == {"q1": {"Description": "First", "Levels": {}}, "q2": {"Description": "n/a", "Levels": {}}}
    assert [(p.task, p.participant_id, p.session, p.age) for p in parts] == [
        ("Mood", "sub-1", "ses-1", "34"), ("quiz", "sub-1", "ses-1", "34"), ("quiz", "sub-2", "ses-1", "20")]
    assert not os.path.exists(f"{out}/st/task-broken_beh.json")
    assert read("participants.tsv") == ("participant_id\tsession\tage\nsub-1\tses-1\t34\n"
                                        "sub-1\tses-1\t34\nsub-2\tses-1\t20\n")
    pj = json.loads(read("participants.json"))
    assert list(pj) == ["participant_id", "session", "age"]
    assert pj["age"] == {"Description": "Participant age", "DataType": "string"}

"""Registered queries that feed operators the awkward cases: shared columns,
several files and rows per key, repeated ids, absent files, empty tables.

Oracles state each rule in SQL of their own; nothing is imported from the
code under test.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from quire.functions import ids
from quire.operators import gather, participants, quality, responses, sidecar, trials
from quire.operators.ordering import dense_ranks
from quire.operators.util import mounted, shared_path, stored_table
from quire.plans import convert, roles
from quire.plans.catalog import (
    BENCH_ITEMS_SQL,
    EVENT_CELLS_SQL,
    GATHER_ITEMS,
    LATEST_SQL,
    QUERIES,
    TASK_ITEMS_SQL,
    T,
    q_gather_wide,
    register,
)
from quire.sinks import bids
from quire.sources import bids_tree, tables, workbook

# ---------------------------------------------------------------- W7, F10, A6, O3
SHARED_CELLS_SQL = """
o AS (SELECT 'sub-' || o_custkey AS subject_id, o_orderstatus AS session_id, o_orderkey,
             CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'a_b' ELSE 'c' END AS task,
             'f' || lpad(o_orderkey::VARCHAR, 9, '0') AS file_path, CAST(extract(day FROM o_orderdate) AS INT) % 2 AS row_index,
             CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS shared, o_orderkey::VARCHAR AS own FROM orders),
cells AS (
  SELECT subject_id, session_id, task, file_path, row_index, 0 AS col_seq, 'SHARED' AS "column", shared AS value FROM o
  UNION ALL SELECT subject_id, session_id, task, file_path, row_index, 1, 'OWN_' || task, own FROM o
  UNION ALL SELECT subject_id, session_id, task, file_path, row_index, 2, 'participant_id', 'no' FROM o
  UNION ALL SELECT subject_id, session_id, task, file_path, row_index, 3, 'session_id', 'no' FROM o)"""


def _shared_cells(spark, d):
    o = T(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    third = F.col("o_orderkey") % 3
    task = F.when(third == 0, "a").when(third == 1, "a_b").otherwise("c")
    shared = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority"))
    cell = lambda i, name, value: F.struct(F.lit(i).alias("col_seq"), name.alias("column"), value.alias("value"))
    return o.select(
        F.concat(F.lit("sub-"), F.col("o_custkey").cast("string")).alias("subject_id"), F.col("o_orderstatus").alias("session_id"),
        task.alias("task"), F.concat(F.lit("f"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("file_path"),
        (F.dayofmonth("o_orderdate") % 2).alias("row_index"),
        F.inline(F.array(cell(0, F.lit("SHARED"), shared), cell(1, F.concat(F.lit("OWN_"), task), F.col("o_orderkey").cast("string")),
                         cell(2, F.lit("participant_id"), F.lit("no")), cell(3, F.lit("session_id"), F.lit("no")))))


@register("gather_shared_columns", f"""
WITH {SHARED_CELLS_SQL},
first_rows AS (SELECT * FROM cells WHERE row_index = 0
  QUALIFY rank() OVER (PARTITION BY subject_id, session_id, task ORDER BY file_path) = 1),
spine AS (SELECT DISTINCT subject_id, session_id FROM cells),
p AS (SELECT 'sub-' || c_custkey AS subject_id, c_mktsegment AS seg, c_name AS shared FROM customer),
allc AS (
  SELECT subject_id, session_id, 'SEG' AS "column", seg AS value, 0 AS prec FROM spine JOIN p USING (subject_id)
  UNION ALL SELECT subject_id, session_id, 'SHARED', shared, 0 FROM spine JOIN p USING (subject_id)
  UNION ALL SELECT subject_id, session_id, 'session_id', session_id, 1 FROM spine
  UNION ALL SELECT subject_id, session_id, "column", value, CASE task WHEN 'c' THEN 2 WHEN 'a_b' THEN 3 ELSE 4 END
  FROM first_rows WHERE "column" NOT IN ('participant_id', 'session_id'))
SELECT subject_id, session_id, "column", value FROM allc
QUALIFY row_number() OVER (PARTITION BY subject_id, session_id, "column" ORDER BY prec DESC) = 1""")
def q_gather_shared_columns(spark, d):
    cells = _shared_cells(spark, d)
    c = T(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_name"])
    prow = c.select(F.col("c_custkey").alias("row_seq"), F.concat(F.lit("sub-"), F.col("c_custkey").cast("string")).alias("subject_id"),
                    F.inline(F.array(F.struct(F.lit(1).alias("col_seq"), F.lit("SEG").alias("column"), F.col("c_mktsegment").alias("value")),
                                     F.struct(F.lit(2).alias("col_seq"), F.lit("SHARED").alias("column"), F.col("c_name").alias("value")))))
    spine = cells.select("subject_id", "session_id").distinct()
    return gather.merged_cells(spine, cells, prow, ["c", "a_b", "a"])


@register("gather_shared_wide", f"""
WITH {SHARED_CELLS_SQL},
first_rows AS (SELECT * FROM cells WHERE row_index = 0
  QUALIFY rank() OVER (PARTITION BY subject_id, session_id, task ORDER BY file_path) = 1),
spine AS (SELECT DISTINCT subject_id, session_id FROM cells),
p AS (SELECT 'sub-' || c_custkey AS subject_id, c_mktsegment AS seg, c_name AS shared FROM customer),
t AS (SELECT subject_id, session_id, "column", value, task FROM first_rows),
s AS (SELECT subject_id, session_id, arg_max(coalesce(value, chr(0)), CASE task WHEN 'c' THEN 2 WHEN 'a_b' THEN 3 ELSE 4 END) AS shared
      FROM t WHERE "column" = 'SHARED' GROUP BY subject_id, session_id),
w AS (SELECT subject_id, session_id, max(value) FILTER ("column" = 'OWN_a') AS own_a, max(value) FILTER ("column" = 'OWN_a_b') AS own_a_b,
             max(value) FILTER ("column" = 'OWN_c') AS own_c FROM t GROUP BY subject_id, session_id)
SELECT spine.subject_id, spine.session_id, p.seg AS "SEG",
       CASE WHEN s.shared IS NULL THEN p.shared ELSE nullif(s.shared, chr(0)) END AS "SHARED",
       w.own_c AS "OWN_c", w.own_a_b AS "OWN_a_b", w.own_a AS "OWN_a"
FROM spine LEFT JOIN p USING (subject_id) LEFT JOIN s USING (subject_id, session_id) LEFT JOIN w USING (subject_id, session_id)""")
def q_gather_shared_wide(spark, d):
    cells = _shared_cells(spark, d)
    c = T(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_name"])
    prow = c.select(F.col("c_custkey").alias("row_seq"), F.concat(F.lit("sub-"), F.col("c_custkey").cast("string")).alias("subject_id"),
                    F.inline(F.array(F.struct(F.lit(1).alias("col_seq"), F.lit("SEG").alias("column"), F.col("c_mktsegment").alias("value")),
                                     F.struct(F.lit(2).alias("col_seq"), F.lit("SHARED").alias("column"), F.col("c_name").alias("value")))))
    spine = cells.select("subject_id", "session_id").distinct()
    return gather.gather_wide(spine, cells, prow, ["c", "a_b", "a"], ["SEG", "SHARED"])


# ---------------------------------------------------------------- J7 with repeated ids
@register("trial_first_demographics", """
WITH p AS (SELECT 'quiz' AS task, conv_id::VARCHAR AS id, min(turn) AS first_row, arg_min(role, turn) AS ses
           FROM conversations GROUP BY conv_id),
d AS (SELECT o_custkey::VARCHAR AS id, o_orderpriority AS priority, o_orderstatus AS status FROM orders
      QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1)
SELECT p.id, 'sub-' || p.id AS participant_id, 'ses-' || p.ses AS session, p.first_row, d.priority, d.status
FROM p LEFT JOIN d USING (id)""")
def q_trial_first_demographics(spark, d):
    c = T(spark, d, "conversations", ["conv_id", "turn", "role"])
    answers = c.select(F.lit("s").alias("study"), F.lit("f").alias("file_seq"), F.lit("quiz").alias("task"),
                       F.col("turn").cast("long").alias("row_seq"), F.col("conv_id").cast("string").alias("id"), F.col("role").alias("ses"))
    o = T(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"])
    demo = o.select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").alias("row_seq"),
                    F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    p = trials.trial_participants(answers, demo)
    return p.select("id", "participant_id", "session", F.col("first_row").cast("long").alias("first_row"), "priority", "status")


# ---------------------------------------------------------------- J11/V8, A7, V5, V7
@register("missing_files", """
WITH req AS (SELECT n_name AS study, f AS file_name FROM nation,
             (VALUES ('participants.tsv'), ('participants.json'), ('dataset_description.json')) AS t(f)),
have AS (SELECT DISTINCT n_name AS study, CASE s_suppkey % 4 WHEN 0 THEN 'participants.tsv' WHEN 1 THEN 'participants.json'
                WHEN 2 THEN 'dataset_description.json' ELSE 'README' END AS file_name
         FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT study, file_name FROM req WHERE NOT EXISTS (
  SELECT 1 FROM have h WHERE h.study = req.study AND h.file_name = req.file_name)""")
def q_missing_files(spark, d):
    n = T(spark, d, "nation", ["n_nationkey", "n_name"])
    names = ["participants.tsv", "participants.json", "dataset_description.json"]
    required = n.select(F.col("n_name").alias("study"), F.explode(F.array(*map(F.lit, names))).alias("file_name"))
    s = T(spark, d, "supplier", ["s_suppkey", "s_nationkey"]).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    listed = F.get(F.array(*map(F.lit, [*names, "README"])), F.col("s_suppkey").cast("int") % 4)
    present = s.select(F.col("n_name").alias("study"), listed.alias("file_name")).distinct()
    return quality.missing_files(required, present)


@register("rows_per_file", """
SELECT 'f' || l_orderkey AS file_path, count(DISTINCT l_linenumber) AS n_rows FROM lineitem
GROUP BY l_orderkey HAVING count(DISTINCT l_linenumber) > 1""")
def q_rows_per_file(spark, d):
    li = T(spark, d, "lineitem", ["l_orderkey", "l_linenumber"])
    return quality.rows_per_file(li.select(F.concat(F.lit("f"), F.col("l_orderkey").cast("string")).alias("file_path"),
                                           (F.col("l_linenumber") - 1).alias("row_index")))


@register("empty_tables", """
SELECT n_name AS study, 'suppliers' AS object, 0 AS n_rows FROM nation
WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)""")
def q_empty_tables(spark, d):
    n = T(spark, d, "nation", ["n_nationkey", "n_name"])
    s = T(spark, d, "supplier", ["s_nationkey", "s_acctbal"]).filter("s_acctbal > 5000")
    counts = n.join(s, F.col("s_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("s_acctbal").alias("n_rows"))
    return quality.empty_tables(counts.select(F.col("n_name").alias("study"), F.lit("suppliers").alias("object"), "n_rows"))


@register("sidecar_structure", """
SELECT p_brand AS study, p_type AS task, count(*) AS n,
       count(*) FILTER (p_size % 10 <> 3 AND p_partkey % 9 = 0) AS no_desc
FROM part GROUP BY p_brand, p_type HAVING count(*) FILTER (p_size % 10 <> 3 AND p_partkey % 9 = 0) > 0""")
def q_sidecar_structure(spark, d):
    p = T(spark, d, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_name"])
    kind = F.when(F.col("p_size") % 10 == 3, "meta").otherwise("item")
    entries = p.select(F.col("p_brand").alias("study"), F.col("p_type").alias("task"), kind.alias("kind"),
                       F.when(F.col("p_partkey") % 9 != 0, F.col("p_name")).alias("description"))
    return quality.sidecar_structure(entries)


# ---------------------------------------------------------------- F9/K9
@register("trial_items", """
WITH i AS (SELECT p_brand AS study, p_type AS task, p_partkey, CASE WHEN p_partkey % 6 = 0 THEN '' WHEN p_partkey % 11 = 0 THEN NULL
                  ELSE 'c' || p_size END AS itemname, p_name FROM part)
SELECT study, task, itemname, min(p_partkey) AS position, arg_max(p_name, p_partkey) AS description
FROM i WHERE itemname IS NOT NULL AND itemname <> '' GROUP BY study, task, itemname""")
def q_trial_items(spark, d):
    p = T(spark, d, "part", ["p_partkey", "p_brand", "p_type", "p_size", "p_name"])
    name = F.when(F.col("p_partkey") % 6 == 0, "").when(F.col("p_partkey") % 11 != 0, F.concat(F.lit("c"), F.col("p_size").cast("string")))
    return trials.task_json_items(p.select(F.col("p_brand").alias("study"), F.col("p_type").alias("task"), name.alias("itemname"),
                                           F.col("p_name").alias("itemdescription"), F.col("p_partkey").alias("row_seq")))


def _sheet(lines, day):
    """Sheet lines as they lie in storage, one file per day; ``lines``: (day, mono, text)."""
    key = F.struct(F.lit(0).cast("long").alias("blk"), F.col("mono").cast("long").alias("mono")).alias("row_key")
    sheets = lines.select(F.lit("st").alias("study"), F.concat(F.lit("/st/"), day).alias("file_path"), F.col(day).alias("file_name"),
                          key, F.col("text").alias("line"))
    return stored_table(sheets.repartition("file_path"), "sheets")


# ---------------------------------------------------------------- S3, P2, P3, P5: sheet lines
@register("sheet_lines", """
WITH e AS (SELECT strftime(ts, '%Y%m%d') AS day, event_id, user_id, event_type, value,
                  json_extract_string(props, '$.k') AS k, date_part('day', ts) AS dom FROM events),
f AS (SELECT DISTINCT day, dense_rank() OVER (ORDER BY day) AS file_seq FROM e),
c AS (SELECT *, CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id::VARCHAR END AS subject_raw,
             CASE WHEN event_id % 7 = 0 THEN NULL ELSE (1 + (dom - 1) // 10)::BIGINT::VARCHAR END AS session_raw FROM e)
SELECT file_seq, event_id AS row, subject_raw, session_raw, item_seq, item, item_raw, val AS value FROM c JOIN f USING (day),
LATERAL (VALUES (2, 'MOOD01', 'mood-01', event_type), (3, 'a, "b"', 'a, "b"', 'say "' || event_type || '", ' || coalesce(k, '')),
                (5, 'MOOD2', 'MOOD 2', CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id::VARCHAR END)) AS t(item_seq, item, item_raw, val)""")
def q_sheet_lines(spark, d):
    """One sheet per day: blank keys and cells, quoted fields, a column that a
    later one replaces after normalisation."""
    e = T(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "props"])
    day = F.date_format("ts", "yyyyMMdd")
    field = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    blank = lambda cond, c: F.when(cond, F.lit("")).otherwise(c.cast("string"))
    k = F.coalesce(F.get_json_object("props", "$.k"), F.lit(""))
    line = F.concat_ws(
        ",", blank(F.col("event_id") % 10 == 0, F.col("user_id")),
        blank(F.col("event_id") % 7 == 0, F.lit(1) + F.floor((F.dayofmonth("ts") - 1) / 10)),
        F.col("event_type"), field(F.concat(F.lit('say "'), "event_type", F.lit('", '), k)), F.lit("replaced"),
        blank(F.col("event_id") % 3 == 0, F.col("event_id")))
    rows = e.select(day.alias("day"), F.col("event_id").alias("mono"), line.alias("text"))
    heads = e.select(day.alias("day")).distinct().select("day", F.lit(-1).cast("long").alias("mono"),
                                                         F.lit('ID,Ses,mood-01,"a, ""b""",mood2,MOOD 2').alias("text"))
    lines = _sheet(rows.unionByName(heads), "day")
    r = tables.lines_to_responses(lines)
    return r.select(F.col("file_seq").cast("long").alias("file_seq"), F.col("row_seq.mono").alias("row"), "subject_raw", "session_raw",
                    "item_seq", "item", "item_raw", "value")


# ---------------------------------------------------------------- U1, S3, S6: header classes
@register("sheet_shapes", """
WITH e AS (SELECT strftime(ts, '%Y%m%d') AS day, date_part('day', ts)::BIGINT AS dom, event_id, user_id, event_type FROM events),
f AS (SELECT DISTINCT day, dense_rank() OVER (ORDER BY day) AS file_seq FROM e),
c AS (SELECT *, user_id::VARCHAR AS subject_raw, (1 + (dom - 1) // 10)::VARCHAR AS session_raw FROM e JOIN f USING (day))
SELECT file_seq, event_id AS row, subject_raw, session_raw, item_seq, item, item_raw, val AS value FROM c,
LATERAL (SELECT 3 AS item_seq, 'CALM01' AS item, 'CALM01' AS item_raw, event_type AS val WHERE dom % 3 = 0
  UNION ALL SELECT 4, 'extra, "x"', 'extra, "x"', 'a "' || event_type || '",' WHERE dom % 3 = 0
  UNION ALL SELECT 1, 'CALM01', 'calm-01', event_type WHERE dom % 3 = 1
  UNION ALL SELECT 0, 'MOOD2', 'mood 2', CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id::VARCHAR END WHERE dom % 3 = 2
  UNION ALL SELECT 3, 'free', 'free', NULL WHERE dom % 3 = 2 AND event_id % 5 = 0
  UNION ALL SELECT 3, 'free', 'free', 'x' WHERE dom % 3 = 2 AND event_id % 5 <> 0) AS t(item_seq, item, item_raw, val)""")
def q_sheet_shapes(spark, d):
    """One sheet per day, in three shapes by the day: key columns anywhere, names that
    collide after normalisation, records shorter than the header."""
    e = T(spark, d, "events", ["event_id", "ts", "user_id", "event_type"])
    kind = F.dayofmonth("ts") % 3
    ses = (F.lit(1) + F.floor((F.dayofmonth("ts") - 1) / 10)).cast("string")
    quoted = F.concat(F.lit('"a ""'), "event_type", F.lit('"","'))
    text = (F.when(kind == 0, F.concat_ws(",", F.col("user_id").cast("string"), ses, F.lit("replaced"), F.col("event_type"), quoted))
            .when(kind == 1, F.concat_ws(",", ses, F.col("event_type"), F.col("user_id").cast("string")))
            .otherwise(F.concat_ws(",", F.when(F.col("event_id") % 4 == 0, F.lit("")).otherwise(F.col("event_id").cast("string")),
                                   F.col("user_id").cast("string"), ses, F.when(F.col("event_id") % 5 != 0, F.lit("x")))))
    head = F.when(kind == 0, F.lit('id,SES,calm 01,CALM01,"extra, ""x"""')).when(kind == 1, F.lit("Ses,calm-01,ID")).otherwise(
        F.lit("mood 2,Id,ses,free"))
    day = F.date_format("ts", "yyyyMMdd").alias("day")
    rows = e.select(day, F.col("event_id").alias("mono"), text.alias("text"))
    heads = e.select(day, F.lit(-1).cast("long").alias("mono"), head.alias("text")).distinct()
    r = tables.lines_to_responses(_sheet(rows.unionByName(heads), "day"))
    return r.select(F.col("file_seq").cast("long").alias("file_seq"), F.col("row_seq.mono").alias("row"), "subject_raw", "session_raw",
                    "item_seq", "item", "item_raw", "value")


# ---------------------------------------------------------------- S3, S8: quoted line breaks
@register("sheet_quoted_lines", r"""
SELECT doc_id::VARCHAR AS id, lang AS lang_,
  sha256(coalesce(text, '') || chr(13) || chr(10) || 'said "' || coalesce(source, '') || '",' || chr(10)) AS cell_sha256,
  length(coalesce(text, '')) + length(coalesce(source, '')) + 11 AS cell_chars FROM documents""")
def q_sheet_quoted_lines(spark, d):
    """Whole texts with quotes, commas, CRLF and line breaks, written as CSV files
    and read back as split lines: one record per document."""
    docs = T(spark, d, "documents", ["doc_id", "text", "lang", "source"])
    cell = F.concat(F.coalesce("text", F.lit("")), F.lit('\r\nsaid "'), F.coalesce("source", F.lit("")), F.lit('",\n'))
    path = shared_path(spark, "quoted-sheets")
    docs.select(F.col("doc_id").cast("string").alias("id"), F.lit("1").alias("ses"), cell.alias("cell"), F.col("lang").alias("lang_")).write.option(
        "header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    r = tables.lines_to_responses(tables.read_lines(spark, path))
    row = r.groupBy("file_seq", "row_seq", F.col("subject_raw").alias("id")).agg(
        F.max(F.when(F.col("item") == "cell", F.col("value"))).alias("cell"), F.max(F.when(F.col("item") == "lang_", F.col("value"))).alias("lang_"))
    return row.select("id", "lang_", F.sha2("cell", 256).alias("cell_sha256"), F.length("cell").cast("long").alias("cell_chars"))


# ---------------------------------------------------------------- S6, O1, W4: file sequence
@register("file_sequence", """
WITH f AS (SELECT DISTINCT o_orderpriority AS study, 'sheet_' || (o_orderkey % 99991)::VARCHAR || '.csv' AS file_name FROM orders)
SELECT study, file_name, dense_rank() OVER (PARTITION BY study ORDER BY file_name) AS file_seq FROM f""")
def q_file_sequence(spark, d):
    """Names in study order: one sheet per order, five studies."""
    name = F.concat(F.lit("sheet_"), (F.col("o_orderkey") % 99991).cast("string"), F.lit(".csv"))
    files = T(spark, d, "orders", ["o_orderkey", "o_orderpriority"]).select(F.col("o_orderpriority").alias("study"), name.alias("file_name"))
    return dense_ranks(files, ["study"], "file_name", "file_seq")


# ---------------------------------------------------------------- J6, F5: coverage classes
@register("coverage_classes", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL},
defined AS (SELECT DISTINCT study, task FROM bi),
files AS (SELECT DISTINCT study, file_seq FROM cells),
used AS (SELECT DISTINCT study, file_seq, task FROM matched WHERE file_seq % 3 <> 0 OR task <> 'CLICK'),
lists AS (SELECT f.study, f.file_seq, coalesce(string_agg(t.task, '|' ORDER BY t.task) FILTER (u.task IS NULL), '') AS without,
    count(*) FILTER (u.task IS NULL) AS n_without
  FROM files f JOIN defined t USING (study) LEFT JOIN used u ON u.study = f.study AND u.file_seq = f.file_seq AND u.task = t.task
  GROUP BY f.study, f.file_seq)
SELECT study, min(file_seq) AS class, count(*) AS n_files, n_without, without FROM lists GROUP BY study, without, n_without""")
def q_coverage_classes(spark, d):
    """Files by the tasks they lack; every third day's CLICK columns are left out."""
    cells = roles.event_cells(spark, d).withColumn("item", ids.item_name(F.col("item")))
    items = sidecar.task_item_names(roles.event_task_items(spark, d))
    used = responses.match_task_items(cells, items).select("study", "file_seq", "task").distinct()
    used = used.where((F.col("file_seq") % 3 != 0) | (F.col("task") != "CLICK"))
    tasks = roles.event_task_items(spark, d).select("study", "task").distinct()
    classes, _ = quality.coverage_classes(used, cells.select("study", "file_seq").distinct(), tasks)
    return classes.withColumn("without", F.concat_ws("|", "without"))


# ---------------------------------------------------------------- S9, J4: directory spine
@register("tree_spine", """
SELECT DISTINCT 'sub-' || lpad(c_custkey::VARCHAR, greatest(3, length(c_custkey::VARCHAR))::INTEGER, '0') AS subject_id,
  CASE WHEN c_custkey % 4 = 0 THEN '1' ELSE lpad(c_nationkey::VARCHAR, 2, '0') END AS session_id FROM customer""")
def q_tree_spine(spark, d):
    """A tree of one folder per customer, every fourth without session folders, listed back."""
    c = T(spark, d, "customer", ["c_custkey", "c_nationkey"])
    subject = ids.subject_id(F.col("c_custkey").cast("string"))
    session = F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("/ses-"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")))
    root = mounted(shared_path(spark, "tree"))
    files = c.select(F.concat(subject, F.coalesce(session, F.lit("")), F.lit("/note.txt")).alias("path"), F.lit("x").alias("content"))
    os.makedirs(root)
    bids.write_files(files, root)
    return bids_tree.directory_spine(spark, root)


# ---------------------------------------------------------------- K6, O2: gather CSV
def _ordered_gather(spark, d):
    wide = q_gather_wide(spark, d)
    return wide.select("subject_id", "session_id", *sorted(c for c in wide.columns if c not in ("subject_id", "session_id")))


@register("gather_csv", f"""
WITH wide AS ({QUERIES["gather_wide"][1]})
SELECT row_number() OVER (ORDER BY subject_id, session_id) - 1 AS line_no, subject_id || ',' || session_id || ',' ||
  {" || ',' || ".join(f"coalesce({c}, '')" for c in sorted([*GATHER_ITEMS, "nation", "segment"]))} AS line FROM wide""")
def q_gather_csv(spark, d):
    return convert.gather_csv_lines(_ordered_gather(spark, d))


# ---------------------------------------------------------------- S1, S2, S11, V1: workbooks
def _workbook(rows: list[list]) -> bytes:
    """A workbook of two sheets: ``rows`` (None: no cell) and a table of their number."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"

    def sheet(table):
        out = []
        for r, row in enumerate(table):
            cells = (f'<c r="{chr(65 + c)}{r + 1}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' if isinstance(v, str)
                     else f'<c r="{chr(65 + c)}{r + 1}"><v>{v}</v></c>' for c, v in enumerate(row) if v is not None)
            out.append(f'<row r="{r + 1}">{"".join(cells)}</row>')
        return f'<worksheet xmlns="{main}"><sheetData>{"".join(out)}</sheetData></worksheet>'

    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="data" sheetId="1" r:id="r1"/>'
                                      '<sheet name="size" sheetId="2" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="r1" Target="worksheets/a.xml"/><Relationship Id="r2" Target="worksheets/b.xml"/></Relationships>')
        z.writestr("xl/worksheets/a.xml", sheet(rows))
        z.writestr("xl/worksheets/b.xml", sheet([["rows"], [float(len(rows) - 1)]]))
    return buf.getvalue()


@register("workbook_fleet", """
WITH c AS (SELECT 'n' || c_nationkey || '_' || lower(c_mktsegment) || '.xlsx' AS file_name, c_custkey, c_name, c_acctbal,
    row_number() OVER (PARTITION BY c_nationkey, c_mktsegment ORDER BY c_custkey) AS row FROM customer),
f AS (SELECT file_name, count(*) AS n, dense_rank() OVER (ORDER BY file_name) AS file_seq FROM c GROUP BY file_name),
cells AS (SELECT file_name, 0 AS sheet_idx, row, col, val AS value FROM c,
    LATERAL (VALUES (0, c_custkey::VARCHAR), (1, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name || ' <&> ' END),
                    (2, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE floor(c_acctbal)::BIGINT::VARCHAR END)) AS v(col, val)
  UNION ALL SELECT file_name, 0, 0, col, name FROM f, (VALUES (0, 'ID'), (1, 'name'), (2, 'bal ance')) AS h(col, name)
  UNION ALL SELECT file_name, 1, 0, 0, 'rows' FROM f UNION ALL SELECT file_name, 1, 1, 0, n::VARCHAR FROM f)
SELECT file_name, file_seq, sheet_idx, row::BIGINT AS row, col::BIGINT AS col, value FROM cells JOIN f USING (file_name)""")
def q_workbook_fleet(spark, d):
    """One workbook per nation and segment, written by tasks and read back as cells."""
    c = T(spark, d, "customer", ["c_custkey", "c_name", "c_acctbal", "c_nationkey", "c_mktsegment"])
    root = mounted(shared_path(spark, "books"))
    os.makedirs(f"{root}/st")

    def write(key, pdf):
        import pandas as pd

        rows = [["ID", "name", "bal ance"]]
        for k, name, bal in pdf.sort_values("c_custkey")[["c_custkey", "c_name", "c_acctbal"]].itertuples(index=False):
            rows.append([int(k), None if k % 3 == 0 else f"{name} <&> ", None if k % 5 == 0 else float(bal // 1)])
        name = f"n{key[0]}_{key[1].lower()}.xlsx"
        temp = f"{root}/st/~${name}.{uuid.uuid4().hex}"
        with open(temp, "wb") as fh:
            fh.write(_workbook(rows))
        os.replace(temp, f"{root}/st/{name}")
        return pd.DataFrame({"n": [len(rows)]})

    c.groupBy("c_nationkey", "c_mktsegment").applyInPandas(write, "n long").agg(F.sum("n")).collect()
    cells = workbook.workbook_cells(spark, root)
    return cells.select("file_name", F.col("file_seq").cast("long").alias("file_seq"), "sheet_idx", F.col("row").cast("long").alias("row"),
                        F.col("col").cast("long").alias("col"), "value")


# ---------------------------------------------------------------- K9, K10, K8, F3, U2, V9, J9: documents
@register("trial_task_json", """
WITH i AS (SELECT p_brand AS study, p_type AS task, 'q ' || (p_size % 7) AS name, p_partkey, p_name FROM part),
e AS (SELECT study, task, name, min(p_partkey) AS position, arg_max(p_name, p_partkey) AS description FROM i GROUP BY ALL)
SELECT study, task, '{"TaskName":' || to_json(task)::VARCHAR || ',"TaskDescription":' || to_json('Behavioral task: ' || task)::VARCHAR
  || ',"BIDSVersion":"1.8.0", "Items": {' || string_agg(to_json(name)::VARCHAR || ': {"Description":' || to_json(description)::VARCHAR
  || ',"Levels":{}}', ', ' ORDER BY position) || '}}' AS json FROM e GROUP BY study, task""")
def q_trial_task_json(spark, d):
    p = T(spark, d, "part", ["p_brand", "p_type", "p_size", "p_partkey", "p_name"])
    items = p.select(F.col("p_brand").alias("study"), F.col("p_type").alias("task"), F.concat(F.lit("q "), F.col("p_size") % 7).alias("itemname"),
                     F.col("p_name").alias("itemdescription"), F.col("p_partkey").alias("row_seq"))
    return trials.task_json(items).select("study", "task", "json")


@register("trial_dataset_json", """
SELECT s_name AS study, '{"Name":' || to_json(s_name)::VARCHAR || ',"BIDSVersion":"1.8.0","DatasetType":"raw","GeneratedBy":[{"Name":"quire"}]}' AS json
FROM supplier""")
def q_trial_dataset_json(spark, d):
    return trials.dataset_description_b(T(spark, d, "supplier", ["s_name"]).select(F.col("s_name").alias("study")))


@register("sidecar_metadata", """
WITH m AS (SELECT o_orderpriority AS study, o_orderstatus AS task, o_orderkey % 2 + 1 AS sheet_seq, o_orderkey AS row_seq,
    CASE WHEN o_custkey % 6 = 0 THEN NULL ELSE 'key ' || (o_custkey % 40) END AS key,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'v' || o_orderkey END AS value FROM orders)
SELECT study, task, key, arg_max(value, pos) AS value, min(pos).sheet_seq AS first_sheet, min(pos).row_seq AS first_row
FROM (SELECT *, {'sheet_seq': sheet_seq, 'row_seq': row_seq} AS pos FROM m) WHERE key IS NOT NULL AND value IS NOT NULL
GROUP BY study, task, key""")
def q_sidecar_metadata(spark, d):
    """Two metadata sheets per task: the last value of a key wins at its first position."""
    o = T(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"])
    meta = o.select(
        F.col("o_orderpriority").alias("study"), F.col("o_orderstatus").alias("task"), (F.col("o_orderkey") % 2 + 1).alias("sheet_seq"),
        F.col("o_orderkey").alias("row_seq"),
        F.when(F.col("o_custkey") % 6 != 0, F.concat(F.lit("key "), F.col("o_custkey") % 40)).alias("key"),
        F.when(F.col("o_orderkey") % 9 != 0, F.concat(F.lit("v"), "o_orderkey")).alias("value"))
    return sidecar.metadata_entries(meta).select("study", "task", "key", "value", F.col("first.sheet_seq").alias("first_sheet"),
                                                 F.col("first.row_seq").alias("first_row"))


@register("declared_missing", """
WITH v AS (SELECT p_brand AS study, lower(trim(p_type)) AS variable FROM part GROUP BY ALL),
h AS (SELECT p_brand AS study, lower(trim(p_type)) AS variable FROM part WHERE p_size <= 3 GROUP BY ALL)
SELECT study, variable FROM v WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.study = v.study AND h.variable = v.variable)""")
def q_declared_missing(spark, d):
    """Variables that a study declares and its demographics sheet lacks."""
    p = T(spark, d, "part", ["p_brand", "p_type", "p_size"]).select(F.col("p_brand").alias("study"), F.col("p_type").alias("VariableName"), "p_size")
    return participants.missing_variable_rows(p.where("p_size <= 3").select("study", F.col("VariableName").alias("column")), p)


@register("definition_columns", """
WITH h AS (SELECT DISTINCT p_brand AS study, p_type AS object, CASE p_size % 5 WHEN 0 THEN 'itemname' WHEN 1 THEN ' itemdescription '
    WHEN 2 THEN 'ItemName' WHEN 3 THEN 'levels' ELSE 'levels.1' END AS name FROM part)
SELECT study, object, string_agg(need, ', ' ORDER BY need) AS detail FROM (SELECT DISTINCT study, object FROM h) s,
  (VALUES ('itemname'), ('itemdescription')) AS r(need)
WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.study = s.study AND h.object = s.object AND trim(h.name) = r.need) GROUP BY study, object""")
def q_definition_columns(spark, d):
    """V2 on definition sheets: those that lack a required column, names stripped, case kept."""
    name = F.element_at(F.array(*map(F.lit, ("itemname", " itemdescription ", "ItemName", "levels", "levels.1"))), (F.col("p_size") % 5 + 1).cast("int"))
    heads = T(spark, d, "part", ["p_brand", "p_type", "p_size"]).select(F.col("p_brand").alias("study"), F.col("p_type").alias("object"), name.alias("column"))
    return quality.required_columns(heads, ("itemname", "itemdescription")).select("study", "object", "detail")

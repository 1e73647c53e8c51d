"""Registered queries over the driver tables, each with its DuckDB oracle.

``QUERIES[name] = (spark_fn, oracle_sql or None)``.  Every query reads whole
tables (no id subsets, no row caps) through ``roles``; each Spark side is built
from the library operators, each SQL side states the same semantics
independently in DuckDB SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions import ids, levels, paths, text
from quire.operators import casting, dataset, gather, participants, quality, responses, sidecar, trials
from quire.operators.util import stored_table
from quire.plans import roles
from quire.plans import sqlfrag as S
from quire.sinks import bids

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        if not fn.__name__.startswith("q_") or name in QUERIES:
            raise ValueError(f"bad registration of {name!r} -> {fn.__name__}")
        QUERIES[name] = (fn, sql)
        return fn

    return deco


T = roles.table
TAB = "chr(9)"

# ---------------------------------------------------------------- shared SQL
EVENT_CELLS_SQL = f"""
ev AS (
  SELECT 'tpch' AS study, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS file_seq, ts, event_id AS row_seq,
         CAST(user_id AS VARCHAR) AS subject_raw,
         CAST(CAST(1 + floor((day(ts) - 1) / 10) AS BIGINT) AS VARCHAR) AS session_raw,
         upper(event_type) AS t, value, props
  FROM events),
cells0 AS (
  SELECT study, file_seq, ts, row_seq, subject_raw, session_raw, 0 AS item_seq, t || '01' AS item,
         {S.integral_text('value')} AS value FROM ev
  UNION ALL
  SELECT study, file_seq, ts, row_seq, subject_raw, session_raw, 1, t || '02', json_extract_string(props, '$.k') FROM ev
  UNION ALL
  SELECT study, file_seq, ts, row_seq, subject_raw, session_raw, 2, t || '_TS', strftime(ts, '%H:%M:%S') FROM ev),
cells AS (
  SELECT study, file_seq, ts, row_seq, item_seq, {S.item_name('item')} AS item, value,
         {S.subject_id('subject_raw')} AS subject_id, {S.session_id('session_raw')} AS session
  FROM cells0)"""

TYPES_SQL = "(SELECT list(t ORDER BY t) FROM (SELECT DISTINCT upper(event_type) AS t FROM events WHERE event_type IS NOT NULL))"
BENCH_ITEMS_SQL = f"""
types AS (SELECT {TYPES_SQL} AS ts),
bi0 AS (
  SELECT 'tpch' AS study, ts[item_id % len(ts) + 1] AS task, item_id,
         printf('%02d', item_id // len(ts) + 1) AS nn, text
  FROM benchmark, types WHERE len(ts) > 0),
bi AS (
  SELECT study, task, item_id AS row_seq,
         CASE WHEN item_id % 7 = 6 THEN 'example_' || lower(task) || nn ELSE lower(task) || '-' || nn END AS itemname,
         text AS itemdescription
  FROM bi0)"""

TASK_ITEMS_SQL = f"""
ti AS (
  SELECT DISTINCT study, task, {S.item_name('itemname')} AS item_norm
  FROM bi WHERE itemname IS NOT NULL AND NOT contains(lower(itemname), 'example'))"""

LATEST_SQL = f"""
matched AS (
  SELECT c.*, ti.task FROM cells c JOIN ti ON c.study = ti.study AND c.item = ti.item_norm
  WHERE contains(upper(c.item), upper(ti.task))),
latest AS (
  SELECT * FROM matched
  QUALIFY rank() OVER (PARTITION BY study, subject_id, session, lower(task) ORDER BY ts DESC, row_seq DESC) = 1)"""


def _matched(spark, d) -> DataFrame:
    """Cells of a task's items.  W1 removes records, never a key, so queries on
    keys and tasks start here."""
    cells = roles.event_cells(spark, d).withColumn("item", ids.item_name(F.col("item")))
    items = sidecar.task_item_names(roles.event_task_items(spark, d))
    return responses.match_task_items(cells, items).withColumn("task_lc", F.lower("task"))


def _latest(spark, d) -> DataFrame:
    items = sidecar.task_item_names(roles.event_task_items(spark, d))
    return responses.records_of_rows(roles.event_rows(spark, d), roles.event_row_headers(spark, d), items, order=("ts", "row_seq"))


# ---------------------------------------------------------------- C1-C5, C16
@register("subject_ids", f"""
WITH r AS (
  SELECT c_custkey, CASE c_mktsegment
      WHEN 'HOUSEHOLD' THEN CAST(c_custkey AS VARCHAR)
      WHEN 'MACHINERY' THEN 'sub-' || CAST(c_custkey AS VARCHAR)
      WHEN 'FURNITURE' THEN 'sub---' || CAST(c_custkey AS VARCHAR)
      WHEN 'AUTOMOBILE' THEN ' SUB-' || CAST(c_custkey AS VARCHAR) || {TAB}
      ELSE c_name END AS raw_id
  FROM customer)
SELECT c_custkey, raw_id, {S.subject_id('raw_id')} AS subject_id,
       {S.subject_compliant(S.subject_id('raw_id'))} AS is_compliant
FROM r""")
def q_subject_ids(spark, d):
    c = T(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    k = F.col("c_custkey").cast("string")
    seg = F.col("c_mktsegment")
    raw = (
        F.when(seg == "HOUSEHOLD", k)
        .when(seg == "MACHINERY", F.concat(F.lit("sub-"), k))
        .when(seg == "FURNITURE", F.concat(F.lit("sub---"), k))
        .when(seg == "AUTOMOBILE", F.concat(F.lit(" SUB-"), k, F.lit("\t")))
        .otherwise(F.col("c_name"))
    )
    r = c.select("c_custkey", raw.alias("raw_id"))
    sid = ids.subject_id(F.col("raw_id"))
    return r.select("c_custkey", "raw_id", sid.alias("subject_id"), ids.subject_compliant(sid).alias("is_compliant"))


@register("session_ids", f"""
WITH r AS (
  SELECT o_orderkey, CASE o_orderstatus
      WHEN 'F' THEN CAST(month(o_orderdate) AS VARCHAR)
      WHEN 'O' THEN o_orderpriority
      ELSE ' ' || CAST(year(o_orderdate) AS VARCHAR) || {TAB} END AS raw_session
  FROM orders)
SELECT o_orderkey, raw_session, {S.session_id('raw_session')} AS session_id FROM r""")
def q_session_ids(spark, d):
    o = T(spark, d, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])
    st = F.col("o_orderstatus")
    raw = (
        F.when(st == "F", F.month("o_orderdate").cast("string"))
        .when(st == "O", F.col("o_orderpriority"))
        .otherwise(F.concat(F.lit(" "), F.year("o_orderdate").cast("string"), F.lit("\t")))
    )
    r = o.select("o_orderkey", raw.alias("raw_session"))
    return r.select("o_orderkey", "raw_session", ids.session_id(F.col("raw_session")).alias("session_id"))


@register("task_names", f"""
WITH r AS (
  SELECT p_partkey, CASE p_type
      WHEN 'ECONOMY' THEN p_brand || '_' || p_name || '.XLSX'
      WHEN 'SMALL' THEN p_brand || ' ' || p_name || '.csv'
      WHEN 'LARGE' THEN ' ' || p_name || '.xls '
      WHEN 'PROMO' THEN ' -.csv'
      ELSE p_type || '-' || p_name END AS raw_task
  FROM part)
SELECT p_partkey, raw_task, {S.task_name('raw_task')} AS task_name,
       CASE WHEN raw_task IS NULL THEN 'no task name'
            WHEN {S.task_name('raw_task')} IS NULL THEN 'no letter or digit in the task name' END AS issue
FROM r""")
def q_task_names(spark, d):
    p = T(spark, d, "part", ["p_partkey", "p_name", "p_brand", "p_type"])
    ty = F.col("p_type")
    raw = (
        F.when(ty == "ECONOMY", F.concat("p_brand", F.lit("_"), "p_name", F.lit(".XLSX")))
        .when(ty == "SMALL", F.concat("p_brand", F.lit(" "), "p_name", F.lit(".csv")))
        .when(ty == "LARGE", F.concat(F.lit(" "), "p_name", F.lit(".xls ")))
        .when(ty == "PROMO", F.lit(" -.csv"))
        .otherwise(F.concat("p_type", F.lit("-"), "p_name"))
    )
    r = p.select("p_partkey", raw.alias("raw_task"))
    return r.select("p_partkey", "raw_task", ids.task_name(F.col("raw_task")).alias("task_name"),
                    ids.task_name_issue(F.col("raw_task")).alias("issue"))


@register("item_names", f"""
WITH r AS (
  SELECT p_partkey, lower(p_type) || CASE p_type
      WHEN 'ECONOMY' THEN '-' WHEN 'SMALL' THEN ' ' WHEN 'LARGE' THEN '_' WHEN 'PROMO' THEN '--'
      WHEN 'MEDIUM' THEN '' ELSE '#' END || CAST(p_size AS VARCHAR) AS raw_item
  FROM part)
SELECT p_partkey, raw_item, {S.item_name('raw_item')} AS item_norm, {S.sidecar_key('raw_item')} AS item_key FROM r""")
def q_item_names(spark, d):
    p = T(spark, d, "part", ["p_partkey", "p_type", "p_size"])
    ty = F.col("p_type")
    sep = (
        F.when(ty == "ECONOMY", "-").when(ty == "SMALL", " ").when(ty == "LARGE", "_").when(ty == "PROMO", "--")
        .when(ty == "MEDIUM", "").otherwise("#")
    )
    r = p.select("p_partkey", F.concat(F.lower(ty), sep, F.col("p_size").cast("string")).alias("raw_item"))
    return r.select("p_partkey", "raw_item", ids.item_name(F.col("raw_item")).alias("item_norm"),
                    ids.sidecar_key(F.col("raw_item")).alias("item_key"))


# ---------------------------------------------------------------- C6-C10, C17
@register("clean_text", f"""
SELECT conv_id, turn, {S.clean_text('text')} AS text_clean FROM conversations""")
def q_clean_text(spark, d):
    c = T(spark, d, "conversations", ["conv_id", "turn", "text"])
    return c.select("conv_id", "turn", text.clean_text(F.col("text")).alias("text_clean"))


@register("sanitize_tsv", f"""
SELECT doc_id, {S.sanitize_tsv('text')} AS text_tsv, {S.sanitize_tsv('lang')} AS lang_tsv FROM documents""")
def q_sanitize_tsv(spark, d):
    c = T(spark, d, "documents", ["doc_id", "text", "lang"])
    return c.select("doc_id", text.sanitize_tsv(F.col("text")).alias("text_tsv"),
                    text.sanitize_tsv(F.col("lang")).alias("lang_tsv"))


@register("integral_text", f"""
SELECT l_orderkey, l_linenumber, {S.integral_text('l_quantity')} AS quantity_text,
       {S.integral_text('l_extendedprice')} AS price_text, {S.integral_text('l_discount')} AS discount_text
FROM lineitem""")
def q_integral_text(spark, d):
    li = T(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount"])
    return li.select("l_orderkey", "l_linenumber", text.integral_text(F.col("l_quantity")).alias("quantity_text"),
                     text.integral_text(F.col("l_extendedprice")).alias("price_text"),
                     text.integral_text(F.col("l_discount")).alias("discount_text"))


# Fixed declarations for the customer-as-demographics role.
CUSTOMER_DECLARED = (
    ("custkey", "integer"), ("nation", "cat_num"), ("acctbal", "float"), ("acctbal_int", "integer"),
    ("segment", "cat_num"), ("name", "string"),
)


def customer_cells(spark, d) -> DataFrame:
    c = T(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "c_name"])
    bal = text.integral_text(F.col("c_acctbal"))
    cells = c.select(
        "c_custkey",
        F.inline(F.array(
            F.struct(F.lit("custkey").alias("variable"), F.col("c_custkey").cast("string").alias("value")),
            F.struct(F.lit("nation").alias("variable"), F.col("c_nationkey").cast("string").alias("value")),
            F.struct(F.lit("acctbal").alias("variable"), bal.alias("value")),
            F.struct(F.lit("acctbal_int").alias("variable"), bal.alias("value")),
            F.struct(F.lit("segment").alias("variable"), F.col("c_mktsegment").alias("value")),
            F.struct(F.lit("name").alias("variable"), F.col("c_name").alias("value")),
        )),
    )
    return cells


@register("declared_casts", f"""
WITH cells AS (
  SELECT c_custkey, 'custkey' AS variable, CAST(c_custkey AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'acctbal', {S.integral_text('c_acctbal')} FROM customer
  UNION ALL SELECT c_custkey, 'acctbal_int', {S.integral_text('c_acctbal')} FROM customer
  UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, 'name', c_name FROM customer),
vars AS (SELECT * FROM (VALUES {", ".join(f"('{n}', '{t}')" for n, t in CUSTOMER_DECLARED)}) v(variable, data_type)),
d AS (SELECT c.*, v.data_type, TRY_CAST(c.value AS DOUBLE) AS num FROM cells c JOIN vars v USING (variable)),
st AS (SELECT variable,
         count(*) FILTER (WHERE num IS NOT NULL AND num <> floor(num)) AS n_frac,
         count(*) FILTER (WHERE num IS NULL OR num <> floor(num)) AS n_bad
       FROM d GROUP BY variable),
r AS (SELECT d.*, CASE
         WHEN data_type = 'integer' THEN CASE WHEN n_frac = 0 THEN 'long' ELSE 'keep' END
         WHEN data_type = 'float' THEN 'double'
         WHEN data_type = 'cat_num' THEN CASE WHEN n_bad = 0 THEN 'long' ELSE 'string' END
         WHEN data_type IN ('cat_string', 'string') THEN 'string' ELSE 'keep' END AS resolved
      FROM d JOIN st USING (variable))
SELECT c_custkey, variable, data_type, resolved,
       CASE WHEN resolved = 'long' AND CAST(num AS BIGINT) <> -999 THEN CAST(num AS BIGINT) END AS value_long,
       CASE WHEN resolved = 'double' AND num <> -999 THEN num END AS value_double,
       CASE WHEN resolved IN ('string', 'keep') THEN value END AS value_string
FROM r""")
def q_declared_casts(spark, d):
    variables = spark.createDataFrame(list(CUSTOMER_DECLARED), "variable string, data_type string")
    return casting.long_form_casts(customer_cells(spark, d), variables)


@register("missing_code", f"""
WITH r AS (SELECT l_orderkey, l_linenumber,
                  CASE WHEN l_linenumber = 7 THEN -999.0 ELSE l_quantity END AS q FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN q <> -999 THEN q END AS quantity,
       {S.integral_text('q')} AS quantity_text FROM r""")
def q_missing_code(spark, d):
    li = T(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity"])
    q = F.when(F.col("l_linenumber") == 7, F.lit(-999.0)).otherwise(F.col("l_quantity"))
    r = li.select("l_orderkey", "l_linenumber", text.integral_text(q).alias("raw"))
    return r.select("l_orderkey", "l_linenumber", casting.cast_column(F.col("raw"), "double").alias("quantity"),
                    casting.cast_column(F.col("raw"), "string").alias("quantity_text"))


@register("na_tokens", f"""
WITH l AS (SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM conversations)
SELECT conv_id, turn, line_no, {S.na_token('line')} AS value FROM l""")
def q_na_tokens(spark, d):
    c = T(spark, d, "conversations", ["conv_id", "turn", "text"])
    lines = c.select("conv_id", "turn", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    return lines.select("conv_id", "turn", F.col("line_no").cast("long").alias("line_no"),
                        text.na_token_to_null(F.col("line")).alias("value"))


# ---------------------------------------------------------------- C11, C12
LEVELS_STR_SQL = ("CAST(c_nationkey AS VARCHAR) || ': ' || n_name || '; ' || CAST(n_regionkey AS VARCHAR) || ':' || r_name"
                  " || ';' || c_mktsegment || '; ' || CAST(n_regionkey AS VARCHAR) || ': ' || c_mktsegment || ';' || c_name || ':x:y'")


@register("levels_parse", f"""
WITH s AS (SELECT c_custkey, {LEVELS_STR_SQL} AS lv
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
p AS (SELECT c_custkey, unnest(string_split(lv, ';')) AS piece,
             generate_subscripts(string_split(lv, ';'), 1) - 1 AS pos FROM s),
kv AS (SELECT c_custkey, pos, string_split({S.strip('piece')}, ':') AS kv FROM p),
e AS (SELECT c_custkey, pos, {S.strip('kv[1]')} AS level_key, {S.strip('kv[2]')} AS level_value FROM kv WHERE len(kv) = 2)
SELECT c_custkey, CAST(min(pos) AS INTEGER) AS pos, level_key, arg_max(level_value, pos) AS level_value FROM e
GROUP BY c_custkey, level_key""")
def q_levels_parse(spark, d):
    c = T(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment", "c_name"])
    n = T(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = T(spark, d, "region", ["r_regionkey", "r_name"])
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, F.col("n_regionkey") == r.r_regionkey)
    lv = F.concat(
        F.col("c_nationkey").cast("string"), F.lit(": "), "n_name", F.lit("; "), F.col("n_regionkey").cast("string"),
        F.lit(":"), "r_name", F.lit(";"), "c_mktsegment", F.lit("; "), F.col("n_regionkey").cast("string"), F.lit(": "),
        "c_mktsegment", F.lit(";"), "c_name", F.lit(":x:y"),
    )
    e = j.select("c_custkey", F.explode(levels.level_entries(lv)).alias("e"))
    return e.select("c_custkey", F.col("e.pos").alias("pos"), F.col("e.key").alias("level_key"),
                    F.col("e.value").alias("level_value"))


@register("list_split", f"""
WITH l AS (SELECT conv_id, turn, {S.split_list('text')} AS items FROM conversations)
SELECT conv_id, turn, CAST(generate_subscripts(items, 1) - 1 AS INTEGER) AS pos, unnest(items) AS element FROM l""")
def q_list_split(spark, d):
    c = T(spark, d, "conversations", ["conv_id", "turn", "text"])
    e = c.select("conv_id", "turn", F.posexplode(levels.split_list(F.col("text"))).alias("pos", "element"))
    return e


# ---------------------------------------------------------------- C13-C15, A8
def supplier_dataset_meta(spark, d) -> DataFrame:
    s = T(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"])
    n = T(spark, d, "nation", ["n_nationkey", "n_name"])
    j = s.join(n, s.s_nationkey == n.n_nationkey)
    nk = F.col("s_nationkey").cast("string")
    def row(seq, key, value):
        return F.struct(F.lit(seq).alias("seq"), F.lit(key).alias("key"), value.alias("value"))

    rows = F.array(
        row(0, "Name", F.col("s_name")),
        row(1, "Licence", F.lit("CC0")),
        row(2, "Authors", F.concat("s_name", F.lit("; "), "n_name", F.lit(";;"))),
        row(3, "funding", F.concat(F.lit("grant "), nk, F.lit(", grant "), F.col("s_suppkey").cast("string"))),
        row(4, "BIDSVersion",
            F.when(F.col("s_acctbal") > 5000, F.concat(F.lit("1."), nk, F.lit(".0"))).otherwise(F.concat(F.lit("1."), nk))),
        row(5, "DatasetType",
            F.when(F.col("s_acctbal") < 0, F.lit("derivative")).when(F.col("s_acctbal") < 1000, F.lit("weird")).otherwise(F.lit("raw"))),
        row(6, "License", F.lit("PDDL")),
        row(7, " Name ", F.when(F.col("s_acctbal") < 2000, F.lit("")).otherwise(F.concat("s_name", F.lit(" (renamed)")))),
        row(8, "ReferencesAndLink", F.lit("")),
    )
    return j.select(F.concat(F.lit("supplier-"), F.col("s_suppkey").cast("string")).alias("study"), F.inline(rows))


DATASET_CTES = f"""
WITH m AS (
  SELECT 'supplier-' || CAST(s_suppkey AS VARCHAR) AS study, s_name, n_name, s_nationkey, s_suppkey, s_acctbal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
raw0 AS (
  SELECT study, 0 AS seq, 'Name' AS key, s_name AS value FROM m
  UNION ALL SELECT study, 1, 'Licence', 'CC0' FROM m
  UNION ALL SELECT study, 2, 'Authors', s_name || '; ' || n_name || ';;' FROM m
  UNION ALL SELECT study, 3, 'funding', 'grant ' || CAST(s_nationkey AS VARCHAR) || ', grant ' || CAST(s_suppkey AS VARCHAR) FROM m
  UNION ALL SELECT study, 4, 'BIDSVersion', CASE WHEN s_acctbal > 5000 THEN '1.' || CAST(s_nationkey AS VARCHAR) || '.0'
                                            ELSE '1.' || CAST(s_nationkey AS VARCHAR) END FROM m
  UNION ALL SELECT study, 5, 'DatasetType', CASE WHEN s_acctbal < 0 THEN 'derivative' WHEN s_acctbal < 1000 THEN 'weird'
                                            ELSE 'raw' END FROM m
  UNION ALL SELECT study, 6, 'License', 'PDDL' FROM m
  UNION ALL SELECT study, 7, ' Name ', CASE WHEN s_acctbal < 2000 THEN '' ELSE s_name || ' (renamed)' END FROM m
  UNION ALL SELECT study, 8, 'ReferencesAndLink', '' FROM m),
raw AS (SELECT study, key, min(seq) AS first, arg_max(value, seq) AS value FROM raw0 GROUP BY study, key),
proc AS (
  SELECT study, first, {S.strip('key')} AS k0, lower({S.strip('key')}) AS lk, coalesce({S.strip('value')}, '') AS value FROM raw),
proc2 AS (
  SELECT study, first, value,
         CASE WHEN lk IN ('referencesandlinks', 'referencesandlink') THEN 'ReferencesAndLinks'
              WHEN lk IN ('fundingsources', 'funding') THEN 'Funding'
              WHEN lk IN ('license', 'licence') THEN 'License' ELSE k0 END AS key,
         lk IN ('authors', 'referencesandlinks', 'referencesandlink', 'fundingsources', 'funding') AS is_list
  FROM proc),
merged AS (
  SELECT study, key, min(first) AS first, arg_max(value, first) AS value, arg_max(is_list, first) AS is_list
  FROM proc2 GROUP BY study, key),
defaults AS (
  SELECT DISTINCT study, d.key, d.dflt, d.i FROM raw0,
    (VALUES ('Name', 'Unnamed Dataset', 0), ('BIDSVersion', '1.8.0', 1), ('DatasetType', 'raw', 2)) d(key, dflt, i)),
j AS (
  SELECT coalesce(m.study, d.study) AS study, coalesce(m.key, d.key) AS key, m.first, m.value, m.is_list,
         CASE WHEN m.is_list THEN {S.split_list('m.value')} END AS items, d.dflt, d.i
  FROM merged m FULL OUTER JOIN defaults d ON m.study = d.study AND m.key = d.key),
f AS (
  SELECT study, key,
         CASE WHEN first IS NULL THEN 1 ELSE 0 END AS pos_part, coalesce(first, i) AS pos_seq,
         (dflt IS NOT NULL AND (first IS NULL OR (is_list AND len(items) = 0) OR (NOT is_list AND coalesce(value, '') = '')))
           AS use_default,
         is_list, value, items, dflt
  FROM j),
g AS (
  SELECT study, key, pos_part, pos_seq,
         CASE WHEN use_default THEN false ELSE is_list END AS is_list,
         CASE WHEN use_default THEN dflt ELSE value END AS value,
         CASE WHEN use_default THEN NULL ELSE items END AS items
  FROM f),
h AS (
  SELECT study, key, pos_part, pos_seq,
         CASE WHEN key IN ('BIDSVersion', 'DatasetType') THEN false ELSE is_list END AS is_list,
         CASE WHEN key = 'BIDSVersion' AND NOT coalesce(regexp_matches(value, '^\\d+\\.\\d+\\.\\d+$'), false) THEN '1.8.0'
              WHEN key = 'DatasetType' AND NOT coalesce(value IN ('raw', 'derivative'), false) THEN 'raw'
              ELSE value END AS value,
         CASE WHEN key IN ('BIDSVersion', 'DatasetType') THEN NULL ELSE items END AS items
  FROM g)"""


@register("dataset_description", f"""
{DATASET_CTES}
SELECT study, key, pos_part, CAST(pos_seq AS BIGINT) AS pos_seq, is_list,
       CASE WHEN is_list THEN NULL ELSE value END AS value,
       CAST(u.idx AS INTEGER) AS item_index, u.item
FROM h LEFT JOIN LATERAL (
  SELECT generate_subscripts(h.items, 1) - 1 AS idx, unnest(h.items) AS item) u ON true""")
def q_dataset_description(spark, d):
    rows = dataset.dataset_rows(supplier_dataset_meta(spark, d))
    e = rows.select("study", "key", F.col("position.part").alias("pos_part"), F.col("position.seq").alias("pos_seq"),
                    "is_list", "value", F.posexplode_outer("items").alias("item_index", "item"))
    return e


# ---------------------------------------------------------------- P5, P6, W1, J1-J3
@register("wide_to_long", """
SELECT l_orderkey, l_linenumber, item, value FROM (
  SELECT l_orderkey, l_linenumber, 'l_quantity' AS item, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_orderkey, l_linenumber, 'l_tax', l_tax FROM lineitem)""")
def q_wide_to_long(spark, d):
    li = T(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return li.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "item", "value")


# The columns of the oracles' wide tables, which SQL must name; the queries take them from the data.
ORACLE_ITEMS = [f"{t}{n}" for t in ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW") for n in ("01", "02")]


@register("latest_record", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}
SELECT study, subject_id, session, task, item, value, file_seq, row_seq FROM latest""")
def q_latest_record(spark, d):
    return _latest(spark, d).select("study", "subject_id", "session", "task", "item", "value", "file_seq", "row_seq")


@register("long_to_wide", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}
SELECT subject_id, session, {", ".join(f"max(value) FILTER (WHERE item = '{i}') AS {i}" for i in ORACLE_ITEMS)}
FROM latest GROUP BY subject_id, session""")
def q_long_to_wide(spark, d):
    items = [f"{t}{n}" for t in roles.task_list(spark, d) for n in ("01", "02")]
    return responses.records_to_wide(_latest(spark, d), ["subject_id", "session"], items)


HEADERS_SQL = """
headers AS (SELECT DISTINCT study, file_seq, item FROM cells),
tasks AS (SELECT DISTINCT study, task FROM bi),
tcols AS (SELECT DISTINCT h.study, h.file_seq, t.task, h.item FROM headers h JOIN tasks t
          ON h.study = t.study AND contains(upper(h.item), upper(t.task)))"""


def _task_cols(spark, d):
    tasks = roles.event_task_items(spark, d).select("study", "task").distinct()
    return quality.task_columns(roles.event_headers(spark, d), tasks)


@register("task_columns", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {HEADERS_SQL}
SELECT study, file_seq, task, item FROM tcols""")
def q_task_columns(spark, d):
    return _task_cols(spark, d).select("study", "file_seq", "task", "item")


@register("missing_items", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {HEADERS_SQL},
ft AS (SELECT DISTINCT study, file_seq, task FROM tcols)
SELECT ft.study, ft.file_seq, ft.task, ti.item_norm AS item FROM ft JOIN ti ON ft.study = ti.study AND ft.task = ti.task
WHERE NOT EXISTS (SELECT 1 FROM tcols c WHERE c.study = ft.study AND c.file_seq = ft.file_seq AND c.task = ft.task
                  AND c.item = ti.item_norm)""")
def q_missing_items(spark, d):
    tc = _task_cols(spark, d)
    items = sidecar.task_item_names(roles.event_task_items(spark, d)).select("study", "task", "item_norm").distinct()
    ft = tc.select("study", "file_seq", "task").distinct()
    return quality.missing_items(tc, items, ft).select("study", "file_seq", "task", "item")


@register("extra_columns", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {HEADERS_SQL}
SELECT study, file_seq, task, item FROM tcols c
WHERE NOT EXISTS (SELECT 1 FROM ti WHERE ti.study = c.study AND ti.task = c.task AND ti.item_norm = c.item)""")
def q_extra_columns(spark, d):
    tc = _task_cols(spark, d)
    items = sidecar.task_item_names(roles.event_task_items(spark, d)).select("study", "task", "item_norm").distinct()
    return quality.extra_columns(tc, items).select("study", "file_seq", "task", "item")


# ---------------------------------------------------------------- A1, A3
@register("null_counts", """
WITH j AS (SELECT d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT source, 'quality' AS item, CAST(quality AS VARCHAR) AS value FROM j
      UNION ALL SELECT source, 'toxic', CAST(toxic AS VARCHAR) FROM j)
SELECT source, item, count(*) FILTER (WHERE value IS NULL) AS nan_count FROM c GROUP BY source, item
HAVING count(*) FILTER (WHERE value IS NULL) > 0""")
def q_null_counts(spark, d):
    docs = T(spark, d, "documents", ["doc_id", "source"])
    lab = T(spark, d, "labels", ["doc_id", "quality", "toxic"])
    j = docs.join(lab, "doc_id", "left")
    cells = j.select(
        F.col("source").alias("file_seq"),
        F.inline(F.array(
            F.struct(F.lit("quality").alias("item"), F.col("quality").cast("string").alias("value")),
            F.struct(F.lit("toxic").alias("item"), F.col("toxic").cast("string").alias("value")),
        )),
    ).withColumn("study", F.lit(roles.STUDY))
    cols = cells.select("study", "file_seq", "item").distinct().withColumn("task", F.lit("LABELS"))
    out = quality.null_counts(cells, cols)
    return out.select(F.col("file_seq").alias("source"), "item", "nan_count")


@register("duplicate_subjects", f"""
SELECT {S.subject_id('o_custkey')} AS subject_id, count(*) AS n FROM orders
GROUP BY {S.subject_id('o_custkey')} HAVING count(*) > 1""")
def q_duplicate_subjects(spark, d):
    o = T(spark, d, "orders", ["o_custkey"]).select(ids.subject_id(F.col("o_custkey")).alias("subject_id"))
    return quality.duplicate_keys(o, ["subject_id"])


# ---------------------------------------------------------------- P7-P9, K3, K4
def customer_demographics(spark, d) -> DataFrame:
    c = T(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment", "c_name"])
    return c.select(
        F.col("c_custkey").cast("string").alias("ID "),
        F.col("c_mktsegment").alias("Segment"),
        F.col("c_nationkey").cast("string").alias("nation"),
        text.integral_text(F.col("c_acctbal")).alias("acctbal"),
        F.col("c_name").alias("name"),
        F.col("c_name").alias("undeclared"),
    )


# Fixed declarations of the participants variables sheet (Levels derived from data).
PARTICIPANT_VARIABLES = (
    (0, "id", "string", "Participant ID"),
    (1, "segment", "cat_string", "Market segment"),
    (2, "nation", "cat_num", "Nation of the participant"),
    (3, "acctbal", "float", "Account balance"),
    (4, "balance_int", "integer", "Balance as integer"),
    (5, "Name ", "string", "Participant name"),
)


def customer_variables(spark, d) -> DataFrame:
    """Variables sheet; the Levels of ``nation`` and ``segment`` are built by
    Spark from the distinct values present in ``customer``."""
    c = T(spark, d, "customer", ["c_nationkey", "c_mktsegment"])
    n = T(spark, d, "nation", ["n_nationkey", "n_name"])
    nat = c.select("c_nationkey").distinct().join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    nat_lv = nat.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", F.concat(F.col("n_nationkey").cast("string"), F.lit(": "), "n_name").alias("t")))).alias("a")) \
        .select(F.lit("nation").alias("VariableName"), F.concat_ws("; ", F.transform("a", lambda x: x["t"])).alias("Levels"))
    seg = c.select("c_mktsegment").distinct()
    seg_lv = seg.agg(F.array_sort(F.collect_list(F.concat("c_mktsegment", F.lit(":"), F.lower("c_mktsegment")))).alias("a")) \
        .select(F.lit("segment").alias("VariableName"), F.concat_ws(";", "a").alias("Levels"))
    base = spark.createDataFrame(list(PARTICIPANT_VARIABLES), "seq int, VariableName string, DataType string, Description string")
    base = participants.normalize_variables(base)
    return base.join(nat_lv.unionByName(seg_lv), "VariableName", "left")


PARTICIPANTS_BASE_SQL = f"""
demo AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation,
         {S.integral_text('c_acctbal')} AS acctbal, c_name AS name FROM customer)"""


@register("participants_table", f"""
WITH {PARTICIPANTS_BASE_SQL},
t AS (SELECT {S.subject_id('id')} AS participant_id, segment, CAST(TRY_CAST(nation AS DOUBLE) AS BIGINT) AS nation,
             TRY_CAST(acctbal AS DOUBLE) AS acctbal, NULL::BIGINT AS balance_int, name FROM demo)
SELECT {S.sanitize_tsv('participant_id')} AS participant_id, {S.sanitize_tsv('segment')} AS segment,
       {S.sanitize_tsv('CAST(CASE WHEN nation <> -999 THEN nation END AS VARCHAR)')} AS nation,
       {S.sanitize_tsv('CAST(CASE WHEN acctbal <> -999 THEN acctbal END AS VARCHAR)')} AS acctbal,
       {S.sanitize_tsv('CAST(balance_int AS VARCHAR)')} AS balance_int, {S.sanitize_tsv('name')} AS name
FROM t""")
def q_participants_table(spark, d):
    typed, resolved = participants.participants_table(customer_demographics(spark, d), customer_variables(spark, d))
    return participants.participants_tsv_rows(typed, resolved)


@register("participants_metadata", f"""
WITH nat AS (SELECT string_agg(CAST(n_nationkey AS VARCHAR) || ': ' || n_name, '; ' ORDER BY n_nationkey) AS lv
             FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)),
seg AS (SELECT string_agg(s || ':' || lower(s), ';' ORDER BY s) AS lv FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)),
v AS (SELECT * FROM (VALUES {", ".join(f"({q}, '{n.strip().lower()}', '{t}', '{de}')" for q, n, t, de in PARTICIPANT_VARIABLES)})
      x(seq, variable, data_type, description)),
vl AS (SELECT v.*, CASE WHEN variable = 'nation' THEN (SELECT lv FROM nat) WHEN variable = 'segment' THEN (SELECT lv FROM seg) END AS levels
       FROM v WHERE variable <> 'id'),
p AS (SELECT variable, description, unnest(string_split(levels, ';')) AS piece FROM vl
      WHERE data_type IN ('cat_num', 'cat_string') AND levels IS NOT NULL),
kv AS (SELECT variable, string_split({S.strip('piece')}, ':') AS kv FROM p),
e AS (SELECT DISTINCT variable, {S.strip('kv[1]')} AS level_key, {S.strip('kv[2]')} AS level_value FROM kv WHERE len(kv) = 2)
SELECT vl.variable, vl.description, e.level_key, e.level_value FROM vl LEFT JOIN e USING (variable)
UNION ALL SELECT 'participant_id', 'Unique participant identifier', NULL, NULL""")
def q_participants_metadata(spark, d):
    rows = participants.participants_metadata(customer_variables(spark, d))
    e = rows.select("variable", "description", F.explode_outer("levels").alias("lv"))
    return e.select("variable", "description", F.col("lv.key").alias("level_key"), F.col("lv.value").alias("level_value"))


# ---------------------------------------------------------------- K1: sidecars
PART_ITEMS_SQL = f"""
pi AS (
  SELECT 'tpch' AS study, p_type AS task, p_partkey AS row_seq, lower(p_type) || '-' || CAST(p_size AS VARCHAR) AS itemname,
         p_name AS itemdescription, coalesce(TRY_CAST(regexp_extract(p_brand, '#(\\d+)$', 1) AS INTEGER), 0) AS n,
         CAST(p_size AS VARCHAR) AS v0, p_name AS d0, p_type AS v1, p_brand AS d1, CAST(p_partkey AS VARCHAR) AS v2, p_name AS d2
  FROM part
  WHERE itemname IS NOT NULL AND NOT starts_with(lower({S.strip('itemname')}), 'itemname')
        AND {S.strip('itemname')} <> 'Unknown Item'),
keyed AS (
  SELECT *, {S.sidecar_key(S.strip('itemname'))} AS key,
         min(row_seq) OVER (PARTITION BY study, task, {S.sidecar_key(S.strip('itemname'))}) AS position
  FROM pi
  QUALIFY row_number() OVER (PARTITION BY study, task, {S.sidecar_key(S.strip('itemname'))} ORDER BY row_seq DESC) = 1),
pairs AS (
  SELECT study, task, key, 0 AS i, v0 AS v, d0 AS dsc, n FROM keyed
  UNION ALL SELECT study, task, key, 1, v1, d1, n FROM keyed
  UNION ALL SELECT study, task, key, 2, v2, d2, n FROM keyed),
lv AS (
  SELECT study, task, key, level_key, min(i) AS pos, arg_max(dsc, i) AS level_value FROM (
    SELECT study, task, key, i, dsc, CAST(TRY_CAST({S.strip('v')} AS BIGINT) AS VARCHAR) AS level_key FROM pairs
    WHERE i < n AND v IS NOT NULL AND dsc IS NOT NULL AND TRY_CAST({S.strip('v')} AS BIGINT) IS NOT NULL)
  GROUP BY study, task, key, level_key)"""


def _part_sidecar(spark, d):
    return sidecar.sidecar_entries(roles.part_items(spark, d))


@register("sidecar_items", f"""
WITH {PART_ITEMS_SQL},
cnt AS (SELECT study, task, key, count(*) AS n_levels FROM lv GROUP BY study, task, key)
SELECT k.study, k.task, k.key, CAST(k.position AS BIGINT) AS position,
       coalesce(k.itemdescription, 'No description available') AS description,
       CASE WHEN coalesce(c.n_levels, 0) = 0 AND k.d0 IS NOT NULL THEN {S.strip('k.d0')} END AS units,
       CAST(coalesce(c.n_levels, 0) AS INTEGER) AS n_levels
FROM keyed k LEFT JOIN cnt c USING (study, task, key)""")
def q_sidecar_items(spark, d):
    e = _part_sidecar(spark, d)
    return e.select("study", "task", "key", F.col("position.a").alias("position"), "description", "units",
                    F.size("level_entries").alias("n_levels"))


@register("level_maps", f"""
WITH {PART_ITEMS_SQL}
SELECT study, task, key, level_key, level_value FROM lv""")
def q_level_maps(spark, d):
    e = _part_sidecar(spark, d).select("study", "task", "key", F.explode("level_entries").alias("l"))
    return e.select("study", "task", "key", F.col("l.key").alias("level_key"), F.col("l.value").alias("level_value"))


@register("anonymized_items", f"""
WITH {BENCH_ITEMS_SQL},
k AS (SELECT study, task, row_seq, {S.sidecar_key(S.strip('itemname'))} AS key FROM bi
      WHERE itemname IS NOT NULL AND NOT starts_with(lower({S.strip('itemname')}), 'itemname')
            AND {S.strip('itemname')} <> 'Unknown Item')
SELECT study, task, key, min(row_seq) AS position, 'Question ' || CAST(max(row_seq) + 1 AS VARCHAR) AS description
FROM k GROUP BY study, task, key""")
def q_anonymized_items(spark, d):
    items = roles.event_task_items(spark, d).withColumn("likert_scale", F.lit(None).cast("string")).withColumn(
        "levels", F.array().cast("array<struct<i:int,value:string,description:string>>"))
    e = sidecar.sidecar_entries(items, anonymize=True)
    return e.select("study", "task", "key", F.col("position.a").alias("position"), "description")


# ---------------------------------------------------------------- J8, J6/F5, J11, A5/A10/A11
DEFINED_TASKS_SQL = """
defined AS (SELECT DISTINCT study, task FROM bi UNION SELECT DISTINCT 'tpch', p_type FROM part)"""


def _defined_tasks(spark, d):
    a = roles.event_task_items(spark, d).select("study", "task")
    b = roles.part_items(spark, d).select("study", "task")
    return a.unionByName(b).distinct()


@register("unused_tasks", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}, {DEFINED_TASKS_SQL}
SELECT study, task FROM defined d
WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.study = d.study AND lower(l.task) = lower(d.task))""")
def q_unused_tasks(spark, d):
    return quality.unused_tasks(_defined_tasks(spark, d), _matched(spark, d)).select("study", "task")


@register("file_task_coverage", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}, {DEFINED_TASKS_SQL},
files AS (SELECT DISTINCT study, file_seq FROM cells),
used AS (SELECT DISTINCT study, file_seq, task FROM matched)
SELECT f.study, f.file_seq, count(*) AS n_without, string_agg(t.task, '|' ORDER BY t.task) AS without
FROM files f JOIN defined t ON f.study = t.study
WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.study = f.study AND u.file_seq = f.file_seq AND u.task = t.task)
GROUP BY f.study, f.file_seq""")
def q_file_task_coverage(spark, d):
    cells = roles.event_cells(spark, d).withColumn("item", ids.item_name(F.col("item")))
    items = sidecar.task_item_names(roles.event_task_items(spark, d))
    used = responses.match_task_items(cells, items).select("study", "file_seq", "task").distinct()
    files = cells.select("study", "file_seq").distinct()
    lacking = quality.file_task_coverage(used, files, _defined_tasks(spark, d))
    return lacking.withColumn("without", F.concat_ws("|", "without"))


@register("required_files", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL},
rec AS (SELECT DISTINCT subject_id, session, lower(task) AS task FROM latest),
spine AS (SELECT DISTINCT subject_id, session FROM rec),
subj_tasks AS (SELECT DISTINCT subject_id, task FROM rec),
req AS (SELECT s.subject_id, s.session, t.task FROM spine s JOIN subj_tasks t USING (subject_id))
SELECT subject_id, session, task,
       subject_id || '/ses-' || session || '/beh/' || subject_id || '_ses-' || session || '_task-' || task || '_beh.tsv' AS file_name
FROM req WHERE NOT EXISTS (SELECT 1 FROM rec r WHERE r.subject_id = req.subject_id AND r.session = req.session AND r.task = req.task)""")
def q_required_files(spark, d):
    # Required: every session directory of a subject holds a file for every
    # task the subject has anywhere.  Per (subject, session) the task set is
    # compared with the subject's task set (both bounded by the task count);
    # only missing files are emitted, no sessions x tasks product is formed.
    rec = _matched(spark, d).select("subject_id", "session", F.col("task_lc").alias("task")).distinct()
    per_session = rec.groupBy("subject_id", "session").agg(F.collect_set("task").alias("have"))
    per_subject = rec.groupBy("subject_id").agg(F.collect_set("task").alias("need"))
    j = per_session.join(per_subject, "subject_id")
    miss = j.select("subject_id", "session", F.explode(F.array_except("need", "have")).alias("task"))
    return miss.select("subject_id", "session", "task",
                       paths.record_path(F.col("subject_id"), F.col("session"), F.col("task")).alias("file_name"))


@register("run_summary", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}
SELECT lower(task) AS task, count(DISTINCT subject_id || '|' || session) AS n_records,
       count(DISTINCT subject_id) AS n_subjects, count(DISTINCT file_seq) AS n_files
FROM latest GROUP BY lower(task)""")
def q_run_summary(spark, d):
    lt = _latest(spark, d)
    return lt.groupBy(F.col("task_lc").alias("task")).agg(
        F.count_distinct("subject_id", "session").alias("n_records"),
        F.count_distinct("subject_id").alias("n_subjects"),
        F.count_distinct("file_seq").alias("n_files"),
    )


@register("path_keys", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL},
p AS (SELECT DISTINCT 'rawdata/' || subject_id || '/ses-' || session || '/beh/' || subject_id || '_ses-' || session
                      || '_task-' || lower(task) || '_beh.tsv' AS path FROM latest)
SELECT path, regexp_extract(path, {S.q(S.SUBJECT_DIR)}, 1) AS subject_dir,
       coalesce(nullif(regexp_extract(path, {S.q(S.SESSION_DIR)}, 1), ''), '1') AS session,
       regexp_extract(path, {S.q(S.TASK_IN_NAME)}, 1) AS task
FROM p""")
def q_path_keys(spark, d):
    lt = _matched(spark, d)
    p = lt.select(F.concat(F.lit("rawdata/"), paths.record_path(F.col("subject_id"), F.col("session"), F.col("task"))).alias("path")).distinct()
    return p.select("path", paths.path_subject("path").alias("subject_dir"), paths.path_session("path").alias("session"),
                    paths.path_task("path").alias("task"))


# ---------------------------------------------------------------- B: trials
def conversation_answers(spark, d) -> DataFrame:
    c = T(spark, d, "conversations", ["conv_id", "turn", "role", "text"])
    a = c.select(
        F.lit(roles.STUDY).alias("study"), F.col("role").alias("file_seq"), F.col("role").alias("task"),
        F.col("turn").alias("row_seq"), F.col("conv_id").cast("string").alias("id"),
        (F.floor(F.col("turn") / 2) + 1).cast("string").alias("ses"), F.col("text").alias("text"),
    )
    return trials.fill_missing(a)


@register("trial_onsets", """
WITH a AS (SELECT role AS task, turn AS row_seq, CAST(conv_id AS VARCHAR) AS id,
                  CAST(CAST(floor(turn / 2) + 1 AS BIGINT) AS VARCHAR) AS ses, coalesce(text, 'n/a') AS text FROM conversations)
SELECT task, 'sub-' || id || '_ses-' || first_value(ses) OVER (PARTITION BY task, id ORDER BY row_seq) || '_task-' || task
       || '_beh.tsv' AS file_name, row_seq,
       row_number() OVER (PARTITION BY task, id ORDER BY row_seq) - 1 AS onset, CAST(1.0 AS DOUBLE) AS duration,
       'response' AS trial_type, id, ses, text
FROM a""")
def q_trial_onsets(spark, d):
    t = trials.trial_rows(conversation_answers(spark, d))
    return t.select("task", "file_name", "row_seq", "onset", "duration", "trial_type", "id", "ses", "text")


def order_answers(spark, d) -> DataFrame:
    o = T(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"])
    return o.select(
        F.lit(roles.STUDY).alias("study"), F.col("o_orderpriority").alias("file_seq"), F.col("o_orderpriority").alias("task"),
        F.col("o_orderkey").alias("row_seq"), F.col("o_custkey").cast("string").alias("id"),
        F.year("o_orderdate").cast("string").alias("ses"),
    )


@register("trial_first_session", """
SELECT o_orderpriority AS task, CAST(o_custkey AS VARCHAR) AS id,
       CAST(arg_min(year(o_orderdate), o_orderkey) AS VARCHAR) AS session, min(o_orderkey) AS first_row
FROM orders GROUP BY o_orderpriority, o_custkey""")
def q_trial_first_session(spark, d):
    return trials.first_sessions(order_answers(spark, d)).select("task", "id", "session", "first_row")


@register("trial_participants", """
WITH p AS (SELECT o_orderpriority AS task, CAST(o_custkey AS VARCHAR) AS id,
                  CAST(arg_min(year(o_orderdate), o_orderkey) AS VARCHAR) AS ses, min(o_orderkey) AS first_row
           FROM orders GROUP BY o_orderpriority, o_custkey),
d AS (SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer
      QUALIFY row_number() OVER (PARTITION BY CAST(c_custkey AS VARCHAR) ORDER BY c_custkey) = 1)
SELECT p.task, p.id, 'sub-' || p.id AS participant_id, 'ses-' || p.ses AS session, p.first_row, d.name, d.segment
FROM p LEFT JOIN d ON p.id = d.id""")
def q_trial_participants(spark, d):
    c = T(spark, d, "customer", ["c_custkey", "c_name", "c_mktsegment"])
    demo = c.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_custkey").alias("row_seq"),
                    F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    p = trials.trial_participants(order_answers(spark, d), demo)
    return p.select("task", "id", "participant_id", "session", "first_row", "name", "segment")


# ---------------------------------------------------------------- C: gather
def _gather_tasks(spark, d) -> list[str]:
    return [t.lower() for t in roles.task_list(spark, d)]


def _gather_inputs(spark, d, participant_rows: DataFrame):
    lt = _latest(spark, d).select("subject_id", "session", "task", "task_lc", "item_seq", "item", "value")
    cells = lt.select(
        "subject_id", F.col("session").alias("session_id"), F.col("task_lc").alias("task"),
        paths.record_path(F.col("subject_id"), F.col("session"), F.col("task")).alias("file_path"),
        F.lit(0).alias("row_index"), F.col("item_seq").alias("col_seq"), F.col("item").alias("column"),
        text.na_token_to_null(F.col("value")).alias("value"),
    )
    cells = stored_table(cells, "record-cells")  # a tree's files, read several times
    spine = cells.select("subject_id", "session_id").distinct()
    return spine, cells, participant_rows


def customer_participant_rows(spark, d) -> DataFrame:
    c = T(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])
    return c.select(
        F.col("c_custkey").alias("row_seq"), ids.subject_id(F.col("c_custkey").cast("string")).alias("subject_id"),
        F.inline(F.array(
            F.struct(F.lit(1).alias("col_seq"), F.lit("segment").alias("column"), text.na_token_to_null(F.col("c_mktsegment")).alias("value")),
            F.struct(F.lit(2).alias("col_seq"), F.lit("nation").alias("column"), F.col("c_nationkey").cast("string").alias("value")),
        )),
    )


def order_participant_rows(spark, d) -> DataFrame:
    o = T(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"])
    return o.select(
        F.col("o_orderkey").alias("row_seq"), ids.subject_id(F.col("o_custkey").cast("string")).alias("subject_id"),
        F.inline(F.array(
            F.struct(F.lit(1).alias("col_seq"), F.lit("priority").alias("column"), F.col("o_orderpriority").alias("value")),
            F.struct(F.lit(2).alias("col_seq"), F.lit("status").alias("column"), F.col("o_orderstatus").alias("value")),
        )),
    )


GATHER_ITEMS = [i for i in ORACLE_ITEMS if i != "ERROR02"]
GATHER_BASE_SQL = f"""
rec AS (SELECT subject_id, session AS session_id, lower(task) AS task, item, {S.na_token('value')} AS value FROM latest),
spine AS (SELECT DISTINCT subject_id, session_id FROM rec),
pl AS (SELECT {S.subject_id('CAST(c_custkey AS VARCHAR)')} AS subject_id, c_mktsegment AS segment,
              CAST(c_nationkey AS VARCHAR) AS nation FROM customer
       QUALIFY row_number() OVER (PARTITION BY {S.subject_id('CAST(c_custkey AS VARCHAR)')} ORDER BY c_custkey DESC) = 1)"""


@register("gather_wide", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}, {GATHER_BASE_SQL}
SELECT s.subject_id, s.session_id, pl.segment, pl.nation,
       {", ".join(f"max(r.value) FILTER (WHERE r.item = '{i}') AS {i}" for i in GATHER_ITEMS)}
FROM spine s LEFT JOIN pl USING (subject_id) LEFT JOIN rec r ON r.subject_id = s.subject_id AND r.session_id = s.session_id
GROUP BY s.subject_id, s.session_id, pl.segment, pl.nation""")
def q_gather_wide(spark, d):
    spine, cells, prow = _gather_inputs(spark, d, customer_participant_rows(spark, d))
    return gather.gather_wide(spine, cells, prow, _gather_tasks(spark, d), ["subject_id", "segment", "nation"])


@register("gather_override", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL}, {GATHER_BASE_SQL},
allc AS (
  SELECT s.subject_id, s.session_id, 'segment' AS "column", pl.segment AS value, 0 AS prec FROM spine s JOIN pl USING (subject_id)
  UNION ALL SELECT s.subject_id, s.session_id, 'nation', pl.nation, 0 FROM spine s JOIN pl USING (subject_id)
  UNION ALL SELECT subject_id, session_id, 'session_id', session_id, 1 FROM spine
  UNION ALL SELECT subject_id, session_id, item, value,
                   2 + list_position({TYPES_SQL}, upper(task)) - 1 FROM rec)
SELECT subject_id, session_id, "column", value FROM allc
QUALIFY row_number() OVER (PARTITION BY subject_id, session_id, "column" ORDER BY prec DESC) = 1""")
def q_gather_override(spark, d):
    spine, cells, prow = _gather_inputs(spark, d, customer_participant_rows(spark, d))
    m = gather.merged_cells(spine, cells, prow, _gather_tasks(spark, d))
    return m.select("subject_id", "session_id", "column", "value")


@register("gather_participants", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL},
spine AS (SELECT DISTINCT subject_id, session AS session_id FROM latest),
lastp AS (SELECT {S.subject_id('CAST(o_custkey AS VARCHAR)')} AS subject_id, o_orderpriority, o_orderstatus FROM orders
          QUALIFY row_number() OVER (PARTITION BY {S.subject_id('CAST(o_custkey AS VARCHAR)')} ORDER BY o_orderkey DESC) = 1)
SELECT s.subject_id, s.session_id, 'priority' AS "column", p.o_orderpriority AS value FROM spine s JOIN lastp p USING (subject_id)
UNION ALL
SELECT s.subject_id, s.session_id, 'status', p.o_orderstatus FROM spine s JOIN lastp p USING (subject_id)""")
def q_gather_participants(spark, d):
    spine, _, _ = _gather_inputs(spark, d, None)
    p = gather.last_participants(order_participant_rows(spark, d)).join(spine, "subject_id")
    return p.select("subject_id", "session_id", "column", "value")


# ---------------------------------------------------------------- K1, K5 documents
@register("sidecar_json", f"""
WITH {PART_ITEMS_SQL},
lvj AS (SELECT study, task, key, count(*) AS n,
               string_agg(CAST(to_json(level_key) AS VARCHAR) || ':' || CAST(to_json(level_value) AS VARCHAR), ',' ORDER BY pos)
                 AS levels_json
        FROM lv GROUP BY study, task, key),
ent AS (
  SELECT k.study, k.task, k.key, k.position,
         '{{"Description":' || CAST(to_json(coalesce(k.itemdescription, 'No description available')) AS VARCHAR)
         || CASE WHEN coalesce(l.n, 0) > 0 THEN ',"Levels":{{' || l.levels_json || '}}' ELSE '' END
         || CASE WHEN coalesce(l.n, 0) = 0 AND k.d0 IS NOT NULL THEN ',"Units":' || CAST(to_json({S.strip('k.d0')}) AS VARCHAR)
                 ELSE '' END || '}}' AS j
  FROM keyed k LEFT JOIN lvj l USING (study, task, key))
SELECT study, task, '{{' || string_agg(CAST(to_json(key) AS VARCHAR) || ': ' || j, ', ' ORDER BY position) || '}}' AS json
FROM ent GROUP BY study, task""")
def q_sidecar_json(spark, d):
    return sidecar.sidecar_documents(_part_sidecar(spark, d)).select("study", "task", "json")


@register("dataset_json", f"""
{DATASET_CTES}
SELECT study, '{{' || string_agg(CAST(to_json(key) AS VARCHAR) || ': ' ||
       CASE WHEN is_list THEN CAST(to_json(coalesce(items, []::VARCHAR[])) AS VARCHAR) ELSE CAST(to_json(value) AS VARCHAR) END,
       ', ' ORDER BY pos_part, pos_seq) || '}}' AS json
FROM h GROUP BY study""")
def q_dataset_json(spark, d):
    return dataset.dataset_json(dataset.dataset_rows(supplier_dataset_meta(spark, d))).select("study", "json")


@register("participants_json", f"""
WITH nat AS (SELECT string_agg(CAST(n_nationkey AS VARCHAR) || ': ' || n_name, '; ' ORDER BY n_nationkey) AS lv
             FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer)),
seg AS (SELECT string_agg(s || ':' || lower(s), ';' ORDER BY s) AS lv FROM (SELECT DISTINCT c_mktsegment AS s FROM customer)),
v AS (SELECT * FROM (VALUES {", ".join(f"({q}, '{n.strip().lower()}', '{t}', '{de}')" for q, n, t, de in PARTICIPANT_VARIABLES)})
      x(seq, variable, data_type, description)),
vl AS (SELECT v.*, CASE WHEN variable = 'nation' THEN (SELECT lv FROM nat) WHEN variable = 'segment' THEN (SELECT lv FROM seg) END AS levels
       FROM v WHERE variable <> 'id'),
p AS (SELECT variable, unnest(string_split(levels, ';')) AS piece, generate_subscripts(string_split(levels, ';'), 1) AS pos
      FROM vl WHERE data_type IN ('cat_num', 'cat_string') AND levels IS NOT NULL),
kv AS (SELECT variable, pos, string_split({S.strip('piece')}, ':') AS kv FROM p),
e AS (SELECT variable, {S.strip('kv[1]')} AS level_key, min(pos) AS pos, arg_max({S.strip('kv[2]')}, pos) AS level_value
      FROM kv WHERE len(kv) = 2 GROUP BY variable, {S.strip('kv[1]')}),
lj AS (SELECT variable, string_agg(CAST(to_json(level_key) AS VARCHAR) || ':' || CAST(to_json(level_value) AS VARCHAR), ','
                                   ORDER BY pos) AS levels_json FROM e GROUP BY variable),
ent AS (
  SELECT CAST(vl.seq AS BIGINT) AS o, CAST(to_json(vl.variable) AS VARCHAR) || ': {{"Description":' || CAST(to_json(vl.description) AS VARCHAR)
         || CASE WHEN lj.levels_json IS NOT NULL THEN ',"Levels":{{' || lj.levels_json || '}}' ELSE '' END || '}}' AS t
  FROM vl LEFT JOIN lj USING (variable)
  UNION ALL
  SELECT 4611686018427387904, '"participant_id": {{"Description":"Unique participant identifier","LongName":"Participant ID"}}')
SELECT '{{' || string_agg(t, ', ' ORDER BY o) || '}}' AS json FROM ent""")
def q_participants_json(spark, d):
    return participants.participants_json(participants.participants_metadata(customer_variables(spark, d)))


# ---------------------------------------------------------------- K2 record files
@register("record_tsv", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {LATEST_SQL},
g AS (
  SELECT study, subject_id, session, lower(task) AS task, count(*) AS n,
         string_agg(item, chr(9) ORDER BY item_seq) AS header,
         string_agg(coalesce({S.clean_text('value')}, ''), chr(9) ORDER BY item_seq) AS vals
  FROM latest GROUP BY study, subject_id, session, lower(task))
SELECT study || '/rawdata/' || subject_id || '/ses-' || session || '/beh/' || subject_id || '_ses-' || session
       || '_task-' || task || '_beh.tsv' AS path,
       header || chr(10) || CASE WHEN n = 1 AND vals = '' THEN '""' ELSE vals END || chr(10) AS content
FROM g""")
def q_record_tsv(spark, d):
    return bids.record_files(_latest(spark, d).withColumn("task", F.col("task_lc")), "task")


@register("type_mismatch", f"""
WITH cells AS (
  SELECT c_custkey, 'custkey' AS variable, CAST(c_custkey AS VARCHAR) AS value FROM customer
  UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT c_custkey, 'acctbal', {S.integral_text('c_acctbal')} FROM customer
  UNION ALL SELECT c_custkey, 'acctbal_int', {S.integral_text('c_acctbal')} FROM customer
  UNION ALL SELECT c_custkey, 'segment', c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, 'name', c_name FROM customer),
vars AS (SELECT * FROM (VALUES {", ".join(f"('{n}', '{t}')" for n, t in CUSTOMER_DECLARED)}) v(variable, data_type)),
st AS (SELECT variable, count(*) AS n, count(*) FILTER (WHERE value IS NULL) AS n_null,
              count(*) FILTER (WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL) AS n_num,
              count(*) FILTER (WHERE TRY_CAST(value AS DOUBLE) = floor(TRY_CAST(value AS DOUBLE))) AS n_int
       FROM cells GROUP BY variable),
r AS (SELECT st.variable, vars.data_type,
             CASE WHEN n_num + n_null < n THEN 'object' WHEN n_null = 0 AND n_int = n THEN 'int64' ELSE 'float64' END AS inferred
      FROM st JOIN vars USING (variable))
SELECT variable, data_type, inferred,
       (data_type = 'integer' AND NOT contains(inferred, 'int')) OR (data_type = 'float' AND NOT contains(inferred, 'float'))
         AS mismatch
FROM r""")
def q_type_mismatch(spark, d):
    variables = spark.createDataFrame(list(CUSTOMER_DECLARED), "variable string, data_type string")
    return casting.inferred_dtypes(customer_cells(spark, d), variables)


# ---------------------------------------------------------------- V3 report
@register("consistency_report", f"""
WITH {EVENT_CELLS_SQL}, {BENCH_ITEMS_SQL}, {TASK_ITEMS_SQL}, {HEADERS_SQL},
ft AS (SELECT DISTINCT study, file_seq, task FROM tcols),
miss AS (SELECT ft.study, ft.file_seq, ft.task, ti.item_norm AS item FROM ft JOIN ti ON ft.study = ti.study AND ft.task = ti.task
         WHERE NOT EXISTS (SELECT 1 FROM tcols c WHERE c.study = ft.study AND c.file_seq = ft.file_seq AND c.task = ft.task
                           AND c.item = ti.item_norm)),
extra AS (SELECT study, file_seq, task, item FROM tcols c
          WHERE NOT EXISTS (SELECT 1 FROM ti WHERE ti.study = c.study AND ti.task = c.task AND ti.item_norm = c.item)),
nans AS (SELECT t.study, t.file_seq, t.task, t.item, count(*) FILTER (WHERE c.value IS NULL) AS n
         FROM cells c JOIN tcols t ON c.study = t.study AND c.file_seq = t.file_seq AND c.item = t.item
         GROUP BY t.study, t.file_seq, t.task, t.item HAVING count(*) FILTER (WHERE c.value IS NULL) > 0)
SELECT study, 'V3.missing_items' AS "check", 'warning' AS severity, task || '@' || CAST(file_seq AS VARCHAR) AS object,
       item AS detail FROM miss
UNION ALL SELECT study, 'V3.extra_columns', 'info', task || '@' || CAST(file_seq AS VARCHAR), item FROM extra
UNION ALL SELECT study, 'V3.nan_values', 'info', task || '@' || CAST(file_seq AS VARCHAR), item || '=' || CAST(n AS VARCHAR) FROM nans""")
def q_consistency_report(spark, d):
    cells = roles.event_cells(spark, d).withColumn("item", ids.item_name(F.col("item")))
    tcols = _task_cols(spark, d)
    items = sidecar.task_item_names(roles.event_task_items(spark, d)).select("study", "task", "item_norm").distinct()
    ft = tcols.select("study", "file_seq", "task").distinct()
    where = F.concat(F.col("task"), F.lit("@"), F.col("file_seq").cast("string"))
    parts = [
        quality.issue_rows(quality.missing_items(tcols, items, ft), "V3.missing_items", "warning", where, "item"),
        quality.issue_rows(quality.extra_columns(tcols, items), "V3.extra_columns", "info", where, "item"),
        quality.issue_rows(quality.null_counts(cells, tcols), "V3.nan_values", "info", where,
                           F.concat(F.col("item"), F.lit("="), F.col("nan_count").cast("string"))),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# ---------------------------------------------------------------- K7 trial files
def _tsv_q(x: str) -> str:
    return (f"(CASE WHEN regexp_matches({x}, '[' || chr(9) || '\"' || chr(13) || chr(10) || ']') "
            f"THEN '\"' || replace({x}, '\"', '\"\"') || '\"' ELSE {x} END)")


@register("trial_tsv", f"""
WITH a AS (SELECT role AS task, turn AS row_seq, CAST(conv_id AS VARCHAR) AS id,
                  CAST(CAST(floor(turn / 2) + 1 AS BIGINT) AS VARCHAR) AS ses, coalesce(text, 'n/a') AS text FROM conversations),
r AS (SELECT task, row_seq, id, ses, text,
             first_value(ses) OVER (PARTITION BY task, id ORDER BY row_seq) AS first_ses,
             row_number() OVER (PARTITION BY task, id ORDER BY row_seq) - 1 AS onset FROM a)
SELECT 'tpch/sub-' || id || '_ses-' || first_ses || '_task-' || task || '_beh.tsv' AS path, row_seq,
       CAST(onset AS VARCHAR) || chr(9) || '1.0' || chr(9) || 'response' || chr(9) || {_tsv_q('id')} || chr(9)
       || {_tsv_q('ses')} || chr(9) || {_tsv_q('text')} AS line
FROM r""")
def q_trial_tsv(spark, d):
    rows = trials.trial_rows(conversation_answers(spark, d))
    data_cols = [c for c in rows.columns if c not in ("study", "file_seq", "task", "file_name", "row_seq")]
    line = F.concat_ws("\t", *[F.coalesce(bids.tsv_field(F.col(f"`{c}`").cast("string")), F.lit("")) for c in data_cols])
    return rows.select(F.concat(F.col("study"), F.lit("/"), F.col("file_name")).alias("path"), "row_seq", line.alias("line"))


from quire.plans import catalog_more  # noqa: E402,F401  (registers its queries)

"""Registered block-graph queries: encode star tables as OCR responses, parse them (S5), decode."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import blocks as B
from quire.plans import encode
from quire.plans.registry import register
from quire.session import materialize, read_table
from quire.sources.blocks import parse_blocks


# The parsed block tables are read by several lookups each; they are materialised once (S5: "parse once").

def line_blocks(spark, sf_dir):
    return materialize(parse_blocks(encode.encode_lines(read_table(spark, sf_dir, "documents").select(
        "doc_id", "text"))), "line-blocks")


# Where one decoder reads them, it is the responses: what the decoder does not use is then never made a row.

def table_responses(spark, sf_dir):
    return encode.encode_tables(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))


def table_blocks(spark, sf_dir):
    return parse_blocks(materialize(table_responses(spark, sf_dir), "table-responses"))


def form_blocks(spark, sf_dir):
    return parse_blocks(materialize(encode.encode_forms(read_table(spark, sf_dir, "customer")), "form-responses"))


def query_blocks(spark, sf_dir):
    return parse_blocks(materialize(encode.encode_queries(read_table(spark, sf_dir, "supplier")), "query-responses"))


@register("text_lines", """
SELECT doc_id, CAST(2 * (i - 1) AS INTEGER) AS ord, ls[i] AS text
FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
""")
def q_text_lines(spark, sf_dir):
    return B.text_lines(line_blocks(spark, sf_dir))


@register("document_text", """
SELECT doc_id, text AS text_newline, replace(text, chr(10), ' ') AS text_space FROM documents
""")
def q_document_text(spark, sf_dir):
    blocks = line_blocks(spark, sf_dir)
    newline = B.document_text(blocks).withColumnRenamed("text", "text_newline")
    return newline.join(B.document_text(blocks, " ").withColumnRenamed("text", "text_space"), "doc_id")


_LI = """li AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS r,
         l_partkey, l_returnflag, l_extendedprice, l_discount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


@register("table_cells", f"""
WITH {_LI}
SELECT l_orderkey AS doc_id, 0 AS table_ord, CAST(r AS INTEGER) AS row_index, 1 AS col_index,
       CAST(l_partkey AS VARCHAR) AS text FROM li
UNION ALL SELECT l_orderkey, 0, CAST(r AS INTEGER), 2, l_returnflag FROM li
UNION ALL SELECT l_orderkey, 0, CAST(r AS INTEGER), 3, printf('%.2f', l_extendedprice) FROM li
""")
def q_table_cells(spark, sf_dir):
    return B.table_cells(table_blocks(spark, sf_dir)).select("doc_id", "table_ord", "row_index", "col_index", "text")


@register("table_grids", f"""
WITH {_LI},
g AS (SELECT l_orderkey, count(*) AS n,
        string_agg(CAST(l_partkey AS VARCHAR) || '|' || l_returnflag || '|' || printf('%.2f', l_extendedprice),
                   chr(10) ORDER BY r) AS grid_text
      FROM li GROUP BY l_orderkey)
SELECT o_orderkey AS doc_id, 0 AS table_ord, CAST(coalesce(n, 0) AS INTEGER) AS n_rows,
       CASE WHEN n > 0 THEN 3 ELSE 0 END AS n_cols, coalesce(grid_text, '') AS grid_text
FROM orders LEFT JOIN g ON l_orderkey = o_orderkey
""")
def q_table_grids(spark, sf_dir):
    grids = B.table_grids(table_blocks(spark, sf_dir)).select("doc_id", F.posexplode("tables").alias("table_ord",
                                                                                                     "grid"))
    return grids.select(
        "doc_id", "table_ord", F.size("grid").alias("n_rows"),
        F.when(F.size("grid") > 0, F.size(F.get("grid", 0))).otherwise(0).alias("n_cols"),
        F.array_join(F.transform("grid", lambda r: F.array_join(r, "|")), "\n").alias("grid_text"))


_KV_SQL = """
SELECT c_custkey AS doc_id, 'Customer Name' AS key, trim(c_name) AS value FROM customer
UNION ALL SELECT c_custkey, 'Market Segment', trim(c_mktsegment || ' segment') FROM customer
UNION ALL SELECT c_custkey, 'Account Balance', printf('%.2f', c_acctbal) FROM customer
UNION ALL SELECT c_custkey, 'Fax Number', '' FROM customer
"""


@register("kv_pairs", _KV_SQL)
def q_kv_pairs(spark, sf_dir):
    return B.kv_pairs(form_blocks(spark, sf_dir)).select("doc_id", "key", "value")


@register("kv_map", """
SELECT c_custkey AS doc_id, 'Customer Name=' || trim(c_name) || '|Market Segment=' || trim(c_mktsegment || ' segment')
  || '|Account Balance=' || printf('%.2f', c_acctbal) || '|Fax Number=' AS kv FROM customer""")
def q_kv_map(spark, sf_dir):
    m = B.kv_map(B.kv_pairs(form_blocks(spark, sf_dir)))
    return m.select("doc_id", F.array_join(F.transform(F.map_entries("kv_pairs"), lambda e: F.concat_ws("=", e["key"], e["value"])), "|").alias("kv"))


_ANSWERS_SQL = """
SELECT s_suppkey AS doc_id, 0 AS query_ord, 'What is the supplier name?' AS query, 'SUPPLIER_NAME' AS alias,
  CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS answer,
  CASE WHEN s_suppkey % 5 = 0 THEN '0.0%' WHEN s_suppkey % 3 = 0 THEN '98.2%'
       ELSE printf('%.1f%%', CAST((s_suppkey * 37) % 1000 AS DOUBLE) / 10.0) END AS confidence
FROM supplier
UNION ALL
SELECT s_suppkey, 4, 'What is the account balance?', 'What is the account balance?',
  CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE printf('%.2f', s_acctbal) END,
  CASE WHEN s_suppkey % 5 = 0 THEN '0.0%' ELSE printf('%.1f%%', CAST((s_suppkey * 53) % 1000 AS DOUBLE) / 10.0) END
FROM supplier
"""


@register("answer_details", _ANSWERS_SQL)
def q_answer_details(spark, sf_dir):
    return B.answer_details(query_blocks(spark, sf_dir))


@register("query_answers", """
SELECT s_suppkey AS doc_id, 'SUPPLIER_NAME' AS alias, CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE s_name END AS answer
FROM supplier
UNION ALL
SELECT s_suppkey, 'What is the account balance?', CASE WHEN s_suppkey % 5 = 0 THEN '' ELSE printf('%.2f', s_acctbal) END
FROM supplier
""")
def q_query_answers(spark, sf_dir):
    return B.query_answers(B.answer_details(query_blocks(spark, sf_dir)))

"""Registered queries for structured responses (A3-A6, W1, W2) and the review flow (P6, F1, J13, A11, J14, F2, F3,
ST2, ST4, W6, C7, C8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.operators import review as R
from quire.operators import structured as S
from quire.operators.blocks import kv_pairs
from quire.plans import encode
from quire.plans.q_blocks import form_blocks
from quire.plans.registry import register
from quire.session import read_table

_LI = """li AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey
           ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS r,
         l_partkey, l_returnflag, l_extendedprice, l_discount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey)"""


def _expense_resp(spark, sf_dir):
    return encode.encode_expense(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))


@register("expense_summary", """
SELECT o_orderkey AS doc_id, 0 AS expense_ord, 'TOTAL' AS type, printf('%.2f', o_totalprice) AS value FROM orders
UNION ALL SELECT o_orderkey, 0, 'STATUS', o_orderstatus FROM orders
UNION ALL SELECT o_orderkey, 0, 'PRIORITY', o_orderpriority FROM orders
UNION ALL SELECT o_orderkey, 0, 'UNKNOWN', 'cust-' || CAST(o_custkey AS VARCHAR) FROM orders
UNION ALL SELECT o_orderkey, 0, 'DUE', '' FROM orders
""")
def q_expense_summary(spark, sf_dir):
    return S.expense_summary(_expense_resp(spark, sf_dir))


@register("expense_line_items", f"""
WITH {_LI},
it AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, r) - 1 AS INTEGER)
         AS item_ord, r, l_partkey, l_extendedprice FROM li)
SELECT l_orderkey AS doc_id, 0 AS expense_ord, item_ord, 'ITEM' AS type, CAST(l_partkey AS VARCHAR) AS value FROM it
UNION ALL SELECT l_orderkey, 0, item_ord, 'PRICE', printf('%.2f', l_extendedprice) FROM it
UNION ALL SELECT l_orderkey, 0, item_ord, 'ROW', CAST(r AS VARCHAR) FROM it
UNION ALL SELECT l_orderkey, 0, item_ord, 'NOTE', '' FROM it
""")
def q_expense_line_items(spark, sf_dir):
    return S.expense_line_items(_expense_resp(spark, sf_dir))


@register("expense", f"""
WITH {_LI}, n AS (SELECT l_orderkey, count(*) AS c, string_agg(CAST(l_partkey AS VARCHAR) || ':' || printf('%.2f', l_extendedprice)
                     || ':' || CAST(r AS VARCHAR) || ':', '|' ORDER BY l_returnflag, r) AS items
                   FROM li GROUP BY l_orderkey)
SELECT o_orderkey AS doc_id, 1 AS n_documents, 5 AS n_summary_fields, CAST(coalesce(c, 0) AS INTEGER) AS n_line_items,
       printf('%.2f', o_totalprice) AS total, 'DUE=|PRIORITY=' || o_orderpriority || '|STATUS=' || o_orderstatus || '|TOTAL='
         || printf('%.2f', o_totalprice) || '|UNKNOWN=cust-' || CAST(o_custkey AS VARCHAR) AS summary, coalesce(items, '') AS items
FROM orders LEFT JOIN n ON l_orderkey = o_orderkey
""")
def q_expense(spark, sf_dir):
    e = S.expense(_expense_resp(spark, sf_dir))
    d = F.col("expense_data.documents")
    return e.select("doc_id", F.size(d).alias("n_documents"),
                    F.size(F.map_keys(d[0]["summary_fields"])).alias("n_summary_fields"),
                    F.size(d[0]["line_items"]).alias("n_line_items"),
                    d[0]["summary_fields"]["TOTAL"].alias("total"),
                    F.array_join(F.transform(F.array_sort(F.map_entries(d[0]["summary_fields"])),
                                             lambda e: F.concat_ws("=", e["key"], e["value"])), "|").alias("summary"),
                    F.array_join(F.transform(d[0]["line_items"], lambda i: F.concat_ws(
                        ":", i["ITEM"], i["PRICE"], i["ROW"], i["NOTE"])), "|").alias("items"))


@register("identity_fields", """
SELECT c_custkey AS doc_id, 'NAME' AS type, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'SEGMENT', c_mktsegment FROM customer
UNION ALL SELECT c_custkey, 'NATION', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'UNKNOWN', printf('%.2f', c_acctbal) FROM customer
UNION ALL SELECT c_custkey, 'DOB', '' FROM customer
""")
def q_identity_fields(spark, sf_dir):
    return S.identity_fields(encode.encode_identity(read_table(spark, sf_dir, "customer")))


_CLASSES = """c AS (
  SELECT o_orderkey AS doc_id, 'invoice' AS class, 0 AS pos,
         round(CAST((o_orderkey * 7) % 101 AS DOUBLE) / 101.0, 4) AS score FROM orders
  UNION ALL SELECT o_orderkey, 'receipt', 1, CASE o_orderkey % 7 WHEN 0 THEN 0.5555 WHEN 1 THEN 0.0001 WHEN 2 THEN 0.0312
      ELSE round(CAST((o_orderkey * 13) % 101 AS DOUBLE) / 101.0, 4) END FROM orders
  UNION ALL SELECT o_orderkey, 'bank-statement', 2, round(CAST((o_orderkey * 29) % 101 AS DOUBLE) / 101.0, 4)
  FROM orders),
rk AS (SELECT doc_id, class, score,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos) AS INTEGER) AS rank FROM c)"""


def _class_resp(spark, sf_dir):
    return encode.encode_classes(read_table(spark, sf_dir, "orders"))


@register("rank_classes", f"WITH {_CLASSES} SELECT * FROM rk")
def q_rank_classes(spark, sf_dir):
    return S.rank_classes(_class_resp(spark, sf_dir))


@register("top_class", f"""WITH {_CLASSES}
SELECT doc_id, class AS document_type, score AS classification_confidence FROM rk WHERE rank = 1""")
def q_top_class(spark, sf_dir):
    return S.top_class(_class_resp(spark, sf_dir)).drop("error")


@register("needs_review", f"""WITH {_CLASSES}
SELECT doc_id, class AS document_type, score AS classification_confidence FROM rk
WHERE rank = 1 AND score > 0 AND score < 0.9""")
def q_needs_review(spark, sf_dir):
    t = S.top_class(_class_resp(spark, sf_dir)).drop("error")
    return t.where(R.needs_review(F.col("classification_confidence")))


@register("review_queue", f"""WITH {_CLASSES}
SELECT doc_id, 'idp-review-' || sha256(CAST(doc_id AS VARCHAR)) AS loop_id,
       class AS document_type, score AS confidence, 's3://documents/orders/' || CAST(doc_id AS VARCHAR) AS task_object
FROM rk WHERE rank = 1 AND score > 0 AND score < 0.9""")
def q_review_queue(spark, sf_dir):
    t = (S.top_class(_class_resp(spark, sf_dir))
         .withColumn("s3_uri", R.make_uri(F.lit("documents"), F.concat(F.lit("orders/"),
                                                                        F.col("doc_id").cast("string")))))
    q = R.review_queue(t)
    return q.select("doc_id", "loop_id", "document_type", "confidence",
                    F.get_json_object("payload", "$.taskObject").alias("task_object"))


@register("review_payload", f"""WITH {_CLASSES}
SELECT doc_id, 's3://documents/orders/' || CAST(doc_id AS VARCHAR) AS task_object, class AS document_type, score AS confidence,
       'Order=' || CAST(doc_id AS VARCHAR) || ';Note=say "hi"' AS kv_pairs, true AS human_review_triggered
FROM rk WHERE rank = 1 AND score > 0 AND score < 0.9""")
def q_review_payload(spark, sf_dir):
    """The payload read back whole."""
    name = F.col("doc_id").cast("string")
    t = S.top_class(_class_resp(spark, sf_dir)).withColumn("s3_uri", R.make_uri(F.lit("documents"), F.concat(F.lit("orders/"), name)))
    t = t.withColumn("kv_pairs", F.create_map(F.lit("Order"), name, F.lit("Note"), F.lit('say "hi"')))
    back = F.from_json("payload", "taskObject string, extractedData struct<document_type:string,kv_pairs:map<string,string>,confidence:double>")
    q = R.review_queue(t).select("doc_id", "human_review_triggered", back.alias("p"))
    pairs = F.transform(F.map_entries("p.extractedData.kv_pairs"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return q.select("doc_id", F.col("p.taskObject").alias("task_object"), "p.extractedData.document_type", "p.extractedData.confidence",
                    F.array_join(pairs, ";").alias("kv_pairs"), "human_review_triggered")


def _confidences(spark, sf_dir):
    return encode.field_confidences(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "lineitem"))


@register("evaluate_fields", f"""
WITH {_LI}, f AS (SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE round(l_discount * 10, 4) < 0.9) AS low,
                    string_agg('item_' || CAST(r AS VARCHAR), ',' ORDER BY r) FILTER (WHERE round(l_discount * 10, 4) < 0.9) AS lows,
                    string_agg('item_' || CAST(r AS VARCHAR) || '=' || printf('%.4f', round(l_discount * 10, 4)), ',' ORDER BY r) AS fields
                  FROM li GROUP BY l_orderkey)
SELECT o_orderkey AS doc_id, coalesce(low, 0) > 0 AS review_needed, CAST(coalesce(low, 0) AS INTEGER) AS n_low,
       CAST(coalesce(n, 0) AS INTEGER) AS n_fields, coalesce(lows, '') AS low_confidence_fields, coalesce(fields, '') AS all_fields
FROM orders LEFT JOIN f ON l_orderkey = o_orderkey
""")
def q_evaluate_fields(spark, sf_dir):
    e = R.evaluate_fields(read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc_id")),
                          _confidences(spark, sf_dir))
    fields = F.transform("all_fields", lambda x: F.format_string("%s=%.4f", x["key"], x["score"]))
    return e.withColumn("low_confidence_fields", F.array_join("low_confidence_fields", ",")).withColumn(
        "all_fields", F.array_join(fields, ","))


@register("low_confidence_fields", f"""
WITH {_LI}
SELECT l_orderkey AS doc_id, 'item_' || CAST(r AS VARCHAR) AS key, round(l_discount * 10, 4) AS score FROM li
WHERE round(l_discount * 10, 4) < 0.9
""")
def q_low_confidence_fields(spark, sf_dir):
    return R.low_confidence_fields(_confidences(spark, sf_dir)).select("doc_id", "key", "score")


def _reviewed(spark, sf_dir):
    """Reviewer output files, as JSON rows: negative balances were corrected to 0.00 by a reviewer (the first
    answer is superseded by the second)."""
    c = read_table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    out = F.to_json(F.struct(F.array(
        F.struct(F.create_map(F.lit("Account Balance"), F.lit("pending")).alias("answerContent")),
        F.struct(F.create_map(F.lit("Account Balance"), F.lit("0.00")).alias("answerContent")),
    ).alias("humanAnswers")))
    return R.parse_review_output(c.select(F.col("c_custkey").alias("doc_id"), out.alias("output")))


@register("apply_corrections", """
SELECT c_custkey AS doc_id, 'Customer Name' AS key, trim(c_name) AS value, false AS corrected FROM customer
UNION ALL SELECT c_custkey, 'Market Segment', trim(c_mktsegment || ' segment'), false FROM customer
UNION ALL SELECT c_custkey, 'Account Balance',
  CASE WHEN c_acctbal < 0 THEN '0.00' ELSE printf('%.2f', c_acctbal) END, c_acctbal < 0 FROM customer
UNION ALL SELECT c_custkey, 'Fax Number', '', false FROM customer
""")
def q_apply_corrections(spark, sf_dir):
    extracted = kv_pairs(form_blocks(spark, sf_dir)).select("doc_id", "key", "value")
    return R.apply_corrections(extracted, _reviewed(spark, sf_dir))


# ---------------------------------------------------------------- loop lifecycle over `events`

# Fixed mapping of the event log onto review-loop statuses.
_STATUS_OF = {"signup": "InProgress", "purchase": "Completed", "error": "Failed"}


def _status_col():
    c = F.col("event_type")
    return (F.when(c == "signup", "InProgress").when(c == "purchase", "Completed")
            .when(c == "error", "Failed"))


def _loop_events(spark, sf_dir):
    e = read_table(spark, sf_dir, "events").where(F.col("event_type").isin(list(_STATUS_OF)))
    return e.select(F.concat(F.lit("loop-"), F.col("user_id").cast("string")).alias("loop_id"),
                    _status_col().alias("status"), "ts", "event_id")


_LOOP_EVENTS_SQL = """le AS (
  SELECT 'loop-' || CAST(user_id AS VARCHAR) AS loop_id,
         CASE event_type WHEN 'signup' THEN 'InProgress' WHEN 'purchase' THEN 'Completed' ELSE 'Failed' END AS status,
         ts, event_id
  FROM events WHERE event_type IN ('signup', 'purchase', 'error'))"""


@register("latest_loop_status", f"""WITH {_LOOP_EVENTS_SQL}
SELECT loop_id, arg_max(status, (ts, event_id)) AS status, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ts
FROM le GROUP BY loop_id""")
def q_latest_loop_status(spark, sf_dir):
    s = R.latest_loop_status(_loop_events(spark, sf_dir))
    return s.select("loop_id", "status", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


@register("stop_loops", f"""WITH {_LOOP_EVENTS_SQL},
cur AS (SELECT loop_id, arg_max(status, (ts, event_id)) AS status FROM le GROUP BY loop_id)
SELECT loop_id, CASE WHEN status = 'InProgress' THEN 'Stopped' ELSE status END AS status
FROM cur""")
def q_stop_loops(spark, sf_dir):
    ev = _loop_events(spark, sf_dir)
    # Every loop is named for the stop; only those still in progress get a Stopped event, stamped after the log.
    to_stop = ev.select("loop_id").distinct()
    after = F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    return R.latest_loop_status(R.stop_loops(ev, to_stop, after)).select("loop_id", "status")


def _starts_ends(spark, sf_dir, start_type, end_map):
    e = read_table(spark, sf_dir, "events")
    starts = e.where(F.col("event_type") == start_type).select(
        F.concat(F.lit("loop-"), F.col("event_id").cast("string")).alias("loop_id"), "user_id", "ts")
    status = None
    for k, v in end_map.items():
        status = (status.when(F.col("event_type") == k, v) if status is not None
                  else F.when(F.col("event_type") == k, v))
    ends = e.where(F.col("event_type").isin(list(end_map))).select("event_id", "user_id", "ts",
                                                                     status.alias("status"))
    return starts, ends


def _outcome_sql(start_type, end_map, timeout_s):
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in end_map.items())
    ends_in = ", ".join(f"'{k}'" for k in end_map)
    return f"""
WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = '{start_type}'),
e AS (SELECT event_id, user_id, ts, CASE event_type {cases} END AS status FROM events WHERE event_type IN ({ends_in})),
m AS (SELECT s.event_id AS sid, arg_min(e.status, (e.ts, e.event_id)) AS status,
             arg_min(e.event_id, (e.ts, e.event_id)) AS eid
      FROM s JOIN e ON e.user_id = s.user_id AND e.ts >= s.ts AND e.ts <= s.ts + INTERVAL {timeout_s} SECOND
      GROUP BY s.event_id)
SELECT 'loop-' || CAST(s.event_id AS VARCHAR) AS loop_id, coalesce(m.status, 'Timeout') AS outcome, m.eid AS end_event_id
FROM s LEFT JOIN m ON m.sid = s.event_id"""


_REVIEW_ENDS = {"purchase": "Completed", "error": "Failed"}
_OCR_ENDS = {"purchase": "SUCCEEDED", "error": "FAILED"}


@register("loop_outcomes", _outcome_sql("signup", _REVIEW_ENDS, 1800))
def q_loop_outcomes(spark, sf_dir):
    starts, ends = _starts_ends(spark, sf_dir, "signup", _REVIEW_ENDS)
    return R.loop_outcomes(starts, ends, "user_id", 1800).select("loop_id", "outcome", "end_event_id")


@register("ocr_jobs", _outcome_sql("view", _OCR_ENDS, 300))
def q_ocr_jobs(spark, sf_dir):
    starts, ends = _starts_ends(spark, sf_dir, "view", _OCR_ENDS)
    return R.loop_outcomes(starts, ends, "user_id", 300).select("loop_id", "outcome", "end_event_id")


def _job_pages(spark, sf_dir):
    """The lines of an order as the pages of a job."""
    return read_table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("loop-"), F.col("l_orderkey").cast("string")).alias("loop_id"), F.col("l_linenumber").cast("long").alias("page"),
        F.concat("l_returnflag", "l_linestatus").alias("text"))


@register("ocr_job_pages", f"""WITH o AS ({_outcome_sql("view", _OCR_ENDS, 300)})
SELECT loop_id, CAST(l_linenumber AS BIGINT) AS page, l_returnflag || l_linestatus AS text
FROM lineitem JOIN o ON o.loop_id = 'loop-' || CAST(l_orderkey AS VARCHAR) WHERE outcome = 'SUCCEEDED'""")
def q_ocr_job_pages(spark, sf_dir):
    """ST4: the pages of finished jobs."""
    starts, ends = _starts_ends(spark, sf_dir, "view", _OCR_ENDS)
    return R.finished_pages(R.loop_outcomes(starts, ends, "user_id", 300), _job_pages(spark, sf_dir))


@register("ocr_job_errors", f"""WITH o AS ({_outcome_sql("view", _OCR_ENDS, 300)})
SELECT loop_id, 'extraction' AS phase, 'Extraction failed: job ' || loop_id || CASE outcome WHEN 'Timeout' THEN ' timed out after 300s'
  ELSE ' FAILED' END AS error FROM o WHERE outcome <> 'SUCCEEDED'""")
def q_ocr_job_errors(spark, sf_dir):
    """ST4: failed and timed out jobs as errors of the extraction phase."""
    starts, ends = _starts_ends(spark, sf_dir, "view", _OCR_ENDS)
    return R.job_errors(R.loop_outcomes(starts, ends, "user_id", 300), 300)


@register("list_loops", f"""WITH {_LOOP_EVENTS_SQL},
cur AS (SELECT loop_id, arg_max(status, (ts, event_id)) AS status, max(ts) AS ts FROM le GROUP BY loop_id)
SELECT loop_id, status, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM cur WHERE status = 'Completed'
ORDER BY cur.ts DESC, loop_id LIMIT 50""")
def q_list_loops(spark, sf_dir):
    cur = R.latest_loop_status(_loop_events(spark, sf_dir))
    return R.list_loops(cur, "Completed", 50).select("loop_id", "status",
                                                      F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))

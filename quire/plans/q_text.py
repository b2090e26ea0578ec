"""Registered queries over ``documents``: personal data, redaction, chunking, truncation, previews."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.spans import PII_PATTERNS
from quire.operators import pii
from quire.plans.registry import register
from quire.plans.sqlgen import spans_cte
from quire.session import read_table

_SPANS_SQL = f"""
WITH {spans_cte(PII_PATTERNS)}
SELECT doc_id,
  CAST(row_number() OVER (PARTITION BY doc_id ORDER BY type_ord, i) - 1 AS INTEGER) AS span_ord,
  type, CAST(b AS INTEGER) AS begin_offset, CAST(b + length(t) AS INTEGER) AS end_offset, t AS text, CAST(1.0 AS DOUBLE) AS score
FROM __s
"""


@register("detect_pii", _SPANS_SQL)
def q_detect_pii(spark, sf_dir):
    return pii.detect_pii(read_table(spark, sf_dir, "documents"))


_REDACT_SQL = f"""
WITH {spans_cte(PII_PATTERNS)},
__agg AS (SELECT doc_id, count(*) AS n, list(struct_pack(b := CAST(b AS BIGINT), e := CAST(b + length(t) AS BIGINT))) AS sp FROM __s GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(a.n, 0) AS INTEGER) AS n_pii,
  CASE WHEN a.n > 0 THEN list_reduce(list_sort(a.sp, 'DESC'),
       lambda acc, s: left(acc, s.b) || repeat('*', s.e - s.b) || substr(acc, s.e + 1), d.text)
       ELSE '' END AS redacted_text
FROM documents d LEFT JOIN __agg a ON a.doc_id = d.doc_id
"""


@register("redact_documents", _REDACT_SQL)
def q_redact(spark, sf_dir):
    return pii.redact_documents(read_table(spark, sf_dir, "documents"))


_FILTER_PII_SQL = f"""
WITH {spans_cte({k: PII_PATTERNS[k] for k in ("EMAIL", "IP_ADDRESS")})}
SELECT doc_id, type, CAST(b AS INTEGER) AS begin_offset, CAST(b + length(t) AS INTEGER) AS end_offset, t AS text
FROM __s
"""


@register("filter_pii", _FILTER_PII_SQL)
def q_filter_pii(spark, sf_dir):
    spans = pii.detect_pii(read_table(spark, sf_dir, "documents"), types=["EMAIL", "IP_ADDRESS"])
    return pii.filter_pii(spans, ["EMAIL", "IP_ADDRESS"]).select("doc_id", "type", "begin_offset", "end_offset",
                                                                  "text")

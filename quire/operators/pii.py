"""Personal-data detection and text redaction over a documents DataFrame.

All of it is map-side: one row per document in, spans computed in the row, no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import explode_rows
from quire.functions.spans import PII_PATTERNS, redact, with_spans


def with_pii_spans(docs: DataFrame, types: Sequence[str] | None = None, text_col: str = "text",
                   patterns: dict[str, str] | None = None) -> DataFrame:
    """Add ``pii array<struct<type, begin_offset, end_offset, text, score>>`` to every document.

    P4: ``types`` keeps the requested types only; ``None`` or empty keeps all. Only requested patterns are run.
    """
    pats = dict(patterns or PII_PATTERNS)
    if types:
        pats = {t: p for t, p in pats.items() if t in set(types)}
    if not pats:
        return docs.withColumn("pii", F.expr("cast(array() as array<struct<type:string,begin_offset:int,"
                                             "end_offset:int,text:string,score:double>>)"))
    return with_spans(docs, text_col, "pii", pats)


def detect_pii(docs: DataFrame, types: Sequence[str] | None = None, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """C2 long form: ``(doc_id, span_ord, type, begin_offset, end_offset, text, score)``."""
    d = with_pii_spans(docs.select(id_col, text_col), types, text_col)
    return (explode_rows(d, [id_col], F.col("pii"), "s", "span_ord")
            .select(id_col, "span_ord", "s.type", "s.begin_offset", "s.end_offset", "s.text", "s.score"))


def filter_pii(spans: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """P4 over long-form spans: requested types only; ``None``/empty keeps everything."""
    return spans.where(F.col("type").isin(list(types))) if types else spans


def redact_documents(docs: DataFrame, types: Sequence[str] | None = None, mask: str = "*",
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """C3 as the pipeline applies it: ``(doc_id, n_pii, redacted_text)``.

    As in the reference flow, a document without personal data gets ``redacted_text = ''``.
    """
    d = with_pii_spans(docs.select(id_col, text_col), types, text_col)
    return d.select(
        id_col,
        F.size("pii").alias("n_pii"),
        F.when(F.size("pii") > 0, redact(F.col(text_col), F.col("pii"), mask)).otherwise(F.lit("")).alias(
            "redacted_text"),
    )

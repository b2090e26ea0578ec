"""Span arithmetic as column expressions: typed pattern spans (C2), masking (C3), truncation (P5), preview (P10).

Everything here is a per-row expression built from Spark SQL higher-order functions, so it runs inside
whole-stage code generation, needs no shuffle and scales with the number of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import bind, with_exclusive_prefix_sum

# One pattern per personal-data type, in the subset shared by Java regex and RE2
# (no look-around, no \b), so the Spark result and the DuckDB oracle agree match for match.
PII_PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "IP_ADDRESS": r"[0-9]{1,3}(\.[0-9]{1,3}){3}",
    "CREDIT_DEBIT_NUMBER": r"[0-9]{13,16}",
    "SSN": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "PHONE": r"[0-9]{3}-[0-9]{3}-[0-9]{4}",
}

#: A character that every match of a pattern holds. Without it, the search for an e-mail address reads the rest of a word from each letter.
_HELD = {PII_PATTERNS["EMAIL"]: "@"}

SPAN_TYPE = "array<struct<type:string,begin_offset:int,end_offset:int,text:string,score:double>>"


def with_spans(df: DataFrame, text_col: str = "text", out_col: str = "spans",
               patterns: dict[str, str] | None = None) -> DataFrame:
    """Add ``out_col`` = typed spans of every pattern (types concatenated in the order given).

    Matches come from ``regexp_extract_all``, the gaps between them from ``split`` on the same pattern, so
    gap_0 match_0 gap_1 match_1 ... rebuilds the text (a text without a match, the most frequent case, is not split; one without a
    character that every match holds, see ``_HELD``, is not searched): a match begins after all earlier gaps and matches, i.e.
    at the exclusive prefix sum of (gap + match) lengths plus its own gap. Each array is a column of its own
    (each regex runs once per document) and the prefix sum is linear-ish (``with_exclusive_prefix_sum``).
    Offsets are 0-based, half-open, in code points. Overlaps between types are kept (each type is scanned on
    the original text), as a detector returns them.
    """
    pats = patterns or PII_PATTERNS
    tmp, parts = [], []
    for k, (span_type, p) in enumerate(pats.items()):
        m, g, st, ps = f"__m{k}", f"__g{k}", f"__st{k}", f"__ps{k}"
        found, none = F.regexp_extract_all(F.col(text_col), F.lit(p), 0), F.array().cast("array<string>")
        if p in _HELD:
            found = F.when(~F.contains(F.col(text_col), F.lit(_HELD[p])), none).otherwise(found)
        df = (df.withColumn(m, found)
              .withColumn(g, F.when(F.size(m) == 0, none).otherwise(F.slice(F.split(F.col(text_col), p, -1), 1, F.size(m)))))
        df = df.withColumn(st, F.zip_with(g, m, lambda gap, mt: F.length(gap) + F.length(mt)))
        df = with_exclusive_prefix_sum(df, st, ps)
        tmp += [m, g, st, ps]
        parts.append(F.zip_with(F.zip_with(ps, g, lambda o, gap: o + F.length(gap)), m, lambda b, mt: F.struct(
            F.lit(span_type).alias("type"), b.cast("int").alias("begin_offset"),
            (b + F.length(mt)).cast("int").alias("end_offset"), mt.alias("text"), F.lit(1.0).alias("score"))))
    return df.withColumn(out_col, F.concat(*parts)).drop(*tmp)


#: Least number of spans that one fold of ``redact`` takes.
_REDACT_BLOCK = 32


def redact(text: Column, spans: Column, mask: str = "*") -> Column:
    """Replace every code point that a span covers by ``mask``.

    With a one-character mask the length is preserved, so applying overlapping spans right to left gives the same as masking their
    union, which is what happens: a sweep over the spans in order of their begin, which puts gaps and masks together once. A past-the-end span
    extends like a Python slice does. Spans are swept in blocks of about the square root of their number, each over its own stretch of
    the text, so no fold copies or searches more than its stretch.
    """
    if len(mask) != 1:
        raise ValueError("mask must be one character so that offsets of other spans stay valid")

    def piece(t, block, j, starts, reach, last):
        """The stretch of block ``j``, masked; positions are relative to its start. Spans of earlier blocks reach ``reach[j]``."""
        start = F.get(starts, j)
        width = F.when(j < last, F.get(starts, j + 1) - start).otherwise(F.lit(2**31 - 1) - start)

        def sweep(part):
            def step(acc, s):
                b, e = s["b"] - start, F.least(s["e"] - start, width)
                return F.struct(F.greatest(acc["at"], e).alias("at"), F.concat(
                    acc["out"], F.substring(part, acc["at"] + 1, b - acc["at"]),
                    F.repeat(F.lit(mask), e - F.greatest(b, acc["at"]))).alias("out"))

            before = F.least(F.greatest(F.get(reach, j) - start, F.lit(0)), width)
            return F.aggregate(block, F.struct(before.alias("at"), F.repeat(F.lit(mask), before).alias("out")), step, lambda acc: F.concat(
                acc["out"], F.substring(part, acc["at"] + 1, F.lit(2**31 - 1))))

        return bind(F.substring(t, start + 1, width), sweep)

    def sweep_blocks(t, blocks):
        starts = F.transform(blocks, lambda b, j: F.when(j == 0, F.lit(0)).otherwise(F.get(b, F.lit(0))["b"]))
        tops = F.transform(blocks, lambda b: F.array_max(F.transform(b, lambda s: s["e"])))
        reach = F.aggregate(tops, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), x))))
        return bind(starts, lambda st: bind(reach, lambda r: F.array_join(F.transform(
            blocks, lambda b, j: piece(t, b, j, st, r, F.size(blocks) - 1)), "")))

    def cut(ordered):
        size = F.greatest(F.lit(_REDACT_BLOCK), F.ceil(F.sqrt(F.size(ordered))).cast("int"))
        return bind(size, lambda n: F.transform(F.sequence(F.lit(0), F.floor((F.size(ordered) - 1) / n).cast("int")), lambda j: F.slice(ordered, j * n + 1, n)))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["begin_offset"].cast("int").alias("b"), s["end_offset"].cast("int").alias("e"))))
    masked = bind(text, lambda t: bind(bind(ordered, cut), lambda blocks: sweep_blocks(t, blocks)))
    return F.when(F.size(spans) == 0, text).when(text.isNotNull() & spans.isNotNull(), masked)


def truncate_text(text: Column, n: int) -> Column:
    """P5: the first ``n`` code points (20000 medical entities/PHI, 10000 code linking, 8000 prompts)."""
    return F.substring(text, 1, n)


def preview(text: Column, n: int = 300) -> Column:
    """P10: first ``n`` characters, with '...' only when the text is longer."""
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)

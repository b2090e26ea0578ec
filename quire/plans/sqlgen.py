"""Small helpers that write DuckDB oracle SQL for the pattern operators (the oracle must run each pattern literally)."""

from __future__ import annotations


def duck_str(s: str) -> str:
    """A DuckDB string literal: standard SQL, backslashes are not escapes."""
    return "'" + s.replace("'", "''") + "'"


def spans_cte(patterns: dict[str, str], table: str = "documents", id_col: str = "doc_id",
              text_expr: str = "text") -> str:
    """CTE body producing ``(doc_id, type_ord, type, i, b, t)``: 1-based match number, 0-based begin, match text."""
    parts = []
    for k, (t, p) in enumerate(patterns.items()):
        rx = duck_str(p)
        parts.append(
            f"SELECT {id_col} AS doc_id, {k} AS type_ord, {duck_str(t)} AS type, "
            f"regexp_extract_all({text_expr}, {rx}) AS ms, string_split_regex({text_expr}, {rx}) AS gs FROM {table}"
        )
    m = "\nUNION ALL\n".join(parts)
    return f"""
__m AS ({m}),
__u AS (SELECT doc_id, type_ord, type, ms, gs, unnest(generate_series(1, len(ms))) AS i FROM __m WHERE len(ms) > 0),
__s AS (
  SELECT doc_id, type_ord, type, i,
    coalesce(list_sum(list_transform(gs[1:i], lambda x: length(x))), 0)
      + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0) AS b,
    ms[i] AS t
  FROM __u)"""

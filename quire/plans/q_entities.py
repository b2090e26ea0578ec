"""Registered entity and chunking queries over ``documents`` and ``benchmark``."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.arrays import explode_rows
from quire.functions import text as TX
from quire.functions.spans import PII_PATTERNS, preview, truncate_text
from quire.operators import entities as EN
from quire.plans import lookups
from quire.plans.registry import register
from quire.plans.sqlgen import duck_str, spans_cte
from quire.session import read_table

WS = duck_str(TX.WS_RE2)


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


def _tokens_cte(text_expr: str = "text", p: str = "") -> str:
    return f"""
{p}__d AS (SELECT doc_id, string_split_regex({text_expr}, {WS}) AS ps, regexp_extract_all({text_expr}, {WS}) AS ss
        FROM documents),
{p}__p AS (SELECT doc_id, i, ps[i] AS tok, length(ps[i]) + coalesce(length(ss[i]), 0) AS w
        FROM (SELECT doc_id, ps, ss, unnest(generate_series(1, len(ps))) AS i FROM {p}__d)),
{p}__tk AS (SELECT doc_id, i AS pos, tok AS token,
           CAST(coalesce(sum(w) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                         0) AS INTEGER) AS begin_offset
         FROM {p}__p),
{p}__t AS (SELECT * FROM {p}__tk WHERE token <> '')"""


_WORDS = f"list_filter(string_split_regex(text, {WS}), lambda x: x <> '')"

_ENTITY_LIST_CTE = f"""
__el0 AS (SELECT lower(array_to_string({_WORDS}[1:2], ' ')) AS phrase, min(item_id) AS mid FROM benchmark GROUP BY 1),
__el AS (SELECT phrase, CASE WHEN mid % 2 = 0 THEN 'SAVINGS_AC' ELSE 'CHECKING_AC' END AS type,
           len(string_split(phrase, ' ')) AS n FROM __el0 WHERE phrase <> '')"""

_LEXICON_CTE = f"""
__lex AS (SELECT term,
            ['MEDICATION', 'MEDICAL_CONDITION', 'ANATOMY', 'TEST_TREATMENT_PROCEDURE'][length(term) % 4 + 1] AS category,
            'GENERIC' AS type
          FROM (SELECT DISTINCT lower(regexp_replace(w, '[.,;:!?]+$', '')) AS term
                FROM (SELECT unnest({_WORDS}) AS w FROM benchmark))
          WHERE regexp_matches(term, '^\\p{{L}}{{8,}}$'))"""

_GRAMS_CTE = """
__g AS (SELECT doc_id, pos, token, begin_offset,
          lead(token, 1) OVER w AS t1, lead(begin_offset, 1) OVER w AS b1,
          lead(token, 2) OVER w AS t2, lead(begin_offset, 2) OVER w AS b2
        FROM __t WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
__grams AS (
  SELECT doc_id, 1 AS n, token AS text, begin_offset, begin_offset + length(token) AS end_offset FROM __g
  UNION ALL SELECT doc_id, 2, token || ' ' || t1, begin_offset, b1 + length(t1) FROM __g WHERE t1 IS NOT NULL
  UNION ALL SELECT doc_id, 3, token || ' ' || t1 || ' ' || t2, begin_offset, b2 + length(t2) FROM __g
  WHERE t2 IS NOT NULL)"""

_DICT_HITS_SQL = f"""
WITH {_tokens_cte()}, {_GRAMS_CTE}, {_ENTITY_LIST_CTE}
SELECT g.doc_id, g.begin_offset, CAST(g.end_offset AS INTEGER) AS end_offset, g.text, e.type, CAST(1.0 AS DOUBLE) AS score
FROM __grams g JOIN __el e ON lower(g.text) = e.phrase AND g.n = e.n"""


def _dict_entities(spark, sf_dir):
    return EN.dictionary_entities(_docs(spark, sf_dir), lookups.entity_list(read_table(spark, sf_dir, "benchmark")))


@register("dictionary_entities", _DICT_HITS_SQL)
def q_dictionary_entities(spark, sf_dir):
    return _dict_entities(spark, sf_dir)


_PATTERN_ENTS = f"""
WITH {spans_cte(EN.ENTITY_PATTERNS)}
SELECT doc_id, CAST(b AS INTEGER) AS begin_offset, CAST(b + length(t) AS INTEGER) AS end_offset, t AS text, type
FROM __s"""


@register("all_entities", f"""
WITH p AS ({_PATTERN_ENTS}), c AS ({_DICT_HITS_SQL})
SELECT doc_id, 0 AS source, begin_offset, end_offset, text, type FROM p
UNION ALL SELECT doc_id, 1, begin_offset, end_offset, text, type FROM c""")
def q_all_entities(spark, sf_dir):
    b = EN.pattern_entities(_docs(spark, sf_dir))
    return EN.all_entities(b, _dict_entities(spark, sf_dir)).select("doc_id", "source", "begin_offset", "end_offset",
                                                                     "text", "type")


@register("filter_entities", _PATTERN_ENTS)
def q_filter_entities(spark, sf_dir):
    ents = EN.all_entities(EN.pattern_entities(_docs(spark, sf_dir)), _dict_entities(spark, sf_dir))
    return EN.filter_entities(ents).select("doc_id", "begin_offset", "end_offset", "text", "type")


_BY_TYPE = ["SAVINGS_AC", "CHECKING_AC", "PERSON"]


@register("entities_by_type", f"""
WITH h AS ({_DICT_HITS_SQL}),
g AS (SELECT doc_id, type, count(*) AS n, string_agg(text, '|' ORDER BY begin_offset, end_offset, text) AS texts
      FROM h GROUP BY doc_id, type),
r AS (SELECT doc_id, type FROM documents, (VALUES ('SAVINGS_AC'), ('CHECKING_AC'), ('PERSON')) v(type))
SELECT r.doc_id, r.type, CAST(coalesce(n, 0) AS INTEGER) AS n, coalesce(texts, '') AS texts
FROM r LEFT JOIN g ON g.doc_id = r.doc_id AND g.type = r.type""")
def q_entities_by_type(spark, sf_dir):
    g = EN.entities_by_type(_docs(spark, sf_dir), _dict_entities(spark, sf_dir), _BY_TYPE)
    return g.select("doc_id", "type", "n", F.array_join("texts", "|").alias("texts"))


def _lex(spark, sf_dir):
    return lookups.lexicon(read_table(spark, sf_dir, "benchmark"))


def _med_sql(p: str = "") -> str:
    return f"""{_tokens_cte("text", p)}, {_LEXICON_CTE},
{p}__mh AS (SELECT t.doc_id, t.begin_offset, CAST(t.begin_offset + length(t.text) AS INTEGER) AS end_offset, t.text,
           l.term, l.category, l.type, CAST(1.0 AS DOUBLE) AS score
         FROM (SELECT doc_id, begin_offset, regexp_replace(token, '[.,;:!?]+$', '') AS text FROM {p}__t) t
         JOIN __lex l ON lower(t.text) = l.term
         WHERE t.text <> '')"""


@register("medical_entities", f"""WITH {_med_sql()}
SELECT doc_id, begin_offset, end_offset, text, category, type, score FROM __mh""")
def q_medical_entities(spark, sf_dir):
    return EN.medical_entities(_docs(spark, sf_dir), _lex(spark, sf_dir)).select(
        "doc_id", "begin_offset", "end_offset", "text", "category", "type", "score")


def _codes_sql(system: str) -> str:
    """Two concepts for terms of even length, one for others, none for terms of a length divisible by five."""
    return f"""SELECT term, code, description, score,
        CAST(row_number() OVER (PARTITION BY term ORDER BY score DESC, code) AS INTEGER) AS concept_rank
      FROM (SELECT term, substr(md5('{system}' || term || CAST(i AS VARCHAR)), 1, 6) AS code, upper(term) AS description,
              CASE WHEN i = 0 THEN 0.75 ELSE 0.5 + (length(term) % 3) * 0.25 END AS score
            FROM __lex, (VALUES (0), (1)) v(i) WHERE length(term) % 5 <> 0 AND (i = 0 OR length(term) % 2 = 0))"""


def _link_sql(system: str, category: str | None) -> str:
    where = f"WHERE category = '{category}'" if category else ""
    return f"""WITH {_med_sql()}
SELECT doc_id, begin_offset, text, category, code, description, score, concept_rank
FROM (SELECT * EXCLUDE (score) FROM __mh {where}) LEFT JOIN ({_codes_sql(system)}) USING (term)"""


def _link(spark, sf_dir, fn):
    lex = _lex(spark, sf_dir)
    ents = EN.medical_entities(_docs(spark, sf_dir), lex)
    return fn(ents, lookups.codes(lex))


@register("link_icd10", _link_sql("ICD10CM", "MEDICAL_CONDITION"))
def q_link_icd10(spark, sf_dir):
    return _link(spark, sf_dir, EN.link_icd10)


@register("link_rxnorm", _link_sql("RXNORM", "MEDICATION"))
def q_link_rxnorm(spark, sf_dir):
    return _link(spark, sf_dir, EN.link_rxnorm)


@register("link_snomed", _link_sql("SNOMEDCT", None))
def q_link_snomed(spark, sf_dir):
    return _link(spark, sf_dir, EN.link_snomed)


@register("medical_by_category", f"""WITH {_med_sql()},
g AS (SELECT doc_id, category, count(*) AS n,
        string_agg(CAST(begin_offset AS VARCHAR) || ':' || CAST(end_offset AS VARCHAR) || ':' || text || ':' || type || ':1.0', '|'
                   ORDER BY begin_offset, end_offset, text) AS entities
      FROM __mh GROUP BY doc_id, category),
r AS (SELECT doc_id, category FROM documents, (VALUES ('MEDICATION'), ('MEDICAL_CONDITION'), ('ANATOMY'),
        ('TEST_TREATMENT_PROCEDURE'), ('PROTECTED_HEALTH_INFORMATION')) v(category))
SELECT r.doc_id, r.category, CAST(coalesce(n, 0) AS INTEGER) AS n, coalesce(entities, '') AS entities
FROM r LEFT JOIN g ON g.doc_id = r.doc_id AND g.category = r.category""")
def q_medical_by_category(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    g = EN.medical_by_category(docs, EN.medical_entities(docs, _lex(spark, sf_dir)))
    record = F.transform("entities", lambda e: F.concat_ws(
        ":", e["begin_offset"].cast("string"), e["end_offset"].cast("string"), e["text"], e["type"], e["score"].cast("string")))
    return g.select("doc_id", "category", "n", F.array_join(record, "|").alias("entities"))


_PHI = {k: v for k, v in PII_PATTERNS.items() if k in ("EMAIL", "PHONE", "SSN", "IP_ADDRESS")}
_PHI_CTE = spans_cte(_PHI)


@register("detect_phi", f"""WITH {_PHI_CTE}
SELECT doc_id, CAST(b AS INTEGER) AS begin_offset, CAST(b + length(t) AS INTEGER) AS end_offset, t AS text, type,
       'PROTECTED_HEALTH_INFORMATION' AS category FROM __s""")
def q_detect_phi(spark, sf_dir):
    return EN.detect_phi(_docs(spark, sf_dir)).select("doc_id", "begin_offset", "end_offset", "text", "type", "category")


def _linked_list(name: str, system: str, category: str) -> str:
    return f"""SELECT doc_id, '{name}' AS list, begin_offset, end_offset, text, category, code, description, concept_rank
FROM (SELECT * EXCLUDE (score) FROM __mh WHERE category = '{category}') LEFT JOIN ({_codes_sql(system)}) USING (term)"""


@register("full_medical_analysis", f"""WITH {_med_sql()},
{_PHI_CTE}
SELECT doc_id, 'entities' AS list, begin_offset, end_offset, text, category, NULL AS code, NULL AS description,
       NULL AS concept_rank FROM __mh
UNION ALL {_linked_list("icd10cm", "ICD10CM", "MEDICAL_CONDITION")}
UNION ALL {_linked_list("rxnorm", "RXNORM", "MEDICATION")}
UNION ALL SELECT doc_id, 'phi', CAST(b AS INTEGER), CAST(b + length(t) AS INTEGER), t, 'PROTECTED_HEALTH_INFORMATION',
  NULL, NULL, NULL FROM __s""")
def q_full_medical_analysis(spark, sf_dir):
    lex = _lex(spark, sf_dir)
    return EN.full_medical_analysis(_docs(spark, sf_dir), lex, lookups.codes(lex))


# ---------------------------------------------------------------- chunking, truncation, previews

_CHUNK_SQL = f"""
WITH w AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
f AS (SELECT doc_id, ws, list_reduce(list_transform(ws, lambda x: strlen(x) + 1),
        lambda acc, c: CASE WHEN acc.size + c > {TX.CHUNK_MAX_BYTES} AND acc.size > 0
                            THEN {{'starts': list_append(acc.starts, acc.i), 'size': c, 'i': acc.i + 1}}
                            ELSE {{'starts': acc.starts, 'size': acc.size + c, 'i': acc.i + 1}} END,
        {{'starts': [0], 'size': 0, 'i': 0}}).starts AS st
      FROM w WHERE len(ws) > 0),
c AS (SELECT doc_id, ws, st, unnest(generate_series(1, len(st))) AS j FROM f),
x AS (SELECT doc_id, j - 1 AS chunk_ord,
        array_to_string(ws[st[j] + 1 : CASE WHEN j < len(st) THEN st[j + 1] ELSE len(ws) END], ' ') AS text FROM c)"""


@register("chunk_by_bytes", _CHUNK_SQL + """
SELECT doc_id, CAST(chunk_ord AS INTEGER) AS chunk_ord, CAST(strlen(text) AS INTEGER) AS n_bytes, text FROM x""")
def q_chunk_by_bytes(spark, sf_dir):
    d = TX.with_chunks(_docs(spark, sf_dir))
    return (explode_rows(d, ["doc_id"], F.col("chunks"), "text", "chunk_ord")
            .select("doc_id", "chunk_ord", F.octet_length("text").alias("n_bytes"), "text"))


@register("rebase_spans", _CHUNK_SQL + """,
y AS (SELECT doc_id, chunk_ord, length(text) AS l FROM x)
SELECT doc_id, CAST(chunk_ord AS INTEGER) AS chunk_ord,
  CAST(coalesce(sum(l) OVER (PARTITION BY doc_id ORDER BY chunk_ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
       AS INTEGER) AS drift_offset
FROM y""")
def q_rebase_spans(spark, sf_dir):
    d = TX.with_drift_offsets(TX.with_chunks(_docs(spark, sf_dir)).select("doc_id", "chunks"))
    z = F.zip_with("chunks", "drift_offsets",
                   lambda c, o: F.struct(c.alias("text"), o.alias("drift_offset")))
    return (explode_rows(d, ["doc_id"], z, "z", "chunk_ord")
            .select("doc_id", "chunk_ord", F.col("z.drift_offset").alias("drift_offset")))


@register("split_text_fixed", f"""
SELECT doc_id, CAST(i - 1 AS INTEGER) AS chunk_ord, CAST(s AS INTEGER) AS start, substr(text, s, {TX.SPLIT_CHUNK_SIZE}) AS text
FROM (SELECT doc_id, text, s, row_number() OVER (PARTITION BY doc_id ORDER BY s) AS i
      FROM (SELECT doc_id, text, unnest(generate_series(1, greatest(1, length(text) - {TX.SPLIT_CHUNK_OVERLAP}),
                                                        {TX.SPLIT_CHUNK_SIZE - TX.SPLIT_CHUNK_OVERLAP})) AS s
            FROM documents WHERE length(text) > 0))""")
def q_split_text_fixed(spark, sf_dir):
    return (explode_rows(_docs(spark, sf_dir), ["doc_id"], TX.split_text_fixed(F.col("text")), "c", "chunk_ord").select("doc_id", "chunk_ord", F.col("c.start").alias("start"), F.col("c.text").alias("text")))


@register("truncate_text", """
SELECT doc_id, md5(substr(text, 1, 20000)) AS h20000, md5(substr(text, 1, 10000)) AS h10000,
       md5(substr(text, 1, 8000)) AS h8000, CAST(length(substr(text, 1, 8000)) AS INTEGER) AS n8000 FROM documents""")
def q_truncate_text(spark, sf_dir):
    t = F.col("text")
    return _docs(spark, sf_dir).select(
        "doc_id", F.md5(truncate_text(t, 20000)).alias("h20000"), F.md5(truncate_text(t, 10000)).alias("h10000"),
        F.md5(truncate_text(t, 8000)).alias("h8000"), F.length(truncate_text(t, 8000)).alias("n8000"))


@register("preview", """
SELECT doc_id, CASE WHEN length(text) > 300 THEN substr(text, 1, 300) || '...' ELSE text END AS preview FROM documents""")
def q_preview(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", preview(F.col("text")).alias("preview"))

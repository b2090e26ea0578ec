"""Registered queries for phase guards (P7), query numbering (P8), page texts (P12), prompts (C10), the
separator splitter (C4), ask-documents (C14) and per-order results from OCR blocks (A12 with blocks)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.arrays import explode_rows
from quire.functions.splitter import atom_pattern, split_text_separators
from quire.functions.text import SPLIT_CHUNK_OVERLAP, SPLIT_CHUNK_SIZE, WS_RE2
from quire.operators import assembly as AS
from quire.operators import blocks as B
from quire.operators import retrieval as RT
from quire.plans import encode
from quire.plans.lookups import DEFAULT_QUESTIONS
from quire.plans.q_blocks import table_responses
from quire.plans.q_retrieval import _RETRIEVE_CTE, _W, _Q_VALUES
from quire.plans.registry import register
from quire.plans.sqlgen import duck_str
from quire.session import materialize, read_table


def _docs(spark, sf_dir):
    return read_table(spark, sf_dir, "documents").select("doc_id", "text")


# Extensions in turn over the documents: known ones in both cases, unknown ones, none.
_EXTENSIONS = (".pdf", ".PDF", ".png", ".Jpg", ".jpeg", ".tiff", ".tif", ".docx", "pdf", "", None)


@register("phase_guards", """
SELECT doc_id, coalesce(length(text), 0) > 0 AS run_classify, coalesce(length(text), 0) > 0 AS run_enrichment,
       coalesce(length(text), 0) > 0 AS run_qa,
       CASE WHEN doc_id % 11 < 7 THEN true WHEN doc_id % 11 < 10 THEN false END AS run_expense FROM documents""")
def q_phase_guards(spark, sf_dir):
    ext = F.element_at(F.array(*map(F.lit, _EXTENSIONS)), (F.col("doc_id") % len(_EXTENSIONS) + 1).cast("int"))
    return AS.phase_guards(_docs(spark, sf_dir).withColumn("ext", ext), ext_col="ext").select(
        "doc_id", "run_classify", "run_enrichment", "run_qa", "run_expense")


# Answers as a model may give them, in turn: right, cut off, prose, a field missing, a field of the wrong type, none, a field too many.
@register("validate_answers", """
SELECT doc_id, doc_id % 7 IN (0, 3, 6) AS valid, CASE WHEN doc_id % 7 IN (0, 3, 6) THEN doc_id END AS number,
       CASE WHEN doc_id % 7 IN (0, 6) THEN coalesce(source, '') END AS source, CASE WHEN doc_id % 7 IN (1, 2, 4) THEN
         CASE doc_id % 7 WHEN 1 THEN '{"number":' || doc_id WHEN 2 THEN 'The number is ' || doc_id || '.'
         ELSE '{"number":"no ' || doc_id || '"}' END END AS corrupt FROM documents""")
def q_validate_answers(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("source", F.lit("")).alias("source"))
    n, kind = F.col("doc_id").cast("string"), F.col("doc_id") % 7
    good = F.to_json(F.struct(F.col("doc_id").alias("number"), "source"))
    answer = (F.when(kind == 0, good).when(kind == 1, F.concat(F.lit('{"number":'), n))
              .when(kind == 2, F.concat(F.lit("The number is "), n, F.lit(".")))
              .when(kind == 3, F.concat(F.lit('{"number":'), n, F.lit("}")))
              .when(kind == 4, F.concat(F.lit('{"number":"no '), n, F.lit('"}')))
              .when(kind == 6, F.concat(F.lit('{"more":[1],'), F.substring(good, 2, 1 << 20))))
    v = RT.validate_json(d.select("doc_id", answer.alias("answer")), "answer", "number long, source string")
    return v.select("doc_id", "valid", "parsed.number", "parsed.source", F.col("parsed._corrupt").alias("corrupt"))


@register("number_queries", """
SELECT item_id AS query_ord, string_split(text, '. ')[1] AS text, 'Q' || CAST(item_id + 1 AS VARCHAR) AS alias
FROM benchmark""")
def q_number_queries(spark, sf_dir):
    b = read_table(spark, sf_dir, "benchmark")
    q = b.select(F.col("item_id").alias("query_ord"), F.element_at(F.split("text", "\\. ", -1), 1).alias("text"))
    return B.number_queries(q)


@register("page_texts", """
SELECT doc_id, CAST((i - 1) // 10 AS INTEGER) AS page_ord,
       string_agg(ls[i], chr(10) ORDER BY i) AS text
FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
GROUP BY doc_id, page_ord""")
def q_page_texts(spark, sf_dir):
    return B.page_texts(encode.encode_line_pages(_docs(spark, sf_dir)))


# The schema description used by the structured-extraction prompt query.
EXTRACT_SCHEMA = "Extract the email address and the year as a JSON object."
_SPRE, _SPOST = RT.SUMMARY_PROMPT.replace("{words}", str(RT.SUMMARY_WORDS)).split("{text}")
_EPRE, _EPOST = RT.EXTRACT_PROMPT.replace("{schema}", EXTRACT_SCHEMA).split("{text}")


@register("prompts", f"""
SELECT doc_id, md5({duck_str(_SPRE)} || text || {duck_str(_SPOST)}) AS summary_prompt_md5,
       md5({duck_str(_EPRE)} || text || {duck_str(_EPOST)}) AS extract_prompt_md5
FROM documents""")
def q_prompts(spark, sf_dir):
    d = _docs(spark, sf_dir)
    return d.select("doc_id", F.md5(RT.summary_prompt(F.col("text"))).alias("summary_prompt_md5"),
                    F.md5(RT.extract_prompt(F.col("text"), EXTRACT_SCHEMA)).alias("extract_prompt_md5"))


_PART = SPLIT_CHUNK_SIZE - SPLIT_CHUNK_OVERLAP
_BEST = " ".join(f"WHEN acc.b{i} >= acc.start + {_PART // 2} THEN acc.b{i}" for i in range(4))
_SPLIT_SQL = f"""
WITH a AS (SELECT doc_id, text, regexp_extract_all(text, {duck_str("(" + atom_pattern(SPLIT_CHUNK_SIZE, SPLIT_CHUNK_OVERLAP) + ")")}, 1) AS atoms
           FROM documents),
f AS (SELECT doc_id, text, list_reduce(list_transform(atoms, lambda x: {{'n': CAST(length(x) AS INTEGER), 'level':
          CASE WHEN contains(x, chr(10) || chr(10)) THEN 0 WHEN contains(x, chr(10)) THEN 1
               WHEN regexp_matches(x, '[.!?] +$') THEN 2 ELSE 3 END, 'start': 0, 'at': 0, 'b0': 0, 'b1': 0, 'b2': 0, 'b3': 0,
          'cuts': CAST([] AS INTEGER[])}}),
        lambda acc, x: CASE
          WHEN acc.at + x.n - acc.start <= {_PART} OR acc.at <= acc.start THEN
            {{'n': 0, 'level': 0, 'start': acc.start, 'at': acc.at + x.n, 'b0': CASE WHEN x.level = 0 THEN acc.at + x.n ELSE acc.b0 END,
              'b1': CASE WHEN x.level = 1 THEN acc.at + x.n ELSE acc.b1 END, 'b2': CASE WHEN x.level = 2 THEN acc.at + x.n ELSE acc.b2 END,
              'b3': CASE WHEN x.level = 3 THEN acc.at + x.n ELSE acc.b3 END, 'cuts': acc.cuts}}
          WHEN acc.at + x.n - (CASE {_BEST} ELSE acc.at END) > {_PART} AND acc.at > (CASE {_BEST} ELSE acc.at END) THEN
            {{'n': 0, 'level': 0, 'start': acc.at, 'at': acc.at + x.n, 'b0': CASE WHEN x.level = 0 THEN acc.at + x.n ELSE acc.b0 END,
              'b1': CASE WHEN x.level = 1 THEN acc.at + x.n ELSE acc.b1 END, 'b2': CASE WHEN x.level = 2 THEN acc.at + x.n ELSE acc.b2 END,
              'b3': CASE WHEN x.level = 3 THEN acc.at + x.n ELSE acc.b3 END,
              'cuts': list_concat(acc.cuts, [CASE {_BEST} ELSE acc.at END, acc.at])}}
          ELSE
            {{'n': 0, 'level': 0, 'start': CASE {_BEST} ELSE acc.at END, 'at': acc.at + x.n,
              'b0': CASE WHEN x.level = 0 THEN acc.at + x.n ELSE acc.b0 END,
              'b1': CASE WHEN x.level = 1 THEN acc.at + x.n ELSE acc.b1 END, 'b2': CASE WHEN x.level = 2 THEN acc.at + x.n ELSE acc.b2 END,
              'b3': CASE WHEN x.level = 3 THEN acc.at + x.n ELSE acc.b3 END, 'cuts': list_append(acc.cuts, CASE {_BEST} ELSE acc.at END)}}
        END,
        {{'n': 0, 'level': 0, 'start': 0, 'at': 0, 'b0': -1, 'b1': -1, 'b2': -1, 'b3': -1, 'cuts': CAST([] AS INTEGER[])}}).cuts AS cuts FROM a),
e AS (SELECT doc_id, text, list_append(cuts, CAST(length(text) AS INTEGER)) AS ends FROM f),
c AS (SELECT doc_id, i, regexp_replace(substr(text, b + 1, ends[i] - b), {duck_str("^" + WS_RE2 + "|" + WS_RE2 + "$")}, '', 'g') AS t
      FROM (SELECT *, CASE WHEN i > 1 THEN greatest(ends[i - 1] - {SPLIT_CHUNK_OVERLAP}, 0) ELSE 0 END AS b
            FROM (SELECT doc_id, text, ends, unnest(generate_series(1, len(ends))) AS i FROM e)))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS chunk_ord, CAST(length(t) AS INTEGER) AS n_chars,
       t AS text FROM c WHERE t <> ''"""


@register("split_text_separators", _SPLIT_SQL)
def q_split_text_separators(spark, sf_dir):
    """C4 separator form."""
    d = _docs(spark, sf_dir)
    return (explode_rows(d, ["doc_id"], split_text_separators(F.col("text")), "text", "chunk_ord")
            .select("doc_id", "chunk_ord", F.length("text").alias("n_chars"), "text"))


@register("ask_documents", f"""WITH {_RETRIEVE_CTE},
qw AS (SELECT question_ord, list_distinct(list_filter(string_split_regex(lower(question), {_W}),
                                                      lambda w: w <> '' AND length(w) >= 4)) AS qw
       FROM (VALUES {_Q_VALUES}) v(question_ord, question)),
s AS (SELECT doc_id, question_ord, question, rank, j - 1 AS sentence_ord, ss[j] AS sentence
      FROM (SELECT doc_id, question_ord, question, rank, string_split(t, '. ') AS ss,
                   unnest(generate_series(1, len(string_split(t, '. ')))) AS j FROM __top)),
o AS (SELECT s.*, len(list_intersect(qw.qw, list_distinct(list_filter(string_split_regex(lower(s.sentence), {_W}),
                                                                       lambda w: w <> '')))) AS overlap
      FROM s JOIN qw USING (question_ord)),
b AS (SELECT doc_id, question_ord, question, arg_min(sentence, (-overlap, rank, sentence_ord)) AS sentence,
             max(overlap) AS mo FROM o GROUP BY doc_id, question_ord, question),
n AS (SELECT doc_id, question_ord, count(*) AS n, md5(string_agg(t || '@documents/' || CAST(doc_id AS VARCHAR), '|' ORDER BY rank)) AS s
      FROM __top GROUP BY doc_id, question_ord)
SELECT b.doc_id, b.question_ord, b.question, CASE WHEN mo > 0 THEN sentence ELSE '' END AS answer,
       CAST(n.n AS INTEGER) AS n_sources, n.s AS sources_md5
FROM b JOIN n USING (doc_id, question_ord)""")
def q_ask_documents(spark, sf_dir):
    r = RT.ask_documents(_docs(spark, sf_dir), DEFAULT_QUESTIONS)
    cited = F.array_join(F.transform("source_documents", lambda s: F.concat_ws("@", s["text"], s["source"])), "|")
    return r.select("doc_id", "question_ord", "question", "answer", F.size("source_documents").alias("n_sources"),
                    F.md5(cited).alias("sources_md5"))


@register("order_results", """
WITH n AS (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY l_orderkey)
SELECT o_orderkey AS doc_id, 1 AS n_tables, CAST(coalesce(c, 0) AS INTEGER) AS n_rows, 0 AS n_kv,
       'documents/orders/' || CAST(o_orderkey AS VARCHAR) AS document_path, 0 AS n_errors
FROM orders LEFT JOIN n ON l_orderkey = o_orderkey""")
def q_order_results(spark, sf_dir):
    """A12 fed by OCR blocks: one result per order with its table decoded from the encoded response."""
    o = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"),
        F.concat(F.lit("documents/orders/"), F.col("o_orderkey").cast("string")).alias("document_path"))
    r = AS.process_documents(o, blocks=table_responses(spark, sf_dir))
    return r.select("doc_id", F.size("tables").alias("n_tables"),
                    F.coalesce(F.size(F.get("tables", 0)), F.lit(0)).alias("n_rows"),
                    F.size(F.map_keys("kv_pairs")).alias("n_kv"), "document_path", F.size("errors").alias("n_errors"))

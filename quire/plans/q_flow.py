"""Registered queries for sources and keys (S2 S3 S6 S7 C7), boxes (J4 P11), learning (J5 A13 A14) and
assembly (A10 A12 A16 O2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from quire.functions.spans import PII_PATTERNS
from quire.functions.text import with_chunks
from quire.operators import assembly as AS
from quire.operators import blocks as B
from quire.operators import boxes as BX
from quire.operators import classify as CL
from quire.operators.pii import detect_pii
from quire.operators.review import split_uri
from quire.plans import encode, lookups
from quire.plans.q_blocks import line_blocks
from quire.plans.q_entities import _CHUNK_SQL, _DICT_HITS_SQL, _PATTERN_ENTS
from quire.plans.q_text import _SPANS_SQL
from quire.plans.registry import register
from quire.session import materialize, read_table, scratch_path
from quire.sources import files as FS
from quire.sources.blocks import combine_pages, parse_blocks, response_status

_EXTS = (*FS.SUPPORTED_EXTENSIONS, ".html")
_EXTS_SQL = ", ".join(f"'{e}'" for e in _EXTS)


def _page_files(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", F.regexp_extract("url", r"^[A-Za-z]+://([^?#]*)", 1).alias("path"))


def _planned(spark, sf_dir):
    return FS.plan_upload(_page_files(spark, sf_dir), "documents", "raw", exts=_EXTS)


_PLAN_CTE = f"""
__f AS (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://([^?#]*)', 1) AS path FROM pages),
__n AS (SELECT page_id, path, regexp_extract(path, '([^/\\\\]*)[/\\\\]*$', 1) AS name FROM __f),
__x AS (SELECT page_id, path, name, lower(regexp_extract(name, '^.+(\\.[^.]+)$', 1)) AS ext FROM __n),
__pl AS (SELECT page_id, path, ext,
           CASE WHEN ext IN ({_EXTS_SQL}) THEN 'raw/' || replace(name, '\\', '/') END AS key,
           CASE WHEN ext IN ({_EXTS_SQL}) THEN 's3://documents/raw/' || replace(name, '\\', '/') END AS uri,
           CASE WHEN ext NOT IN ({_EXTS_SQL}) THEN 'Unsupported file format ''' || ext || '''' END AS error
         FROM __x)"""


@register("plan_upload", f"WITH {_PLAN_CTE} SELECT page_id, path, ext, key, uri, error FROM __pl")
def q_plan_upload(spark, sf_dir):
    return _planned(spark, sf_dir).select("page_id", "path", "ext", "key", "uri", "error")


@register("key_collisions", f"""WITH {_PLAN_CTE}
SELECT key, count(*) AS count FROM __pl WHERE key IS NOT NULL GROUP BY key HAVING count(*) > 1""")
def q_key_collisions(spark, sf_dir):
    return FS.key_collisions(_planned(spark, sf_dir))


@register("list_documents", f"WITH {_PLAN_CTE} SELECT page_id, key FROM __pl WHERE starts_with(key, 'raw/8')")
def q_list_documents(spark, sf_dir):
    return FS.list_documents(_planned(spark, sf_dir), "raw/8").select("page_id", "key")


@register("split_uri", f"""WITH {_PLAN_CTE}
SELECT page_id, regexp_extract(uri, '^s3://([^/]+)/(.*)$', 1) AS bucket, regexp_extract(uri, '^s3://([^/]+)/(.*)$', 2)
  AS object_key FROM __pl WHERE uri IS NOT NULL""")
def q_split_uri(spark, sf_dir):
    p = _planned(spark, sf_dir).where(F.col("uri").isNotNull())
    b, k = split_uri(F.col("uri"))
    return p.select("page_id", b.alias("bucket"), k.alias("object_key"))


_S4_SQL = """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'bytes' WHEN page_id % 4 < 3 THEN 's3' END AS input_kind,
  CASE page_id % 4 WHEN 1 THEN 's3://documents/' || key WHEN 2 THEN 's3://archive/' || key END AS input_uri,
  CASE WHEN page_id % 4 = 3 THEN 'Provide either s3_key or image_bytes' END AS error
FROM (SELECT page_id, 'raw/' || CAST(page_id AS VARCHAR) AS key FROM pages)"""


@register("resolve_input", _S4_SQL)
def q_resolve_input(spark, sf_dir):
    """S4 over pages: bytes, a key, a key in a bucket of its own, or neither."""
    m = F.col("page_id") % 4
    p = read_table(spark, sf_dir, "pages").select(
        "page_id", F.when(m == 0, F.col("html").cast("binary")).alias("content"),
        F.when(m != 3, F.concat(F.lit("raw/"), F.col("page_id").cast("string"))).alias("key"),
        F.when(m == 2, F.lit("archive")).alias("bucket"))
    return FS.resolve_input(p, "documents", bucket_col="bucket").select("page_id", "input_kind", "input_uri", "error")


@register("with_model", "SELECT doc_id, CAST(length(text) * 10 AS BIGINT) AS score FROM documents")
def q_with_model(spark, sf_dir):
    """U1 with a stub: a model loaded once per task scores whole batches."""
    from quire.functions.models import with_model

    def score(model, batch):
        return batch.assign(score=batch["text"].str.len() * model)[["doc_id", "score"]]

    return with_model(read_table(spark, sf_dir, "documents").select("doc_id", "text"), score, "doc_id long, score long", load=lambda: 10)


@register("key_collisions_flat", f"""WITH {_PLAN_CTE},
f AS (SELECT 'raw/' || CAST(page_id % 100 AS VARCHAR) || '.html' AS key FROM pages)
SELECT key, count(*) AS count FROM f GROUP BY key HAVING count(*) > 1""")
def q_key_collisions_flat(spark, sf_dir):
    """Flat base names collide across folders."""
    p = read_table(spark, sf_dir, "pages").select("page_id", F.format_string("d%d/%d.html", F.col("page_id"), F.col("page_id") % 100).alias("path"))
    return FS.key_collisions(FS.plan_upload(p, "documents", "raw", exts=_EXTS))


@register("layers", """
SELECT doc_id, lang AS document_type, CAST(CASE WHEN lang = 'en' THEN -n_chars ELSE n_chars END AS BIGINT) AS n_chars, true AS pruned
FROM documents WHERE lang IN ('en', 'fr')""")
def q_layers(spark, sf_dir):
    """A layer is written for every class, one class is run again, and two classes are read back from their folders alone."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("document_type"), F.col("n_chars").cast("long").alias("n_chars"))
    base = scratch_path(spark, "layers")
    FS.write_layers(docs, base, "classified")
    FS.write_layers(docs.where("document_type = 'en'").withColumn("n_chars", -F.col("n_chars")), base, "classified")
    folder = F.regexp_extract(F.input_file_name(), "document_type=([^/]+)/", 1)
    return FS.read_layer(spark, base, "classified", ["en", "fr"]).select(
        "doc_id", "document_type", "n_chars", (folder == F.col("document_type")).alias("pruned"))


@register("wrap_text", "SELECT doc_id, md5(text) AS text_md5, source FROM documents")
def q_wrap_text(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    w = FS.wrap_text(d.select("doc_id", "text", "source"), source=F.col("source"))
    return w.select("doc_id", F.md5("text").alias("text_md5"), F.col("metadata.source").alias("source"))


@register("combine_pages", """
SELECT doc_id, CAST(2 * (i - 1) AS INTEGER) AS ord, ls[i] AS text
FROM (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
      FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))""")
def q_combine_pages(spark, sf_dir):
    pages = encode.encode_line_pages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return B.text_lines(combine_pages(pages))


# ---------------------------------------------------------------- J4, P11

_LINES_CTE = """
__ls AS (SELECT doc_id, ls, unnest(generate_series(1, len(ls))) AS i
         FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents)),
__lines AS (SELECT doc_id, CAST(2 * (i - 1) AS INTEGER) AS ord, ls[i] AS text,
              CAST(i - 1 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS top FROM __ls)"""

_BOXES_SQL = f"""WITH {_LINES_CTE},
__pii AS (SELECT DISTINCT doc_id, lower(text) AS p FROM ({_SPANS_SQL}) WHERE text <> ''),
__hit AS (SELECT DISTINCT l.doc_id, l.ord, l.text, l.top FROM __lines l JOIN __pii p
          ON p.doc_id = l.doc_id AND contains(lower(l.text), p.p))"""


def _boxes(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return BX.redaction_boxes(line_blocks(spark, sf_dir), detect_pii(docs))


@register("redaction_boxes", _BOXES_SQL + """
SELECT doc_id, ord, CAST(0.1 AS DOUBLE) AS "left", round(top, 6) AS top, CAST(0.8 AS DOUBLE) AS width,
       CAST(0.01 AS DOUBLE) AS height, text FROM __hit""")
def q_redaction_boxes(spark, sf_dir):
    return _boxes(spark, sf_dir).withColumn("top", F.round("top", 6))


@register("box_to_pixels", _BOXES_SQL + """
SELECT doc_id, ord,
  CAST(trunc(CAST(0.1 AS DOUBLE) * 1700) AS INTEGER) AS x0, CAST(trunc(top * 2200) AS INTEGER) AS y0,
  CAST(trunc(CAST(0.1 AS DOUBLE) * 1700) AS INTEGER) + CAST(trunc(CAST(0.8 AS DOUBLE) * 1700) AS INTEGER) AS x1,
  CAST(trunc(top * 2200) AS INTEGER) + CAST(trunc(CAST(0.01 AS DOUBLE) * 2200) AS INTEGER) AS y1
FROM __hit""")
def q_box_to_pixels(spark, sf_dir):
    return BX.box_to_pixels(_boxes(spark, sf_dir), 1700, 2200).select("doc_id", "ord", "x0", "y0", "x1", "y1")


# ---------------------------------------------------------------- J5, A13, A14

def _training(spark, sf_dir):
    return CL.training_set(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                           read_table(spark, sf_dir, "labels"))


@register("training_set", """
SELECT d.doc_id, CAST(l.quality AS VARCHAR) AS label, md5(d.text) AS text_md5
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""")
def q_training_set(spark, sf_dir):
    return _training(spark, sf_dir).select("doc_id", "label", F.md5("text").alias("text_md5"))


@register("classify")
def q_classify(spark, sf_dir):
    """A13 + A14 (no SQL oracle: a fitted model): train on labelled documents, score every document."""
    models = CL.train_classifier(_training(spark, sf_dir), max_iter=20)
    return CL.classify(read_table(spark, sf_dir, "documents").select("doc_id", "text"), models["label"])


@register("classify_invariants", """
SELECT doc_id, CAST((SELECT count(DISTINCT quality) FROM labels) AS INTEGER) AS n_classes, true AS ranks_in_order, true AS scores_add_up
FROM documents""")
def q_classify_invariants(spark, sf_dir):
    """A14 + W1: per document, a rank for every learned class from the best score down, and scores that sum to 1 within rounding."""
    c = q_classify(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "class"))).alias("c"))
    n = F.size("c")
    falling = F.aggregate("c", F.struct(F.lit(True).alias("ok"), F.lit(2.0).alias("s"), F.lit(0).alias("r")), lambda a, x: F.struct(
        (a["ok"] & (x["score"] <= a["s"]) & (x["rank"] == a["r"] + 1)).alias("ok"), x["score"].alias("s"), x["rank"].alias("r")))
    total = F.aggregate("c", F.lit(0.0), lambda a, x: a + x["score"])
    return c.select("doc_id", F.size(F.array_distinct(F.transform("c", lambda x: x["class"]))).alias("n_classes"),
                    (falling["ok"] & (falling["r"] == n)).alias("ranks_in_order"), (F.abs(total - 1) <= n * 0.0001).alias("scores_add_up"))


@register("classify_multilabel")
def q_classify_multilabel(spark, sf_dir):
    """A13 multi-label mode: one binary model per label (quality, toxic); scores of the positive class."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels")
    train = docs.join(lab, "doc_id").select("text", F.col("quality").cast("string").alias("quality"),
                                            F.col("toxic").cast("string").alias("toxic"))
    models = CL.train_classifier(train, CL.MULTI_LABEL, ("quality", "toxic"), max_iter=20)
    out = None
    for name, m in models.items():
        s = CL.classify(docs, m).where(F.col("class") == "1").select("doc_id", F.lit(name).alias("label"), "score")
        out = s if out is None else out.unionByName(s)
    return out


# ---------------------------------------------------------------- A12, A10, O2, A16

def _results(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    el = lookups.entity_list(read_table(spark, sf_dir, "benchmark"))
    return AS.process_documents(docs, el, lookups.DEFAULT_QUESTIONS)


@register("process_documents")
def q_process_documents(spark, sf_dir):
    """A12 (ROWS): one 17-field nested result row per document."""
    return _results(spark, sf_dir)


_SUMMARY_SQL = f"""
WITH pe AS ({_PATTERN_ENTS}), de AS ({_DICT_HITS_SQL}), sp AS ({_SPANS_SQL}),
e AS (SELECT doc_id, count(*) AS n FROM (SELECT doc_id FROM pe UNION ALL SELECT doc_id FROM de) GROUP BY doc_id),
p AS (SELECT doc_id, count(*) AS n FROM sp GROUP BY doc_id)
SELECT d.doc_id, 'N/A' AS document_type, 0 AS n_tables, 0 AS n_kv, CAST(coalesce(e.n, 0) AS INTEGER) AS n_entities,
       CAST(coalesce(p.n, 0) AS INTEGER) AS n_pii, 0 AS kv_more,
       CASE WHEN length(d.text) > 0 THEN 3 ELSE 0 END AS n_answers, 0 AS n_errors
FROM documents d LEFT JOIN e ON e.doc_id = d.doc_id LEFT JOIN p ON p.doc_id = d.doc_id"""


@register("document_summary", _SUMMARY_SQL)
def q_document_summary(spark, sf_dir):
    s = AS.document_summary(_results(spark, sf_dir))
    return s.select("doc_id", "document_type", "n_tables", "n_kv", "n_entities", "n_pii", "kv_more",
                    F.size("answers").alias("n_answers"), "n_errors")


@register("summary_fields", """WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang, doc_id % 14 AS n, doc_id % 11 = 10 AS failed,
  doc_id % 9 / 8.0 AS score FROM documents)
SELECT doc_id, 'in/' || doc_id AS document_path, CASE WHEN failed OR doc_id % 4 = 0 OR lang = '' THEN 'N/A' ELSE lang END AS document_type,
  CASE WHEN failed OR score = 0 THEN 'N/A' ELSE printf('%.2f%%', score * 100) END AS confidence,
  CASE WHEN failed THEN '' WHEN length(t) > 300 THEN substr(t, 1, 300) || '...' ELSE t END AS preview,
  CAST(CASE WHEN failed THEN 0 ELSE doc_id % 3 END AS INTEGER) AS n_tables, CAST(CASE WHEN failed THEN 0 ELSE n END AS INTEGER) AS n_kv,
  CAST(CASE WHEN failed THEN 0 ELSE doc_id % 5 END AS INTEGER) AS n_entities, CAST(CASE WHEN failed THEN 0 ELSE doc_id % 6 END AS INTEGER) AS n_pii,
  CASE WHEN failed THEN '' ELSE array_to_string(list_transform(generate_series(1, least(n, 10)), lambda i: 'k' || i || '=' || (doc_id + i)), ';') END AS kv_first,
  CAST(CASE WHEN failed THEN 0 ELSE greatest(n - 10, 0) END AS INTEGER) AS kv_more,
  CASE WHEN failed THEN '' ELSE 'q=' || lang END AS query_answers, CASE WHEN failed THEN '' ELSE substr(t, 1, 200) || '|short' END AS answers,
  CAST(CASE WHEN failed THEN 1 ELSE doc_id % 2 END AS INTEGER) AS n_errors FROM d""")
def q_summary_fields(spark, sf_dir):
    """A10/P10 over results of every shape: no, some and more than ten pairs, scores of zero, no type, long answers, failed inputs."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("raw_text"), F.coalesce("lang", F.lit("")).alias("lang"))
    d = d.withColumn("document_path", F.concat(F.lit("in/"), "doc_id"))
    i = F.col("doc_id").cast("int")

    def times(x, n):
        return F.array_repeat(F.lit(x), n)

    pairs = F.transform(F.when(i % 14 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), i % 14)), lambda k: F.struct(
        F.concat(F.lit("k"), k), (F.col("doc_id") + k).cast("string")))
    good = d.where(i % 11 != 10).select(
        "doc_id", "document_path", "raw_text", F.when(i % 4 == 0, F.lit("")).otherwise(F.col("lang")).alias("document_type"),
        (i % 9 / F.lit(8.0)).alias("classification_confidence"), times("t", i % 3).alias("tables"), F.map_from_entries(pairs).alias("kv_pairs"),
        times("e", i % 5).alias("entities"), times("p", i % 6).alias("pii_entities"), F.create_map(F.lit("q"), "lang").alias("query_answers"),
        F.array(F.struct(F.col("raw_text").alias("answer")), F.struct(F.lit("short").alias("answer"))).alias("genai_answers"),
        times("error", i % 2).alias("errors"))
    failed = AS.failed_results(d.where(i % 11 == 10).withColumn("error", F.lit("upload failed")))

    def joined(entries):
        return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")

    s = AS.document_summary(AS.batch_results(good, failed))
    return s.withColumn("kv_first", joined(F.col("kv_first"))).withColumn("query_answers", joined(F.map_entries("query_answers"))).withColumn(
        "answers", F.array_join("answers", "|"))


# Inputs with planted failures: of every 50 documents one has a corrupt response, one a blank page, one a failed upload, one errors
# of later phases, one no response.
_KIND_SQL = """CASE doc_id % 50 WHEN 7 THEN 'corrupt' WHEN 8 THEN 'blank' WHEN 9 THEN 'upload' WHEN 10 THEN 'later' WHEN 11 THEN 'none'
  ELSE 'fine' END"""


def _planted(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("kind", F.expr(_KIND_SQL))
    coded = encode.encode_lines(docs.select("doc_id", "text"))
    raw = coded.join(docs.select("doc_id", "kind"), "doc_id").where("kind <> 'none'").withColumn(
        "response", F.when(F.col("kind") == "corrupt", F.concat(F.lit("{"), F.col("response")))
        .when(F.col("kind") == "blank", F.lit('{"Blocks": []}')).otherwise(F.col("response"))).select("doc_id", "response")
    later = docs.where("kind IN ('later', 'upload')").select("doc_id", F.explode(F.array(
        F.struct(F.lit("review").alias("phase"), F.lit("Review failed").alias("error")),
        F.struct(F.lit("queries").alias("phase"), F.lit("Queries failed").alias("error")))).alias("e")).select("doc_id", "e.*")
    upload = docs.where("kind = 'upload'").select("doc_id", F.lit("upload").alias("phase"), F.lit("Upload failed").alias("error"))
    identity = docs.where("kind <> 'none'").select("doc_id", F.explode(F.array(
        F.struct(F.lit("NUMBER").alias("type"), F.col("doc_id").cast("string").alias("value")),
        F.struct(F.lit("KIND").alias("type"), F.col("kind").alias("value")))).alias("f")).select("doc_id", "f.*")
    raw = materialize(raw, "responses")
    return AS.process_documents(docs.select("doc_id"), lookups.entity_list(read_table(spark, sf_dir, "benchmark")),
                                blocks=materialize(parse_blocks(raw), "result-blocks"), responses=response_status(raw),
                                phase_errors=upload.unionByName(later), identity=identity)


_PLANTED_CTE = f"""
k AS (SELECT doc_id, text, {_KIND_SQL} AS kind FROM documents),
t AS (SELECT doc_id, kind, CASE WHEN kind IN ('fine', 'later') THEN text ELSE '' END AS text FROM k)"""


_QUESTIONS_SQL = "'" + "|".join(q.replace("'", "''") for q in AS.DEFAULT_QUESTIONS) + "'"


@register("process_results", f"""
WITH pe AS ({_PATTERN_ENTS}), de AS ({_DICT_HITS_SQL}), sp AS ({_SPANS_SQL}), {_PLANTED_CTE},
e AS (SELECT doc_id, string_agg(type || ':' || CAST(begin_offset AS VARCHAR) || ':' || text, ',' ORDER BY source, begin_offset, end_offset, text, type) AS s
      FROM (SELECT 0 AS source, doc_id, begin_offset, end_offset, text, type FROM pe UNION ALL
            SELECT 1, doc_id, begin_offset, end_offset, text, type FROM de) GROUP BY doc_id),
p AS (SELECT doc_id, string_agg(type || ':' || CAST(begin_offset AS VARCHAR), ',' ORDER BY span_ord) AS s FROM sp GROUP BY doc_id),
a AS (SELECT t.*, e.s AS ents, p.s AS pii FROM t LEFT JOIN e ON e.doc_id = t.doc_id LEFT JOIN p ON p.doc_id = t.doc_id)
SELECT doc_id, 'document_path' AS field, 'documents/' || CAST(doc_id AS VARCHAR) AS value FROM a
UNION ALL SELECT doc_id, 'raw_text', md5(text) FROM a
UNION ALL SELECT doc_id, 's3_uri', CASE WHEN kind = 'upload' THEN '' ELSE 's3://documents/documents/' || CAST(doc_id AS VARCHAR) END FROM a
UNION ALL SELECT doc_id, 'entities', CASE WHEN text <> '' THEN md5(coalesce(ents, '')) ELSE md5('') END FROM a
UNION ALL SELECT doc_id, 'redacted_length', CAST(CASE WHEN text <> '' AND pii IS NOT NULL THEN length(text) ELSE 0 END AS VARCHAR) FROM a
UNION ALL SELECT doc_id, 'defaults', '||0|0|0|0|false|' FROM a
UNION ALL SELECT doc_id, 'pii', CASE WHEN text <> '' THEN coalesce(pii, '') ELSE '' END FROM a
UNION ALL SELECT doc_id, 'answers', CASE WHEN text <> '' THEN {_QUESTIONS_SQL} ELSE '' END FROM a
UNION ALL SELECT doc_id, 'id_fields', CASE WHEN kind IN ('none', 'upload') THEN '' ELSE 'KIND=' || kind || '|NUMBER=' || CAST(doc_id AS VARCHAR) END FROM a
UNION ALL SELECT doc_id, 'errors', CASE kind WHEN 'corrupt' THEN 'Extraction failed: response is not valid JSON'
  WHEN 'upload' THEN 'Upload failed' WHEN 'later' THEN 'Queries failed|Review failed' WHEN 'none' THEN 'Extraction failed: no text'
  ELSE '' END FROM a""")
def q_process_results(spark, sf_dir):
    """A12 with F4: the fields of every result in long form, with planted failures."""
    r = _planted(spark, sf_dir)
    pii = F.array_join(F.transform("pii_entities", lambda p: F.concat_ws(":", p["type"], p["begin_offset"].cast("string"))), ",")
    ids = F.array_join(F.transform(F.array_sort(F.map_entries("id_fields")), lambda e: F.concat_ws("=", e["key"], e["value"])), "|")
    ents = F.array_join(F.transform("entities", lambda e: F.concat_ws(":", e["type"], e["begin_offset"].cast("string"), e["text"])), ",")
    # what no input of this query fills: type, confidence, tables, pairs, expenses, answers to queries, review
    defaults = F.concat_ws("|", "document_type", F.lit(""), F.size("tables") + F.col("classification_confidence").cast("int"), F.size("kv_pairs"),
                           F.size("expense_data.documents"), F.size("query_answers"), F.col("human_review_triggered"), "human_review_arn")
    fields = {"document_path": F.col("document_path"), "raw_text": F.md5("raw_text"), "s3_uri": F.col("s3_uri"),
              "entities": F.md5(ents), "pii": pii, "redacted_length": F.length("redacted_text").cast("string"), "defaults": defaults,
              "answers": F.array_join(F.transform("genai_answers", lambda a: a["question"]), "|"), "id_fields": ids,
              "errors": F.array_join("errors", "|")}
    return r.select("doc_id", F.explode(F.array(*[F.struct(F.lit(n).alias("field"), c.alias("value")) for n, c in fields.items()])
                                        ).alias("f")).select("doc_id", "f.field", "f.value")


@register("batch_results", f"""WITH {_PLANTED_CTE}
SELECT doc_id, 'documents/' || CAST(doc_id AS VARCHAR) AS document_path,
       CASE kind WHEN 'corrupt' THEN 'Extraction failed: response is not valid JSON' WHEN 'upload' THEN 'Upload failed' ELSE '' END AS errors,
       CASE WHEN kind IN ('corrupt', 'upload') THEN NULL ELSE md5(text) END AS text_md5
FROM t WHERE kind <> 'none' AND kind <> 'later'""")
def q_batch_results(spark, sf_dir):
    """O2: results of the documents that were read, and rows for those that failed before."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", F.expr(_KIND_SQL).alias("kind"))
    good = AS.process_documents(docs.where("kind IN ('fine', 'blank')").select(
        "doc_id", F.when(F.col("kind") == "fine", F.col("text")).otherwise("").alias("text")), questions=[])
    bad = docs.where("kind IN ('corrupt', 'upload')").select(
        "doc_id", F.concat(F.lit("documents/"), F.col("doc_id").cast("string")).alias("document_path"),
        F.when(F.col("kind") == "upload", "Upload failed").otherwise("Extraction failed: response is not valid JSON").alias("error"))
    r = AS.batch_results(good, AS.failed_results(bad))
    return r.select("doc_id", "document_path", F.array_join("errors", "|").alias("errors"), F.md5("raw_text").alias("text_md5"))


@register("rebased_spans", f"""
WITH sp AS ({_SPANS_SQL}) SELECT doc_id, type, begin_offset, end_offset FROM sp""")
def q_rebased_spans(spark, sf_dir):
    """Spans found in fixed pieces of a text, moved to the text's offsets. Pieces are whole lines, so no span is cut."""
    from quire.functions.spans import with_spans
    from quire.functions.text import rebase_spans

    d = read_table(spark, sf_dir, "documents").select("doc_id", F.split("text", "(?<=\n)", -1).alias("pieces"))
    p = d.select("doc_id", F.posexplode("pieces").alias("piece_ord", "piece"))
    return rebase_spans(with_spans(p, "piece", "spans", PII_PATTERNS), "piece", "spans").select(
        "doc_id", "type", "begin_offset", "end_offset")


@register("run_metrics", f"""
SELECT (SELECT count(*) FROM documents) AS n_documents, (SELECT count(*) FROM ({_SPANS_SQL})) AS n_pii,
       (SELECT count(*) FROM ({_CHUNK_SQL} SELECT * FROM x)) AS n_chunks""")
def q_run_metrics(spark, sf_dir):
    """A16 as a query: the per-phase counts the reference only logs, in one pass over the documents.

    (``assembly.run_metrics`` attaches the same counts to a running job with ``observe``.)"""
    from quire.functions.spans import with_spans

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    per_doc = with_chunks(with_spans(docs, "text", "pii", PII_PATTERNS)).select(
        F.size("pii").alias("p"), F.size("chunks").alias("c"))
    return per_doc.agg(F.count("*").alias("n_documents"), F.sum("p").alias("n_pii"), F.sum("c").alias("n_chunks"))

"""Per-document result assembly (A12), batch results (O2), summaries (A10) and run metrics.

The reference loops over documents and fills one result object per document, catching errors per phase.
Here every phase is a DataFrame keyed by ``doc_id``; the result is a left join of the phase outputs onto the
input documents, and errors are data (``errors array<string>``), so one bad document never stops the batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quire.functions.numbers import round_exact
from quire.functions.spans import PII_PATTERNS, preview, redact, with_spans
from quire.operators import entities as EN
from quire.operators import retrieval as RT
from quire.operators.review import LOOP_PREFIX, loop_id, make_uri, needs_review
from quire.session import materialize

ENTITY_STRUCT = "struct<text:string,type:string,score:double,begin_offset:int,end_offset:int>"


def _entity_structs(ents: DataFrame) -> DataFrame:
    """Entities of each document as an ordered array (by source, offsets): the result row's ``entities``."""
    return ents.groupBy("doc_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("source", "begin_offset", "end_offset", "text", "type", "score"))),
        lambda e: F.struct(e["text"].alias("text"), e["type"].alias("type"), e["score"].alias("score"),
                           e["begin_offset"].alias("begin_offset"), e["end_offset"].alias("end_offset")))
                                              .alias("entities"))


# The phases in which a document can fail, in their order; tables and forms are later steps of extraction.
PHASES = ("upload", "extraction", "tables", "forms", "classification", "queries", "entities", "pii", "questions", "review")
# The questions asked when none are given.
DEFAULT_QUESTIONS = (
    "What is this document about?",
    "What are the key data points in this document?",
    "Are there any dates or deadlines mentioned?",
)
# Extensions for which the pipeline asks for expense analysis (the reference omits '.tif').
EXPENSE_EXTENSIONS = (".pdf", ".png", ".jpg", ".jpeg", ".tiff", ".tif")


def phase_guards(df: DataFrame, text_col: str = "text", ext_col: str | None = None) -> DataFrame:
    """Which phases run for a document: text phases only with non-empty text; expense only for image/PDF
    extensions (we include '.tif', which the reference's list leaves out)."""
    has_text = F.coalesce(F.length(text_col), F.lit(0)) > 0
    out = df.withColumn("run_classify", has_text).withColumn("run_enrichment", has_text).withColumn(
        "run_qa", has_text)
    if ext_col:
        out = out.withColumn("run_expense", F.lower(F.col(ext_col)).isin(list(EXPENSE_EXTENSIONS)))
    return out


def _from_blocks(blocks: DataFrame) -> DataFrame:
    """Extraction phase from OCR blocks: raw text (LINEs joined by newlines), tables, KV map, query answers."""
    from quire.operators import blocks as B

    text = B.document_text(blocks, "\n").withColumnRenamed("text", "block_text")
    tables = B.table_grids(blocks)
    kv = B.kv_map(B.kv_pairs(blocks))
    qa = (B.query_answers(B.answer_details(blocks)).groupBy("doc_id")
          .agg(F.map_from_entries(F.collect_list(F.struct("alias", "answer"))).alias("query_answers")))
    present = blocks.select("doc_id").distinct().withColumn("__has_blocks", F.lit(True))
    return (present.join(text, "doc_id", "left").join(tables, "doc_id", "left").join(kv, "doc_id", "left")
            .join(qa, "doc_id", "left"))


def _with_responses(base: DataFrame, responses: DataFrame) -> DataFrame:
    """``base`` with the columns of ``_from_blocks``, from responses ``(doc_id, response)``: a short one that is its document's only one
    is parsed and decoded in its row; the others are read again, as blocks. The result is written once."""
    from quire.operators import blocks as B
    from quire.sources.blocks import parse_blocks, parse_documents

    rows = B.decode_documents(parse_documents(responses)).withColumn("__response", F.monotonically_increasing_id())
    out = materialize(base.join(rows, "doc_id", "left"), "decoded")
    several = F.min("__response") != F.max("__response")
    others = out.groupBy("doc_id").agg((several | F.max("long")).alias("other")).where("other").select("doc_id")
    decoded = out.drop("__response", "long")
    if others.isEmpty():
        return decoded
    others = materialize(others, "other-documents")
    blocks = materialize(parse_blocks(responses.join(others, "doc_id", "left_semi")), "other-blocks")
    again = base.join(others, "doc_id", "left_semi").join(_from_blocks(blocks), "doc_id", "left")
    return materialize(decoded.join(others, "doc_id", "left_anti").unionByName(again), "decoded")


def process_documents(docs: DataFrame, entity_list: DataFrame | None = None,
                      questions: Sequence[str] | None = None, classes: DataFrame | None = None,
                      bucket: str = "documents", review_threshold: float = 0.90,
                      enable_review: bool = True, blocks: DataFrame | None = None,
                      expense: DataFrame | None = None, responses: DataFrame | None = None,
                      identity: DataFrame | None = None, phase_errors: DataFrame | None = None) -> DataFrame:
    """One result row per input document (17 fields + ``doc_id``), failures included with ``errors``.

    ``docs(doc_id, text?, document_path?)``. ``blocks`` (parsed OCR blocks, or the responses ``(doc_id, response)`` themselves, most of which
    are then decoded in their row) fills raw text, tables, KV pairs and query answers; ``expense`` (``doc_id, expense_data``) the expense field; ``classes(doc_id, document_type,
    classification_confidence, error?)`` the classification (skipped without it, as without an endpoint);
    ``identity`` (``doc_id, type, value``) the identity fields; ``questions=None`` asks the default questions, an empty
    list none. ``responses`` (``doc_id, error``, see ``response_status``) tells which documents have a response: a blank
    page is an empty text, not a failure, and a corrupt response is an error.

    Phase guards (P7): entities, PII and Q&A run only for non-empty text, expense only for its extensions. Errors (F4)
    are data: a missing text is an extraction failure, ``phase_errors`` (``doc_id, phase, error``) come from the phases outside
    and stand in the order of ``PHASES``. The fields of a failed phase stay at their defaults. A failed upload ends its
    document: every field but the path stays at its default and no later error is reported. A failed step of extraction
    (``extraction``, ``tables``, ``forms``) skips the steps of extraction after it. One bad document never stops the batch.
    """
    questions = DEFAULT_QUESTIONS if questions is None else questions
    path = F.col("document_path") if "document_path" in docs.columns else F.concat(
        F.lit("documents/"), F.col("doc_id").cast("string"))
    text = F.col("text") if "text" in docs.columns else F.lit(None).cast("string")
    base = docs.select("doc_id", path.alias("document_path"), text.alias("raw_text"))
    failures = []
    if phase_errors is not None:
        failures.append(phase_errors.select("doc_id", "phase", "error"))
        base = base.join(phase_errors.groupBy("doc_id").agg(F.collect_set("phase").alias("__failed")), "doc_id", "left")
    else:
        base = base.withColumn("__failed", F.lit(None).cast("array<string>"))

    def unless(phase: str, value: Column) -> Column:
        """``value``, or null where the phase failed or never ran: each phase depends on the upload, a step of extraction on the
        steps before it."""
        steps = PHASES[1:4]
        needs = ("upload", *(steps[:steps.index(phase) + 1] if phase in steps else (phase,)))
        return F.when(~F.arrays_overlap(F.coalesce("__failed", F.array().cast("array<string>")),
                                        F.array(*[F.lit(p) for p in needs])), value)

    if responses is not None:
        failures.append(responses.where(F.col("error").isNotNull()).select("doc_id", F.lit("extraction").alias("phase"), "error"))
        there = responses.where(F.col("error").isNull()).select("doc_id").distinct().withColumn("__blank", F.lit(""))
    if blocks is not None:
        decoded = "response" in blocks.columns
        base = ((_with_responses(base, blocks) if decoded else base.join(_from_blocks(blocks), "doc_id", "left"))
                .withColumn("raw_text", F.coalesce("raw_text", F.when(F.col("__has_blocks"), F.coalesce("block_text", F.lit("")))))
                .drop("block_text", "__has_blocks"))
    else:
        base = (base.withColumn("tables", F.lit(None).cast("array<array<array<string>>>"))
                .withColumn("kv_pairs", F.lit(None).cast("map<string,string>"))
                .withColumn("query_answers", F.lit(None).cast("map<string,string>")))
    if responses is not None:
        base = base.join(there, "doc_id", "left").withColumn("raw_text", F.coalesce("raw_text", F.col("__blank"))).drop("__blank")
    if identity is not None:
        ids = identity.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("type", "value"))))
                                             .alias("id_fields"))
        base = base.join(ids, "doc_id", "left")
    else:
        base = base.withColumn("id_fields", F.lit(None).cast("map<string,string>"))
    if expense is not None:
        ext = F.lower(F.regexp_extract("document_path", r"(\.[^./]+)$", 1))
        base = base.join(expense.select("doc_id", "expense_data"), "doc_id", "left").withColumn(
            "expense_data", F.when(ext.isin(list(EXPENSE_EXTENSIONS)), F.col("expense_data")))
    else:
        base = base.withColumn("expense_data", F.lit(None).cast(
            "struct<documents:array<struct<summary_fields:map<string,string>,line_items:array<map<string,string>>>>>"))
    for field, phase in (("raw_text", "extraction"), ("id_fields", "extraction"), ("tables", "tables"), ("kv_pairs", "forms"),
                         ("expense_data", "forms"), ("query_answers", "queries")):
        base = base.withColumn(field, unless(phase, F.col(field)))
    if blocks is not None and not (decoded and responses is None and identity is None and expense is None):
        base = materialize(base, "extracted")  # the block decode feeds every phase below: do it once
    base = base.withColumn("s3_uri", make_uri(F.lit(bucket), F.col("document_path")))
    has_text = F.coalesce(F.length("raw_text"), F.lit(0)) > 0

    # PII and redaction: in-row.
    base = with_spans(base, "raw_text", "__spans", PII_PATTERNS)
    base = (base.withColumn("__pii", F.coalesce(F.when(has_text, unless("pii", F.col("__spans"))), F.array().cast(
        "array<struct<type:string,begin_offset:int,end_offset:int,text:string,score:double>>"))).drop("__spans")
            .withColumn("redacted_text", F.when(F.size("__pii") > 0, redact(F.col("raw_text"), F.col("__pii")))
                        .otherwise(F.lit(""))))

    # Entities: pattern (built-in) then dictionary (custom) ones.
    tdocs = base.where(has_text).select("doc_id", F.col("raw_text").alias("text"), "document_path")
    ents = EN.pattern_entities(tdocs)
    if entity_list is not None:
        ents = EN.all_entities(ents, EN.dictionary_entities(tdocs, entity_list))
    else:
        ents = ents.withColumn("source", F.lit(0))
    # The per-document phase outputs are small and already grouped by doc_id: they are combined first (joins
    # between tables partitioned the same way need no exchange), so the document rows are shuffled only once.
    per_doc = _entity_structs(ents)

    # Retrieval Q&A.
    if questions:
        qa = RT.ask_documents(tdocs, questions)
        ga = qa.groupBy("doc_id").agg(F.transform(
            F.array_sort(F.collect_list(F.struct("question_ord", "question", "answer", "source_documents"))),
            lambda a: F.struct(a["question"].alias("question"), a["answer"].alias("answer"),
                               a["source_documents"].alias("source_documents"))).alias("genai_answers"))
        per_doc = per_doc.join(ga, "doc_id", "full")
    else:
        per_doc = per_doc.withColumn("genai_answers", F.lit(None))

    if classes is not None:
        cerr = F.col("error") if "error" in classes.columns else F.lit(None).cast("string")
        per_doc = per_doc.join(classes.select("doc_id", "document_type", "classification_confidence",
                                              cerr.alias("__class_error")), "doc_id", "full")
    else:
        per_doc = (per_doc.withColumn("document_type", F.lit(None).cast("string"))
                   .withColumn("classification_confidence", F.lit(None).cast("double"))
                   .withColumn("__class_error", F.lit(None).cast("string")))
    if failures:
        every = failures[0] if len(failures) == 1 else failures[0].unionByName(failures[1])
        place = F.array_position(F.array(*[F.lit(p) for p in PHASES]), F.col("phase")).cast("int")
        per_doc = per_doc.join(every.groupBy("doc_id").agg(F.collect_list(F.struct(place.alias("p"), F.col("error"))).alias("__errors")),
                               "doc_id", "full")
    else:
        per_doc = per_doc.withColumn("__errors", F.lit(None).cast("array<struct<p:int,error:string>>"))
    out = base.join(per_doc, "doc_id", "left")

    conf = F.coalesce(F.when(has_text, unless("classification", F.col("classification_confidence"))), F.lit(0.0))
    review = F.coalesce(unless("review", needs_review(conf, review_threshold) & F.lit(enable_review)), F.lit(False))
    given = F.coalesce("__errors", F.array().cast("array<struct<p:int,error:string>>"))

    def error(phase, text):
        return F.struct(F.lit(PHASES.index(phase) + 1).alias("p"), text.alias("error"))

    errors = F.array_sort(F.concat(given, F.array_compact(F.array(
        F.when(F.col("raw_text").isNull() & (F.size(given) == 0), error("extraction", F.lit("Extraction failed: no text"))),
        F.when(has_text & F.col("__class_error").isNotNull(), error("classification", F.col("__class_error"))),
    ))))
    errors = F.transform(F.filter(errors, lambda e: (e["p"] == 1) | ~F.exists(given, lambda g: g["p"] == 1)), lambda e: e["error"])
    empty_map = F.expr("map()").cast("map<string,string>")
    return out.select(
        "doc_id", "document_path", F.coalesce(unless("upload", F.col("s3_uri")), F.lit("")).alias("s3_uri"),
        F.coalesce(F.when(has_text, unless("classification", F.col("document_type"))), F.lit("")).alias("document_type"),
        conf.alias("classification_confidence"),
        F.coalesce("raw_text", F.lit("")).alias("raw_text"),
        F.coalesce("tables", F.array().cast("array<array<array<string>>>")).alias("tables"),
        F.coalesce("kv_pairs", empty_map).alias("kv_pairs"),
        F.coalesce("expense_data", F.struct(F.array().cast(
            "array<struct<summary_fields:map<string,string>,line_items:array<map<string,string>>>>").alias(
            "documents"))).alias("expense_data"),
        F.coalesce("id_fields", empty_map).alias("id_fields"),
        F.coalesce("query_answers", empty_map).alias("query_answers"),
        F.coalesce(unless("entities", F.col("entities")), F.array().cast(f"array<{ENTITY_STRUCT}>")).alias("entities"),
        F.transform("__pii", lambda p: F.struct(p["text"].alias("text"), p["type"].alias("type"),
                                                p["score"].alias("score"), p["begin_offset"].alias("begin_offset"),
                                                p["end_offset"].alias("end_offset"))).alias("pii_entities"),
        "redacted_text",
        F.coalesce(unless("questions", F.col("genai_answers")), F.array().cast(
            "array<struct<question:string,answer:string,source_documents:array<struct<text:string,source:string>>>>"))
        .alias("genai_answers"),
        review.alias("human_review_triggered"),
        F.when(review, loop_id(F.col("doc_id"))).otherwise(F.lit("")).alias("human_review_arn"),
        errors.alias("errors"),
    )


def failed_results(paths: DataFrame, error_col: str = "error") -> DataFrame:
    """Result rows for inputs that failed before any phase (O2's error side): defaults plus the error."""
    return paths.select("doc_id", F.col("document_path"), F.array(F.col(error_col)).alias("errors"))


def batch_results(good: DataFrame, failed: DataFrame) -> DataFrame:
    """O2: good and failed results in one DataFrame (``unionByName``); ``doc_id`` keeps the input order."""
    return good.unionByName(failed, allowMissingColumns=True)


def document_summary(results: DataFrame, max_kv: int = 10, answer_chars: int = 200) -> DataFrame:
    """A10/P10: per document counts of tables, KV pairs, entities and PII; the first ``max_kv`` KV pairs and how
    many more; answers cut to ``answer_chars``; query answers; errors; the start of the text; type and confidence as shown, 'N/A' for an empty
    type and for a confidence of zero. Fields that a failed input does not have (null) count as empty."""
    kv = F.coalesce(F.map_entries("kv_pairs"), F.expr("array()"))
    kind, score = F.coalesce("document_type", F.lit("")), F.col("classification_confidence")

    def count(array):
        return F.coalesce(F.size(array), F.lit(0))

    return results.select(
        "doc_id", "document_path",
        F.when(kind == "", F.lit("N/A")).otherwise(kind).alias("document_type"),
        F.when(F.coalesce(score, F.lit(0.0)) == 0, F.lit("N/A")).otherwise(
            F.format_string("%.2f%%", round_exact(score * 100, 2))).alias("confidence"),
        preview(F.coalesce("raw_text", F.lit(""))).alias("preview"),
        count("tables").alias("n_tables"), F.size(kv).alias("n_kv"),
        count("entities").alias("n_entities"), count("pii_entities").alias("n_pii"),
        F.slice(kv, 1, max_kv).alias("kv_first"),
        F.greatest(F.size(kv) - max_kv, F.lit(0)).alias("kv_more"), F.coalesce("query_answers", F.expr("map()").cast("map<string,string>")).alias("query_answers"),
        F.coalesce(F.transform("genai_answers", lambda a: F.substring(a["answer"], 1, answer_chars)), F.array().cast("array<string>")).alias("answers"),
        count("errors").alias("n_errors"))


def run_metrics(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """Attach named metrics to a DataFrame (``df.observe``); they are filled when an action runs.

    Returns ``(observed_df, observation)``; read ``observation.get`` after the action.
    """
    obs = Observation(name)
    exprs = [c.alias(k) for k, c in metrics.items()] or [F.count(F.lit(1)).alias("rows")]
    return df.observe(obs, *exprs), obs


__all__ = ["process_documents", "batch_results", "failed_results", "document_summary", "run_metrics", "LOOP_PREFIX"]

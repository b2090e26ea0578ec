"""Human-review flow as DataFrame operators (P6, C8, C9, F1, J13, A11, J14, S12, F2, F3, ST2/ST4 batch, W6).

Review loops are rows and their lifecycle is an event table; polling loops become joins and windows over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import explode_rows
from quire.schemas import REVIEW_OUTPUT

# Default review threshold and loop-name prefix.
REVIEW_THRESHOLD = 0.90
LOOP_PREFIX = "idp-review-"


def needs_review(score: Column, threshold: float = REVIEW_THRESHOLD) -> Column:
    """``0 < score < threshold`` (strict on both sides; the pipeline demands a positive score)."""
    return (score > 0) & (score < threshold)


def loop_id(doc_id: Column, name: Column | None = None) -> Column:
    """The given name, else ``idp-review-`` + sha256(doc_id) in hex: deterministic, so retries are idempotent (the
    reference draws them at random), and whole, so that different documents never share a loop."""
    gen = F.concat(F.lit(LOOP_PREFIX), F.sha2(doc_id.cast("string"), 256))
    return F.coalesce(name, gen) if name is not None else gen


def review_payload(uri: Column, document_type: Column, kv: Column, confidence: Column) -> Column:
    """JSON ``{taskObject, extractedData{document_type, kv_pairs, confidence}}``."""
    return F.to_json(F.struct(uri.alias("taskObject"), F.struct(
        document_type.alias("document_type"), kv.alias("kv_pairs"), confidence.alias("confidence")).alias(
        "extractedData")))


def review_queue(results: DataFrame, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """documents whose classification confidence needs review, with loop id and payload.

    ``results`` needs ``doc_id, s3_uri, document_type, classification_confidence`` and optionally ``kv_pairs``.
    """
    kv = F.col("kv_pairs") if "kv_pairs" in results.columns else F.expr("map()").cast("map<string,string>")
    return (results.where(needs_review(F.col("classification_confidence"), threshold))
            .select("doc_id", loop_id(F.col("doc_id")).alias("loop_id"), "document_type",
                    F.col("classification_confidence").alias("confidence"),
                    review_payload(F.col("s3_uri"), F.col("document_type"), kv,
                                   F.col("classification_confidence")).alias("payload"),
                    F.lit(True).alias("human_review_triggered")))


def evaluate_fields(docs: DataFrame, confidences: DataFrame, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """J13 + A11: per document ``(doc_id, review_needed, n_low, n_fields, low_confidence_fields, all_fields)``.

    Driven by the confidence table ``(doc_id, key, score)`` (with ``key_ord`` the lists keep its order, otherwise the
    keys'); ``all_fields`` lists ``(key, score)``; a key missing from the KV set still counts; a
    document without confidences needs no review. Confidences are aggregated first (partial aggregation
    map-side), then joined to the documents on ``doc_id``.
    """
    at = F.col("key_ord") if "key_ord" in confidences.columns else F.lit(0)
    agg = confidences.groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct(at.alias("at"), F.col("key"), F.col("score")))).alias("f"))
    low = F.filter("f", lambda x: x["score"] < threshold)
    agg = agg.select("doc_id", F.size("f").alias("n_fields"), F.size(low).alias("n_low"),
                     F.transform(low, lambda x: x["key"]).alias("low_confidence_fields"),
                     F.transform("f", lambda x: F.struct(x["key"].alias("key"), x["score"].alias("score"))).alias("all_fields"))
    return (docs.select("doc_id").join(agg, "doc_id", "left")
            .select("doc_id", (F.coalesce("n_low", F.lit(0)) > 0).alias("review_needed"),
                    F.coalesce("n_low", F.lit(0)).cast("int").alias("n_low"),
                    F.coalesce("n_fields", F.lit(0)).cast("int").alias("n_fields"),
                    F.coalesce("low_confidence_fields", F.expr("array()").cast("array<string>")).alias(
                        "low_confidence_fields"),
                    F.coalesce("all_fields", F.expr("array()").cast(agg.schema["all_fields"].dataType)).alias("all_fields")))


def low_confidence_fields(confidences: DataFrame, threshold: float = REVIEW_THRESHOLD) -> DataFrame:
    """A11 long form: ``(doc_id, key, score)`` of the fields below the threshold."""
    return confidences.where(F.col("score") < threshold)


def parse_review_output(df: DataFrame, json_col: str = "output") -> DataFrame:
    """Reviewer output JSON -> ``(doc_id, key, value)``; later answers overwrite earlier ones."""
    o = df.select("doc_id", F.from_json(json_col, REVIEW_OUTPUT).alias("o"))
    a = (explode_rows(o, ["doc_id"], F.col("o.humanAnswers"), "a", "a_ord")
         .select("doc_id", "a_ord", F.explode(F.coalesce("a.answerContent", F.expr("map()"))).alias("key", "value")))
    return a.groupBy("doc_id", "key").agg(F.max_by("value", "a_ord").alias("value"))


def read_review_output(spark, path: str) -> DataFrame:
    """S12 from files: one reviewer JSON per file; the file path is the ``doc_id``."""
    raw = (spark.read.option("wholetext", "true").text(path)
           .select(F.input_file_name().alias("doc_id"), F.col("value").alias("output")))
    return parse_review_output(raw)


def read_review_json(spark, path: str) -> DataFrame:
    """S12 from files, whole: ``(output_uri, output)``, the reviewer's JSON text under the address it was written to."""
    return spark.read.option("wholetext", "true").text(path).select(
        F.input_file_name().alias("output_uri"), F.col("value").alias("output"))


def loop_outputs(loops: DataFrame, outputs: DataFrame) -> DataFrame:
    """``loops(loop_id, doc_id, output_uri)`` with the whole output of each finished loop: ``(loop_id, doc_id, output_uri, output)``;
    null where nothing was written. ``parse_review_output`` turns it into corrections keyed by ``doc_id``. Addresses are compared
    without their scheme's slashes, which file systems write differently."""
    def place(c):
        return F.regexp_replace(F.col(c), "^([a-z0-9]+):/*", "$1:/")

    o = outputs.select(place("output_uri").alias("__at"), "output")
    return loops.withColumn("__at", place("output_uri")).join(o, "__at", "left").drop("__at")


def split_uri(uri: Column) -> tuple[Column, Column]:
    """``s3://bucket/key`` -> (bucket, key); anything else -> ('', '')."""
    return (F.regexp_extract(uri, r"^s3://([^/]+)/(.*)$", 1), F.regexp_extract(uri, r"^s3://([^/]+)/(.*)$", 2))


def make_uri(bucket: Column, key: Column) -> Column:
    """``s3://{bucket}/{key}``."""
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def apply_corrections(extracted: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Reviewed values replace extracted ones on ``(doc_id, key)``; unreviewed values pass through."""
    r = reviewed.select("doc_id", "key", F.col("value").alias("reviewed"))
    return (extracted.join(r, ["doc_id", "key"], "left")
            .select("doc_id", "key", F.coalesce("reviewed", "value").alias("value"),
                    F.col("reviewed").isNotNull().alias("corrected")))


# ---------------------------------------------------------------- loop lifecycle

def epoch_seconds(ts: Column) -> Column:
    """Seconds since 1970 of a wall-clock timestamp, independent of the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, ts.cast("timestamp_ntz")) / 1e6


def latest_loop_status(events: DataFrame) -> DataFrame:
    """F2 batch: current status of each loop from ``(loop_id, status, ts, event_id)``; ties by event id.

    ``max_by`` is a declarative aggregate, so a hot loop is pre-aggregated map-side before the shuffle.
    """
    return events.groupBy("loop_id").agg(
        F.max_by(F.struct("status", "ts"), F.struct("ts", "event_id")).alias("s")).select(
        "loop_id", F.col("s.status").alias("status"), F.col("s.ts").alias("ts"))


def stop_loops(events: DataFrame, loop_ids: DataFrame, at: Column) -> DataFrame:
    """append a ``Stopped`` event for every listed loop that is still in progress; F2 then picks it up."""
    cur = latest_loop_status(events).where(F.col("status") == "InProgress")
    stops = (cur.join(loop_ids.select("loop_id"), "loop_id", "left_semi")
             .select("loop_id", F.lit("Stopped").alias("status"), at.alias("ts"),
                     F.lit(None).cast("bigint").alias("event_id")))
    return events.select("loop_id", "status", "ts", "event_id").unionByName(stops)


def loop_outcomes(starts: DataFrame, ends: DataFrame, key: str, timeout_s: int, ok_status: str = "Completed",
                  bucket_s: int | None = None) -> DataFrame:
    """ST2/ST4 batch form: the first end event with ``start <= end <= start + timeout`` decides each loop.

    ``starts(loop_id, key, ts)``, ``ends(event_id, key, ts, status)``; result
    ``(loop_id, outcome, end_event_id, end_ts)`` with outcome = the end status or ``Timeout``.

    This is a forward as-of join done without emitting pairs: starts and ends are unioned and, in time order,
    each start takes the first end that follows it (``first(..., ignorenulls)`` over a following frame).
    To keep one hot key from landing in a single task, rows are also split into time buckets one timeout
    wide: the first end after a start lies in the start's bucket or, failing that, is the first end of the
    next bucket; both candidates are computed and the earlier kept.
    """
    b = bucket_s or timeout_s
    if b < timeout_s:
        raise ValueError("bucket_s must not be smaller than timeout_s")
    sec = epoch_seconds(F.col("ts"))
    s = starts.select("loop_id", F.col(key).alias("k"), F.col("ts"), F.floor(sec / b).alias("bucket"))
    e = ends.select("event_id", F.col(key).alias("k"), F.col("ts"), "status", F.floor(sec / b).alias("bucket"))
    rows = (s.select("k", "bucket", "ts", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("event_id"),
                     "loop_id", F.lit(None).cast("string").alias("status"))
            .unionByName(e.select("k", "bucket", "ts", F.lit(1).alias("kind"), "event_id",
                                  F.lit(None).cast("string").alias("loop_id"), "status")))
    w = (Window.partitionBy("k", "bucket").orderBy("ts", "kind", "event_id")
         .rowsBetween(Window.currentRow, Window.unboundedFollowing))
    end_struct = F.when(F.col("kind") == 1, F.struct("ts", "event_id", "status"))
    same = (rows.withColumn("nxt", F.first(end_struct, ignorenulls=True).over(w))
            .where(F.col("kind") == 0).select("loop_id", "k", "bucket", "ts", F.col("nxt").alias("c1")))
    first_of_bucket = (e.groupBy("k", "bucket")
                       .agg(F.min(F.struct("ts", "event_id", "status")).alias("c2"))
                       .withColumn("bucket", F.col("bucket") - 1))
    cand = same.join(first_of_bucket, ["k", "bucket"], "left")
    best = F.when(F.col("c1").isNotNull(), F.col("c1")).otherwise(F.col("c2"))
    within = best.isNotNull() & (epoch_seconds(best["ts"]) - epoch_seconds(F.col("ts")) <= timeout_s)
    return cand.select(
        "loop_id",
        F.when(within, best["status"]).otherwise(F.lit("Timeout")).alias("outcome"),
        F.when(within, best["event_id"]).alias("end_event_id"),
        F.when(within, best["ts"]).alias("end_ts"),
    )


def list_loops(loops: DataFrame, status: str | None = None, max_results: int = 50) -> DataFrame:
    """Loops of one flow, optional status filter, the first ``max_results`` in a fixed order."""
    df = loops.where(F.col("status") == status) if status else loops
    return df.orderBy(F.col("ts").desc(), F.col("loop_id")).limit(max_results)


# ---------------------------------------------------------------- ST4: what asynchronous jobs left

def finished_pages(outcomes: DataFrame, pages: DataFrame, ok_status: str = "SUCCEEDED") -> DataFrame:
    """ST4: the pages ``(loop_id, ...)`` of jobs that ended well; pages of failed, timed out or unknown jobs are not results."""
    done = outcomes.where(F.col("outcome") == ok_status).select("loop_id")
    return pages.join(done, "loop_id", "left_semi")


def job_errors(outcomes: DataFrame, timeout_s: int, ok_status: str = "SUCCEEDED") -> DataFrame:
    """ST4: ``(loop_id, phase, error)`` of the jobs that failed or did not end in time, as ``process_documents`` takes phase errors."""
    text = F.when(F.col("outcome") == "Timeout", F.concat(F.lit("Extraction failed: job "), "loop_id", F.lit(f" timed out after {timeout_s}s")))
    text = text.otherwise(F.concat(F.lit("Extraction failed: job "), F.col("loop_id"), F.lit(" "), F.col("outcome")))
    return outcomes.where(F.col("outcome") != ok_status).select("loop_id", F.lit("extraction").alias("phase"), text.alias("error"))

"""Structured Streaming forms of the event-driven parts (ST1-ST5).

The reference describes an upload event -> queue -> trigger flow and polls review loops and OCR jobs in sleep
loops. Here uploads are a file stream processed by the same batch operators, and loop/job outcomes are
event-time state over the lifecycle event stream: watermarks bound the state, and a start without an end
inside its timeout is closed as ``Timeout`` once the watermark passes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quire.operators.pii import redact_documents


# ---------------------------------------------------------------- ST1

def stream_documents(spark: SparkSession, source_dir: str, schema: StructType | str, sink_dir: str,
                     checkpoint_location: str, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """ST1: new document files -> the batch redaction operator -> parquet, processing what is available.

    The checkpoint location must be on shared storage (take it from ``spark.checkpoint.dir`` on a cluster); a
    restarted query resumes from it, so a lost executor or driver does not lose or duplicate files.
    """
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    docs = r.load(source_dir)
    out = redact_documents(docs)
    return (out.writeStream.format("parquet").option("path", sink_dir)
            .option("checkpointLocation", checkpoint_location).outputMode("append")
            .trigger(availableNow=True).start())


def document_flow(entity_list: DataFrame | None = None, **options):
    """The whole document flow over a batch of responses ``(doc_id, response, document_path?)``: blocks are parsed, corrupt responses become
    errors, every phase of ``process_documents`` runs. ``options`` go to it."""
    from quire.operators.assembly import process_documents
    from quire.session import materialize
    from quire.sources.blocks import parse_blocks, response_status

    def run(batch: DataFrame) -> DataFrame:
        raw = materialize(batch, "stream-batch")
        docs = raw.select("doc_id", *[c for c in ("document_path",) if c in raw.columns])
        return process_documents(docs, entity_list, blocks=materialize(parse_blocks(raw), "stream-blocks"),
                                 responses=response_status(raw), **options)

    return run


def stream_results(spark: SparkSession, source_dir: str, schema: StructType | str, sink_dir: str, checkpoint_location: str, flow,
                   max_files_per_trigger: int | None = None) -> StreamingQuery:
    """ST1, whole flow: files of OCR responses -> ``results``, ``review`` (the review queue) and ``errors`` under ``sink_dir``.

    Each micro-batch writes folders of its own, named by its id, and a mark last. A batch that failed is replayed by Spark with the same id and
    the same files; it replaces what it had left, so rows are neither lost nor doubled. ``read_stream_results`` reads marked batches only.
    Checkpoint and sink must lie on shared storage.
    """
    from quire.operators.review import review_queue

    def write(batch: DataFrame, batch_id: int) -> None:
        here = batch.sparkSession

        def put(df: DataFrame, name: str) -> DataFrame:
            path = f"{sink_dir.rstrip('/')}/{name}/batch_id={batch_id}"
            df.write.mode("overwrite").parquet(path)
            return here.read.schema(df.schema).parquet(path)

        results = put(flow(batch), "results")
        put(review_queue(results), "review")
        put(results.select("doc_id", F.posexplode("errors").alias("ord", "error")), "errors")
        put(here.range(1).select(F.current_timestamp().alias("written_at")), "marks")

    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return (r.load(source_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())


def read_stream_results(spark: SparkSession, sink_dir: str, name: str) -> DataFrame:
    """``name`` (``results``, ``review`` or ``errors``) of the batches that were written whole."""
    base = sink_dir.rstrip("/")
    marks = spark.read.parquet(f"{base}/marks").select("batch_id").distinct()
    return spark.read.parquet(f"{base}/{name}").join(F.broadcast(marks), "batch_id").drop("batch_id")  # a row per batch


# ---------------------------------------------------------------- ST5

def dedup_uploads(uploads: DataFrame, key: str = "key", ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """ST5: queue delivery can repeat an upload event; keep the first per key within the watermark delay."""
    return uploads.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


# ---------------------------------------------------------------- ST3

LOOP_STATUS_SCHEMA = "loop_id string, status string, ts timestamp"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def loop_status_stream(events: DataFrame, delay: str = "1 hour", state_ttl_ms: int = 3_600_000) -> DataFrame:
    """ST3: the current status of every loop, emitted each time it changes (update mode); equals ``review.latest_loop_status``.

    ``events(loop_id, status, ts, event_id)``; ``delay`` is the watermark delay for late events. State per loop is a typed value ``(status, ts,
    event_id)`` in RocksDB, so it need not fit in memory; a timer removes it once the watermark passes the loop's last event by
    ``state_ttl_ms``. The latest event is that of the greatest ``(ts, event_id)``, a null id before all others, then the status that
    sorts last. Events without a loop or a time are left out. The session must name the RocksDB provider (``STATE_STORE``; ``get_spark``
    does), since the stream keeps the provider that it was started with.
    """
    import pandas as pd
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    if events.sparkSession.conf.get(STATE_STORE, None) != ROCKSDB:
        raise ValueError(f"loop_status_stream needs {STATE_STORE}={ROCKSDB}")

    class LatestStatus(StatefulProcessor):
        """Local to the function, so it travels to the workers by value."""

        def init(self, handle) -> None:
            self.handle = handle
            self.latest = handle.getValueState("latest", "status string, ts timestamp, event_id long")

        def handleInputRows(self, key, rows, timerValues):
            old = self.latest.get() if self.latest.exists() else None
            parts = list(rows)
            if old is not None:
                parts.append(pd.DataFrame([tuple(old)], columns=["status", "ts", "event_id"]))
            seen = pd.concat([p[["ts", "event_id", "status"]].astype({"event_id": "Int64", "ts": "datetime64[us]"}) for p in parts])
            last = seen.sort_values(["ts", "event_id", "status"], na_position="first").iloc[-1]
            event_id = None if pd.isna(last["event_id"]) else int(last["event_id"])
            status = None if pd.isna(last["status"]) else last["status"]
            new = (status, last["ts"].to_pydatetime(), event_id)
            if old is None or new != tuple(old):
                self.latest.update(new)
                for timer in list(self.handle.listTimers()):
                    self.handle.deleteTimer(timer)
                end = last["ts"].value // 1_000_000 + state_ttl_ms
                # a timer must lie ahead of the watermark
                self.handle.registerTimer(max(end, timerValues.getCurrentWatermarkInMs() + 1))
                yield pd.DataFrame({"loop_id": [key[0]], "status": [status], "ts": [last["ts"]]})

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            self.latest.clear()
            return iter([])

        def close(self) -> None:
            pass

    timed = events.where(F.col("loop_id").isNotNull() & F.col("ts").isNotNull()).select(
        "loop_id", "status", "ts", F.col("event_id").cast("long").alias("event_id"))
    return timed.withWatermark("ts", delay).groupBy("loop_id").transformWithStateInPandas(
        LatestStatus(), LOOP_STATUS_SCHEMA, "Update", "EventTime")


# ---------------------------------------------------------------- ST2, ST4

def loop_outcomes_stream(events: DataFrame, key: str, timeout_s: int, delay: str = "1 hour") -> DataFrame:
    """ST2/ST4: outcome of every loop from one event stream ``(kind, loop_id, key, ts, event_id, status)``; result
    ``(loop_id, outcome, end_event_id, start_ts)``.

    ``kind`` is 'start' or 'end'. Starts are joined to the ends of their key with ``start <= end <= start + timeout`` (a
    stream-stream left outer join whose state the watermarks bound), and the first end by ``(ts, event_id)`` decides; none
    gives ``Timeout``. A loop is emitted once the watermark has passed its start and timeout, so the order in which events
    arrive within ``delay`` does not matter, and the result equals the batch form ``review.loop_outcomes``.
    """
    starts = events.where(F.col("kind") == "start").select(
        "loop_id", F.col(key).alias("__s"), F.col("ts").alias("start_ts")).withWatermark("start_ts", delay)
    ends = events.where(F.col("kind") == "end").select(
        F.col(key).alias("__e"), F.col("ts").alias("end_ts"), "event_id", "status").withWatermark("end_ts", delay)
    within = F.expr(f"__s = __e AND end_ts >= start_ts AND end_ts <= start_ts + INTERVAL {int(timeout_s)} SECONDS")
    joined = starts.join(ends, within, "leftOuter")
    first = joined.groupBy("loop_id", "start_ts").agg(F.min(F.struct("end_ts", "event_id", "status")).alias("end"))
    return first.select("loop_id", F.coalesce("end.status", F.lit("Timeout")).alias("outcome"),
                        F.col("end.event_id").alias("end_event_id"), "start_ts")


def finished_pages_stream(events: DataFrame, pages: DataFrame, key: str, timeout_s: int, page_s: int = 3600, ok_status: str = "SUCCEEDED",
                          delay: str = "1 hour") -> DataFrame:
    """ST4 chained: outcomes of jobs (``loop_outcomes_stream``), then the pages ``(loop_id, page_id, ts, ...)`` of the jobs that ended well; equals
    ``review.finished_pages`` over all events. A page is kept until ``timeout_s + page_s`` after its job's start has passed the watermark."""
    done = loop_outcomes_stream(events, key, timeout_s, delay).where(F.col("outcome") == ok_status).select(
        F.col("loop_id").alias("__job"), "start_ts")
    p = pages.withColumnRenamed("ts", "page_ts").withWatermark("page_ts", delay)
    within = F.expr(f"loop_id = __job AND page_ts >= start_ts AND page_ts <= start_ts + INTERVAL {int(timeout_s + page_s)} SECONDS")
    return p.join(done, within).drop("__job", "start_ts")


def job_errors_stream(events: DataFrame, key: str, timeout_s: int, ok_status: str = "SUCCEEDED", delay: str = "1 hour") -> DataFrame:
    """ST4: failed and timed out jobs as error rows, once their time is over; equals ``review.job_errors``."""
    from quire.operators.review import job_errors

    return job_errors(loop_outcomes_stream(events, key, timeout_s, delay), timeout_s, ok_status)


def lifecycle_events(events: DataFrame, start_type: str, end_map: dict[str, str], key: str = "user_id") -> DataFrame:
    """Map the ``events`` table (or stream) onto loop lifecycle rows ``(kind, loop_id, key, ts, event_id, status)``."""
    status = None
    for k, v in end_map.items():
        status = status.when(F.col("event_type") == k, v) if status is not None else F.when(F.col("event_type") == k, v)
    e = events.where(F.col("event_type").isin([start_type, *end_map]))
    return e.select(
        F.when(F.col("event_type") == start_type, "start").otherwise("end").alias("kind"),
        F.concat(F.lit("loop-"), F.col("event_id").cast("string")).alias("loop_id"),
        F.col(key), F.col("ts").cast("timestamp").alias("ts"), "event_id",
        status.alias("status"))

"""Structured Streaming forms (ST1, ST2/ST4, ST3, ST5) checked against their batch forms."""

import datetime as dt
import os

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quire.operators import review as R
from quire.operators.pii import redact_documents
from quire.session import read_table
from quire.streaming import flows


def _drain(q):
    q.processAllAvailable()
    q.stop()


def test_stream_documents_matches_batch(spark, scratch):
    docs = read_table(spark, SF_SMALL, "documents")
    src = os.path.join(scratch, "in")
    docs.repartition(4).write.parquet(src)
    q = flows.stream_documents(spark, src, docs.schema, os.path.join(scratch, "out"), os.path.join(scratch, "ck"),
                               max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(scratch, "out"))
    want = redact_documents(docs)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_dedup_uploads(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("k1", t0), ("k1", t0 + dt.timedelta(seconds=5)), ("k2", t0), ("k3", t0 + dt.timedelta(seconds=1))]
    src = os.path.join(scratch, "up")
    spark.createDataFrame(rows, "key string, ts timestamp").write.parquet(src)
    s = spark.readStream.schema("key string, ts timestamp").parquet(src)
    q = flows.dedup_uploads(s).writeStream.format("memory").queryName("dedup_t").outputMode("append").start()
    _drain(q)
    assert sorted(r.key for r in spark.sql("select * from dedup_t").collect()) == ["k1", "k2", "k3"]


def test_loop_status_stream(spark, scratch):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("a", "InProgress", t0, 1), ("a", "Completed", t0 + dt.timedelta(seconds=9), 3),
            ("b", "InProgress", t0, 2), ("b", "Failed", t0 + dt.timedelta(seconds=4), 4),
            ("a", "Failed", t0 + dt.timedelta(seconds=9), 2)]
    src = os.path.join(scratch, "ev")
    spark.createDataFrame(rows, "loop_id string, status string, ts timestamp, event_id long").write.parquet(src)
    s = spark.readStream.schema("loop_id string, status string, ts timestamp, event_id long").parquet(src)
    q = flows.loop_status_stream(s).writeStream.format("memory").queryName("status_t").outputMode("update").start()
    _drain(q)
    latest = {r.loop_id: r.status for r in spark.sql("select * from status_t").collect()}
    batch = {r.loop_id: r.status for r in R.latest_loop_status(
        spark.createDataFrame(rows, "loop_id string, status string, ts timestamp, event_id long")).collect()}
    assert latest == batch == {"a": "Completed", "b": "Failed"}


EVENT = "kind string, loop_id string, user_id long, ts timestamp, event_id long, status string"


def _outcomes(spark, scratch, name, files, timeout_s=1800, delay="1 hour"):
    """Run the stream with one file per trigger in the given order, then an event far ahead that moves the watermark."""
    src = os.path.join(scratch, name)
    far = dt.datetime(2030, 1, 1)
    files = [*files, [("start", "far", -1, far, -1, None), ("end", None, -1, far, -2, "Completed")],
             [("start", "farther", -1, far + dt.timedelta(days=9), -1, None), ("end", None, -1, far + dt.timedelta(days=9), -2, "x")]]
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{src}/{i:03d}")
        for f in os.listdir(f"{src}/{i:03d}"):
            os.utime(f"{src}/{i:03d}/{f}", (1_700_000_000 + 10 * i,) * 2)
    s = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    q = flows.loop_outcomes_stream(s, "user_id", timeout_s, delay).writeStream.format("memory").queryName(name).outputMode(
        "append").start()
    _drain(q)
    rows = spark.sql(f"select * from {name} where loop_id not like 'far%'").collect()
    assert len(rows) == len({r.loop_id for r in rows})
    return {r.loop_id: (r.outcome, r.end_event_id) for r in rows}


def _batch(spark, rows, timeout_s=1800):
    life = spark.createDataFrame(rows, EVENT)
    starts = life.where(F.col("kind") == "start").select("loop_id", "user_id", "ts")
    ends = life.where(F.col("kind") == "end").select("event_id", "user_id", "ts", "status")
    return {r.loop_id: (r.outcome, r.end_event_id) for r in R.loop_outcomes(starts, ends, "user_id", timeout_s).collect()}


def test_loop_outcomes_stream_agrees_with_batch(spark, scratch):
    ev = read_table(spark, SF_SMALL, "events").orderBy("ts").limit(300)
    life = [tuple(r) for r in flows.lifecycle_events(ev, "signup", {"purchase": "Completed", "error": "Failed"}).select(
        "kind", "loop_id", "user_id", "ts", "event_id", "status").orderBy(F.xxhash64("event_id")).collect()]
    # shuffled arrival over several triggers; the delay covers the whole log
    got = _outcomes(spark, scratch, "outcomes_u", [life[i::3] for i in range(3)], delay="400 days")
    assert got == _batch(spark, life) and len(got) > 10


def test_loop_outcomes_out_of_order(spark, scratch):
    t = dt.datetime(2024, 1, 1)
    at = lambda s: t + dt.timedelta(seconds=s)
    start, end = (lambda i, u, s: ("start", i, u, at(s), s, None)), (lambda e, u, s, x: ("end", None, u, at(s), e, x))
    files = [[end(1, 1, 100, "Completed"), end(5, 2, 60, "Completed")],          # an end before its start arrives
             [start("a", 1, 0), start("b", 2, 30), start("c", 3, 0)], [end(2, 1, 50, "Failed")],  # an earlier end arrives later
             [start("d", 3, 4000), start("e", 3, 10)], [end(7, 3, 4100, "Completed"), end(8, 3, 4100, "Failed")]]
    rows = [r for f in files for r in f]
    got = _outcomes(spark, scratch, "outcomes_o", files)
    assert got == _batch(spark, rows) == {"a": ("Failed", 2), "b": ("Completed", 5), "c": ("Timeout", None), "d": ("Completed", 7),
                                          "e": ("Timeout", None)}


def test_loop_status_state_expires(spark, scratch):
    t, schema = dt.datetime(2024, 1, 1), "loop_id string, status string, ts timestamp, event_id long"
    src = os.path.join(scratch, "exp")
    for i, (name, when) in enumerate([("a", t), ("b", t + dt.timedelta(days=2)), ("c", t + dt.timedelta(days=4)),
                                      ("d", t + dt.timedelta(days=6))]):
        spark.createDataFrame([(name, "InProgress", when, i)], schema).coalesce(1).write.parquet(f"{src}/{i}")
        for f in os.listdir(f"{src}/{i}"):
            os.utime(f"{src}/{i}/{f}", (1_700_000_000 + 10 * i,) * 2)
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    q = flows.loop_status_stream(s).writeStream.format("memory").queryName("exp_t").outputMode("update").start()
    q.processAllAvailable()
    kept = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    assert kept < 4 and spark.sql("select * from exp_t").count() == 4


STATUS_EVENT = "loop_id string, status string, ts timestamp, event_id long"


def _drop_in(spark, src, i, rows):
    """One file, in the order of ``i``."""
    spark.createDataFrame(rows, STATUS_EVENT).coalesce(1).write.parquet(f"{src}/{i:03d}")
    for f in os.listdir(f"{src}/{i:03d}"):
        os.utime(f"{src}/{i:03d}/{f}", (1_700_000_000 + 10 * i,) * 2)


def _status_query(spark, src, ck, out):
    def put(batch, batch_id):
        batch.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/b={batch_id}")

    s = spark.readStream.schema(STATUS_EVENT).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)
    return flows.loop_status_stream(s).writeStream.foreachBatch(put).option("checkpointLocation", ck).outputMode("update").start()


def test_loop_status_restart_late_rows_and_odd_values(spark, scratch):
    """A query stopped mid-stream goes on from its checkpoint with its state: older events change nothing, newer ones do; rows behind the
    watermark are dropped; null ids, times, loops and statuses and ties have the documented result."""
    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    src, ck, out = (os.path.join(scratch, n) for n in ("st", "st-ck", "st-out"))
    _drop_in(spark, src, 0, [("a", "InProgress", at(10), 1), ("b", "InProgress", at(10), 2), ("n", None, at(10), None),
                             ("x", "lost", None, 3), (None, "lost", at(10), 4), ("t", "A", at(10), 5), ("t", "B", at(10), 5)])
    q = _status_query(spark, src, ck, out)
    _drain(q)
    _drop_in(spark, src, 1, [("a", "Failed", at(9), 9), ("b", "Completed", at(11), 5), ("n", "Seen", at(10), 0)])
    _drop_in(spark, src, 2, [("far", "InProgress", at(300), 6)])  # the watermark moves to minute 240
    _drop_in(spark, src, 3, [("far", "Stopping", at(301), 7)])  # rows are judged by the watermark of the batch before
    _drop_in(spark, src, 4, [("b", "Failed", at(12), 8), ("c", "Late", at(20), 7), ("far", "Completed", at(302), 9)])
    q = _status_query(spark, src, ck, out)
    _drain(q)
    rows = spark.read.option("recursiveFileLookup", "true").parquet(out).orderBy("batch").collect()
    seen = {}
    for r in rows:
        seen.setdefault(r.loop_id, []).append(r.status)
    assert seen == {"a": ["InProgress"], "b": ["InProgress", "Completed"], "n": [None, "Seen"], "t": ["B"],
                    "far": ["InProgress", "Stopping", "Completed"]}


def test_loop_status_shuffled_triggers_equal_batch(spark, scratch):
    import random

    r, t0 = random.Random(4), dt.datetime(2024, 1, 1)
    rows = [(f"l{r.randrange(25)}", r.choice(["InProgress", "Completed", "Failed"]), t0 + dt.timedelta(seconds=r.randrange(900)), i)
            for i in range(300)]
    src, out = os.path.join(scratch, "sh"), os.path.join(scratch, "sh-out")
    for i in range(4):
        _drop_in(spark, src, i, rows[i::4])
    _drain(_status_query(spark, src, os.path.join(scratch, "sh-ck"), out))
    got = {}
    for x in spark.read.option("recursiveFileLookup", "true").parquet(out).orderBy("batch").collect():
        got[x.loop_id] = (x.status, x.ts)
    assert got == {x.loop_id: (x.status, x.ts) for x in R.latest_loop_status(spark.createDataFrame(rows, STATUS_EVENT)).collect()}


def test_loop_status_needs_the_rocksdb_provider(spark):
    import pytest

    events = spark.createDataFrame([], STATUS_EVENT)
    was = spark.conf.get(flows.STATE_STORE)
    spark.conf.set(flows.STATE_STORE, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        with pytest.raises(ValueError, match="RocksDB"):
            flows.loop_status_stream(events)
    finally:
        spark.conf.set(flows.STATE_STORE, was)


def test_finished_pages_and_errors_match_batch(spark, scratch):
    """Two chained stateful steps over shuffled triggers equal the batch form: pages of succeeded jobs, errors of the others."""
    import random

    r, t0 = random.Random(6), dt.datetime(2024, 1, 1)
    at = lambda s: t0 + dt.timedelta(seconds=s)
    starts = [(f"j{i}", i % 7, at(i * 40), 1000 + i) for i in range(40)]
    ends = [(5000 + i, r.randrange(7), at(r.randrange(2000)), r.choice(["SUCCEEDED", "FAILED"])) for i in range(60)]
    pages = [(f"j{i}", 10 * i + k, at(i * 40 + r.randrange(200)), "text") for i in range(45) for k in range(3) if i < 40 or k]
    events = [("start", j, u, t, e, None) for j, u, t, e in starts] + [("end", None, u, t, e, s) for e, u, t, s in ends]
    r.shuffle(events)
    r.shuffle(pages)
    late = at(10**6)
    src, psrc, page = os.path.join(scratch, "jobs"), os.path.join(scratch, "jobpages"), "loop_id string, page_id long, ts timestamp, text string"
    for n in range(4):
        spark.createDataFrame(events[n::4], EVENT).coalesce(1).write.mode("append").parquet(src)
        spark.createDataFrame(pages[n::4], page).coalesce(1).write.mode("append").parquet(psrc)
    for n in range(3):  # rows far ahead move the watermarks of all inputs past every timeout
        t = late + dt.timedelta(days=n)
        spark.createDataFrame([("start", f"z{n}", 99, t, 9000 + n, None), ("end", None, 98, t, 9100 + n, "FAILED")], EVENT).coalesce(1).write.mode("append").parquet(src)
        spark.createDataFrame([(f"y{n}", 10**6 + n, t, "")], page).coalesce(1).write.mode("append").parquet(psrc)

    def stream(path, schema):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)

    q = flows.finished_pages_stream(stream(src, EVENT), stream(psrc, page), "user_id", 300).writeStream.format("memory").queryName(
        "job_pages_t").outputMode("append").start()
    _drain(q)
    e = flows.job_errors_stream(stream(src, EVENT), "user_id", 300).writeStream.format("memory").queryName("job_errors_t").outputMode("append").start()
    _drain(e)
    outcomes = R.loop_outcomes(
        spark.createDataFrame([(j, u, t) for j, u, t, _ in starts], "loop_id string, user_id long, ts timestamp"),
        spark.createDataFrame(ends, "event_id long, user_id long, ts timestamp, status string"), "user_id", 300)
    want = sorted((x.loop_id, x.page_id) for x in R.finished_pages(outcomes, spark.createDataFrame(pages, page)).collect())
    assert sorted((x.loop_id, x.page_id) for x in spark.sql("select * from job_pages_t").collect()) == want and want
    errors = sorted(map(tuple, R.job_errors(outcomes, 300).collect()))
    assert [x for x in sorted(map(tuple, spark.sql("select * from job_errors_t").collect())) if x[0][0] == "j"] == errors and errors


def test_document_flow_survives_a_failed_batch(spark, scratch):
    """Results, review queue and errors of a stream equal the batch form after a batch that failed half-way and was replayed."""
    import json

    import pytest

    def response(i):
        return "{broken" if i % 5 == 0 else json.dumps({"Blocks": [{"BlockType": "LINE", "Id": "l", "Text": f"mail a{i}@b.io"}]})

    raw = spark.createDataFrame([(i, response(i)) for i in range(20)], "doc_id long, response string")
    src, sink, ck = (os.path.join(scratch, x) for x in ("responses", "flow", "flow-ck"))
    for n in range(3):
        raw.where(F.col("doc_id") % 3 == n).coalesce(1).write.mode("append").parquet(src)
    flow, seen = flows.document_flow(questions=[]), []

    def failing(batch):
        seen.append(1)
        out = flow(batch)
        if len(seen) == 2:  # written in part, then lost
            out.write.mode("overwrite").parquet(f"{sink}/results/batch_id=1")
            raise RuntimeError("executor lost")
        return out

    with pytest.raises(Exception):
        flows.stream_results(spark, src, raw.schema, sink, ck, failing, 1).awaitTermination(600)
    assert flows.read_stream_results(spark, sink, "results").count() < 20
    flows.stream_results(spark, src, raw.schema, sink, ck, failing, 1).awaitTermination(600)
    want = flow(raw)
    got = flows.read_stream_results(spark, sink, "results")
    assert sorted((x.doc_id, x.raw_text, x.redacted_text) for x in got.collect()) == sorted((x.doc_id, x.raw_text, x.redacted_text) for x in want.collect())
    assert sorted((x.doc_id, x.error) for x in flows.read_stream_results(spark, sink, "errors").collect()) == sorted(
        (x.doc_id, e) for x in want.collect() for e in x.errors)
    assert flows.read_stream_results(spark, sink, "review").count() == 0 and len(seen) == 4

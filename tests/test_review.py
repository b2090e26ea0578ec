"""Review flow: thresholds (P6), field evaluation (J13/A11), corrections (J14), loops (F2, F3, W6, ST2 batch)."""

import datetime as dt
import random

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quire.operators import review as R
from quire.session import read_table


def test_needs_review_thresholds(spark):
    df = spark.createDataFrame([(0.9,), (0.0,), (0.8999,), (0.95,), (-1.0,)], "s double")
    got = [r[0] for r in df.select(R.needs_review(F.col("s"))).collect()]
    assert got == [False, False, True, False, False]


def test_evaluate_fields(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    conf = spark.createDataFrame([(1, "total", 0.5), (1, "name", 0.99), (2, "absent_from_kv", 0.1)],
                                 "doc_id long, key string, score double")
    got = {r.doc_id: (r.review_needed, r.low_confidence_fields) for r in R.evaluate_fields(docs, conf).collect()}
    assert got == {1: (True, ["total"]), 2: (True, ["absent_from_kv"]), 3: (False, [])}
    conf = spark.createDataFrame([(1, "zeta", 0.5, 0), (1, "alpha", 0.4, 1), (1, "mid", 0.95, 2)],
                                 "doc_id long, key string, score double, key_ord int")
    r = R.evaluate_fields(docs, conf).where("doc_id = 1").first()
    assert r.low_confidence_fields == ["zeta", "alpha"] and [f.key for f in r.all_fields] == ["zeta", "alpha", "mid"]


def test_apply_corrections_and_review_output(spark):
    extracted = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "doc_id long, key string, value string")
    out = spark.createDataFrame([(1, '{"humanAnswers":[{"answerContent":{"a":"X0"}},{"answerContent":{"a":"X1"}}]}'),
                                 (2, '{"other": 1}')], "doc_id long, output string")
    reviewed = R.parse_review_output(out)
    got = {(r.key, r.value, r.corrected) for r in R.apply_corrections(extracted, reviewed).collect()}
    assert got == {("a", "X1", True), ("b", "y", False)}


def test_loop_id_is_deterministic(spark):
    df = spark.createDataFrame([(7,), (7,)], "doc_id long")
    ids = {r[0] for r in df.select(R.loop_id(F.col("doc_id"))).collect()}
    assert len(ids) == 1 and next(iter(ids)).startswith("idp-review-") and len(next(iter(ids))) == 11 + 64


def test_list_loops_limits(spark):
    t0 = dt.datetime(2024, 1, 1)
    loops = spark.createDataFrame([(f"l{i:03d}", "Completed", t0 + dt.timedelta(seconds=i)) for i in range(150)],
                                  "loop_id string, status string, ts timestamp")
    assert R.list_loops(loops, None, 0).count() == 0
    assert R.list_loops(loops, None, 100).count() == 100
    assert R.list_loops(loops, None, 101).count() == 101
    assert R.list_loops(loops, "Failed", 50).count() == 0


def test_stop_and_latest_status(spark):
    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([("a", "InProgress", t0, 1), ("b", "InProgress", t0, 2),
                                ("b", "Completed", t0 + dt.timedelta(seconds=5), 3)],
                               "loop_id string, status string, ts timestamp, event_id long")
    stopped = R.stop_loops(ev, spark.createDataFrame([("a",), ("b",)], "loop_id string"),
                           F.lit(t0 + dt.timedelta(days=1)))
    got = {r.loop_id: r.status for r in R.latest_loop_status(stopped).collect()}
    assert got == {"a": "Stopped", "b": "Completed"}


def _brute(starts, ends, timeout):
    out = {}
    for lid, k, ts in starts:
        cands = sorted((e_ts, eid, st) for eid, ek, e_ts, st in ends
                       if ek == k and ts <= e_ts <= ts + dt.timedelta(seconds=timeout))
        out[lid] = (cands[0][2], cands[0][1]) if cands else ("Timeout", None)
    return out


def test_loop_outcomes_against_brute_force(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    starts, ends = [], []
    for i in range(300):
        k = rnd.choice([1, 1, 1, 2, 3])  # key 1 is hot
        starts.append((f"s{i}", k, t0 + dt.timedelta(seconds=rnd.randint(0, 20000))))
    for j in range(300):
        k = rnd.choice([1, 2, 3])
        ends.append((j, k, t0 + dt.timedelta(seconds=rnd.randint(0, 20000)), rnd.choice(["Completed", "Failed"])))
    ends.append((999, 1, starts[0][2], "Completed"))  # end at the very start time counts
    s = spark.createDataFrame(starts, "loop_id string, user_id long, ts timestamp")
    e = spark.createDataFrame(ends, "event_id long, user_id long, ts timestamp, status string")
    got = {r.loop_id: (r.outcome, r.end_event_id) for r in R.loop_outcomes(s, e, "user_id", 1800).collect()}
    assert got == _brute(starts, ends, 1800)
    got_small_buckets = {r.loop_id: (r.outcome, r.end_event_id)
                         for r in R.loop_outcomes(s, e, "user_id", 1800, bucket_s=1800).collect()}
    assert got_small_buckets == got
    with pytest.raises(ValueError):
        R.loop_outcomes(s, e, "user_id", 1800, bucket_s=300)


def test_loop_outcomes_on_events(spark):
    ev = read_table(spark, SF_SMALL, "events")
    starts = ev.where(F.col("event_type") == "signup").select(
        F.concat(F.lit("loop-"), F.col("event_id").cast("string")).alias("loop_id"), "user_id", "ts")
    ends = ev.where(F.col("event_type").isin("purchase", "error")).select(
        "event_id", "user_id", "ts", F.when(F.col("event_type") == "purchase", "Completed").otherwise("Failed")
        .alias("status"))
    out = R.loop_outcomes(starts, ends, "user_id", 1800)
    assert out.count() == starts.count()

"""File scan (S1), keys (S2, S3), sinks (S8-S11) round trips."""

import os

from pyspark.sql import functions as F

from quire.sources import files as FS


def _touch(path, data=b"x"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_scan_documents_case_insensitive(spark, scratch):
    for p in ["a.pdf", "sub/b.PNG", "sub/deep/c.tif", "d.txt", "e.jpeg"]:
        _touch(os.path.join(scratch, p))
    got = sorted(os.path.basename(r.path) for r in FS.scan_documents(spark, scratch).select("path").collect())
    assert got == ["a.pdf", "b.PNG", "c.tif", "e.jpeg"]


def test_plan_upload_prefixes_and_rejects(spark):
    files = spark.createDataFrame([("/data/in/x/a.PDF",), ("/data/in/b.txt",), ("C:\\in\\c.png",), ("/data/in/.pdf",)],
                                  "path string")
    for prefix, want in [("", "/"), ("a", "a/"), ("a/", "a/"), ("a//", "a/")]:
        assert FS.normalise_prefix(prefix) == want
    p = {r.path: (r.key, r.error) for r in FS.plan_upload(files, "bkt", "raw//").collect()}
    assert p["/data/in/x/a.PDF"] == ("raw/a.PDF", None)
    assert p["/data/in/b.txt"][0] is None and "Unsupported" in p["/data/in/b.txt"][1]
    assert p["C:\\in\\c.png"] == ("raw/c.png", None)
    assert p["/data/in/.pdf"][0] is None
    rooted = {r.path: r.key for r in FS.plan_upload(files, "bkt", "raw", root="/data/in").collect()}
    assert rooted["/data/in/x/a.PDF"] == "raw/x/a.PDF"
    m = FS.plan_upload(spark.createDataFrame([("/a/x.pdf",), ("/b/x.pdf",)], "path string"), "bkt")
    assert FS.key_collisions(m).collect()[0]["count"] == 2
    assert FS.list_documents(m, None).count() == 2 and FS.list_documents(m, "other/").count() == 0


def test_training_csv_round_trip(spark, scratch):
    df = spark.createDataFrame([("1", 'say "hi", ok'), ("0", "line\nbreak")], "label string, text string")
    out = os.path.join(scratch, "train")
    FS.write_training_csv(df, out)
    raw = "".join(open(os.path.join(out, f)).read() for f in sorted(os.listdir(out)) if f.endswith(".csv"))
    assert '"1","say ""hi"", ok"' in raw
    back = spark.read.option("multiLine", True).option("escape", '"').csv(out, schema="label string, text string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_entity_list_csv_has_header(spark, scratch):
    df = spark.createDataFrame([("acme", "ORG")], "text string, type string")
    out = os.path.join(scratch, "el")
    FS.write_entity_list_csv(df, out)
    raw = "".join(open(os.path.join(out, f)).read() for f in os.listdir(out) if f.endswith(".csv"))
    assert raw.splitlines()[0] == '"Text","Type"'


def test_results_json_and_layers(spark, scratch):
    df = spark.createDataFrame([(1, "invoice", {"a": "b"}), (2, "receipt", {})],
                               "doc_id long, document_type string, kv_pairs map<string,string>")
    FS.write_results_json(df, os.path.join(scratch, "json"))
    back = spark.read.schema(df.schema).json(os.path.join(scratch, "json"))
    assert sorted(r.doc_id for r in back.collect()) == [1, 2]
    path = FS.write_layers(df, scratch, "classified")
    assert spark.read.parquet(path).where(F.col("document_type") == "invoice").count() == 1


def test_wrap_text_default_source(spark):
    df = spark.createDataFrame([("t",)], "text string")
    assert FS.wrap_text(df).first().metadata.source == "document"


def test_layers_are_replaced_by_type_and_pruned(spark, scratch):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, document_type string")
    FS.write_layers(df, scratch + "/l", "enriched")
    FS.write_layers(df.where("document_type = 'a'").withColumn("doc_id", F.col("doc_id") + 10), scratch + "/l", "enriched")
    assert sorted(map(tuple, FS.read_layer(spark, scratch + "/l", "enriched").collect())) == [(2, "b"), (11, "a"), (13, "a")]
    one = FS.read_layer(spark, scratch + "/l", "enriched", ["b"])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(document_type" in plan or "PartitionFilters: [document_type" in plan
    assert [r.doc_id for r in one.collect()] == [2] and all("document_type=b" in r[0] for r in one.select(F.input_file_name()).collect())


def test_checkpoint_folder_without_a_setting(scratch):
    """A session whose configuration names no folder takes a scratch one when it is local."""
    import subprocess
    import sys

    code = ("from quire.session import get_spark, materialize; s = get_spark(master='local[1]', driver_memory='1g'); "
            "assert not s.conf.get('spark.checkpoint.dir', None); print(materialize(s.range(3)).count(), materialize(s.range(4)).count())")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                         env={**os.environ, "SPARK_CONF_DIR": scratch})
    assert out.stdout.split() == ["3", "4"], out.stderr[-2000:]


def test_rounding_of_values_without_decimals(spark):
    from pyspark.sql import functions as F

    from quire.functions.numbers import round_exact

    df = spark.createDataFrame([(float("nan"),), (1e300,), (-1e300,), (float("inf"),), (None,), (0.55555,), (-0.00015,)], "x double")
    got = [r[0] for r in df.select(round_exact(F.col("x"), 4)).collect()]
    assert got[0] != got[0] and got[1:5] == [1e300, -1e300, float("inf"), None] and got[5] == 0.5555

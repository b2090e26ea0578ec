"""Class ranking (W1, W2), training sets (J5), classifier training and scoring."""

from conftest import SF_SMALL, responses
from pyspark.sql import functions as F

from quire.operators import classify as CL
from quire.operators import structured as S
from quire.session import read_table


def test_top_class_fixture(spark):
    r = {"Classes": [{"Name": "invoice", "Score": 0.9543}, {"Name": "bank-statement", "Score": 0.0312},
                     {"Name": "receipt", "Score": 0.0145}]}
    t = S.top_class(responses(spark, {1: r})).first()
    assert (t.document_type, t.classification_confidence) == ("invoice", 0.9543)
    ranked = [(x["class"], x.rank) for x in S.rank_classes(responses(spark, {1: r})).orderBy("rank").collect()]
    assert ranked == [("invoice", 1), ("bank-statement", 2), ("receipt", 3)]


def test_ties_after_rounding_keep_response_order_and_repeats(spark):
    r = {"Classes": [{"Name": "b", "Score": 0.50001}, {"Name": "a", "Score": 0.50004}, {"Name": "c", "Score": 0.1},
                     {"Name": "c", "Score": 0.9}]}
    ranked = [(x["class"], x.score) for x in S.rank_classes(responses(spark, {1: r})).orderBy("rank").collect()]
    assert ranked == [("c", 0.9), ("b", 0.5), ("a", 0.5)]


def test_no_classes_is_an_error(spark):
    t = S.top_class(responses(spark, {1: {"Classes": []}})).first()
    assert t.document_type is None and t.error.startswith("Classification failed")


def test_train_and_classify(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    train = CL.training_set(docs, read_table(spark, SF_SMALL, "labels"))
    assert train.count() == read_table(spark, SF_SMALL, "labels").join(docs, "doc_id").count()
    models = CL.train_classifier(train, max_iter=5)
    out = CL.classify(docs, models["label"])
    n_classes = len(CL.class_names(models["label"]))
    assert out.count() == docs.count() * n_classes
    # probabilities sum to ~1 per document and rank 1 has the highest score
    chk = out.groupBy("doc_id").agg(F.sum("score").alias("s"), F.max_by("score", -F.col("rank")).alias("top"),
                                    F.max("score").alias("m"))
    assert chk.where((F.abs(F.col("s") - 1) > 1e-3) | (F.col("top") != F.col("m"))).count() == 0


def test_multilabel_trains_one_model_per_label(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    lab = read_table(spark, SF_SMALL, "labels")
    train = docs.join(lab, "doc_id")
    models = CL.train_classifier(train, CL.MULTI_LABEL, ("quality", "toxic"), max_iter=3)
    assert set(models) == {"quality", "toxic"}


def test_a_class_without_score_is_last(spark):
    import json

    from quire.operators import structured as S

    rows = [(1, json.dumps({"Classes": [{"Name": "a"}, {"Name": "b", "Score": 0.2}, {"Name": "c", "Score": 0.7}]})),
            (2, json.dumps({"Classes": [{"Name": "a"}]})), (3, json.dumps({"Classes": []})), (4, "{")]
    df = spark.createDataFrame(rows, "doc_id long, response string")
    assert [(r[0], r[1]) for r in S.rank_classes(df).where("doc_id = 1").orderBy("rank").select("class", "score").collect()] == [
        ("c", 0.7), ("b", 0.2), ("a", None)]
    top = {r.doc_id: (r.document_type, r.classification_confidence, r.error) for r in S.top_class(df).collect()}
    assert top[1] == ("c", 0.7, None) and top[2] == (None, None, "Classification failed: no class has a score")
    assert top[3] == top[4] == (None, None, "Classification failed: no classes returned")

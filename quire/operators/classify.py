"""Document classification: training sets (J5), training (A13) and scoring (A14) with ``pyspark.ml``.

The hosted custom classifier is re-aimed as a ``pyspark.ml`` pipeline (tokenise -> hashing TF -> IDF ->
logistic regression). Multi-label mode trains one binary model per label column. Scores are ranked like the
service's answer (W1): rounded to 4 places, sorted descending, ties in class order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import scratch_path

MULTI_CLASS = "MULTI_CLASS"
MULTI_LABEL = "MULTI_LABEL"


def training_set(docs: DataFrame, labels: DataFrame, label_col: str = "quality") -> DataFrame:
    """``(doc_id, label, text)`` for every labelled document (inner equi-join on ``doc_id``)."""
    return docs.join(labels.select("doc_id", F.col(label_col).cast("string").alias("label")), "doc_id").select(
        "doc_id", "label", "text")


def _pipeline(label_col: str, num_features: int, max_iter: int, reg: float) -> Pipeline:
    return Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="__y", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol="text", outputCol="__tok", pattern="[^\\p{L}\\p{N}]+", toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol="__y", maxIter=max_iter, regParam=reg,
                           family="multinomial"),
    ])


def train_classifier(train: DataFrame, mode: str = MULTI_CLASS, label_cols: Sequence[str] = ("label",),
                     num_features: int = 1 << 16, max_iter: int = 50, reg: float = 0.01) -> dict[str, PipelineModel]:
    """Fit one model (multi-class) or one binary model per label column (multi-label).

    Training is deterministic for a given input (L-BFGS, no sampling). Returns ``{label_col: model}``;
    persist with ``model.write().overwrite().save(path)`` under the shared checkpoint/model folder.
    """
    cols = list(label_cols) if mode == MULTI_LABEL else [label_cols[0]]
    models = {}
    for c in cols:
        data = train.select("text", F.col(c).cast("string").alias(c))
        models[c] = _stored(_pipeline(c, num_features, max_iter, reg).fit(data), train)
    return models


def _stored(model: PipelineModel, df: DataFrame) -> PipelineModel:
    """The model as read back from the shared folder. A freshly fitted one carries a summary of its training with the session in it,
    which cannot be shipped to executors once the session observes metrics."""
    path = scratch_path(df.sparkSession, "model")
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def class_names(model: PipelineModel) -> list[str]:
    return list(model.stages[0].labelsArray[0])


def classify(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """A14 + W1: ``(doc_id, class, score, rank)`` — probabilities rounded to 4 places, ranked descending with
    ties kept in class order. The ranking sorts each document's (short) probability array in the row."""
    names = F.array(*[F.lit(n) for n in class_names(model)])
    probs = vector_to_array("probability")
    entries = F.transform(probs, lambda p, i: F.struct(F.round(p, 4).alias("score"), i.alias("pos")))
    ranked = F.array_sort(entries, lambda a, b: F.when(a["score"] > b["score"], -1)
                          .when(a["score"] < b["score"], 1).otherwise(a["pos"] - b["pos"]))
    return (model.transform(docs.select("doc_id", "text"))
            .select("doc_id", F.posexplode(ranked).alias("r", "c"))
            .select("doc_id", F.element_at(names, F.col("c.pos") + 1).alias("class"), F.col("c.score").alias("score"),
                    (F.col("r") + 1).alias("rank")))

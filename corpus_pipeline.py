"""The corpus pipeline: quality, near duplicates, benchmark passages, personal data, token ids.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; all but the last return the columns of
``docs``. Rows without an id are kept by the filters that decide by id, rows that repeat an id share its decision, and an empty
table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import hand_over_less, save, table

#: The stages train models and extend hits, which SQL cannot express.
ORACLE_SQL = None


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` without the ids in ``dropped``, a table that grows with the documents: a shuffle join at every size."""
    return docs.join(dropped.select("doc_id").distinct().hint("shuffle_hash"), "doc_id", "left_anti").select(docs.columns)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that the rule ensemble scores below 0.7 go."""
    hand_over_less(spark)
    from quire.llm.queries import quality_labels
    from quire.llm.rule_ensemble import holds_back, train

    return holds_back(docs, train(docs, quality_labels(spark, sf_dir)), 0.7)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: of every group of near duplicates the document with the least id stays."""
    from quire.llm.jaccard_join import join_components

    groups = save(join_components(docs), "groups")
    return _without(docs, groups.where("component_id <> doc_id"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents with a twentieth or more of their words in benchmark windows go."""
    from quire.llm import winnowing

    found = winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, save(found.where(winnowing.contaminated()).select("doc_id"), "contaminated"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: every span that was found is replaced by its kind; ``n_chars`` follows the text."""
    from quire.llm.pii_labels import detect_and_redact

    return detect_and_redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: ids of the best segmentation, its score and the next one's, and whether both decode to the text."""
    from quire.llm import pieces
    from quire.llm.queries import tokenizer_file

    out = pieces.encode(docs, tokenizer_file("piece_bpe_32k.model"), 2, "doc_id long, lang string, source string")
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "score",
                      F.try_element_at("others", F.lit(1))["score"].alias("next_score"), "decoded")


STAGES = [("quality", keep_good), ("near_duplicates", drop_near_copies), ("decontamination", decontaminate),
          ("personal_data", redact_personal_data), ("sentencepiece", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written once and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = save(docs, name)
    return docs

"""Operator 10: quality classifier as a sparse rule ensemble.

Small trees are grown on statistics of labelled texts. Every path from a root to a node becomes a rule, a
conjunction of thresholds; a lasso logistic regression over the rules' indicators keeps few of them; the kept rules
compile into one Spark column expression, so scoring needs no model at run time.

Labels are read from at most ``max_rows`` labelled documents (those with the smallest hash of their id); their whole
texts are used. The statistics of all other documents are computed only when they are scored.

Defined cases: null text is empty and is scored like any text; labels other than 0 and 1, and null labels, are
ignored; without both labels every score is the share of label 1 (0.5 without labels); repeated rows are scored
alike; an empty table gives no rows. Rows with a null ``doc_id`` are scored like others but not learned from; a ``doc_id`` labelled twice
has its largest label; a score equal to the threshold is kept; ``score`` ignores columns that ``keep`` does not name, and ``holds_back``
carries all columns, whatever they are called. Very long texts are scored whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import kept, save
from quire.llm.stats import with_stats

MAX_ROWS = 16_000
Rule = tuple[tuple[str, str, float], ...]


def features() -> dict[str, Column]:
    """Ratios of the statistics; bounded or slowly growing, so thresholds carry over to texts of any length."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    letters = F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    return {
        "log_words": F.log1p(F.col("n_words")),
        "word_length": F.col("word_chars") / words,
        "symbols": F.col("n_symbols") / words,
        "upper": F.col("n_upper") / letters,
        "digits": F.col("n_digits") / chars,
        "marks": F.col("n_marks") / chars,
        "bangs": F.col("n_bang") / words,
        "pipes": F.col("n_pipe") / words,
        "stops": F.col("n_stops") / words,
        "dup_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeats": F.col("n_repeat_words") / words,
        "variety": F.col("n_distinct_words") / words,
        "stutter": F.col("n_stutter") / words,
        "line_words": F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1)),
        "max_word": F.log1p(F.col("max_word")),
    }


@dataclass
class RuleEnsemble:
    """``score = sigmoid(intercept + sum of the weights of the rules that hold)``."""

    intercept: float
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weights.items():
            total = total + F.when(holds(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))

    def describe(self) -> list[str]:
        return [f"{w:+.3f}  " + " and ".join(f"{n} {op} {x:.4g}" for n, op, x in r) for r, w in self.weights.items()]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for name, op, x in rule:
        out = out & ((F.col(name) <= x) if op == "<=" else (F.col(name) > x))
    return out


def paths(tree_text: str, names: list[str]) -> set[Rule]:
    """Root-to-node paths of a tree in Spark's printed form, one condition per level of indentation."""
    found, stack = set(), []
    for line in tree_text.splitlines():
        m = re.match(r"(\s*)(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line)
        if m:
            depth = len(m[1])
            stack = [s for s in stack if s[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
            found.add(tuple(sorted({s[1] for s in stack})))
    return found


def fit(labelled: DataFrame, trees: int = 12, depth: int = 3, lasso: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """``labelled``: feature columns and ``label`` (0.0 or 1.0), of a bounded number of rows."""
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array  # noqa: F401  (loads the vector types)

    names = list(features())
    share = labelled.agg(F.avg("label")).first()[0]
    if share is None or share in (0.0, 1.0):
        return RuleEnsemble(_logit(0.5 if share is None else share))
    data = VectorAssembler(inputCols=names, outputCol="x").transform(labelled).select("x", "label", *names)
    forest = RandomForestClassifier(featuresCol="x", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed,
                                    minInstancesPerNode=5, featureSubsetStrategy="0.5").fit(data)
    rules = sorted(set().union(*(paths(t.toDebugString, names) for t in forest.trees)))
    if not rules:
        return RuleEnsemble(_logit(share))
    hits = data.select("label", *(F.when(holds(r), 1.0).otherwise(0.0).alias(f"r{i}") for i, r in enumerate(rules)))
    hits = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="r").transform(hits)
    lr = LogisticRegression(featuresCol="r", labelCol="label", elasticNetParam=1.0, regParam=lasso, maxIter=60,
                            standardization=False).fit(hits.select("r", "label"))
    weights = {r: float(w) for r, w in zip(rules, lr.coefficients) if abs(w) > 1e-6}
    return RuleEnsemble(float(lr.intercept), weights)


def _logit(p: float) -> float:
    import math

    p = min(max(p, 1e-3), 1 - 1e-3)
    return math.log(p / (1 - p))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleEnsemble:
    """Fit on the documents ``(doc_id, text)`` that ``labels`` ``(doc_id, label)`` marks 0 or 1."""
    picked = (labels.where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("label").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    # at most max_rows pairs of numbers, so a broadcast of known size
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    stats = with_stats(rows, "doc_id long, label int")
    # at most max_rows rows of numbers leave the tasks of the scan
    table = save(stats.select(F.col("label").cast("double").alias("label"),
                              *(c.cast("double").alias(n) for n, c in features().items())).repartition(4), "rules")
    return fit(table)


def score(docs: DataFrame, model: RuleEnsemble, keep: str = "doc_id long") -> DataFrame:
    """``docs`` with the carried columns and ``score`` (0 to 1, higher: label 1 likelier)."""
    names = kept(keep)
    stats = with_stats(docs, keep)
    return stats.select(*names, *(c.cast("double").alias(n) for n, c in features().items())).select(
        *names, model.score().alias("score"))


def holds_back(docs: DataFrame, model: RuleEnsemble, threshold: float) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with their columns."""
    names = {c: f"__c{i}" for i, c in enumerate(docs.columns)}  # a column may be named like a statistic
    renamed = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    stats = with_stats(renamed, ", ".join(f"{names[c]} {t}" for c, t in docs.dtypes), names["text"])
    known = stats.select(*names.values(), *(c.cast("double").alias(n) for n, c in features().items()))
    return known.where(model.score() >= threshold).select(*(F.col(n).alias(c) for c, n in names.items()))

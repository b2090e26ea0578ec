"""Operator 9: quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. The votes of all documents are counted per vote
pattern (at most ``3 ** rules`` rows, so the driver's share does not grow with the documents);
expectation-maximisation over these counts estimates how often each rule is right when it votes, separately on good
and bad documents, and the share of good documents. A document's verdict is its posterior probability.

Defined cases: null text is empty; a document without words gets only the votes of the rules that need none; equal
texts get equal verdicts; a posterior equal to the threshold is good; an empty table gives no rows; a null ``doc_id`` is carried like
any; columns that ``keep`` does not name are ignored, whatever they are called. Very long texts are judged whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.stats import with_stats


#: Rates that expectation-maximisation starts from, and the share of all documents that they count as afterwards.
START = {"prior": 0.85, "good": 0.97, "bad": 0.25}
SMOOTH = 0.001


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(x: Column, bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """The rules as columns over the statistics; thresholds are those usual for web text."""
    length, symbols = _share("word_chars", "n_words"), _share("n_symbols", "n_words")
    upper = F.col("n_upper") / F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    repeats, lines = _share("n_repeat_words", "n_words"), _share("n_dup_lines", "n_lines")
    marks, distinct = _share("n_marks", "word_chars"), _share("n_distinct_words", "n_words")
    stops, stutter, words = _share("n_stops", "n_words"), _share("n_stutter", "n_words"), F.col("n_words")
    some = words > 0
    return {
        "words": _vote(words, words < 20, words >= 40),
        "word_length": _vote(length, some & ((length < 2) | (length > 12)), some & length.between(3, 10)),
        "symbols": _vote(symbols, symbols > 0.1, some & (symbols < 0.02)),
        "upper": _vote(upper, upper > 0.4, some & (upper < 0.15)),
        "repeats": _vote(repeats, repeats > 0.3, some & (repeats < 0.1)),
        "lines": _vote(lines, lines > 0.3, some & (lines < 0.05)),
        "marks": _vote(marks, marks > 0.12, some & (marks < 0.06)),
        "variety": _vote(distinct, some & (distinct < 0.2), distinct > 0.3),
        "stutter": _vote(stutter, stutter > 0.25, some & (stutter < 0.1)),
        "sentences": _vote(stops, (words >= 100) & (stops < 0.01), some & stops.between(0.02, 0.3)),
    }


def fit_reliability(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> dict:
    """Expectation-maximisation over vote patterns (rows of -1, 0, 1) and their counts.

    ``right[y][j]``: probability that rule ``j``, when it votes on a document of class ``y`` (0 bad, 1 good), votes
    ``y``. Abstaining carries no information. A bad document usually fails few rules and passes the others, so
    the start is ``START`` (alarms are rare on good documents, and each rule sees a part of the bad ones) instead
    of the majority vote. Estimates are smoothed by ``SMOOTH`` votes at the start's rates; a rule stays better than chance
    (``right[0] + right[1] >= 1.05``), so the classes cannot trade places.
    """
    votes = patterns.astype(float)
    start = np.repeat([[START["bad"]], [START["good"]]], votes.shape[1], axis=1)
    model = {"prior": START["prior"], "right": start}
    if not counts.sum():
        return model
    smooth = SMOOTH * counts.sum()
    for _ in range(rounds):
        post = posterior(patterns, model)
        right = np.empty_like(start)
        for y, weight in ((0, counts * (1 - post)), (1, counts * post)):
            voted = weight @ (votes != 0)
            agreed = weight @ (votes == (1 if y else -1))
            right[y] = (agreed + smooth * start[y]) / (voted + smooth)
        right = np.clip(right, [[0.02], [0.5]], 0.998)
        right[0] = np.maximum(right[0], 1.05 - right[1])
        prior = float(np.clip((counts @ post) / counts.sum(), 0.05, 0.95))
        done = np.abs(right - model["right"]).max() < 1e-9
        model = {"prior": prior, "right": right}
        if done:
            break
    return model


def _weights(model: dict):
    """Log-odds of good that a good and a bad vote of each rule add."""
    bad, good = model["right"]
    return np.log(good / (1 - bad)), np.log((1 - good) / bad)


def posterior(patterns: np.ndarray, model: dict) -> np.ndarray:
    up, down = _weights(model)
    odds = np.log(model["prior"] / (1 - model["prior"])) + (patterns == 1) @ up + (patterns == -1) @ down
    return 1 / (1 + np.exp(-odds))


def quality(docs: DataFrame, threshold: float = 0.5, keep: str = "doc_id long") -> DataFrame:
    """``docs`` -> statistics, ``votes`` (array in the order of ``rules()``), ``p_good`` and ``good``
    (``p_good >= threshold``). Runs one job over the documents to count the vote patterns."""
    named = rules()
    scored = with_stats(docs, keep).withColumn("votes", F.array(*named.values()))
    found = scored.groupBy("votes").count().toPandas()
    patterns = np.array(found["votes"].tolist(), int).reshape(-1, len(named))
    model = fit_reliability(patterns, found["count"].to_numpy(float))
    up, down = _weights(model)
    odds = F.lit(float(np.log(model["prior"] / (1 - model["prior"]))))
    for j in range(len(named)):
        v = F.col("votes")[j]
        odds = odds + F.when(v == 1, float(up[j])).when(v == -1, float(down[j])).otherwise(0.0)
    return scored.withColumn("p_good", 1 / (1 + F.exp(-odds))).withColumn("good", F.col("p_good") >= threshold)

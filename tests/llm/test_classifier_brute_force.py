"""Operators 5, 9 and 10 recomputed in plain Python from what was fitted."""

import collections
import math
import re

import numpy as np
import pytest

from quire.llm import language_id, quality_rules, rule_ensemble
from quire.llm.stats import with_stats

from .conftest import SF_SMALL, texts_of

FULL = (1 << 32) - 1
M1, M2, M3 = 0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D  # fixed values: multipliers of the n-gram hash


def hashed_ngrams(text):
    """Counts of the 2- and 3-grams of bytes per dimension, one by one."""
    b = [x + 32 if 65 <= x <= 90 else x for x in (text or "").encode()]
    b = [x if x >= 128 or 97 <= x <= 122 else 32 for x in b]
    counts = collections.Counter()
    for i in range(len(b) - 1):
        two = (b[i] * M1 + b[i + 1] * M2) & FULL
        counts[((two ^ two >> 15) * M2 & FULL) >> 21] += 1
        if i < len(b) - 2:
            three = (two + b[i + 2] * M3) & FULL
            counts[((three ^ three >> 13) * M1 & FULL) >> 21] += 1
    return counts


def brute_language(text, model):
    """All losses of a text against the codewords -> ``(language, score, distance to the next)``."""
    if not any(c.isalpha() for c in text or ""):
        return "und", 0.0, 0.0
    x = {k: math.sqrt(c) for k, c in hashed_ngrams(text).items()}
    norm = math.sqrt(sum(v * v for v in x.values())) or 1.0
    bits = range(model.code.shape[1])
    margin = [sum(v / norm * float(model.weights[k, j]) for k, v in x.items()) + float(model.weights[-1, j]) for j in bits]
    loss = [sum(math.log1p(math.exp(-margin[j] * int(c[j]))) * float(model.bit_weight[j]) for j in bits) for c in model.code]
    p = [math.exp(min(loss) - x) for x in loss]
    best, after = sorted(p, reverse=True)[:2]
    return model.languages[loss.index(min(loss))], best / sum(p), (best - after) / sum(p)


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_language_against_brute_force(spark, request, which):
    df = request.getfixturevalue(which)
    model = language_id.train(spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr(
        "doc_id", "text", "CASE WHEN pmod(doc_id, 4) < 3 THEN lang END AS lang"))
    assert len(model.languages) > 1
    want = collections.defaultdict(list)
    for i, t in texts_of(df):
        want[i].append(brute_language(t, model))
    got = collections.defaultdict(list)
    for r in language_id.predict(df, model).collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"]))
    assert want.keys() == got.keys()
    for i in want:
        assert sorted(s for _, s in got[i]) == pytest.approx(sorted(s for _, s, _ in want[i]), abs=1e-3)
        if all(gap > 1e-3 for _, _, gap in want[i]):
            assert sorted(x for x, _ in got[i]) == sorted(x for x, _, _ in want[i])


def numbers_of(df):
    """The rows of numbers that rules see, as Spark computes them."""
    stats = with_stats(df, "doc_id long")
    return stats.select("doc_id", *(c.cast("double").alias(n) for n, c in rule_ensemble.features().items())).collect()


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_rule_sums_against_brute_force(spark, request, which):
    df = request.getfixturevalue(which)
    docs, labels = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "labels"))
    model = rule_ensemble.train(docs, labels.selectExpr("doc_id", "CASE WHEN pmod(doc_id, 4) <> 2 THEN quality END AS label"))
    assert model.weights
    want = []
    for r in numbers_of(df):
        total = model.intercept
        for rule, weight in model.weights.items():
            if all(r[name] <= x if op == "<=" else r[name] > x for name, op, x in rule):
                total += weight
        want.append((r["doc_id"] or -1, 1 / (1 + math.exp(-total))))
    got = [(r["doc_id"] or -1, r["score"]) for r in rule_ensemble.score(df, model).collect()]
    assert [i for i, _ in sorted(got)] == [i for i, _ in sorted(want)]
    assert [s for _, s in sorted(got)] == pytest.approx([s for _, s in sorted(want)], abs=1e-9)


def test_simple_features_against_brute_force(docs):
    space = re.compile(r"[^\x20\x09-\x0D]+")
    got = {r["doc_id"]: r for r in numbers_of(docs)}
    for i, t in texts_of(docs):
        words = space.findall(t or "")
        n = max(len(words), 1)
        assert got[i]["log_words"] == pytest.approx(math.log1p(len(words)))
        assert got[i]["word_length"] == pytest.approx(sum(map(len, words)) / n)
        assert got[i]["symbols"] == pytest.approx(len(re.findall(r"[#*$%&|<>]", t or "")) / n)


def test_posterior_against_brute_force():
    """A verdict is Bayes' rule over the votes cast, with the reliabilities of good and of bad documents."""
    rng = np.random.default_rng(4)
    patterns = np.unique(rng.integers(-1, 2, size=(60, 5)), axis=0)
    counts = rng.integers(1, 50, size=len(patterns)).astype(float)
    model = quality_rules.fit_reliability(patterns, counts)
    got = quality_rules.posterior(patterns, model)
    bad, good = model["right"]
    for row, p in zip(patterns.tolist(), got):
        a, b = model["prior"], 1 - model["prior"]
        for j, v in enumerate(row):
            if v:
                a *= good[j] if v > 0 else 1 - good[j]
                b *= 1 - bad[j] if v > 0 else bad[j]
        assert p == pytest.approx(a / (a + b), abs=1e-9)

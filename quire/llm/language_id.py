"""Operator 5: language identification with error-correcting output codes.

Every language gets a codeword; one binary classifier per bit, over hashed byte n-grams of the text, predicts that
bit. Decoding adds up, per language, the logistic losses of the bit margins against its codeword, each bit weighted
by how well it does on the training sample; the language with the least loss wins and a small distance to the next
one flags the text as ambiguous.

The classifiers are fitted on at most ``sample_rows`` labelled texts, spread evenly over the languages and chosen
by the hash of their id; whole texts count. Predictions see the text alone.

Defined cases: null text, or text without a letter, is ``und`` with score 0; texts without labels (null language)
are not learned from; with one language every text with a letter gets it; with none everything is ``und``; equal
texts get equal results; ties go to the language that sorts first; an empty table gives no rows; rows with a null ``doc_id`` are
predicted like others but not learned from; columns that ``keep`` does not name are ignored, whatever they are called. A very long
text becomes a vector of fixed length from all its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quire.llm.common import kept, text_bytes

DIMENSIONS = 2048
SAMPLE_ROWS = 2400
_SALTS = 16
_M1, _M2, _M3 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)


def ngram_vector(data: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """Length-normalised square roots of the counts of byte 2- and 3-grams. A-Z are lowered; other ASCII bytes
    than letters become blanks, so digits, marks and case do not tell languages apart."""
    x = np.where((data >= 65) & (data <= 90), data + 32, data)
    x = np.where((x < 128) & ((x < 97) | (x > 122)), 32, x).astype(np.uint32)
    if len(x) < 2:
        return np.zeros(dims, np.float32)
    shift = np.uint32(32 - int(dims).bit_length() + 1)
    two = x[:-1] * _M1 + x[1:] * _M2
    three = two[:-1] + x[2:] * _M3
    counts = np.bincount((two ^ (two >> np.uint32(15))) * _M2 >> shift, minlength=dims)
    counts = counts + np.bincount((three ^ (three >> np.uint32(13))) * _M1 >> shift, minlength=dims)
    v = np.sqrt(counts).astype(np.float32)
    return v / np.linalg.norm(v)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """``n`` rows of +1/-1. Up to seven languages: all ways to split them in two. Beyond: random columns, as many as
    keep rows well apart (15 per doubling), none constant."""
    if n <= 1:
        return np.ones((n, 0), int)
    if n <= 7:
        cols = [[1] + [1 if (c >> i) & 1 else -1 for i in range(n - 1)] for c in range(2 ** (n - 1) - 1)]
        return np.array(cols).T
    rng = np.random.default_rng(seed)
    out = rng.choice([-1, 1], size=(n, 15 * int(np.ceil(np.log2(n)))))
    return out[:, np.abs(out.sum(0)) < n]


@dataclass
class CodeModel:
    languages: list[str]
    code: np.ndarray          # languages x bits
    weights: np.ndarray       # (dims + 1) x bits
    bit_weight: np.ndarray    # bits

    def decode(self, x: np.ndarray):
        """Rows of vectors -> (index of the language, score, distance to the next best)."""
        n = len(self.languages)
        if n < 2:
            return np.zeros(len(x), int), np.ones(len(x)), np.ones(len(x))
        # one product per row: products of whole batches round differently in batches of other sizes
        margin = np.stack([row @ self.weights[:-1] for row in x]) + self.weights[-1]
        loss = np.stack([(np.logaddexp(0, -margin * c) * self.bit_weight).sum(1) for c in self.code], 1)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        top = np.sort(p, 1)
        return p.argmax(1), top[:, -1], top[:, -1] - top[:, -2]


def sample(docs: DataFrame, languages: int, rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled texts, evenly over the languages: the first ones by hash in each of
    ``_SALTS`` parts of a language, so a language with most rows is ranked in several tasks."""
    each = max(2, rows // (max(1, languages) * _SALTS))
    h = F.xxhash64("doc_id")
    w = W.partitionBy("lang", "salt").orderBy("h", "doc_id")
    ids = docs.select("doc_id", "lang", h.alias("h"), F.pmod(h, F.lit(_SALTS)).alias("salt"))
    ids = ids.withColumn("r", F.row_number().over(w)).where(F.col("r") <= each).select("doc_id", "lang")
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most ``rows`` ids


def vectors(docs: DataFrame, keep: str) -> DataFrame:
    import pyarrow as pa

    names = kept(keep)

    def run(batches):
        for b in batches:
            v = [ngram_vector(t).tobytes() for t in text_bytes(b.column("text"))]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(v, pa.binary())],
                                             names=[*names, "v"])

    return docs.select(*names, "text").mapInArrow(run, f"{keep}, v binary")


def fit(x: np.ndarray, langs: list[str], languages: list[str], rounds: int = 300) -> CodeModel:
    """Logistic regression per bit by accelerated gradient descent; a bit weighs as its training accuracy beyond chance."""
    code = codewords(len(languages))
    if len(languages) < 2:
        return CodeModel(languages, code, np.zeros((DIMENSIONS + 1, 0), np.float32), np.zeros(0))
    where = {name: i for i, name in enumerate(languages)}
    cls = np.array([where[name] for name in langs])
    target = code[cls].astype(np.float32)
    share = 1 / np.bincount(cls, minlength=len(languages))[cls]
    share = (share / share.sum()).astype(np.float32)[:, None]
    x1 = np.hstack([x, np.ones((len(x), 1), np.float32)])
    w = v = np.zeros((x1.shape[1], code.shape[1]), np.float32)
    for t in range(rounds):
        margin = x1 @ v
        g = x1.T @ (-target / (1 + np.exp(margin * target)) * share) + 1e-5 * v
        new = v - 2.0 * g
        v, w = new + (t / (t + 3)) * (new - w), new
    right = ((x1 @ w) * target > 0).mean(0)
    return CodeModel(languages, code, w, np.clip(2 * right - 1, 0.05, 1))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> CodeModel:
    """Fit on labelled documents ``(doc_id, text, lang)``; rows with null text, language or id are left out."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    languages = sorted(r[0] for r in known.select("lang").distinct().collect())  # one row per language
    if len(languages) < 2:
        return fit(np.zeros((0, DIMENSIONS), np.float32), [], languages)
    got = vectors(sample(known, len(languages), sample_rows), "doc_id long, lang string").orderBy("lang", "doc_id")
    rows = got.select("lang", "v").collect()  # at most ``sample_rows`` vectors of fixed length
    x = np.stack([np.frombuffer(r[1], np.float32) for r in rows])
    return fit(x, [r[0] for r in rows], languages)


def predict(docs: DataFrame, model: CodeModel, keep: str = "doc_id long", ambiguous: float = 0.2) -> DataFrame:
    """``docs`` -> carried columns, ``lang_pred``, ``score`` (0 to 1) and ``is_ambiguous`` (the best two languages are
    closer than ``ambiguous``)."""
    import pyarrow as pa

    names = kept(keep)
    # (dims + 1) x bits weights; plain arrays, which workers read without this package
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.code, model.weights, model.bit_weight))

    def run(batches):
        m = CodeModel(*shared.value)
        for b in batches:
            texts, langs, scores, near = list(text_bytes(b.column("text"))), [], [], []
            strings = b.column("text")
            for at in range(0, len(texts), 256):
                part = texts[at:at + 256]
                best, score, gap = m.decode(np.stack([ngram_vector(t) for t in part]))
                for i, t in enumerate(part):
                    has = bool(m.languages) and _has_letter(t, strings, at + i)
                    langs.append(m.languages[best[i]] if has else "und")
                    scores.append(float(score[i]) if has else 0.0)
                    near.append(bool(gap[i] < ambiguous) if has else True)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), pa.array(langs, pa.string()), pa.array(scores, pa.float64()),
                 pa.array(near, pa.bool_())], names=[*names, "lang_pred", "score", "is_ambiguous"])

    return docs.select(*names, "text").mapInArrow(
        run, f"{keep}, lang_pred string, score double, is_ambiguous boolean")


def _has_letter(data: np.ndarray, strings, i: int) -> bool:
    """Whether the text has a character of a letter category; most texts show one in their first bytes."""
    low = data | 32
    if ((low >= 97) & (low <= 122)).any():
        return True
    return (data >= 128).any() and any(map(str.isalpha, strings[i].as_py()))

"""Operator 8: personal data by weak supervision.

Candidate spans of a text are voted on by labelers (strict pattern, check digits and ranges, gazetteer, context
before, surroundings, variety of characters): personal (1), not (-1) or abstain (0). The votes of all candidates are counted
per kind and vote pattern; expectation-maximisation over the counts estimates each labeler's reliability and each
kind's share of true spans. Its posteriors train a logistic span classifier on the votes and the span's shape,
which makes the final decision, so that it can also decide where most labelers abstain.

Spans of the four base kinds (email, ip, card, phone) always stay; candidates that overlap none of them are added if
the classifier's probability reaches ``threshold``. Offsets are code points, end exclusive.

Defined cases: null text is empty and has no spans; equal spans of two kinds are reported in the order of
``KINDS``; repeated rows get equal results; an empty table gives no rows. All scans are linear in the text. A null ``doc_id``
is carried like any; ``detect`` ignores columns that ``keep`` does not name, and ``detect_and_redact`` carries all columns, whatever they
are called.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import kept, save

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "id", "name")
LABELERS = ("pattern", "check", "gazetteer", "context", "surroundings", "variety")

# Cue words, words that speak against a number being personal, given names, titles, and first
# digits of payment cards.
CUES = {
    "email": ("mail", "contact", "write", "send", "reach"),
    "ip": ("ip", "address", "host", "server", "from"),
    "card": ("card", "visa", "credit", "account", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "contact"),
    "secret": ("token", "secret", "key", "password", "passwd", "pwd", "auth"),
    "id": ("ssn", "social", "insurance", "tax", "id"),
    "name": ("dear", "mr", "mrs", "ms", "dr"),
}
AGAINST = ("version", "page", "isbn", "issn", "figure", "table", "chapter", "build", "order", "section", "part")
GIVEN = frozenset("""anna anne antonio carlos carmen charles claire daniel david elena emma ernst franz hans heinrich
helen james jean john jose juan julia karl laura louis lucas maria marie mark martin mary michael miguel nicolas
otto paul pedro peter pierre robert sarah sofia sophie susan thomas william wolfgang""".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "30", "36", "38")

_LOCAL_BACK = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Shapes of numbers, each searched on the whole text. Digits joined by a hyphen or dot belong to one number; a blank, a bracket
# and the end of a sentence part numbers.
_FROM, _TO = r"(?<![0-9])(?<![0-9][.-])", r"(?![.-]?[0-9])"
_LOCAL_PHONE = re.compile(rf"(?:\(|{_FROM}|(?<=\b1[.-]))[0-9]{{3}}\)?[ .-][0-9]{{3}}[ .-][0-9]{{4}}{_TO}")
_ID = re.compile(rf"{_FROM}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_TO}")
#: A group of four may begin a card after the end of another number, so cards may overlap.
_GROUPED = re.compile(rf"{_FROM}(?=([0-9]{{4}}([ -])[0-9]{{4}}\2[0-9]{{4}}\2[0-9]{{1,4}}{_TO}|[0-9]{{13,19}}{_TO}))")
_ASSIGNED = re.compile(r"[=:][ \t]{0,4}[\"']?([A-Za-z0-9+/_-]{16,})")
_NAMED = re.compile(r"\b(?:Dear|Mrs|Mr|Ms|Dr)\.? ([A-Z][a-z]+(?: [A-Z][a-z]+)?)\b")
_TITLES = ("Dear ", "Mr", "Ms", "Dr")
_LISTED = re.compile(rf"\b(?:{'|'.join(sorted(g.capitalize() for g in GIVEN))})\b(?: [A-Z][a-z]+\b)?")
_WORD = re.compile(r"[A-Za-z]+")

Span = tuple[int, str, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else (x * 2 - 9 if x > 4 else x * 2)
    return total % 10 == 0


def _emails(t: str) -> Iterator[Span]:
    """A local part is the whole run of its characters before an ``@``, since none of them is an ``@``."""
    end, at = 0, t.find("@")
    while at >= 0:
        start = at
        while start > end and _LOCAL_BACK.match(t, start - 1):
            start -= 1
        m = _DOMAIN.match(t, at + 1) if start < at else None
        if m:
            yield start, "email", m.end()
            end = m.end()
        at = t.find("@", max(at + 1, end))


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isascii() and c.isdigit())


def base_spans(t: str) -> list[Span]:
    """The base spans, ordered by start, then kind; matches that fail their check are dropped without a retry."""
    found = list(_emails(t))
    if _DIGIT.search(t):
        if "." in t:
            for m in _DOTTED.finditer(t):
                parts, at = m.group().split("."), m.start()
                if len(parts) >= 4:
                    for i in range(0, len(parts) - 3, 4):
                        four = parts[i:i + 4]
                        end = at + sum(map(len, four)) + 3
                        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                            found.append((at, "ip", end))
                        at = end + 1
        for m in _CARD.finditer(t):
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                found.append((m.start(), "card", m.end()))
        if "+" in t:
            found.extend((m.start(), "phone", m.end()) for m in _PHONE.finditer(t) if 10 <= len(_digits(m.group())) <= 15)
    return sorted(found, key=_order)


def _order(s: Span):
    return s[0], KINDS.index(s[1]), s[2]


def more_candidates(t: str) -> Iterator[Span]:
    """Spans of a wider shape that may be personal data."""
    if _DIGIT.search(t):
        for kind, shape, group in (("id", _ID, 0), ("phone", _LOCAL_PHONE, 0), ("card", _GROUPED, 1)):
            yield from ((m.start(group), kind, m.end(group)) for m in shape.finditer(t))
    if "=" in t or ":" in t:
        yield from ((m.start(1), "secret", m.end(1)) for m in _ASSIGNED.finditer(t))
    named = {(m.start(1), "name", m.end(1)) for m in _NAMED.finditer(t)} if any(x in t for x in _TITLES) else set()
    yield from named.union((m.start(), "name", m.end()) for m in _LISTED.finditer(t))


def candidates(t: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and the other candidates that meet none of them."""
    base = base_spans(t)
    ends = [(a, z) for a, _, z in base]
    return base, [s for s in sorted(more_candidates(t), key=_order) if not _overlaps(ends, s)]


def votes(t: str, span: Span, base: bool) -> str:
    """One character per labeler: ``+``, ``-`` or ``0``."""
    start, kind, end = span
    s, d = t[start:end], _digits(t[start:end])
    before = [w.lower() for w in _WORD.findall(t, max(0, start - 32), start)][-4:]
    sign = lambda good, bad: "+" if good else "-" if bad else "0"
    pattern = sign(base or kind == "id" or kind == "name" and " " in s or kind == "secret" and len(s) >= 32, False)
    check = "0"
    if kind == "card":
        check = sign(luhn(d), True)
    elif kind == "phone":
        check = sign(10 <= len(d) <= 15, True)
    elif kind == "id":
        check = sign(d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000", True)
    elif kind == "secret":
        check = sign(bool(d) and any(c.isalpha() for c in s), s.isdigit() or s.isalpha())
    gazetteer = "0"
    if kind == "card":
        gazetteer = sign(d.startswith(CARD_STARTS), True)
    elif kind == "name":
        gazetteer = sign(s.split(" ")[0].lower() in GIVEN, False)
    elif kind == "email":
        gazetteer = sign(s.rpartition(".")[2].isalpha(), True)
    context = sign(any(w.startswith(c) if len(c) > 3 else w == c for w in before for c in CUES[kind]),
                   any(w in AGAINST for w in before))
    left, right = t[start - 1:start], t[end:end + 1]
    glued = (left.isalnum() and s[:1].isalnum()) or (right.isalnum() and s[-1:].isalnum())
    kinds = len(set(s.lower()))
    return pattern + check + gazetteer + context + sign(not glued, glued) + sign(kinds >= 5, kinds <= 2)


def shape(t: str, span: Span) -> str:
    """Coarse shape of a span: a bounded number of values."""
    start, kind, end = span
    s = t[start:end]
    share = int(4 * sum(c.isdigit() for c in s) / len(s))
    return f"{min(6, len(s) // 6)}{share}{int(' ' in s)}{int('-' in s)}{int(t[start - 1:start] in tuple(chr(34) + chr(39)))}"


def spans_text(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{z}" for a, k, z in spans)


def label(docs: DataFrame, keep: str = "doc_id long") -> DataFrame:
    """``docs`` -> carried columns, counts of base spans, ``base_sha256``, ``base`` (their text form) and ``found``: all
    candidates with votes and shape."""
    import pyarrow as pa

    names = kept(keep)
    cand = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                               ("base", pa.bool_()), ("votes", pa.string()), ("shape", pa.string())]))

    def run(batches):
        for b in batches:
            out = {n: [] for n in (*(f"n_{k}" for k in BASE), "base_sha256", "base", "found")}
            for t in b.column("text"):
                t = t.as_py() or ""
                base, extra = candidates(t)
                for k in BASE:
                    out[f"n_{k}"].append(sum(s[1] == k for s in base))
                text = spans_text(base)
                out["base"].append(text)
                out["base_sha256"].append(hashlib.sha256(text.encode()).hexdigest())
                out["found"].append([{"kind": s[1], "start": s[0], "end": s[2], "base": is_base,
                                      "votes": votes(t, s, is_base), "shape": shape(t, s)}
                                     for some, is_base in ((base, True), (extra, False)) for s in some])
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), *(pa.array(out[f"n_{k}"], pa.int64()) for k in BASE),
                 pa.array(out["base_sha256"], pa.string()), pa.array(out["base"], pa.string()),
                 pa.array(out["found"], cand)], names=[*names, *out])

    counts = ", ".join(f"n_{k} long" for k in BASE)
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(
        run, (f"{keep}, " if names else "") + f"{counts}, base_sha256 string, base string, found array<struct<kind:string, start:bigint, "
             "end:bigint, base:boolean, votes:string, shape:string>>")


def _overlaps(spans: list[tuple[int, int]], s: Span) -> bool:
    """Whether ``s`` meets one of the ``spans``, sorted by start (spans of one kind are disjoint, so few reach far)."""
    from bisect import bisect_left

    i = bisect_left(spans, (s[2], 0))
    return any(spans[j][1] > s[0] for j in range(max(0, i - 2 * len(BASE)), i))


_VOTE = {"+": 1.0, "-": -1.0, "0": 0.0}


def fit_reliability(kind: np.ndarray, vote: np.ndarray, counts: np.ndarray, rounds: int = 100):
    """Expectation-maximisation. Start: labelers are right in 4 of 5 votes; a rate stays within 0.55 and 0.99."""
    right = np.full((2, vote.shape[1]), 0.8)
    prior = np.full(len(KINDS), 0.5)
    for _ in range(rounds):
        odds = np.log(prior / (1 - prior))[kind]
        odds = odds + (vote > 0) @ np.log(right[1] / (1 - right[0])) + (vote < 0) @ np.log((1 - right[1]) / right[0])
        post = 1 / (1 + np.exp(-odds))
        new = np.empty_like(right)
        for y, w in ((0, counts * (1 - post)), (1, counts * post)):
            agreed, voted = w @ (vote == (1 if y else -1)), w @ (vote != 0)
            new[y] = np.clip((agreed + 8) / (voted + 10), 0.55, 0.99)
        total = np.bincount(kind, counts, len(KINDS))
        prior = np.clip((np.bincount(kind, counts * post, len(KINDS)) + 1) / (total + 2), 0.02, 0.98)
        if np.abs(new - right).max() < 1e-9:
            break
        right = new
    return right, prior, post


def span_features(kind: str, vote: str, shp: str) -> list[float]:
    v = [_VOTE[c] for c in vote]
    return [1.0, *(float(kind == k) for k in KINDS), *(float(x > 0) for x in v), *(float(x < 0) for x in v),
            int(shp[0]) / 6, int(shp[1]) / 4, *(float(c) for c in shp[2:])]


def train(found: DataFrame, rounds: int = 400) -> list[float]:
    """Weights of the span classifier, from counts per (kind, votes, shape) over all candidates."""
    cells = (found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.shape")
             .groupBy("kind", "votes", "shape").count().orderBy("kind", "votes", "shape").toPandas())
    if not len(cells):
        return []
    counts = cells["count"].to_numpy(float)
    vote = np.array([[_VOTE[c] for c in v] for v in cells["votes"]])
    kind = np.array([KINDS.index(k) for k in cells["kind"]])
    _, _, post = fit_reliability(kind, vote, counts)
    x = np.array([span_features(*r) for r in cells[["kind", "votes", "shape"]].itertuples(index=False)])
    w, weight = np.zeros(x.shape[1]), counts / counts.sum()
    for _ in range(rounds):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-x @ w))
        g = x.T @ (weight * (p - post)) + 1e-4 * w
        step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-4 * np.eye(len(w)), g)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return [float(v) for v in w]


class Decider:
    """The span classifier: whether a candidate is personal data. Decisions are kept per votes and shape."""

    def __init__(self, weights: list[float], threshold: float):
        self.weights, self.least, self.known = np.array(weights), float(np.log(threshold / (1 - threshold))), {}

    def __call__(self, kind: str, vote: str, shp: str) -> bool:
        key = kind, vote, shp
        if key not in self.known:
            self.known[key] = float(np.dot(self.weights, span_features(*key))) >= self.least
        return self.known[key]


def classify(found: DataFrame, weights: list[float], threshold: float = 0.5) -> DataFrame:
    """Add ``spans``: base spans and the candidates that the classifier accepts, ordered by start, then kind."""
    @F.pandas_udf("string")
    def decide(rows):
        import pandas as pd

        accept = Decider(weights, threshold)
        return pd.Series([spans_text(sorted(((c["start"], c["kind"], c["end"]) for c in cands if c["base"] or accept(
            c["kind"], c["votes"], c["shape"])), key=_order)) for cands in rows])

    return found.withColumn("spans", decide("found"))


def detect(docs: DataFrame, keep: str = "doc_id long", threshold: float = 0.5) -> DataFrame:
    """Label all documents, fit on all of their candidates, classify. The labelled table (spans, not texts) is
    written once in the shared folder."""
    found = save(label(docs, keep), "pii")
    return classify(found, train(found), threshold)


def masked(t: str, spans: list[Span]) -> str:
    """Every span replaced by ``[KIND]``; overlapping spans become one, named by the first."""
    parts, at = [], 0
    for i, (a, kind, z) in enumerate(spans):
        if i and a < at:
            at = max(at, z)
            continue
        parts += [t[at:a], f"[{kind.upper()}]"]
        at = z
    return "".join([*parts, t[at:]])


def detect_and_redact(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` with the spans that were found masked in ``text``; all columns are carried. The labelers run twice, once for the
    counts and once where the text is at hand, so no text is stored or shuffled."""
    import pyarrow as pa

    weights = train(label(docs.select("text"), ""))
    place = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))]

    def run(batches):
        accept = Decider(weights, threshold)
        for b in batches:
            out = []
            for t in b.column(place):
                t = t.as_py()
                base, extra = candidates(t or "")
                spans = sorted([*base, *(s for s in extra if accept(s[1], votes(t, s, False), shape(t, s)))], key=_order)
                out.append(masked(t, spans) if spans else t)
            columns = list(b.columns)
            columns[place] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"{n} {t}" for n, (_, t) in zip(names, docs.dtypes))
    return docs.toDF(*names).mapInArrow(run, schema).toDF(*docs.columns)

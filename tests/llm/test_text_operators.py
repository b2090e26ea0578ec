"""Token output (7), SentencePiece (1), personal data (8), quality rules (9): one row per document, no joins."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from quire.llm import pii_labels, pieces, quality_rules, tokens
from quire.llm.queries import QUERIES, tokenizer_file

from .conftest import SF_SMALL, texts_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# --- operator 7

def expected_tokens(pairs):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_file("word_bpe_49k.json"))
    out, start = [], 0
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or "")):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_token_files_hold_the_ids(request, which):
    df = request.getfixturevalue(which)
    got = [tuple(r) for r in tokens.token_output(df, tokenizer_file("word_bpe_49k.json")).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected_tokens(texts_of(df))


def test_special_strings_and_marks_are_cut_as_the_tokenizer_does(spark):
    texts = ["<|endoftext|> a<|startoftext|>b", "don't,can't. we'll!x's 'tis", "a.b,c!! d?e 12.5% #x&y", "İ ΣΣ é.",
             "a\x1cb c d", "it's.'s ,'s", "a...'ll"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in tokens.token_output(df, tokenizer_file("word_bpe_49k.json"), encoding="dictionary").collect()]
    assert sorted(got) == expected_tokens(list(enumerate(texts)))


def test_case_is_lowered_by_the_tokenizer(spark):
    texts = ["<|ENDOFTEXT|> <|EndOfText|>x <|endoftext|>Y", "J\u030c H\u0331 T\u0308 aJ\u030cB,", "\u00c9T\u00c9 DON'T ABC<D", "<|StartOfText|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [tuple(r) for r in tokens.token_output(df, tokenizer_file("word_bpe_49k.json"), encoding="dictionary").collect()]
    assert sorted(got) == expected_tokens(list(enumerate(texts)))


def test_selective_reads(spark, docs, scratch):
    tokens.write_tokens(docs, f"{scratch}/t", tokenizer_file("word_bpe_49k.json"), 2, row_group_bytes=64 << 10)
    some = tokens.read_tokens(spark, f"{scratch}/t", 10, 14)
    assert [r[0] for r in some.orderBy("doc_id").collect()] == [10, 11, 12, 13, 14]
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,10)" in some._jdf.queryExecution().toString()
    meta = tokens.read_metadata(spark, f"{scratch}/t")
    plan = meta._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in re.findall(r"ReadSchema: (\S+)", plan)[0]
    r = meta.orderBy("start").collect()
    assert [x["start"] for x in r] == np.cumsum([0, *(x["n_tokens"] for x in r)])[:-1].tolist()
    import glob

    import pyarrow.parquet as pq

    col = pq.ParquetFile(glob.glob(f"{scratch}/t/part-*.parquet")[0]).metadata.row_group(0).column(4)
    assert "DELTA_BINARY_PACKED" in col.encodings and col.path_in_schema.startswith("ids")


def test_token_output_of_nothing(nothing):
    assert tokens.token_output(nothing, tokenizer_file("word_bpe_49k.json")).count() == 0


# --- operator 1

@pytest.fixture(scope="module")
def unigram():
    """The library's own N-best search over the same pieces, as a model without merges; it adds up in single
    precision, so pieces with scores of a billion are left out of the comparison."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as pb

    m = pb.ModelProto()
    with open(tokenizer_file("piece_bpe_32k.model"), "rb") as f:
        m.ParseFromString(f.read())
    m.trainer_spec.model_type = 1
    return SentencePieceProcessor(model_proto=m.SerializeToString())


def test_nbest_matches_the_library(unigram, docs):
    lattice = pieces.PieceLattice(tokenizer_file("piece_bpe_32k.model"))
    checked = 0
    for _, t in texts_of(docs)[:60]:
        for word in t[:300].split()[:12]:
            theirs = unigram.NBestEncodeAsIds(word, 5)
            score = [sum(unigram.get_score(i) for i in ids) for ids in theirs]
            if min(score) < -1e8 or any(unigram.is_byte(i) for ids in theirs for i in ids):
                continue
            ours = lattice.nbest(" " + word, 5)
            assert [s for s, _ in ours] == pytest.approx(sorted(score, reverse=True), abs=1)
            checked += 1
    assert checked > 100


def brute_nbest(lattice, text, n):
    """All segmentations, best first; ties by number of pieces, then ids from the end."""
    paths = {0: [(0.0, ())]}
    for z in range(1, len(text) + 1):
        paths[z] = []
        for a in range(z):
            piece = text[a:z]
            if piece in lattice.ids:
                paths[z] += [(s + lattice.score[piece], (*p, lattice.ids[piece])) for s, p in paths[a]]
            elif z == a + 1:
                raw = tuple(lattice.byte_id[b] for b in piece.encode())
                paths[z] += [(s + lattice.unknown, (*p, *raw)) for s, p in paths[a]]
    return sorted(paths[len(text)], key=lambda x: (-x[0], len(x[1]), x[1][::-1]))[:n]


@pytest.mark.parametrize("text", ["the", " hello", "aaaa", "a😀b", "  x", "l'été", "&&&", "\n\n a"])
def test_nbest_against_all_segmentations(text):
    lattice = pieces.PieceLattice(tokenizer_file("piece_bpe_32k.model"))
    assert lattice.nbest(text, 6) == brute_nbest(lattice, text, 6)


def test_units_and_whole_texts_agree(docs, edge):
    enc = pieces.PieceEncoder(tokenizer_file("piece_bpe_32k.model"))
    texts = [(t or "")[:150] for _, t in texts_of(docs)[:40] + texts_of(edge)]
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    _, _, got = enc.encode(np.concatenate(raw), offsets, 4)
    for t, best in zip(texts, got):
        want = enc.lattice.nbest(" " + t, 4) if t else [(0.0, ())]
        assert [s for s, _ in best] == [s for s, _ in want]
        assert tuple(best[0][1]) == want[0][1]
        assert len({tuple(x) for _, x in best}) == len(best)


def test_sentencepiece_round_trip(edge, nothing):
    model = tokenizer_file("piece_bpe_32k.model")
    coded = pieces.encode(edge, model, 3)
    r = coded.collect()
    assert all(x["decoded"] for x in r) and len(r) == edge.count()
    back = {x["doc_id"]: x["text"] for x in pieces.decode(coded, model).collect()}
    assert back == {i: t or "" for i, t in texts_of(edge)}
    same = [x for x in r if x["doc_id"] in (6, 7)]
    assert len(same) == 3 and len({tuple(x["ids"]) for x in same}) == 1
    assert pieces.encode(nothing, model).count() == 0 and pieces.digest(nothing, model).count() == 0


# --- operator 8

def luhn(s):
    x = [int(c) for c in s][::-1]
    return (sum(x[0::2]) + sum(sum(divmod(2 * v, 10)) for v in x[1::2])) % 10 == 0


BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(re.sub(r"\D", "", s)) <= 19 and luhn(re.sub(r"\D", "", s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(re.sub(r"\D", "", s)) <= 15)]


def base(t):
    return sorted(((m.start(), j, m.end()) for j, (_, p, ok) in enumerate(BASE) for m in re.finditer(p, t) if ok(m.group())))


@pytest.mark.parametrize("text", [
    "a@b.c", "a@b", "x@y@z.com", "a.b@c-d.e.f. g@h.i", "1.2.3.4.5.6.7.8", "1.2.3.256", "01.002.3.4", "1..2.3.4.5", "4111-1111-1111-1111",
    "4111 1111  1111 1111", "+1 (234) 567-8901", "+1234567890123456", "++1 234 567 890", "é@b.cd ü+1 555 555 5555.", "a@b.c@d.e", "@@a@b.c-",
    "1" * 40, "0000000000000000", "٣.٣.٣.٣ 1.1.1.1"])
def test_base_spans(text):
    assert pii_labels.base_spans(text) == [(a, BASE[j][0], z) for a, j, z in base(text)]


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_base_spans_stay(request, which):
    df = request.getfixturevalue(which)
    want = collections.Counter()
    for i, t in texts_of(df):
        s = ",".join(f"{BASE[j][0]}:{a}:{z}" for a, j, z in base(t or ""))
        want[i, hashlib.sha256(s.encode()).hexdigest()] += 1
    out = pii_labels.detect(df).collect()
    assert collections.Counter((r["doc_id"], r["base_sha256"]) for r in out) == want
    text = dict(texts_of(df))
    for r in out:
        assert set(filter(None, r["base"].split(","))) <= set(r["spans"].split(","))
        for s in filter(None, r["spans"].split(",")):
            kind, a, z = s.split(":")
            assert kind != "secret" or len(text[r["doc_id"]][int(a):int(z)]) >= 16


def test_secrets_are_added_and_masked(spark, nothing):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id < 300")
    out = pii_labels.detect(docs)
    text = dict(texts_of(docs))
    found = sum('token = "' in t for t in text.values())
    assert sum("secret:" in r["spans"] for r in out.collect()) == found > 0
    masked = dict(texts_of(pii_labels.detect_and_redact(docs)))
    assert not any(base(t) or re.search(r"[0-9a-f]{40}", t) for t in masked.values())
    assert all(masked[i] == t for i, t in text.items() if not base(t) and "token" not in t)
    assert pii_labels.detect(nothing).count() == 0 and pii_labels.detect_and_redact(nothing).count() == 0


@pytest.mark.parametrize("text, want", [
    ("123-45-6789 2019", ["id 123-45-6789"]), ("No. 1. 123-45-6789", ["id 123-45-6789"]), ("(123-45-6789)", ["id 123-45-6789"]),
    ("ID-123-45-6789, 123-45-6789-1 1.123-45-6789", ["id 123-45-6789"]),
    ("555-123-4567 555-987-6543", ["phone 555-123-4567", "phone 555-987-6543"]),
    ("Call 555-123-4567. 24 hours", ["phone 555-123-4567"]), ("(555) 123-4567 (555) 987-6543", ["phone (555) 123-4567", "phone (555) 987-6543"]),
    ("1-555-123-4567 or 21-555-123-4567", ["phone 555-123-4567"]), ("1(555) 123-4567", ["phone (555) 123-4567"]),
    ("2019 4111 1111 1111 1112", ["card 2019 4111 1111 1111", "card 4111 1111 1111 1112"]),
    ("1. 4111-1111-1111-1112 2", ["card 4111-1111-1111-1112"]), ("41111111111111112 9", ["card 41111111111111112"]),
    ("we met Anna Schmidt and Pedro, not Josefa", ["name Anna Schmidt", "name Pedro"]), ("Dear Maria Lopez,", ["name Maria Lopez"]),
    ("1234-45-67890 12345678901234567890 555-123-45678", [])])
def test_candidates_in_ordinary_text(text, want):
    assert [f"{k} {text[a:z]}" for a, k, z in pii_labels.candidates(text)[1]] == want


def test_numbers_next_to_others_are_masked(spark):
    rows = [(i, f"Her SSN {100 + i}-45-67{i % 90 + 10} 2019. Call 555-{200 + i}-4567 555-987-6543. It was Anna who came.") for i in range(50)]
    out = pii_labels.detect_and_redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["text"] for r in out} == {"Her SSN [ID] 2019. Call [PHONE] [PHONE]. It was [NAME] who came."}


def test_redaction_carries_all_columns(edge):
    edge = edge.selectExpr("*", "named_struct('a', 1, 'b', map('x', 2.5)) AS nested", "CAST(1 AS DECIMAL(10,2)) AS dec")
    out = pii_labels.detect_and_redact(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    assert out.where("spans <> 'spans!' or found <> 'found!'").count() == 0


# --- operator 9

def brute_rules(t):
    w = WORD.findall(t)
    c = collections.Counter(tuple(w[k:k + 8]) for k in range(len(w) - 7))
    cover = {p for k in range(len(w) - 7) if c[tuple(w[k:k + 8])] > 1 for p in range(k, k + 8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(cover)


@pytest.mark.parametrize("which", ["edge", "docs"])
def test_quality_statistics(request, which):
    df = request.getfixturevalue(which)
    want = collections.Counter((i, *brute_rules(t or "")) for i, t in texts_of(df))
    got = quality_rules.quality(df)
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert collections.Counter(tuple(r) for r in got.select(cols).collect()) == want
    assert got.where("p_good < 0 or p_good > 1 or p_good is null").count() == 0


def test_quality_verdicts_follow_the_labels(spark, docs):
    kept = QUERIES["op9_quality_rules"](spark, SF_SMALL).select("doc_id", "kept")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").join(kept, "doc_id")
    n = {(r[0], r[1]): r[2] for r in labels.groupBy("quality", "kept").count().collect()}
    good, bad = n.get((1, True), 0), n.get((0, False), 0)
    assert good >= 0.95 * (good + n.get((1, False), 0)) and bad >= 0.8 * (bad + n.get((0, True), 0))


def test_em_recovers_reliabilities():
    rng = np.random.default_rng(3)
    y = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.97, 0.92])
    seen = rng.random((len(y), 4)) < 0.9
    vote = np.where(rng.random((len(y), 4)) < right, 1, -1) * np.where(y, 1, -1)[:, None] * seen
    p, c = np.unique(vote, axis=0, return_counts=True)
    m = quality_rules.fit_reliability(p, c.astype(float))
    assert m["prior"] == pytest.approx(0.8, abs=0.03) and np.abs(m["right"][1] - right).max() < 0.03
    assert quality_rules.fit_reliability(np.zeros((0, 4), int), np.zeros(0))["prior"] > 0


def test_quality_of_nothing(nothing):
    assert quality_rules.quality(nothing).count() == 0


def test_long_runs_are_searched_in_linear_time():
    import time

    lattice = pieces.PieceLattice(tokenizer_file("piece_bpe_32k.model"))
    for unit in ("abcde" * 8000, "a" * 8000):
        began = time.time()
        got = lattice.nbest(unit, 4)
        assert time.time() - began < 8  # seconds; a copy of the pieces per entry takes half a minute
        assert len({ids for _, ids in got}) == 4 and [s for s, _ in got] == sorted((s for s, _ in got), reverse=True)
        assert all(b"".join(lattice.bytes[i] for i in ids).decode() == unit for _, ids in got)


def test_units_searched_together(monkeypatch):
    import random

    r = random.Random(3)
    lattice = pieces.PieceLattice(tokenizer_file("piece_bpe_32k.model"))
    units = {"".join(r.choice("aeinrst ,.éÜ日😀\x00\t") for _ in range(r.randint(1, 24))) for _ in range(400)}
    units = [*sorted(units), " " * 40, " ", "\x01", "😀", "�x", "日本語" * 5, "the" * 30, *words(300, 7, "etaoin")]

    def one_by_one(lattice):
        for u in units:
            got = lattice.nbest(u, 2)
            yield list(got[0][1]), got[0][0], got[0][0] - got[1][0] if len(got) > 1 else float("inf")

    def together(lattice):
        ids, values = lattice.best_of(units)
        return [(i.tolist(), *v) for i, v in zip(ids, values.tolist())]

    assert together(lattice) == list(one_by_one(lattice))
    flat = pieces.PieceLattice(tokenizer_file("piece_bpe_32k.model"))  # few different scores: many ties
    flat.score = {t: -float(len(t) // 3) for t in flat.ids}
    flat.unknown = -3.0
    flat.trie = {t: x and (flat.score[t], x[1]) for t, x in flat.trie.items()}
    flat.scores[list(flat.ids.values())] = list(flat.score.values())
    assert together(flat) == list(one_by_one(flat))
    # no search of its own for a short unit; one for a long one, whose passes it would have to itself
    enc, calls, nbest = pieces.PieceEncoder(tokenizer_file("piece_bpe_32k.model")), [], pieces.PieceLattice.nbest
    monkeypatch.setattr(pieces.PieceLattice, "nbest", lambda self, u, n: calls.append(u) or nbest(self, u, n))
    monkeypatch.setattr(pieces, "_TOGETHER", 1000)
    long = "e" * 400
    ids, values = enc.search([*units, long])
    assert calls == [long]
    assert [(i.tolist(), *v) for i, v in zip(ids, values.tolist())] == [*one_by_one(lattice), (
        list(nbest(lattice, long, 2)[0][1]), *[nbest(lattice, long, 2)[0][0], nbest(lattice, long, 2)[0][0] - nbest(lattice, long, 2)[1][0]])]

"""Operators 11 to 13 against brute force, round trips and damaged input."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.llm import align, spelling, warc
from quire.llm.queries import QUERIES, tokenizer_file

from .conftest import CLASHING, SF_SMALL

BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


# --- operator 11

def page_rows():
    big = "<p>é😀" + "x" * 3000
    return [(1, "http://a/b c", "short"), (2, None, None), (3, "u", big), (7, "u", big), (5, "v", big), (9, "w", "y" * 1000), (8, "w", "y" * 1000),
            (10, "w", "z" * 999), (11, "w", "z" * 999), (12, "w", "HTTP/1.1\r\n\r\n5\r\nWARC/1.1\r\n" * 3000), (None, "n", big),
            (13, "w", "q" * 200_000), (13, "w", "q" * 200_000), (None, "m", "m" * 2000)]


def expected_pages(rows, least=1000):
    out = []
    for key, _, html in rows:
        raw = (html or "").encode()
        top = max((k for k, _, h in rows if (h or "") == (html or "") and k is not None), default=None)
        revisit = len(raw) >= least and top is not None and key != top
        out.append((key, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def pages_back(spark, path):
    found = warc.resolve_revisits(warc.read_warc(spark, path)).selectExpr(
        "cast(key as long)", "payload_bytes", "payload_digest", "type", "cast(refers_key as long)", "error").collect()
    assert all(r["error"] is None for r in found)
    return sorted((tuple(r)[:5] for r in found), key=str)


@pytest.mark.parametrize("segment_bytes,file_records", [(16 << 10, 16_384), (700, 3)])
def test_archive_round_trip(spark, scratch, segment_bytes, file_records):
    df = spark.createDataFrame(page_rows(), "page_id long, url string, html string").selectExpr(
        "*", *(f"'{c}!' AS {c}" for c in (*CLASHING, "key", "payload", "sha1", "rid", "size")))
    path = f"{scratch}/warc-{segment_bytes}"
    warc.write_warc(df, path, segment_bytes=segment_bytes, file_records=file_records)
    assert pages_back(spark, path) == expected_pages(page_rows())
    records = warc.read_records(spark, path)
    assert records.where(F.length("block") > segment_bytes).isEmpty()
    if segment_bytes == 700:
        assert records.where("type = 'continuation'").count() > 100
    files = [r[0] for r in spark.read.format("binaryFile").load(path).select("content").collect()]
    assert all(gzip.decompress(f).startswith(b"WARC/1.1\r\nWARC-Type: ") for f in files if f)  # any reader of gzip
    back = {r["key"]: bytes(r["payload"]).decode() for r in warc.read_warc(spark, path).where("key IS NOT NULL AND payload IS NOT NULL").collect()}
    assert back["12"] == page_rows()[9][2] and back["7"] == page_rows()[3][2] and back["2"] == ""


def test_archive_of_nothing(spark, scratch):
    warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), f"{scratch}/none")
    assert pages_back(spark, f"{scratch}/none") == []


def test_damaged_segments(spark):
    fields = "record_id string, type string, target_uri string, key string, refers_to string, sha1 string, origin string, segment int, total long, block binary, error string"
    block = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5;x=y\r\nhello\r\n3\r\n, w\r\n0\r\nTrailer: t\r\n\r\n"
    n, sha1 = len(block), hashlib.sha1(b"hello, w").hexdigest()

    def parts(o, cuts, total=n, sha=sha1, body=block):
        edges = [0, *cuts, len(body)]
        return [(o if k == 1 else f"{o}/{k}", "response" if k == 1 else "continuation", "u", o if k == 1 else None, None, sha if k == 1 else None,
                 o, k, total if k == len(edges) - 1 else None, body[a:z], None) for k, (a, z) in enumerate(zip(edges, edges[1:]), 1)]

    good, twice = parts("good", [10, 30, 50]), parts("twice", [20])
    missing = [p for p in parts("missing", [10, 30]) if p[7] != 2]
    headless = parts("headless", [10])[1:]
    rows = [*good[::-1], *twice, *twice, *missing, *headless, *parts("length", [9], n + 1), *parts("digest", [9], sha="0" * 40),
            *parts("framing", [9], n - 2, body=block[:-40] + block[-38:]), *parts("open", [9], None),
            ("plain", "response", "u", "plain", None, sha1, None, None, None, block, None),
            *twice[:1], (*twice[1][:9], b"other", None)]
    got = {r["record_id"]: r for r in warc.decode_records(warc.reassemble(spark.createDataFrame(rows, fields))).collect()}
    assert {k: r["error"] for k, r in got.items()} == {
        "good": None, "twice": "segments contradict", "missing": "segment missing", "headless": "segment missing", "length": "total length",
        "digest": "payload digest", "framing": got["framing"]["error"], "open": "segment missing", "plain": None}
    assert got["framing"]["error"] and bytes(got["good"]["payload"]) == bytes(got["plain"]["payload"]) == b"hello, w"


def test_foreign_and_cut_off_files():
    record = warc.header([("WARC-Type", "resource"), ("WARC-Record-ID", "<a>")], 5) + b"12345\r\n\r\n"
    whole = [({"warc-type": "resource", "warc-record-id": "<a>", "content-length": "5"}, b"12345", None)]
    one = [gzip.compress(record), gzip.compress(b"")]
    for raw in (record * 3, gzip.compress(record * 3), b"".join(one * 3)):
        assert list(warc.parsed(warc.inflated(raw, 7))) == whole * 3
    assert [e for _, _, e in warc.parsed(warc.inflated(record + record[:-8]))] == [None, "record cut off"]
    assert [e for _, _, e in warc.parsed(warc.inflated(record + b"junk"))] == [None, "record header"]
    assert [e for _, _, e in warc.parsed(warc.inflated(one[0] + b"\x1f\x8b\x08nonsense"))][-1] == "gzip"
    assert list(warc.parsed(warc.inflated(b""))) == []


def test_archive_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, QUERIES["op11_warc"](spark, SF_SMALL).collect()), key=str) == expected_pages(rows)


# --- operator 12

def brute_alignment(texts):
    """Digest rows by the contract, token by token, with the libraries called on whole texts."""
    from collections import Counter

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    bpe, sp = Tokenizer.from_file(tokenizer_file(BPE)), SentencePieceProcessor(model_file=tokenizer_file(PIECES))
    bpe.encode_special_tokens = True
    alphabet = align.byte_alphabet()
    docs = []
    for key, text in texts:
        a, b, groups = [], [], []
        if text:
            raw = (" " + text).encode()
            a = [(i, bytes(alphabet[c] for c in bpe.id_to_token(i))) for i in bpe.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode())
                 for i in sp.encode(text)]
            if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
                a, b = [], []
        x, y, at_a, at_b = [], [], 0, 0
        rest = list(b)
        for i, t in a:
            x.append(i)
            at_a += len(t)
            while at_b < at_a:
                y.append(rest[0][0])
                at_b += len(rest.pop(0)[1])
            if at_a == at_b:
                groups.append((x, y))
                x, y = [], []
        docs.append((key, a, b, groups))
    counts = Counter((x[-1], y[-1]) for d in docs for x, y in d[3])
    top = {}
    for (_, y), n in counts.items():
        top[y] = max(top.get(y, 0), n)
    out = []
    for key, a, b, groups in docs:
        names = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        pairs = [(x[-1], y[-1]) for x, y in groups]
        out.append((key, len(a), len(b), len(groups), len(pairs), sum(counts[p] == top[p[1]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(names.encode()).hexdigest() if groups else "", sum(len(x) * len(y) for x, y in groups)))
    return sorted(out, key=str)


def odd_texts():
    r = random.Random(5)
    return ["<|endoftext|> <s></s><unk> [INST]", "a▁b", "  two  blanks \n\n\tx ", "it's DON'T 'll x's\"'s", "née ÀÿÖ ×÷ a b  c  d\u0085e", "日本語テキスト 中文。",
            "😀👍🏽 é", "\x00\x01\x7f", "a" * 5000, "12 345,678.90 1a2b3c ²½", " ", "\n", "ﬁ ﬀ ａｂ", "x !!! ,a .b 'c d' \"e\" f;g", "é, é. .é ,é É' 'É ÷a a÷",
            "".join(r.choice("ab '.,é 　\n1") for _ in range(4000)), "�￾", "word " * 3000]


def test_alignment_against_brute_force(spark, edge, docs):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    rows += [(1000 + i, t) for i, t in enumerate(odd_texts())] + [(r["doc_id"] + 5000, r["text"]) for r in docs.limit(60).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'{c}!' AS {c}" for c in (*CLASHING, "a_ids", "n_a", "weight")))
    got = align.alignment_digest(df.repartition(3), tokenizer_file(BPE), tokenizer_file(PIECES))
    assert sorted(map(tuple, got.collect()), key=str) == brute_alignment(rows)


def test_products_against_dense():
    rng = np.random.default_rng(3)
    for n in (0, 1, 40):
        sizes = rng.integers(1, 6, n)
        cuts = np.unique(np.concatenate([rng.integers(0, int(sizes.sum()) + 1, n // 2), [0, int(sizes.sum())]]))
        x, y = sizes, np.diff(cuts)
        found = align.Alignment(x, y)
        ax, ay = np.cumsum(x), np.cumsum(y)
        dense = [[max(0, min(e, f) - max(e - s, f - t)) for f, t in zip(ay, y)] for e, s in zip(ax, x)]
        expected = [(i, j, v) for i, row in enumerate(dense) for j, v in enumerate(row) if v]
        assert [t for blk in found.overlap_links() for t in zip(*(c.tolist() for c in blk))] == expected
        assert list(zip(found.end_a.tolist(), found.end_b.tolist())) == [(i, j) for i, j, _ in expected if ax[i] == ay[j]]
        group_a, group_b = (np.searchsorted(ax[found.end_a], e) for e in (ax, ay))
        assert [(i, j) for blk in found.group_links() for i, j in zip(blk[0].tolist(), blk[1].tolist())] == [
            (i, j) for i, g in enumerate(group_a) for j, h in enumerate(group_b) if g == h]
    a, b = rng.integers(0, 3, (7, 11)) * (rng.random((7, 11)) < .4), rng.integers(0, 3, (11, 5)) * (rng.random((11, 5)) < .5)

    def csr(m):
        return align.CSR(np.concatenate([[0], np.cumsum((m != 0).sum(1))]), np.nonzero(m)[1], m[m != 0], m.shape[1])

    for block in (1, 8, 1000):
        out = np.zeros((7, 5), int)
        for r, c, v in csr(a).product(csr(b), block):
            assert not out[r, c].any()
            out[r, c] = v
        assert (out == a @ b).all()


def test_pairs_are_bounded_by_the_vocabularies():
    pair = align.Pair(tokenizer_file(BPE), tokenizer_file(PIECES))
    a, b = set(pair.a.entries) - {b""}, set(pair.b.entries) - {b""}
    some = sorted(a)[::97]
    small = align.Pair.__new__(align.Pair)
    small.a, small.b = align.Side(some), align.Side(sorted(b)[::31])
    assert small.pair_bound() == sum(x.endswith(y) or y.endswith(x) for x in some for y in small.b.entries)
    assert 0 < pair.pair_bound() < 1_000_000


def test_links_of_all_kinds(spark):
    df = spark.createDataFrame([(1, "unbelievable news"), (2, None), (None, "x")], "doc_id long, text string")
    by = {k: align.links(df, tokenizer_file(BPE), tokenizer_file(PIECES), k).collect() for k in ("overlap", "end", "group")}
    pair = align.Pair(tokenizer_file(BPE), tokenizer_file(PIECES))
    for r in by["end"]:
        x, y = pair.a.entries[r["a_id"]], pair.b.entries[r["b_id"]]
        assert x.endswith(y) or y.endswith(x)
    assert {(r["doc_id"], r["a"], r["b"]) for r in by["end"]} <= {(r["doc_id"], r["a"], r["b"]) for r in by["overlap"]}
    assert sum(r["weight"] for r in by["overlap"] if r["doc_id"] == 1) == len(" unbelievable news") and len(by["group"]) >= len(by["end"])
    with pytest.raises(ValueError):
        align.links(df, "", "", "none")


def test_alignment_of_nothing(nothing):
    assert align.alignment_digest(nothing, tokenizer_file(BPE), tokenizer_file(PIECES)).count() == 0


# --- operator 13

def near(a, b):
    """Whether one insertion, deletion or replacement of a code point turns ``a`` into ``b``."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_spelling(rows, times=10):
    import re
    from collections import Counter

    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= 2}
    form, out = {}, []
    for w, n in words.items():
        others = [x for x in words if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= times * n else None
        out.append((w, n, len(others), form[w], words[best] if form[w] else None))
    roots = {}
    for w in words:
        at = w
        while form[at]:
            at = form[at]
        roots[w] = at
    return sorted((*r, roots[r[0]]) for r in out)


def spelled_texts():
    r = random.Random(11)
    base = ["".join(r.choice("abcdeé") for _ in range(r.randint(7, 12))) for _ in range(40)] + ["aaaaaaaa", "abababab", "ÀÿÀÿÀÿÀ", "banananana"]
    rows = []
    for i in range(300):
        text = []
        for _ in range(40):
            w = list(base[min(int(r.expovariate(0.15)), len(base) - 1)])
            for _ in range(r.choice([0, 0, 0, 0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w[at:at + r.choice([0, 1])] = r.choice(["", "a", "z", "É"])
            text.append("".join(w))
        rows.append((i, " ".join(text)))
    return [*rows, (300, None), (301, ""), (None, "Nothing Nothing nothing"), (302, "x" * 9000 + " " + "x" * 9000), (302, "x" * 9001)]


@pytest.mark.parametrize("block", [5000, 2])
def test_spelling_against_brute_force(spark, block):
    rows = spelled_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'{c}!' AS {c}" for c in (*CLASHING, "word", "key", "root")))
    words = spelling.count_words(df.repartition(4)).where("n >= 2")
    got = spelling.with_roots(spelling.variant_forms(words, block=block)).select("word", "n", "n_near", "form", "form_n", "root")
    expected = brute_spelling(rows)
    assert sorted(map(tuple, got.collect())) == expected
    assert sum(e[3] is not None for e in expected) > 50 and len({e[5] for e in expected}) < len(expected)


def test_chains_of_forms(spark):
    words = spark.createDataFrame([("aaaaaaa", 1_000_000), ("aaaaaab", 50_000), ("aaaaabb", 2_000), ("aaaabbb", 100), ("aaabbbb", 9), ("zzzzzzz", 5)], "word string, n long")
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.with_roots(spelling.variant_forms(words)).collect()}
    assert got == {"aaaaaaa": (None, "aaaaaaa"), "aaaaaab": ("aaaaaaa", "aaaaaaa"), "aaaaabb": ("aaaaaab", "aaaaaaa"),
                   "aaaabbb": ("aaaaabb", "aaaaaaa"), "aaabbbb": ("aaaabbb", "aaaaaaa"), "zzzzzzz": (None, "zzzzzzz")}


def test_pivots_are_the_lightest_disjoint_pair():
    r = random.Random(1)
    for _ in range(300):
        places = sorted(r.sample(range(12), r.randint(4, 9)))
        weights = [r.randint(1, 20) for _ in places]
        prefix = [(p, i) for i, p in enumerate(places)]
        a, b = spelling.pivots(prefix, weights)
        by = dict(zip(places, weights))
        assert b - a >= 2 and by[a] + by[b] == min(by[x] + by[y] for x in places for y in places if y - x >= 2)


def test_near_pairs_meet_once(spark):
    words = [w for w, *_ in brute_spelling(spelled_texts())]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [(r["a"], r["b"]) for r in spelling.near_pairs(df).collect()]
    assert sorted(got) == sorted((a, b) for a in words for b in words if a < b and near(a, b))


def test_spelling_of_nothing(nothing):
    assert spelling.spelling_groups(nothing).count() == 0

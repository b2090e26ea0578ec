"""Suffix-array dedup (2), Jaccard join (3), chat formatting (4), language (5), decontamination (6), quality classifier (10), pipeline."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from quire.llm import chat, common, jaccard_join, language_id, rule_ensemble, suffix_dedup, winnowing
from quire.llm.common import batches_of
from quire.llm.components import connected
from quire.llm.queries import QUERIES

from .conftest import SF_SMALL, texts_of, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- operator 2

def brute_dedup(pairs, span=200):
    raw = [(i, (t or "").encode()) for i, t in pairs]
    count = collections.Counter(t[k:k + span] for _, t in raw for k in range(len(t) - span + 1))
    out = []
    for i, t in raw:
        hit = np.zeros(len(t) + 1, int)
        for k in range(len(t) - span + 1):
            if count[t[k:k + span]] > 1:
                hit[k] += 1
                hit[k + span] -= 1
        gone = np.cumsum(hit)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((i, len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return collections.Counter(out)


@pytest.mark.parametrize("batches", [1, 4])
def test_dedup_small_texts(edge, batches):
    df = edge.where("doc_id is null or doc_id not in (11, 12)")
    got = collections.Counter(tuple(r) for r in suffix_dedup.dedup(df, batches=batches, digest=True).collect())
    assert got == brute_dedup(texts_of(df))


def test_dedup_documents(docs):
    got = collections.Counter(tuple(r) for r in suffix_dedup.dedup(docs, digest=True).collect())
    assert got == brute_dedup(texts_of(docs))


def test_dedup_edges_of_matches(spark):
    """Shared strings of 199, 200, 201 and more bytes, in different surroundings, overlapping, and in one text."""
    a = "".join(words(200, 11))
    rows = [(n, "".join(words(20, 100 + n)) + a[n:n + 150 + n] + "".join(words(30, 200 + n))) for n in range(45, 60)]
    rows += [(90, a[300:520] + "|" + a[310:512] + "|" + a[300:499]), (91, a[300:400] + a[300:600]), (92, "q" + a[555:755] + "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(tuple(r) for r in suffix_dedup.dedup(df, digest=True).collect())
    assert got == brute_dedup(rows)


def test_dedup_of_a_frequent_seed(spark, monkeypatch):
    line = "a very common line that many documents carry in their midst, word for word.\n"
    rows = [(i, " ".join(words(30, i)) + line * (1 + i % 3) + " ".join(words(40, 1000 + i % 7))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(suffix_dedup, "HOT_PART", 1)
    monkeypatch.setattr(suffix_dedup, "HOT_FROM", 3)
    got = collections.Counter(tuple(r) for r in suffix_dedup.dedup(df, digest=True).collect())
    assert got == brute_dedup(rows)


def test_a_passage_of_very_many_documents_gathers_nowhere(spark, monkeypatch):
    passage = " ".join(words(60, 21))[:300]
    rows = [(i, " ".join(words(30, i)) + passage + " ".join(words(30, 9000 + i))) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    for name, value in (("HOT_PART", 1), ("HOT_FROM", 3), ("WIDE_FROM", 50), ("WINDOWS_AT_ONCE", 4000)):
        monkeypatch.setattr(suffix_dedup, name, value, raising=False)
    seen, resolve = [], suffix_dedup.resolve
    monkeypatch.setattr(suffix_dedup, "resolve", lambda texts, found, *more: seen.append(found) or resolve(texts, found, *more))
    got = collections.Counter(tuple(r) for r in suffix_dedup.dedup(df, digest=True).collect())
    assert got == brute_dedup(rows)
    p = np.concatenate([np.frombuffer(r["block"], suffix_dedup.PLACE) for r in seen[0].where("kind = 'place'").collect()])
    one_task = p[p["wide"] == 0] if "wide" in p.dtype.names else p
    assert len(p) > 700 and max(collections.Counter(one_task["key"].tolist()).values(), default=0) < 100


@pytest.mark.parametrize("copies", [2, 2000])
def test_copies_send_the_bytes_of_one(spark, monkeypatch, copies):
    passage = "".join(random.Random(7).choices("abcdefghijklmnop ", k=700))
    text = "".join(random.Random(8).choices("qrstuvwxyz ", k=400)) + passage
    rows = [(i, text) for i in range(copies)] + [(copies, passage + "".join(random.Random(9).choices("0123456789 ", k=400)))]
    sent, streamed = [], suffix_dedup._streamed

    def spy(df, *more):
        if "data" in df.columns:
            sent.append(df.agg(F.sum(F.length("data"))).first()[0])
        return streamed(df, *more)

    monkeypatch.setattr(suffix_dedup, "_streamed", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got = collections.Counter(tuple(r) for r in suffix_dedup.dedup(df, digest=True).collect())
    two = brute_dedup([rows[0], rows[1], rows[-1]])  # a copy more does not change what goes
    assert sorted(k[1:] for k in two) == sorted(k[1:] for k in got if k[0] in (0, 1, copies))
    assert len({k[1:] for k in got}) == 2 and sum(got.values()) == copies + 1
    assert 0 < sum(sent) < 20 * len(text)


def test_a_passage_spread_thinly_is_counted(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "RARE_PART", 1)
    passage = "".join(random.Random(7).choices("abcdefghijklmnop ", k=300))
    texts = ["".join(random.Random(100 + i).choices("qrstuvwxyz ", k=300)) + passage * (i % 40 == 0) for i in range(1200)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(1).select(F.xxhash64("text").alias("cls"), "text")
    with batches_of(spark, 10):  # hardly ever twice in a batch
        hot, _ = suffix_dedup.frequent_seeds(df, 200, 32)
    assert len(hot)


def test_matched_windows_are_sent_once():
    w = np.zeros(6, suffix_dedup.WINDOW)
    w["one"], w["doc"], w["gives"] = [1, 1, 1, 2, 2, 3], [1, 2, 3, 4, 4, 5], [0, 0, 1, 0, 0, 0]
    sent, twice = suffix_dedup.matched(w, 200)
    assert sent[["one", "gives"]].tolist() == [(1, 1), (2, 0), (3, 0)] and twice["doc"].tolist() == [1, 2]


def test_levels_merge_geometrically(spark, docs):
    index = suffix_dedup.LogIndex(spark, np.zeros(0, np.uint64), 5)
    texts = docs.select(F.xxhash64("text").alias("cls"), "text")
    sizes = []
    for i in range(5):
        index.insert(texts.where(F.pmod(F.shiftright("cls", 8), F.lit(5)) == i))
        sizes.append([n for n, _ in index.levels])
    assert sizes == [[1], [2], [2, 1], [4], [4, 1]]


def test_dedup_of_nothing(nothing):
    assert suffix_dedup.dedup(nothing).count() == 0


# --- operator 3

def brute_join(pairs):
    sets = []
    for i, t in pairs:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append((i, {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()))
    parent = list(range(len(sets)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    where = collections.defaultdict(list)
    for a, (_, s) in enumerate(sets):
        for x in s:
            where[x].append(a)
    for a, (_, s) in enumerate(sets):
        for b, k in collections.Counter(b for x in s for b in where[x] if b > a).items():
            if 100 * k >= 75 * (len(s) + len(sets[b][1]) - k):
                parent[root(b)] = root(a)
    least = collections.defaultdict(list)
    for a, (i, _) in enumerate(sets):
        if i is not None:
            least[root(a)].append(i)
    return collections.Counter((i, len(s), (min(least[root(a)], default=None) if s else i)) for a, (i, s) in enumerate(sets))


def joined(df, **kw):
    return collections.Counter(tuple(r) for r in jaccard_join.join_components(df, **kw).collect())


def test_join_edges(edge):
    assert joined(edge) == brute_join(texts_of(edge))


def test_join_documents(docs):
    assert joined(docs) == brute_join(texts_of(docs))


def test_join_of_large_groups(spark):
    """Near copies around the threshold and documents that share a passage, with groups split into small parts and known
    frequencies for few tokens."""
    base, passage = words(60, 21), words(40, 22)
    rows = []
    for i in range(70):
        w = [*base]
        for k in range(i % 9):
            w[(i * 7 + k * 13) % 60] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
        rows.append((1000 + i, " ".join([*passage, *words(10 + i, 500 + i)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_join(rows)
    assert joined(df) == want
    assert joined(df, block=10, known_tokens=5) == want


@pytest.mark.parametrize("broadcast", [True, False])
def test_components_are_named_by_their_least_id(spark, monkeypatch, broadcast):
    """A component of most classes, a class of most documents, classes without links or ids, and empty texts."""
    if not broadcast:
        monkeypatch.setattr(common, "sized_broadcast", lambda df, limit=0: df)
    rows = [(5000 + i, 9, i % 1500) for i in range(3000)] + [(10_000 + i, 9, 7) for i in range(3000)]
    rows += [(3, 9, 1499), (None, 9, 1500), (None, 9, 1501), (8, 9, 1501), (40, 0, -1), (None, 0, -1)]
    label = [(c, 0) for c in range(1500) if c != 1]  # class 1 is linked with nothing
    df = spark.createDataFrame(rows, "doc_id long, n long, cls long").repartition(8)
    reps = df.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs"))
    got = jaccard_join.name_components(df, reps, spark.createDataFrame(label, "node long, component long"))
    want = {c: 3 for c in range(1500)} | {1: 5001, 1500: None, 1501: 8}
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter(
        (d, n, want[c] if n else d) for d, n, c in rows)


def test_join_of_nothing(nothing):
    assert jaccard_join.join_components(nothing).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (7, 3), (200, 200)] + [(300, 301 + i) for i in range(30)]
    got = {r[0]: r[1] for r in connected(spark.createDataFrame(chain, "src long, dst long")).collect()}
    assert {got[i] for i in range(41)} == {0} and got[101] == got[100] == 100 and got[330] == 300 and 200 not in got


# --- operator 4

def test_events_fold_in_order(spark):
    ev = [(1, 5, 1, "delta", "assistant", "lo"), (1, 4, 1, "delta", "assistant", "hel"), (1, 2, 1, "delta", "assistant", "draft"),
          (1, 3, 1, "regenerate", "assistant", None), (1, 1, 0, "message", "user", "hi"), (1, 6, 0, "edit", None, "hi there"),
          (2, 1, 0, "delta", None, None), (None, 1, None, "message", "user", "lost"), (1, 7, 2, "regenerate", "assistant", "x")]
    df = spark.createDataFrame(ev, "conv_id long, seq long, turn long, kind string, role string, text string").withColumn("n", F.lit("!"))
    got = {(r[0], r[1]): (r[2], r[3]) for r in chat.fold_events(df).collect()}
    assert got == {(1, 0): ("user", "hi there"), (1, 1): ("assistant", "hello"), (1, 2): ("assistant", "x"), (2, 0): ("", ""),
                   (None, None): ("user", "lost")}


NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user<|text|>x<|end|>\n", "\\l\\b\\\\<[", "", "\\", "<", "é😀\n", "a\\l"]


def test_format_is_reversible(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", s) for t, s in enumerate(NASTY)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.format_chat(df).select("*", chat.parse_chat(F.col("formatted")).alias("m"), chat.learned_text(F.col("segments")).alias("l")).first()
    assert [(m["role"], m["text"]) for m in r["m"]] == [(x[2], x[3]) for x in rows]
    learned = [x[3] for x in rows if x[2] == "assistant"]
    assert r["l"] == "".join(learned)
    unescape = lambda s: "\\".join(p.replace("\\l", "<").replace("\\b", "[") for p in s.split("\\\\"))
    assert [unescape(r["formatted"][s["start"]:s["end"]]) for s in r["loss_spans"]] == learned
    assert r["formatted"].count("<") == 3 * len(rows) and "[INST]" not in r["formatted"]


def test_chat_rows_survive(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, "assistant", "y" * 1000), (1, 1, "assistant", "y" * 1000), (2, None, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chat(chat.fold_events(chat.log_of_rows(df))).select("conv_id", chat.parse_chat(F.col("formatted")).alias("m"))
    got = {r[0]: [(m["role"], m["text"]) for m in r[1]] for r in out.collect()}
    assert got == {1: [("user", ""), ("", "x"), ("assistant", "y" * 1000), ("assistant", "y" * 1000)], 2: [("assistant", "z")]}
    assert chat.format_chat(chat.fold_events(chat.log_of_rows(df.limit(0)))).count() == 0


# --- operator 5

def test_language_of_held_out_texts(spark):
    got = QUERIES["op5_language_id"](spark, SF_SMALL)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang")
    r = got.join(docs, "doc_id").where("held_out").selectExpr("count(*)", "sum(int(lang = lang_pred))", "min(score)", "max(score)").first()
    assert r[1] >= 0.97 * r[0] > 0 and 0 <= r[2] <= r[3] <= 1
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got.collect())


def test_language_edges(spark, edge, nothing):
    train = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = language_id.train(train)
    out = {r["doc_id"]: r for r in language_id.predict(edge, model).collect()}
    assert {i for i, r in out.items() if r["lang_pred"] == "und"} == {1, 2, 3, 19} and out[19]["score"] == 0
    assert out[6]["score"] == out[7]["score"]
    assert language_id.predict(nothing, model).count() == 0
    empty = language_id.train(nothing)
    assert {r["lang_pred"] for r in language_id.predict(edge, empty).collect()} == {"und"}
    one = language_id.train(train.where("lang = 'en'"))
    assert {r["lang_pred"] for r in language_id.predict(edge, one).collect()} == {"und", "en"}


def test_codewords_differ():
    for n in (2, 3, 5, 8, 60):
        c = language_id.codewords(n)
        apart = (c[:, None] != c).sum(2)[~np.eye(n, dtype=bool)]
        assert apart.min() >= max(1, c.shape[1] // 5) and (np.abs(c.sum(0)) < n).all()


# --- operator 6

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_contamination(docs, items):
    w = lambda t: ALNUM.findall((t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in items:
        x = w(t)
        n = min(13, len(x))
        for k in range(len(x) - n + 1 if x else 0):
            windows[tuple(x[k:k + n])].add(i)
    sizes = {len(k) for k in windows}
    out = set()
    for i, t in docs:
        x, hit, found = w(t), set(), set()
        for n in sizes:
            for k in range(len(x) - n + 1):
                if tuple(x[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(x[k:k + n])]
        out.add((i, len(x), len(hit), tuple(sorted(found))))
    return out


@pytest.mark.parametrize("short", [False, True])
def test_contamination(spark, docs, edge, short):
    d = docs.select("doc_id", "text").unionByName(edge.select((F.col("doc_id") + 10_000).alias("doc_id"), "text"))
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, None), (901, "!!"), (902, " ".join(words(70, 2)[3:30]).upper()), (903, items[0][1])]
    if short:
        items += [(904, "née ünï"), (905, "Two"), (906, "ab ab ab")]
        for i, n in enumerate(range(1, 13)):  # every size, taken from a document; and one that occurs nowhere
            items += [(910 + i, " ".join(words(70, 2)[40:40 + n])), (930 + i, " ".join(["zqzq", *words(70, 2)[5:4 + n]]))]
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["n_words"], r["n_hit"], tuple(sorted(r["items"]))) for r in winnowing.decontaminate(d, b).collect()}
    assert got == brute_contamination(texts_of(d), items)


def test_a_short_item_adds_only_candidates_that_have_it(spark, docs):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    d = docs.select("doc_id", "text")

    def near(more):
        b = spark.createDataFrame(items + more, "item_id long, text string")
        per_doc, _ = winnowing.candidates(d, winnowing.item_windows(b, 13))
        return {r["doc_id"] for r in per_doc.where(F.size("hit") > 0).collect()}

    having = collections.Counter(w for _, t in texts_of(d) for w in set(ALNUM.findall((t or "").translate(LOWER))))
    common, rare = having.most_common(1)[0][0], min(having, key=lambda w: (having[w], w))
    plain = near([])
    assert 0 < len(plain) < having[common] and having[rare] < 5
    assert near([(900, f"zqzq {common}"), (901, "zqzq"), (902, f"{common} zqzq {common}")]) == plain
    has_it = {i for i, t in texts_of(d) if rare in ALNUM.findall((t or "").translate(LOWER))}
    assert near([(900, rare)]) == plain | has_it


def test_families_cover_every_size():
    for span in (1, 2, 3, 5, 8, 13, 16, 50):
        for size in range(1, span + 1):
            k, w = winnowing.family(size, span)
            assert k >= 1 and w >= 1 and k + w - 1 <= size
        assert len({winnowing.family(n, span) for n in range(1, span + 1)}) <= 3 + span.bit_length()


def test_contamination_of_nothing(spark, docs, nothing):
    b = spark.createDataFrame([], "item_id long, text string")
    assert winnowing.decontaminate(docs, b).where("n_hit > 0").count() == 0
    assert winnowing.decontaminate(nothing, b).count() == 0


def test_decontamination_runs_no_python(spark, docs):
    plan = winnowing.decontaminate(docs, spark.read.parquet(f"{SF_SMALL}/benchmark.parquet"))
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_sigma_before_a_dot_is_a_candidate(spark):
    greek = [f"\u039f\u0394\u039f{c}\u03a3" for c in "\u0391\u0392\u0393\u0394\u0395\u0396\u0397\u0398\u0399\u039a\u039b\u039c\u039d"]
    d = spark.createDataFrame([(1, ".".join(greek)), (2, " ".join(greek)), (3, "'".join(greek))], "doc_id long, text string")
    b = spark.createDataFrame([(5, " ".join(greek))], "item_id long, text string")
    assert sorted((r["doc_id"], r["n_hit"]) for r in winnowing.decontaminate(d, b).collect()) == [(1, 13), (2, 13), (3, 13)]


# --- operator 10

def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_quality_classifier"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    r = got.selectExpr("count(*)", "sum(int(predicted = quality))", "min(score)", "max(score)").first()
    assert r[1] >= 0.97 * r[0] > 0 and 0 <= r[2] <= r[3] <= 1


def test_rule_paths():
    text = ("DecisionTreeClassificationModel: depth=2\n  If (feature 0 <= 0.5)\n   If (feature 1 > 1.0E-4)\n    Predict: 0.0\n"
            "   Else (feature 1 <= 1.0E-4)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 1.0\n")
    assert rule_ensemble.paths(text, ["a", "b"]) == {
        (("a", "<=", 0.5),), (("a", "<=", 0.5), ("b", ">", 1e-4)), (("a", "<=", 0.5), ("b", "<=", 1e-4)), (("a", ">", 0.5),)}


def test_rules_on_edges(spark, edge, nothing):
    model = rule_ensemble.RuleEnsemble(0.5, {(("symbols", ">", 0.1), ("log_words", ">", 1.0)): -3.0})
    out = rule_ensemble.score(edge, model)
    assert out.count() == edge.count() and out.where("score is null or score < 0 or score > 1").count() == 0
    kept = rule_ensemble.holds_back(edge, model, 0.0)
    assert kept.columns == edge.columns and kept.count() == edge.count()
    labels = spark.createDataFrame([(6, 1), (7, None), (None, 1)], "doc_id long, label int")
    assert rule_ensemble.score(edge, rule_ensemble.train(edge, labels)).agg(F.min("score")).first()[0] > 0.9
    assert rule_ensemble.score(nothing, rule_ensemble.train(nothing, labels.limit(0))).count() == 0


# --- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    now = docs
    for name, stage in P.STAGES[:-1]:
        before = {r[0] for r in now.select("doc_id").collect()}
        now = stage(spark, now, SF_SMALL).cache()
        assert now.columns == docs.columns and {r[0] for r in now.select("doc_id").collect()} <= before, name
        if name == "near_duplicates":
            want = brute_join(texts_of(docs.join(spark.createDataFrame([(i,) for i in before], "doc_id long"), "doc_id")))
            assert {r[0] for r in now.select("doc_id").collect()} == {i for i, _, c in want if i == c}
        if name == "decontamination":
            items = texts_of(spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
            bad = {i for i, n, hit, _ in brute_contamination(texts_of(docs), items) if hit and 20 * hit >= n}
            assert {r[0] for r in now.select("doc_id").collect()} == before - bad
    out = P.run(spark, SF_SMALL)
    assert out.count() == now.count() > 0 and out.where("not decoded").count() == 0


@pytest.mark.parametrize("table", ["edge", "nothing"])
def test_pipeline_on_edges(spark, request, table):
    import corpus_pipeline as P

    now = request.getfixturevalue(table)
    if "lang" not in now.columns or "source" not in now.columns:
        now = now.withColumn("source", F.lit("s"))
    now = now.withColumn("n_chars", F.length("text").cast("long"))
    for _, stage in P.STAGES:
        now = stage(spark, now, SF_SMALL).cache()
        now.count()
    assert now.where("not decoded").count() == 0

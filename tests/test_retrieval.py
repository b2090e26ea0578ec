"""Retrieval, prompts, extractive answers and summaries; invariants and a brute-force top-k check."""

import math

from conftest import SF_SMALL
from pyspark.sql import functions as F

from quire.functions.models import with_model
from quire.operators import index as IX
from quire.operators import retrieval as RT
from quire.plans.lookups import DEFAULT_QUESTIONS
from quire.session import read_table


def test_retrieve_bounds_and_order(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    r = RT.retrieve(docs, DEFAULT_QUESTIONS, k=4)
    rows = r.select("doc_id", "question_ord", "top").collect()
    assert len(rows) == docs.where(F.length("text") > 0).count() * 3
    for row in rows:
        d = [(t.distance, t.chunk_ord) for t in row.top]
        assert 1 <= len(d) <= 4 and d == sorted(d)


def test_top_k_by_key_matches_brute_force(spark):
    v = read_table(spark, SF_SMALL, "embeddings")
    q = RT.label_centroids(v)
    got = {(r.label, r.rank): r.vec_id for r in RT.top_k_by_key(v, q, "label", 4, salt_buckets=3).collect()}
    cents = {r.label: r.query for r in q.collect()}
    want = {}
    by_label = {}
    for r in v.collect():
        d = sum((float(x) - c) ** 2 for x, c in zip(r.embedding, cents[r.label]))
        by_label.setdefault(r.label, []).append((d, r.vec_id))
    for lab, lst in by_label.items():
        for i, (_, vid) in enumerate(sorted(lst)[:4]):
            want[(lab, i + 1)] = vid
    assert got == want


def test_two_queries_under_one_key(spark):
    v = spark.createDataFrame([(i, "k", [float(i), 0.0]) for i in range(9)], "vec_id long, key string, embedding array<double>")
    q = spark.createDataFrame([("k", 1, [0.0, 0.0]), ("k", 2, [8.0, 0.0])], "key string, q int, query array<double>")
    got = sorted((r.q, r.rank, r.vec_id) for r in RT.top_k_by_key(v, q, "key", 2, query_id="q").collect())
    assert got == [(1, 1, 0), (1, 2, 1), (2, 1, 8), (2, 2, 7)]
    asked = q.select(F.col("q").alias("query_id"), F.col("query").alias("embedding"))
    shared = sorted((r.query_id, r.rank, r.vec_id) for r in IX.top_k_all(v, asked, 2).collect())
    assert shared == got


def test_distances(spark):
    df = spark.createDataFrame([([1.0, 2.0], [4.0, 6.0])], "a array<double>, b array<double>")
    r = df.select(RT.l2_distance(F.col("a"), F.col("b")), RT.cosine_similarity(F.col("a"), F.col("b"))).first()
    zero = spark.createDataFrame([([0.0], [1.0])], "a array<double>, b array<double>")
    assert zero.select(RT.cosine_similarity(F.col("a"), F.col("b"))).first()[0] is None
    assert r[0] == 25.0 and math.isclose(r[1], 16 / (math.sqrt(5) * math.sqrt(52)))


def test_hashed_vectors_retrieve(spark):
    docs = spark.createDataFrame([(1, "Cats sleep a lot. " * 5 + "The deadline is on Friday. " + "Dogs bark at night. " * 5)],
                                 "doc_id long, text string")
    r = RT.retrieve(docs, ["when is the deadline", "dogs bark"], k=1, size=40, overlap=10, embed=RT.embed_hashed,
                    distance=RT.sparse_l2).orderBy("question_ord").collect()
    assert "deadline" in r[0].top[0].text and "Dogs bark" in r[1].top[0].text
    assert all(0 <= x.top[0].distance <= 2 for x in r)
    _, out = RT.embed_hashing(docs, num_features=1 << 10)
    v = out.first().embedding
    assert type(v).__name__ == "SparseVector" and v.size == 1 << 10


def test_answer_and_prompt(spark):
    docs = spark.createDataFrame([(1, "Cats sleep a lot. The deadline is Friday. Dogs bark.")],
                                 "doc_id long, text string")
    r = RT.answer(RT.stuff_prompts(RT.retrieve(docs, ["When is the deadline?", "Zebra?"]))).orderBy(
        "question_ord").collect()
    assert r[0].answer == "The deadline is Friday" and r[1].answer == ""
    assert r[0].prompt.startswith("Passages from the documents") and "Question: When is the deadline?" in r[0].prompt


def test_summary_respects_word_budget(spark):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    s = RT.summarise(docs, words=50)
    assert s.where((F.col("n_words") > 50) & (F.col("n_sentences") > 1)).count() == 0
    assert s.count() == docs.count()
    odd = spark.createDataFrame([(1, "word " * 300), (2, "1 2 3"), (3, None)], "doc_id long, text string")
    assert {r.doc_id: r.n_words for r in RT.summarise(odd).collect()} == {1: 300, 2: 0, 3: 0}


def test_with_model_stub(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "de")], "doc_id long, text string")

    def fn(model, b):
        b = b.copy()
        b["n"] = b["text"].str.len() * model
        return b[["doc_id", "n"]]

    out = with_model(docs, fn, "doc_id long, n long", load=lambda: 10)
    assert sorted(map(tuple, out.collect())) == [(1, 30), (2, 20)]


def vectors_with_ties(spark, n=400):
    import random

    r = random.Random(2)
    rows = [(i, [float(r.choice([0, 1, 2])) for _ in range(4)]) for i in range(n)] + [(n + i, [1.0, 1.0, 1.0, 1.0]) for i in range(300)] + [(-1, None)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute_nearest(rows, asked, k):
    return sorted((q, i + 1, v) for q, x in asked for i, (_, v) in enumerate(sorted(
        (sum((a - b) ** 2 for a, b in zip(x, y)), v) for v, y in rows if y is not None)[:k]))


def test_exact_search_in_lists_and_blocks(spark):
    rows, v = vectors_with_ties(spark)
    asked = [r for r in rows if r[0] % 20 == 0 or r[1] is None]
    q = spark.createDataFrame(asked, "query_id long, embedding array<float>")
    got = IX.top_k_all(v, q, 5, list_rows=50, block_queries=7)
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got.collect()) == brute_nearest(rows, [a for a in asked if a[1] is not None], 5)
    assert IX.top_k_all(v.limit(0), q, 5).count() == 0 and IX.top_k_all(v, q.limit(0), 5).count() == 0


def test_approximate_search(spark):
    rows, v = vectors_with_ties(spark)
    q = spark.createDataFrame([r for r in rows if r[0] % 20 == 0], "query_id long, embedding array<float>")
    centroids = IX.fit_centroids(v, cells=16)
    index = IX.build_cells(v, centroids)
    assert index.count() == len(rows) - 1  # every vector that there is
    exact = IX.top_k_all(v, q, 4)
    whole = IX.recall(IX.top_k_approx(index, q, centroids, 4, probes=16, list_rows=40, block_queries=9), exact).first()
    some = IX.recall(IX.top_k_approx(index, q, centroids, 4, probes=4), exact).first()
    assert whole.recall == 1.0 and 0 < some.recall <= 1.0 and whole.n_exact == 4 * whole.n_queries


def brute_terms(docs, questions, k, size, overlap):
    import re
    from collections import Counter

    def words(t):
        return [w for w in re.split(r"[^\w]+|_", t.lower()) if w]

    chunks = [(d, j, Counter(words(t[s:s + size]))) for d, t in docs if t
              for j, s in enumerate(range(0, max(1, len(t) - overlap), size - overlap))]
    df = Counter(w for _, _, c in chunks for w in c)
    out = []
    for i, question in enumerate(questions):
        asked, scored = Counter(words(question)), []
        for d, j, c in chunks:
            both = [w for w in asked if w in c]
            if both:
                scored.append((-sum(asked[w] * math.floor(1000 * (1 + math.log(c[w])) * math.log1p(len(chunks) / df[w])) for w in both), d, j))
        out += [(i, d, j, -s, n + 1) for n, (s, d, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_inverted_index_against_full_scoring(spark):
    import random

    r = random.Random(9)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "and"] * 12
    docs = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 3, 40, 300])))) for i in range(250)] + [(900, None), (901, "The the")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    questions = ["the of and w1", "w2 w2 w3 w4 the", "and the", "zzz", "", "w5 of w6 of w7 of w8 of"]
    index = IX.postings(df, 200, 20)
    got = IX.search_terms(index, IX.question_terms(questions, spark), 5)
    assert sorted(map(tuple, got.collect())) == brute_terms(docs, questions, 5, 200, 20)
    assert IX.search_terms(index.limit(0), IX.question_terms(questions, spark), 5).count() == 0


def test_validate_json(spark):
    from quire.operators.retrieval import validate_json

    answers = ['{"n": 1, "s": "a"}', '{"n": 1', "no", "[]", '{"n": "x", "s": "a"}', "{}", "", "  ", None, '{"n": 2, "z": {"n": 3}}', "null"]
    df = spark.createDataFrame(list(enumerate(answers)), "i long, a string")
    got = {r.i: (r.valid, r.parsed and r.parsed.n, r.parsed and r.parsed.s, r.parsed and r.parsed._corrupt)
           for r in validate_json(df, "a", "n long, s string").collect()}
    bad = lambda i: (False, None, None, answers[i])
    assert got == {
        0: (True, 1, "a", None), 1: bad(1), 2: bad(2), 3: bad(3), 4: bad(4), 5: (True, None, None, None),
        6: (False, None, None, None), 7: (False, None, None, None), 8: (False, None, None, None), 9: (True, 2, None, None), 10: bad(10)}


def test_a_list_meets_a_block_of_queries_in_bounded_memory(monkeypatch):
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from quire.operators import index as IX

    rng = np.random.default_rng(1)

    def table(n, id_col, col):
        x = rng.integers(0, 9, (n, 8)).astype(np.float32)  # many ties
        return x, pa.table({id_col: pa.array(np.arange(n)), col: pa.array(list(x), pa.list_(pa.float32()))})

    (x, v), (y, q) = table(IX.LIST_ROWS, "vec_id", "__v"), table(IX.BLOCK_QUERIES, "query_id", "__q")
    run = IX._nearest_in_list(4)
    tracemalloc.start()
    got = run(v, q)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32 << 20  # the distances of all queries of the block at once are 64 MB
    for i in (0, 63, 64, 700, 1023):
        d = ((x.astype(float) - y[i]) ** 2).sum(1)
        want = sorted(zip(d, range(len(d))))[:4]
        assert [(r["distance"], r["vec_id"]) for r in got.slice(4 * i, 4).to_pylist()] == [(a, b) for a, b in want]


def test_letters_are_counted_without_counting_characters(spark):
    from quire.operators.retrieval import embed_letters

    texts = ["", "abba zoo", "é ü 日本 ñandú 𝄞a", "z" * 50 + "́"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(1).select("t", embed_letters(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == {t: [float(t.count(chr(c))) for c in range(97, 123)] for t in texts}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "octet_length" in plan and "(length(" not in plan


def test_words_of_a_large_vocabulary(spark):
    from collections import Counter

    from quire.session import materialize

    words = [f"w{i}" for i in range(300) for _ in range(1 + 900 // (i + 1))]
    rows = materialize(spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, doc_id long"))
    df = materialize(rows.groupBy("word").agg(F.count(F.lit(1)).alias("df")))
    want = sorted((w, i, Counter(words)[w]) for i, w in enumerate(words))
    for bounds, anti in (((50, 1 << 20), True), ((1000, 600), True), ((1000, 1 << 20), False), ((0, 1 << 20), False)):
        got = IX.join_words(rows, df, max_words=bounds[0], max_bytes=bounds[1])
        assert sorted(map(tuple, got.select("word", "doc_id", "df").collect())) == want
        # only rows of rare words are left for the shuffle
        assert ("LeftAnti" in got._jdf.queryExecution().optimizedPlan().toString()) == anti


def test_words_counted_in_batches():
    import pyarrow as pa

    b = pa.RecordBatch.from_arrays([pa.array([9, 1, None, 1]), pa.array([0, 1, 2, 3], pa.int32()), pa.array(
        [["x"], ["b", "a", "", "b"], [""], ["a", "a", "é"]])], names=["doc_id", "chunk_ord", "words"])
    out = [sorted(tuple(r.values()) for r in got.to_pylist()) for got in IX._count_in_rows([b, b.slice(1), b.slice(2, 1), b.slice(0, 0)])]
    rest = [("a", 1, 1, 1), ("a", 1, 3, 2), ("b", 1, 1, 2), ("é", 1, 3, 1)]
    assert out == [sorted([*rest, ("x", 9, 0, 1)]), rest, [], []]


def test_scores_of_sentences_with_rare_words(spark):
    from quire.session import materialize

    docs = spark.createDataFrame([(i, ". ".join(" ".join(f"w{chr(97 + (i * j + k) % 23) * (1 + (i + k) % 9)}" for k in range(2 + j % 5)) for j in range(9)) + " w w. w")
                                  for i in range(60)] + [(60, "only once. 1 2. w w only"), (61, None), (62, "")], "doc_id long, text string")
    occ = RT.sentences(docs).select("doc_id", "sentence_ord", F.explode("words").alias("word"))
    idf = materialize(occ.groupBy("word").agg(F.countDistinct("doc_id").alias("df")).withColumn("idf", F.ln(F.lit(64.0) / (F.col("df") + 1))))
    by, known = {}, {r.word: r.idf for r in idf.collect()}
    for r in occ.collect():
        by.setdefault((r.doc_id, r.sentence_ord), []).append(known[r.word])
    want = sorted((*k, sum(v) / len(v), len(v)) for k, v in by.items())
    for most in (10_000, 40, 3, 0):
        got = RT.mean_idf(occ, idf, max_words=most)
        rows = sorted((r.doc_id, r.sentence_ord, r.score, r.n) for r in got.collect())
        assert [(*r[:2], r[3]) for r in rows] == [(*r[:2], r[3]) for r in want]
        assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(rows, want))
        # a row per occurrence is never sorted by word
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "sentence-parts" in got.inputFiles()[0] if most < 10_000 else "strategy=broadcast" in plan

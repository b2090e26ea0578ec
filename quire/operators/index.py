"""Shared indexes over all documents: nearest vectors (J12/W5) and weighted terms (C5 + J12).

Vectors: the table is cut into cells (one cell: exact search; cells around centroids: approximate search), every cell into lists of about
``LIST_ROWS`` vectors, and the queries that probe a cell into blocks of about ``BLOCK_QUERIES``. A task meets one list with one block,
keeps each query's ``k`` nearest and emits only those, so neither a popular cell nor a large query set lands in one task.

Terms: an inverted index holds per term the chunks that have it, with an integer weight. A question's terms are split by their bounds (the
term's largest weight times the question's): what a chunk can get from the weak terms alone stays below the ``k``-th best score that is already
known, so the postings of weak terms are only read for chunks that a strong term brought up (the MaxScore rule). The result is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import explode_rows
from quire.functions.text import SPLIT_CHUNK_OVERLAP, SPLIT_CHUNK_SIZE, split_text_fixed, window_starts
from quire.session import BROADCAST_MAX_BYTES, BROADCAST_MAX_ROWS, broadcast_if_small, materialize

LIST_ROWS = 8_192
BLOCK_QUERIES = 1_024
#: Queries whose distances to a whole list a task holds at once.
HELD_QUERIES = 64


# ---------------------------------------------------------------- nearest vectors

def _nearest_in_list(k: int):
    """Per (list of vectors, block of queries): every query's ``k`` nearest by ``(distance, vec_id)``. Distances come from matrix products
    of some queries at a time, which bound a task's memory; those near the ``k``-th are computed again coordinate by coordinate, so ties and the order are exact."""
    import numpy as np
    import pyarrow as pa

    def matrix(column):
        flat = column.combine_chunks()
        return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)

    def run(vectors, queries):
        found = []
        if vectors.num_rows and queries.num_rows:
            x, ids = matrix(vectors.column("__v")), vectors.column("vec_id").to_numpy()
            q, asked = matrix(queries.column("__q")), queries.column("query_id").to_numpy()
            xx, qq = (x * x).sum(1), (q * q).sum(1)
            m = min(k, len(ids))
            for at in range(0, len(q), HELD_QUERIES):
                part = slice(at, at + HELD_QUERIES)
                about = q[part] @ x.T
                about *= -2
                about += xx
                about += qq[part, None]
                limit = np.partition(about, m - 1, axis=1)[:, m - 1] + 1e-9 * (xx.max() + qq[part] + 1)
                for i, row in enumerate(about, at):
                    near = np.flatnonzero(row <= limit[i - at])
                    exact = ((x[near] - q[i]) ** 2).sum(1)
                    for j in np.lexsort((ids[near], exact))[:m]:
                        found.append((int(asked[i]), int(ids[near[j]]), float(exact[j])))
        columns = list(zip(*found)) if found else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()),
                         "distance": pa.array(columns[2], pa.float64())})

    return run


def search_cells(vectors: DataFrame, queries: DataFrame, k: int, list_rows: int = LIST_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """``(query_id, vec_id, distance, rank)``: the ``k`` nearest of the vectors ``(vec_id, __v, cell)`` in the cells that a query
    ``(query_id, __q, cell)`` names, ranked by ``(distance, vec_id)``. ``cell`` takes a bounded number of values, so the
    sizes of the cells are a small table."""
    lists = vectors.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / list_rows).cast("int").alias("lists"))
    blocks = queries.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_queries).cast("int").alias("blocks"))
    sizes = materialize(lists.join(blocks, "cell"), "cells")  # a row per cell
    v = vectors.join(F.broadcast(sizes), "cell").withColumn("list", F.pmod(F.xxhash64("vec_id"), F.col("lists")).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("cell", "list", "block", "vec_id", "__v")
    q = queries.join(F.broadcast(sizes), "cell").withColumn("block", F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int")).withColumn(
        "list", F.explode(F.sequence(F.lit(0), F.col("lists") - 1))).select("cell", "list", "block", "query_id", "__q")
    key = ["cell", "list", "block"]
    local = v.groupBy(*key).cogroup(q.groupBy(*key)).applyInArrow(_nearest_in_list(k), "query_id long, vec_id long, distance double")
    last = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return local.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)


def _sides(vectors: DataFrame, queries: DataFrame, id_col: str, vec_col: str, query_id: str, query_col: str):
    v = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("__v"))
    q = queries.where(F.col(query_col).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), F.col(query_col).alias("__q"))
    return v, q


def top_k_all(vectors: DataFrame, queries: DataFrame, k: int = 4, id_col: str = "vec_id", vec_col: str = "embedding",
              query_id: str = "query_id", query_col: str = "embedding", **sizes) -> DataFrame:
    """J12 over one shared index, exact: for every row of ``queries`` the ``k`` nearest of all ``vectors``. Null vectors are in no
    result; all vectors have one length. Ids are unique."""
    v, q = _sides(vectors, queries, id_col, vec_col, query_id, query_col)
    # one cell; computed from the ids, since a join on a literal would be planned as a product
    return search_cells(v.withColumn("cell", F.pmod("vec_id", F.lit(1))), q.withColumn("cell", F.pmod("query_id", F.lit(1))), k, **sizes)


def fit_centroids(vectors: DataFrame, cells: int = 64, sample_rows: int = 50_000, vec_col: str = "embedding", id_col: str = "vec_id",
                  seed: int = 1) -> list[list[float]]:
    """At most ``cells`` centroids of k-means over the ``sample_rows`` vectors with the smallest hash of their id."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    sample = vectors.where(F.col(vec_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(sample_rows).select(
        array_to_vector(F.col(vec_col).cast("array<double>")).alias("features"))
    sample = materialize(sample, "centroid-sample")
    n = sample.count()
    if not n:
        return []
    return [[float(x) for x in c] for c in KMeans(k=min(cells, n), seed=seed, maxIter=10).fit(sample).clusterCenters()]


def with_cells(df: DataFrame, vec_col: str, centroids: Sequence[Sequence[float]], probes: int) -> DataFrame:
    """A row per vector and each of its ``probes`` nearest centroids, ``cell``; at most 65,536 centroids travel with the tasks."""
    import numpy as np
    import pyarrow as pa

    known = df.sparkSession.sparkContext.broadcast(np.array(centroids, np.float64))
    names = df.columns

    def run(batches):
        c = known.value
        cc, m = (c * c).sum(1), min(probes, len(c))
        for b in batches:
            column = b.column(vec_col)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, c.shape[1]))
            near = np.argsort(cc[None, :] - 2 * (x @ c.T), axis=1, kind="stable")[:, :m]
            rows = pa.array(np.repeat(np.arange(len(column)), m))
            yield pa.RecordBatch.from_arrays([*(b.column(n).take(rows) for n in names), pa.array(near.reshape(-1).astype(np.int32))],
                                             names=[*names, "cell"])

    return df.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", cell int")


def build_cells(vectors: DataFrame, centroids, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The inverted lists: every vector with the cell of its nearest centroid, ``(vec_id, __v, cell)``, written once."""
    v = vectors.where(F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("__v"))
    return materialize(with_cells(v, "__v", centroids, 1), "vector-cells")


def top_k_approx(index: DataFrame, queries: DataFrame, centroids, k: int = 4, probes: int = 8, query_id: str = "query_id",
                 query_col: str = "embedding", **sizes) -> DataFrame:
    """J12, approximate: as ``top_k_all``, but a query meets only the vectors in its ``probes`` nearest cells of ``index``
    (``build_cells``). Distances are exact; a neighbour in a cell that is not probed is missed."""
    q = queries.where(F.col(query_col).isNotNull()).select(F.col(query_id).cast("long").alias("query_id"), F.col(query_col).alias("__q"))
    return search_cells(index, materialize(with_cells(q, "__q", centroids, probes), "probed-cells"), k, **sizes)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row ``(n_queries, n_exact, n_found, recall)``: the share of exact neighbours that the search found."""
    hit = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id").withColumn("hit", F.lit(1)), ["query_id", "vec_id"], "left")
    return hit.agg(F.countDistinct("query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_exact"),
                   F.coalesce(F.sum("hit"), F.lit(0)).alias("n_found")).withColumn("recall", F.col("n_found") / F.col("n_exact"))


# ---------------------------------------------------------------- weighted terms

#: Weights are whole numbers, so that sums, and with them ranks and ties, do not depend on the order of addition.
IMPACT = 1_000


NO_WORD = "[^\\p{L}\\p{N}]+"


def words_of(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), NO_WORD, -1), lambda w: w != "")


def _count_in_rows(batches):
    """Batches of ``(doc_id, chunk_ord, words)`` -> a row per chunk and distinct word with its count; empty words are left out."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for b in batches:
        words = b.column("words")
        coded = words.flatten().dictionary_encode()
        known, row = coded.dictionary, np.repeat(np.arange(len(words)), words.value_lengths().to_numpy())
        pairs, tf = np.unique(row * max(len(known), 1) + coded.indices.to_numpy(), return_counts=True)
        row, word = np.divmod(pairs, max(len(known), 1))
        real = pc.not_equal(known, "").to_numpy(zero_copy_only=False)[word]
        row, word, tf = pa.array(row[real]), pa.array(word[real]), tf[real]
        yield pa.RecordBatch.from_arrays([known.take(word), b.column("doc_id").take(row), b.column("chunk_ord").take(row), pa.array(tf, pa.int32())],
                                         names=["word", "doc_id", "chunk_ord", "tf"])


def frequent_from(df: DataFrame, max_words: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> int | None:
    """The least ``df`` from which on the words of ``(word, df)`` may be broadcast together, most frequent first: 1 if all may, None if none.
    The vocabulary grows with the input, but few rows have a rare word."""
    level = F.length(F.bin("df")).alias("level")  # of 2^(level - 1) rows at least
    sizes = df.groupBy(level).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("word") + 16).alias("size")).collect()
    words = size = 0
    least = None
    for x in sorted(sizes, reverse=True):
        words, size = words + x.n, size + x.size
        if words > max_words or size > max_bytes:
            return least
        least = 1 << (x.level - 1)
    return 1


def join_words(rows: DataFrame, df: DataFrame, **bounds) -> DataFrame:
    """``rows`` with the ``df``, number of rows, of their ``word``; ``df`` has a row for every word. Only rows of rare words are shuffled. Both
    tables are read twice, so they should be written ones."""
    least = frequent_from(df, **bounds)
    if least == 1:
        return rows.join(F.broadcast(df), "word")
    if least is None:
        return rows.join(df, "word")
    often = F.broadcast(df.where(F.col("df") >= least))
    seldom = rows.join(often.select("word"), "word", "left_anti").join(df.where(F.col("df") < least).hint("shuffle_merge"), "word")
    return rows.join(often, "word").unionByName(seldom)


def postings(docs: DataFrame, size: int = SPLIT_CHUNK_SIZE, overlap: int = SPLIT_CHUNK_OVERLAP) -> DataFrame:
    """The inverted index of all chunks: ``(word, doc_id, chunk_ord, weight)``, written once.

    ``weight = floor(IMPACT * (1 + ln tf) * ln(1 + chunks / chunks with the word))``. A word that nearly every chunk has weighs little but
    is indexed like any other. Empty and null texts have no chunks.
    """
    docs = docs.where(F.length("text") > 0)
    chunks = F.transform(split_text_fixed(F.col("text"), size, overlap), lambda c, i: F.struct(i.alias("chunk_ord"), c["text"].alias("text")))
    c = explode_rows(docs, ["doc_id"], chunks, "c", "__p").select(
        "doc_id", F.col("c.chunk_ord").alias("chunk_ord"), F.col("c.text").alias("chunk"))
    split = c.select("doc_id", "chunk_ord", F.split(F.lower("chunk"), NO_WORD, -1).alias("words"))
    n = docs.agg(F.coalesce(F.sum(F.size(window_starts(F.col("text"), size, overlap))), F.lit(0))).first()[0]
    rows = materialize(split.mapInArrow(_count_in_rows, f"word string, doc_id {docs.schema['doc_id'].dataType.simpleString()}, chunk_ord int, tf int"),
                       "term-rows")
    df = materialize(rows.groupBy("word").agg(F.count(F.lit(1)).alias("df")), "words")
    weight = F.floor(F.lit(IMPACT) * (1 + F.log(F.col("tf").cast("double"))) * F.log1p(F.lit(float(n)) / F.col("df")))
    return materialize(join_words(rows, df).select("word", "doc_id", "chunk_ord", weight.cast("long").alias("weight")), "postings")


def question_terms(questions: Sequence[str], spark) -> DataFrame:
    """``(question_ord, word, asked)``: the words of the questions with their counts. The questions are a parameter."""
    rows = spark.createDataFrame([(i, q) for i, q in enumerate(questions)], "question_ord int, question string")
    return rows.select("question_ord", F.explode(words_of(F.col("question"))).alias("word")).groupBy("question_ord", "word").agg(
        F.count(F.lit(1)).alias("asked"))


def search_terms(index: DataFrame, terms: DataFrame, k: int = 4) -> DataFrame:
    """``(question_ord, doc_id, chunk_ord, score, rank)``: the ``k`` chunks with the largest sum of ``asked * weight``, ranked by
    ``(-score, doc_id, chunk_ord)``. Exact; chunks without a common word are never returned.

    1. every term's bound; 2. the full scores of the chunks that stand highest in the lists of each question's strongest term give a
    threshold no larger than the ``k``-th best score; 3. strong terms are those without which a chunk cannot reach it; 4. chunks of strong
    terms whose sum and the weak terms' bounds reach it are completed from the weak terms' postings.
    """
    terms = broadcast_if_small(terms)
    hits = materialize(index.join(terms, "word").select("question_ord", "word", "doc_id", "chunk_ord",
                                                        (F.col("asked") * F.col("weight")).alias("gain")), "asked-postings")
    bounds = hits.groupBy("question_ord", "word").agg(F.max("gain").alias("bound"))
    by_bound = Window.partitionBy("question_ord").orderBy("bound", "word")
    bounds = materialize(bounds.withColumn("below", F.sum("bound").over(by_bound)).withColumn(
        "place", F.row_number().over(Window.partitionBy("question_ord").orderBy(F.desc("bound"), F.desc("word")))), "term-bounds")
    chunk = ["question_ord", "doc_id", "chunk_ord"]

    # 2: k chunks per question that the strongest term ranks first, with their full scores (two-phase, so a long list is no single task's)
    strongest = hits.join(broadcast_if_small(bounds.where("place = 1").select("question_ord", "word")), ["question_ord", "word"])
    strongest = strongest.withColumn("salt", F.pmod(F.xxhash64("doc_id", "chunk_ord"), F.lit(64)))
    order = [F.desc("gain"), "doc_id", "chunk_ord"]
    seeds = strongest.withColumn("r", F.row_number().over(Window.partitionBy("question_ord", "salt").orderBy(*order))).where(F.col("r") <= k)
    seeds = seeds.withColumn("r", F.row_number().over(Window.partitionBy("question_ord").orderBy(*order))).where(F.col("r") <= k)
    full = hits.join(broadcast_if_small(seeds.select(*chunk)), chunk).groupBy(*chunk).agg(F.sum("gain").alias("score"))
    known = full.groupBy("question_ord").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
    threshold = known.select("question_ord", F.when(F.col("n") >= k, F.col("least")).otherwise(F.lit(0)).alias("threshold"))

    # 3: a term is weak while it and all weaker ones together stay below the threshold
    split = materialize(bounds.join(threshold, "question_ord").select(
        "question_ord", "word", "bound", "threshold", (F.col("below") < F.col("threshold")).alias("weak")), "term-split")
    rest = split.groupBy("question_ord").agg(F.max("threshold").alias("threshold"), F.coalesce(
        F.sum(F.when(F.col("weak"), F.col("bound"))), F.lit(0)).alias("rest"))
    kinds = broadcast_if_small(split.select("question_ord", "word", "weak"))
    marked = hits.join(kinds, ["question_ord", "word"])

    # 4: candidates from strong terms alone, completed by the weak ones
    strong = marked.where("NOT weak").groupBy(*chunk).agg(F.sum("gain").alias("sum"))
    kept = materialize(strong.join(broadcast_if_small(rest), "question_ord").where(F.col("sum") + F.col("rest") >= F.col("threshold"))
                       .select(*chunk, "sum"), "candidates")
    weak = marked.where("weak").join(kept.select(*chunk), chunk, "left_semi").groupBy(*chunk).agg(F.sum("gain").alias("more"))
    scored = kept.join(weak, chunk, "left").select(*chunk, (F.col("sum") + F.coalesce("more", F.lit(0))).alias("score"),
                                                   F.pmod(F.xxhash64("doc_id", "chunk_ord"), F.lit(64)).alias("salt"))
    best = [F.desc("score"), "doc_id", "chunk_ord"]
    local = scored.withColumn("r", F.row_number().over(Window.partitionBy("question_ord", "salt").orderBy(*best))).where(F.col("r") <= k)
    return local.withColumn("rank", F.row_number().over(Window.partitionBy("question_ord").orderBy(*best))).where(
        F.col("rank") <= k).select(*chunk, "score", "rank")

"""Retrieval question answering as Spark operators.

The reference rebuilds an in-memory vector index per document and asks questions one at a time. Here:

* per-document retrieval (the default) keeps each document's chunks, vectors and questions inside its row:
  ranking is an ``array_sort`` over that document's chunks, so no shuffle is needed at all;
* a shared index partitioned by a key (``top_k_by_key``) is an equi-join on the key plus a two-phase top-k
  (salted local top-k, then a bounded global one), so a hot key never lands in one task.

Models are re-aimed as deterministic computations: a letter-frequency vector that SQL can reproduce, or the
``pyspark.ml`` hashing/IDF pipeline (``embed_hashing``), or a user model through ``functions.models.with_model``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import bind, explode_rows
from quire.functions.text import SPLIT_CHUNK_OVERLAP, SPLIT_CHUNK_SIZE, split_text_fixed

# Retrieval depth and summary length.
TOP_K = 4
SUMMARY_WORDS = 200
# Prompt templates ("stuff" question answering, summary, structured extraction).
QA_PROMPT = ("Passages from the documents:\n\n{context}\n\nAnswer from these passages alone; say so if they do not hold the "
             "answer.\nQuestion: {question}\nAnswer:")
SUMMARY_PROMPT = ("Please provide a concise summary of the following document in approximately {words} words."
                  "\n\nDocument:\n{text}")
EXTRACT_PROMPT = "{schema}\n\nDocument text:\n{text}\n\nReturn ONLY valid JSON. Do not include explanation."


# ---------------------------------------------------------------- C5, C6

def embed_letters(low: Column) -> Column:
    """C5 (SQL-reproducible form): 26 doubles, the count of each letter a-z in an already lower-cased text.

    The input must be a column or a lambda variable (not an expression): it is read once per letter. A letter is one byte, so sizes
    in bytes, which need no counting, tell the same as lengths.
    """
    return F.transform(F.sequence(F.lit(97), F.lit(122)),
                       lambda c: (F.octet_length(low) - F.octet_length(F.replace(low, F.chr(c), F.lit("")))).cast("double"))


def l2_distance(a: Column, b: Column) -> Column:
    """Squared Euclidean distance in double (same order as L2)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) ** 2), F.lit(0.0),
                       lambda acc, v: acc + v)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine similarity in double."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                      lambda acc, v: acc + v)
    na = F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    nb = F.sqrt(F.aggregate(b, F.lit(0.0), lambda acc, v: acc + v.cast("double") * v.cast("double")))
    return F.try_divide(dot, na * nb)  # null for a zero vector


def embed_hashed(low: Column, num_features: int = 1 << 18) -> Column:
    """C5 (column form of the hashing model): the words of an already lower-cased text as a sparse unit vector
    ``map<int,double>`` of hashed word counts. Pass it to ``retrieve`` together with ``distance=sparse_l2``; unlike raw letter
    counts it does not favour short chunks."""
    words = F.filter(F.split(low, "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")
    slots = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(num_features)).cast("int"))

    def counted(s):
        return F.transform(F.array_distinct(s), lambda i: F.struct(
            i.alias("i"), F.size(F.filter(s, lambda j: j == i)).cast("double").alias("n")))

    def unit(c):
        norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x["n"] * x["n"]))
        return F.element_at(F.transform(F.array(norm), lambda z: F.map_from_entries(
            F.transform(c, lambda x: F.struct(x["i"], (x["n"] / z).alias("v"))))), 1)

    counts = F.element_at(F.transform(F.array(slots), counted), 1)
    return F.element_at(F.transform(F.array(counts), unit), 1)


def sparse_l2(a: Column, b: Column) -> Column:
    """C6 over ``map<int,double>`` vectors: squared Euclidean distance."""
    def square(m):
        return F.aggregate(F.map_values(m), F.lit(0.0), lambda acc, v: acc + v * v)

    dot = F.aggregate(F.map_entries(a), F.lit(0.0), lambda acc, e: acc + e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0)))
    return square(a) + square(b) - 2 * dot


def embed_hashing(df: DataFrame, text_col: str = "text", num_features: int = 1 << 18, out_col: str = "embedding"):
    """C5 (model form): ``RegexTokenizer -> HashingTF -> IDF -> Normalizer`` fitted on ``df``; the vector stays a sparse
    ``pyspark.ml`` vector. Returns ``(model, transformed_df)``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer

    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern="[^\\p{L}\\p{N}]+", toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="__idf"),
        Normalizer(inputCol="__idf", outputCol="__vec", p=2.0),
    ])
    model = pipe.fit(df)
    out = model.transform(df).withColumnRenamed("__vec", out_col).drop("__tok", "__tf", "__idf")
    return model, out


# ---------------------------------------------------------------- J11, J12, W5

def ask(docs: DataFrame, questions: Sequence[str]) -> DataFrame:
    """Every question against every document with text (P7 guard); the question list is a parameter,
    exploded per document."""
    qs = F.array(*[F.struct(F.lit(i).alias("question_ord"), F.lit(q).alias("question"))
                   for i, q in enumerate(questions)])
    keep = [c for c in docs.columns]
    return (docs.where(F.length("text") > 0)
            .select(*keep, F.explode(qs).alias("q"))
            .select(*keep, "q.question_ord", "q.question"))


def retrieve(docs: DataFrame, questions: Sequence[str], k: int = TOP_K, size: int = SPLIT_CHUNK_SIZE,
             overlap: int = SPLIT_CHUNK_OVERLAP, embed=embed_letters, keep: Sequence[str] = (), distance=l2_distance) -> DataFrame:
    """J11 + J12 + W5, per-document index: for each (document, question) the ``k`` nearest chunks of that document.

    Chunks are C4 windows; distance is C6 over ``embed`` vectors; rank by ``(distance, chunk_ord)``. Chunk vectors
    are computed once per document, before the questions are exploded (the index is built once, not per
    question). Output ``(doc_id, text, question_ord, question, top)`` with ``top array<struct<distance,
    chunk_ord, text>>`` in rank order. All inside the row: no join, no shuffle.
    """
    lowered = F.transform(split_text_fixed(F.col("text"), size, overlap),
                          lambda c, i: F.struct(i.alias("chunk_ord"), c["text"].alias("text"),
                                                F.lower(c["text"]).alias("low")))
    chunks = F.transform(lowered, lambda c: F.struct(c["chunk_ord"].alias("chunk_ord"), c["text"].alias("text"),
                                                     embed(c["low"]).alias("v")))
    indexed = docs.where(F.length("text") > 0).select("doc_id", "text", *keep, chunks.alias("__chunks"))

    def ranked(q):
        return F.slice(F.array_sort(F.transform("__chunks", lambda c: F.struct(
            distance(c["v"], q).alias("distance"), c["chunk_ord"].alias("chunk_ord"), c["text"].alias("text")))), 1, k)

    asked = ask(indexed, questions)
    return asked.withColumn("top", bind(bind(F.lower("question"), embed), ranked)).drop("__chunks")


def top_k_by_key(vectors: DataFrame, queries: DataFrame, key: str, k: int = TOP_K, salt_buckets: int = 64,
                 id_col: str = "vec_id", vec_col: str = "embedding", qvec_col: str = "query",
                 query_id: str | None = None) -> DataFrame:
    """W5/J12 over a shared index partitioned by ``key``: the ``k`` nearest vectors of each query among the
    vectors with the same key, ranked by ``(distance, id)``. ``query_id`` names the column that tells the queries of one
    key apart (default: one query per key).

    Equi-join on ``key`` (each vector meets only its own key's queries), then a two-phase top-k: a local top-k
    per ``(key, query, salt)`` with ``salt = hash(id) % salt_buckets``, and the global top-k over at most
    ``salt_buckets * k`` candidates per query. A key holding a third of all vectors is thus spread over
    ``salt_buckets`` tasks instead of one; choose more for larger indexes.
    """
    from quire.session import broadcast_if_small

    # The query side is small (one vector per key and query): behind the size check it is broadcast, so the
    # vector table is joined map-side without being shuffled; above the bound this is a shuffle join.
    j = vectors.join(broadcast_if_small(queries), key).withColumn(
        "distance", l2_distance(F.col(vec_col), F.col(qvec_col)))
    j = j.withColumn("__salt", F.pmod(F.hash(id_col), F.lit(salt_buckets))).drop(vec_col, qvec_col)
    by = [key, query_id] if query_id else [key]
    w1 = Window.partitionBy(*by, "__salt").orderBy("distance", id_col)
    local = j.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= k)
    w2 = Window.partitionBy(*by).orderBy("distance", id_col)
    return (local.withColumn("rank", F.row_number().over(w2)).where(F.col("rank") <= k)
            .drop("__salt", "__r"))


def retrieve_shared(docs: DataFrame, questions: Sequence[str], k: int = TOP_K, size: int = SPLIT_CHUNK_SIZE,
                    overlap: int = SPLIT_CHUNK_OVERLAP, embed=embed_letters, salt_buckets: int = 64) -> DataFrame:
    """J12 over the chunks of all documents as one index: ``(question_ord, rank, doc_id, chunk_ord, distance, text)``, the ``k``
    nearest chunks of each question, ranked by ``(distance, doc_id, chunk_ord)``.

    Chunks carry only ids and distances through the top-k; the texts of the few winners are cut again from their
    documents.
    """
    qs = F.array(*[F.struct(F.lit(i).alias("question_ord"), F.lit(q.lower()).alias("low")) for i, q in enumerate(questions)])
    qv = F.transform(qs, lambda q: F.struct(q["question_ord"].alias("question_ord"), embed(q["low"]).alias("v")))
    chunks = F.transform(split_text_fixed(F.col("text"), size, overlap), lambda c, i: F.struct(
        i.alias("chunk_ord"), F.lower(c["text"]).alias("low")))
    c = explode_rows(docs.where(F.length("text") > 0), ["doc_id"], chunks, "c", "__p").select(
        "doc_id", F.col("c.chunk_ord").alias("chunk_ord"), embed(F.col("c.low")).alias("v"))
    d = c.withColumn("__qv", qv).select("doc_id", "chunk_ord", F.explode(F.transform("__qv", lambda q: F.struct(
        q["question_ord"].alias("question_ord"), l2_distance(F.col("v"), q["v"]).alias("distance")))).alias("d"))
    d = d.select("doc_id", "chunk_ord", "d.question_ord", "d.distance",
                 F.pmod(F.hash("doc_id", "chunk_ord"), F.lit(salt_buckets)).alias("__salt"))
    order = ["distance", "doc_id", "chunk_ord"]
    local = d.withColumn("__r", F.row_number().over(Window.partitionBy("question_ord", "__salt").orderBy(*order)))
    best = local.where(F.col("__r") <= k).withColumn("rank", F.row_number().over(Window.partitionBy("question_ord").orderBy(*order)))
    best = best.where(F.col("rank") <= k).select("question_ord", "rank", "doc_id", "chunk_ord", "distance")
    # at most k rows per question of the parameter
    return docs.select("doc_id", "text").join(F.broadcast(best), "doc_id").select(
        "question_ord", "rank", "doc_id", "chunk_ord", "distance",
        F.get(split_text_fixed(F.col("text"), size, overlap), F.col("chunk_ord"))["text"].alias("text"))


def label_centroids(vectors: DataFrame, key: str = "label", vec_col: str = "embedding") -> DataFrame:
    """Mean vector per key (a data-derived query set), averaged per dimension in double.

    ``posexplode`` + ``groupBy(key, dim)`` uses partial aggregation, so a hot key is combined map-side.
    """
    per_dim = (vectors.select(key, F.posexplode(vec_col).alias("dim", "x"))
               .groupBy(key, "dim").agg(F.avg(F.col("x").cast("double")).alias("m")))
    return per_dim.groupBy(key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "m"))), lambda s: s["m"]).alias("query"))


# ---------------------------------------------------------------- A15, C10, C13

def stuff_prompts(retrieved: DataFrame, template: str = QA_PROMPT) -> DataFrame:
    """A15 + C10: the "stuff" prompt per (document, question): the k chunks in rank order joined by a blank line
    as context; ``sources`` keeps the chunk texts."""
    context = F.array_join(F.transform("top", lambda t: t["text"]), "\n\n")
    pre, rest = template.split("{context}")
    mid, post = rest.split("{question}")
    return retrieved.withColumn("sources", F.transform("top", lambda t: t["text"])).withColumn(
        "prompt", F.concat(F.lit(pre), context, F.lit(mid), F.col("question"), F.lit(post)))


def _words(s: Column) -> Column:
    return F.filter(F.split(F.lower(s), "[^\\p{L}\\p{N}]+", -1), lambda w: w != "")


def answer(retrieved: DataFrame, min_word_len: int = 4) -> DataFrame:
    """C13 (extractive): the sentence of the top-k chunks sharing most distinct question words of length >= 4;
    ties by ``(chunk rank, sentence order)``; no shared word -> ''. Sentences split on the literal '. '."""
    asked = F.array_distinct(F.filter(_words(F.col("question")), lambda w: F.length(w) >= min_word_len))
    sents = F.flatten(F.transform("top", lambda t, r: F.transform(
        F.split(t["text"], "\\. ", -1),
        lambda s, j: F.struct(r.alias("rank"), j.alias("sentence_ord"), s.alias("sentence")))))

    def best_of(words):
        return F.array_min(F.transform(sents, lambda s: F.struct(
            (-F.size(F.array_intersect(words, F.array_distinct(_words(s["sentence"]))))).alias("neg_overlap"),
            s["rank"].alias("rank"), s["sentence_ord"].alias("sentence_ord"), s["sentence"].alias("sentence"))))

    d = retrieved.withColumn("__best", bind(asked, best_of))
    best = F.col("__best")
    return d.withColumn("answer", F.when(best.isNotNull() & (best["neg_overlap"] < 0), best["sentence"])
                        .otherwise(F.lit(""))).drop("__best")


def ask_documents(docs: DataFrame, questions: Sequence[str], k: int = TOP_K) -> DataFrame:
    """C14 (process_and_ask): split -> embed -> retrieve -> stuff -> answer, all documents and questions at once.

    Result ``(doc_id, question_ord, question, answer, source_documents array<struct<text, source>>)``; a source is the path of
    its document.
    """
    path = F.col("document_path") if "document_path" in docs.columns else F.concat(F.lit("documents/"), F.col("doc_id").cast("string"))
    r = answer(stuff_prompts(retrieve(docs.withColumn("document_path", path), questions, k, keep=("document_path",))))
    return r.select("doc_id", "question_ord", "question", "answer",
                    F.transform("sources", lambda s: F.struct(s.alias("text"), F.col("document_path").alias("source")))
                    .alias("source_documents"))


# ---------------------------------------------------------------- C10, C11, C12

def _part(text: Column, max_chars: int | None) -> Column:
    return F.substring(text, 1, max_chars) if max_chars else text


def summary_prompt(text: Column, words: int = SUMMARY_WORDS, max_chars: int | None = None) -> Column:
    pre, post = SUMMARY_PROMPT.replace("{words}", str(words)).split("{text}")
    return F.concat(F.lit(pre), _part(text, max_chars), F.lit(post))


def extract_prompt(text: Column, schema_description: str, max_chars: int | None = None) -> Column:
    pre, post = EXTRACT_PROMPT.replace("{schema}", schema_description).split("{text}")
    return F.concat(F.lit(pre), _part(text, max_chars), F.lit(post))


def sentences(docs: DataFrame) -> DataFrame:
    """``(doc_id, sentence_ord, sentence, words)`` of the whole text, split on the literal '. '."""
    return (explode_rows(docs, ["doc_id"], F.split("text", "\\. ", -1), "sentence",
                         "sentence_ord")
            .withColumn("words", F.filter(F.split(F.lower("sentence"), "[^\\p{L}]+", -1), lambda w: w != "")))


def mean_idf(occ: DataFrame, idf: DataFrame, **bounds) -> DataFrame:
    """Word occurrences ``(doc_id, sentence_ord, word)`` and ``(word, df, idf)`` of every word -> mean IDF, ``score`` (rounded to 6), and number
    ``n`` of each sentence's words.

    Frequent words, as many as may be broadcast, are weighed and added up where their sentence is read; a row per sentence and rare word is
    all that is shuffled by word, never one per occurrence.
    """
    from quire.operators.index import frequent_from
    from quire.session import materialize

    sentence = ["doc_id", "sentence_ord"]
    least = frequent_from(idf.select("word", "df"), **bounds)
    if least == 1:
        return occ.join(F.broadcast(idf.select("word", "idf")), "word").groupBy(*sentence).agg(
            F.round(F.avg("idf"), 6).alias("score"), F.count("*").alias("n"))
    often = F.lit(False) if least is None else F.col("df") >= least
    each = occ.join(F.broadcast(idf.where(often).select("word", "idf")), "word", "left")
    parts = materialize(each.groupBy(*sentence, F.when(F.col("idf").isNull(), F.col("word")).alias("word")).agg(
        F.sum("idf").alias("total"), F.count("*").alias("n")), "sentence-parts")
    seldom = parts.where("word IS NOT NULL").join(idf.where(~often).hint("shuffle_merge"), "word").select(
        *sentence, (F.col("n") * F.col("idf")).alias("total"), "n")
    return parts.where("word IS NULL").select(*sentence, "total", "n").unionByName(seldom).groupBy(*sentence).agg(
        F.round(F.sum("total") / F.sum("n"), 6).alias("score"), F.sum("n").alias("n"))


def summarise(docs: DataFrame, words: int = SUMMARY_WORDS) -> DataFrame:
    """C11 (extractive): sentences scored by mean corpus IDF of their words (rounded to 6), taken by
    ``(score desc, sentence_ord)``: the best one always, further ones while the running word count stays <= ``words``,
    emitted in sentence order. Every document gets a row, '' if it has no words.

    IDF = ln((1 + N) / (1 + df)). A document's distinct words are found in its row, so document frequencies are
    one partial aggregation by word, written once.
    """
    from quire.session import materialize

    s = sentences(docs)
    occ = explode_rows(s, ["doc_id", "sentence_ord"], F.col("words"), "word")
    n_docs = docs.agg(F.count("*")).scalar()  # scalar subquery: evaluated once, inlined as a value
    own = docs.select(F.array_distinct(F.filter(F.split(F.lower("text"), "[^\\p{L}]+", -1), lambda w: w != "")).alias("w"))
    df_ = explode_rows(own, [], F.col("w"), "word").groupBy("word").agg(F.count("*").alias("df"))
    scored = mean_idf(occ, materialize(df_.select("word", "df", F.ln((n_docs + 1) / (F.col("df") + 1)).alias("idf")), "summary-words"))
    w = Window.partitionBy("doc_id").orderBy(F.col("score").desc(), "sentence_ord").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    chosen = scored.withColumn("running", F.sum("n").over(w)).where(
        (F.col("running") <= words) | (F.col("running") == F.col("n")))
    picked = chosen.join(s.select("doc_id", "sentence_ord", "sentence"), ["doc_id", "sentence_ord"])
    out = (picked.groupBy("doc_id")
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("sentence_ord", "sentence"))),
                                         lambda x: x["sentence"]), ". ").alias("summary"),
                F.count("*").alias("n_sentences"), F.sum("n").cast("int").alias("n_words")))
    return docs.select("doc_id").join(out, "doc_id", "left").select(
        "doc_id", F.coalesce("summary", F.lit("")).alias("summary"), F.coalesce("n_sentences", F.lit(0)).alias("n_sentences"),
        F.coalesce("n_words", F.lit(0)).alias("n_words"))


def extract_structured(docs: DataFrame, fields: dict[str, str], max_chars: int | None = None) -> DataFrame:
    """C12 (pattern form): for each ``(field, pattern)`` the first capture group in the text
    (missing -> ''); ``values`` is the JSON object of all fields."""
    t = _part(F.col("text"), max_chars)
    vals = [F.regexp_extract(t, p, 1).alias(f) for f, p in fields.items()]
    return docs.select("doc_id", F.to_json(F.struct(*vals)).alias("values"), *vals)


def validate_json(df: DataFrame, col: str, schema) -> DataFrame:
    """C12 validation of a model's JSON answer against ``schema`` (a StructType or DDL): ``parsed``, and ``valid``.

    An answer that is cut off, no JSON object or has a value of another type is not valid: its raw text is ``parsed._corrupt`` and its
    fields are null. A missing field is null, further ones are ignored; no answer (null or blank) is not valid and has no text."""
    from pyspark.sql import types as T

    fields = schema.fields if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema).fields
    sch = T.StructType([*fields, T.StructField("_corrupt", T.StringType())])
    raw = F.from_json(col, sch, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    bad = raw["_corrupt"].isNotNull()
    parsed = F.struct(*(F.when(~bad, raw[f.name]).alias(f.name) for f in fields), raw["_corrupt"].alias("_corrupt"))
    blank = F.coalesce(F.trim(col) == "", F.lit(True))
    return df.withColumn("parsed", F.when(~blank, parsed)).withColumn("valid", ~blank & ~bad)

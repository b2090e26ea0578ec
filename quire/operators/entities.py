"""Entity operators: pattern entities, dictionary entities (J6), medical entities (J7), code linking (J8-J10),
filters and grouping (P3, A7, A8, A9, O1).

Tokens with their true character offsets and the n-grams are built inside each document's row (an in-row
prefix sum over piece lengths), so the corpus is never shuffled. Lookup tables (dictionaries,
lexicons, code tables) join on the normalised phrase; they are broadcast only behind a counted size bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.arrays import explode_rows, with_exclusive_prefix_sum
from quire.functions.spans import with_spans
from quire.functions.text import WS_JAVA
from quire.session import broadcast_if_small, is_small

# The built-in entity types and the medical categories.
BUILTIN_ENTITY_TYPES = ["PERSON", "LOCATION", "ORGANIZATION", "COMMERCIAL_ITEM", "EVENT", "DATE", "QUANTITY",
                        "TITLE", "OTHER"]
MEDICAL_CATEGORIES = ["MEDICATION", "MEDICAL_CONDITION", "ANATOMY", "TEST_TREATMENT_PROCEDURE",
                      "PROTECTED_HEALTH_INFORMATION"]
# Our patterns for the pattern-detectable built-in entity types (Java and RE2 compatible).
ENTITY_PATTERNS = {
    "DATE": r"[0-9]{4}-[0-9]{2}-[0-9]{2}",
    "QUANTITY": r"[0-9]+(\.[0-9]+)?",
}
# Trailing punctuation stripped before a medical term lookup.
TRAILING_PUNCT = "[.,;:!?]+$"


def with_token_array(docs: DataFrame, max_chars: int | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """``(doc_id, toks array<struct<token, begin_offset>>)``: whitespace tokens with their 0-based offsets in
    the original text, computed inside the document's row.

    ``split`` gives the pieces, ``regexp_extract_all`` the whitespace run after each piece; the exclusive prefix
    sum of piece + run lengths is each piece's offset (``with_exclusive_prefix_sum``: no shuffle, no window).
    ``max_chars`` reads only the first characters (P5).
    """
    text = F.substring(F.col(text_col), 1, max_chars) if max_chars else F.col(text_col)
    d = docs.select(F.col(id_col).alias("doc_id"), text.alias("__t"))
    d = d.withColumn("__p", F.split("__t", WS_JAVA, -1)).withColumn(
        "__s", F.regexp_extract_all("__t", F.lit(WS_JAVA), 0))
    d = d.withColumn("__w", F.zip_with("__p", "__s", lambda p, s: F.length(p) + F.coalesce(F.length(s), F.lit(0))))
    d = with_exclusive_prefix_sum(d, "__w", "__off")
    toks = F.filter(F.zip_with("__p", "__off", lambda p, o: F.struct(p.alias("token"), o.alias("begin_offset"))),
                    lambda t: t["token"] != "")
    return d.select("doc_id", toks.alias("toks"))


def tokens(docs: DataFrame, max_chars: int | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, pos, token, begin_offset)``: one row per whitespace token (see ``with_token_array``)."""
    t = with_token_array(docs, max_chars, id_col, text_col)
    return (explode_rows(t, ["doc_id"], F.col("toks"), "x", "pos")
            .select("doc_id", "pos", F.col("x.token").alias("token"), F.col("x.begin_offset").alias("begin_offset")))


def ngrams(docs: DataFrame, lengths: Sequence[int], max_chars: int | None = None) -> DataFrame:
    """``(doc_id, pos, n, text, begin_offset, end_offset)`` for every n in ``lengths`` of consecutive tokens.

    Built in the document's row from the token array (indexed access, linear), then exploded: no shuffle.
    """
    t = with_token_array(docs, max_chars)
    k = F.size("toks")
    def gram(n):
        def build(i):
            parts = [F.get("toks", i + j)["token"] for j in range(n)]
            last = F.get("toks", i + n - 1)
            return F.struct(F.lit(n).alias("n"), (parts[0] if n == 1 else F.concat_ws(" ", *parts)).alias("text"),
                            F.get("toks", i)["begin_offset"].alias("begin_offset"),
                            (last["begin_offset"] + F.length(last["token"])).alias("end_offset"))
        return build

    per_n = [F.transform(F.sequence(F.lit(0), k - n), gram(n)) for n in lengths]
    grams = F.flatten(F.array(*[F.when(k >= n, g).otherwise(F.array().cast(
        "array<struct<n:int,text:string,begin_offset:int,end_offset:int>>")) for n, g in zip(lengths, per_n)]))
    return (explode_rows(t, ["doc_id"], grams, "g", "pos")
            .select("doc_id", "pos", F.col("g.n").alias("n"), F.col("g.text").alias("text"),
                    F.col("g.begin_offset").alias("begin_offset"), F.col("g.end_offset").cast("int").alias("end_offset")))


def _phrase_trie(rows: Sequence[tuple[str, str]]) -> dict:
    """Phrases as a trie of lower-cased tokens; a node's types, one per dictionary row, stand under the key None."""
    root: dict = {}
    for phrase, kind in rows:
        node = root
        for token in phrase.split(" "):
            node = node.setdefault(token, {})
        node.setdefault(None, []).append(kind)
    return root


def trie_matches(tokens: Sequence[str], trie: dict):
    """``(first token, number of tokens, types)`` of every phrase of the trie among lower-cased ``tokens``. A position is followed only while
    its tokens continue some phrase."""
    for i, token in enumerate(tokens):
        node, at = trie.get(token), i + 1
        while node is not None:
            if None in node:
                yield i, at - i, node[None]
            node, at = node.get(tokens[at]) if at < len(tokens) else None, at + 1


def _dictionary_scan(docs: DataFrame, rows: Sequence[tuple[str, str]]) -> DataFrame:
    """Match a dictionary of bounded size in each document's task."""
    import re

    import pyarrow as pa

    from quire.functions.text import WHITESPACE_CODEPOINTS

    known = docs.sparkSession.sparkContext.broadcast({"rows": rows})
    token = "[^" + "".join(re.escape(chr(c)) for c in WHITESPACE_CODEPOINTS) + "]+"

    def run(batches):
        held = known.value  # one object per worker process, so the trie is built once there
        if "trie" not in held:
            held["trie"] = _phrase_trie(held["rows"])
        pattern, trie = re.compile(token), held["trie"]
        for b in batches:
            docs_at, found = [], []
            for k, text in enumerate(b.column("text").to_pylist()):
                words = pattern.findall(text or "")
                hits = list(trie_matches([w.lower() for w in words], trie))
                if hits:
                    spans = [m.span() for m in pattern.finditer(text)]
                    for i, n, kinds in hits:
                        for kind in kinds:
                            docs_at.append(k)
                            found.append((spans[i][0], spans[i + n - 1][1], " ".join(words[i:i + n]), kind, 1.0))
            columns = list(zip(*found)) if found else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(docs_at, pa.int64())),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.float64())))],
                names=["doc_id", "begin_offset", "end_offset", "text", "type", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, begin_offset int, end_offset int, text string, type string, score double")


def _dictionary_join(docs: DataFrame, entities: DataFrame) -> DataFrame:
    """Match a dictionary of any size: runs as long as one of its phrases are joined with it on the phrase."""
    d = entities.withColumn("n", F.size(F.split("phrase", " ", -1)))
    lengths = sorted(r[0] for r in d.select("n").distinct().collect())
    g = ngrams(docs, lengths or [1]).withColumn("phrase", F.lower("text"))
    hits = g.join(d, ["phrase", "n"])
    return hits.select("doc_id", "begin_offset", "end_offset", "text", "type", F.lit(1.0).alias("score"))


def dictionary_entities(docs: DataFrame, entity_list: DataFrame) -> DataFrame:
    """J6 (custom NER re-aimed): ``(doc_id, begin_offset, end_offset, text, type, score)``.

    A hit is a run of n tokens whose lower-cased text equals a dictionary phrase of n tokens, whatever n; a phrase listed twice hits
    twice. The dictionary ``(text, type)`` is normalised (lower case, single spaces). Up to a counted size it travels to the tasks as a
    token trie, which tries a text position only where a phrase can go on; beyond that, runs are joined with it.
    """
    d = (entity_list.select(F.lower(F.array_join(F.filter(F.split("text", WS_JAVA, -1), lambda x: x != ""), " "))
                            .alias("phrase"), "type").where(F.col("phrase") != ""))
    if is_small(d):
        return _dictionary_scan(docs, [(r[0], r[1]) for r in d.collect()])
    return _dictionary_join(docs, d)


def pattern_entities(docs: DataFrame, patterns: dict[str, str] | None = None) -> DataFrame:
    """Built-in entity types that patterns can find (C2 with ``ENTITY_PATTERNS``)."""
    pats = patterns or ENTITY_PATTERNS
    return (explode_rows(with_spans(docs, "text", "__spans", pats), ["doc_id"], F.col("__spans"), "s", "ord")
            .select("doc_id", "s.begin_offset", "s.end_offset", "s.text", "s.type", "s.score"))


def all_entities(builtin: DataFrame, custom: DataFrame) -> DataFrame:
    """O1: built-in entities, then custom ones appended; no de-duplication. ``source`` 0/1 keeps the order."""
    return (builtin.withColumn("source", F.lit(0))
            .unionByName(custom.withColumn("source", F.lit(1)), allowMissingColumns=True))


def filter_entities(ents: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Keep requested types; ``None``/empty keeps the 9 built-ins (so custom types drop by default);
    a missing type counts as OTHER."""
    keep = list(types) if types else BUILTIN_ENTITY_TYPES
    return ents.withColumn("type", F.coalesce("type", F.lit("OTHER"))).where(F.col("type").isin(keep))


def entities_by_type(docs: DataFrame, ents: DataFrame, types: Sequence[str] | None = None,
                     key: str = "type") -> DataFrame:
    """A7 long form: ``(doc_id, type, n, texts)``; every requested type is present for every document, with
    ``n = 0`` and ``[]`` when it has no hits; texts in detection (offset) order, duplicates kept.

    The requested set is a parameter, exploded per document (no join against a types table).
    """
    keep = list(dict.fromkeys(types)) if types else BUILTIN_ENTITY_TYPES
    e = ents.withColumn(key, F.coalesce(key, F.lit("OTHER"))).where(F.col(key).isin(keep))
    grouped = e.groupBy("doc_id", key).agg(
        F.count("*").alias("n"),
        F.transform(F.array_sort(F.collect_list(F.struct("begin_offset", "end_offset", "text"))),
                    lambda s: s["text"]).alias("texts"))
    req = docs.select("doc_id", F.explode(F.array(*[F.lit(t) for t in keep])).alias(key))
    return (req.join(grouped, ["doc_id", key], "left")
            .select("doc_id", key, F.coalesce("n", F.lit(0)).cast("int").alias("n"),
                    F.coalesce("texts", F.array().cast("array<string>")).alias("texts")))


# ---------------------------------------------------------------- medical

def medical_entities(docs: DataFrame, lexicon: DataFrame, max_chars: int | None = None) -> DataFrame:
    """``(doc_id, begin_offset, end_offset, text, category, type, score, traits, attributes)``.

    Single tokens of the whole text (``max_chars``: of its first characters), trailing punctuation removed, looked up
    lower-cased in the lexicon ``(term, category, type)``. Traits and attributes are passed through empty.
    """
    t = (tokens(docs, max_chars)
         .withColumn("text", F.regexp_replace("token", TRAILING_PUNCT, ""))
         .where(F.col("text") != "")
         .withColumn("term", F.lower("text")))
    lex = lexicon.select(F.lower("term").alias("term"), "category", "type")
    hits = t.join(broadcast_if_small(lex), "term")
    return hits.select(
        "doc_id", "begin_offset", (F.col("begin_offset") + F.length("text")).cast("int").alias("end_offset"),
        "text", "category", "type", F.lit(1.0).alias("score"), "term",
        F.array().cast("array<struct<Name:string,Score:double>>").alias("traits"),
        F.array().cast("array<struct<Type:string,Text:string,Score:double>>").alias("attributes"))


def link_codes(ents: DataFrame, codes: DataFrame, system: str, categories: Sequence[str] | None = None) -> DataFrame:
    """Entities of the given categories linked to the concepts of one code system; long form
    ``(doc_id, begin_offset, text, category, code, description, score, concept_rank)``.

    Every entity stays; one without a concept has null code, description, score and rank. Concepts are ranked by
    ``(score desc, code)`` per term in the code table, before the join, so the entities are not shuffled for it.
    """
    e = ents
    if categories:
        e = e.where(F.col("category").isin(list(categories)))
    c = codes.where(F.col("system") == system).select(F.lower("term").alias("term"), "code", "description",
                                                      F.coalesce("score", F.lit(1.0)).alias("cscore"))
    w = Window.partitionBy("term").orderBy(F.col("cscore").desc(), "code")
    c = c.withColumn("concept_rank", F.row_number().over(w))
    j = e.drop("score").join(broadcast_if_small(c), "term", "left")
    return j.select("doc_id", "begin_offset", "text", "category", "code", "description",
                    F.col("cscore").alias("score"), "concept_rank")


def link_icd10(ents: DataFrame, codes: DataFrame) -> DataFrame:
    """Medical conditions -> ICD-10-CM concepts."""
    return link_codes(ents, codes, "ICD10CM", ["MEDICAL_CONDITION"])


def link_rxnorm(ents: DataFrame, codes: DataFrame) -> DataFrame:
    """Medications -> RxNorm concepts."""
    return link_codes(ents, codes, "RXNORM", ["MEDICATION"])


def link_snomed(ents: DataFrame, codes: DataFrame) -> DataFrame:
    """All medical entities -> SNOMED CT concepts."""
    return link_codes(ents, codes, "SNOMEDCT", None)


def medical_by_category(docs: DataFrame, ents: DataFrame, categories: Sequence[str] | None = None) -> DataFrame:
    """A8 long form: ``(doc_id, category, n, entities)`` with whole entity records (text, type, score, offsets, traits,
    attributes) in offset order; every category (5 by default) is present for every document."""
    keep = list(dict.fromkeys(categories)) if categories else MEDICAL_CATEGORIES
    record = F.struct("begin_offset", "end_offset", "text", "type", "score", "traits", "attributes")
    grouped = ents.where(F.col("category").isin(keep)).groupBy("doc_id", "category").agg(
        F.array_sort(F.collect_list(record)).alias("entities"))
    req = docs.select("doc_id", F.explode(F.array(*[F.lit(c) for c in keep])).alias("category"))
    kind = grouped.schema["entities"].dataType.simpleString()
    return req.join(grouped, ["doc_id", "category"], "left").select(
        "doc_id", "category", F.coalesce(F.size("entities"), F.lit(0)).alias("n"),
        F.coalesce("entities", F.array().cast(kind)).alias("entities"))


def detect_phi(docs: DataFrame, patterns: dict[str, str] | None = None,
               max_chars: int | None = None) -> DataFrame:
    """PHI spans over the whole text, or its first ``max_chars`` characters (pattern form, as C2)."""
    from quire.functions.spans import PII_PATTERNS

    pats = patterns or {k: PII_PATTERNS[k] for k in ("EMAIL", "PHONE", "SSN", "IP_ADDRESS")}
    d = docs.select("doc_id", (F.substring("text", 1, max_chars) if max_chars else F.col("text")).alias("text"))
    return pattern_entities(d, pats).withColumn("category", F.lit("PROTECTED_HEALTH_INFORMATION"))


def full_medical_analysis(docs: DataFrame, lexicon: DataFrame, codes: DataFrame) -> DataFrame:
    """A9 long form: the four lists of an analysis as rows ``(doc_id, list, begin_offset, end_offset, text, category, code,
    description, concept_rank)`` with ``list`` one of ``entities``, ``phi``, ``icd10cm`` and ``rxnorm`` (SNOMED is not part of it).

    The texts are tokenised once: the links are left joins of the entity rows with one system's concepts each.
    """
    cols = ["doc_id", "list", "begin_offset", "end_offset", "text", "category", "code", "description", "concept_rank"]
    none = {"code": "string", "description": "string", "concept_rank": "int"}
    w = Window.partitionBy("system", "term").orderBy(F.coalesce("score", F.lit(1.0)).desc(), "code")
    c = codes.withColumn("concept_rank", F.row_number().over(w))
    wanted = F.array(F.struct(F.lit("icd10cm").alias("list"), F.lit("ICD10CM").alias("system"), F.lit("MEDICAL_CONDITION").alias("of")),
                     F.struct(F.lit("rxnorm").alias("list"), F.lit("RXNORM").alias("system"), F.lit("MEDICATION").alias("of")),
                     F.struct(F.lit("entities").alias("list"), F.lit("").alias("system"), F.lit(None).cast("string").alias("of")))
    ents = medical_entities(docs, lexicon)
    rows = ents.withColumn("w", F.explode(F.filter(wanted, lambda x: x["of"].isNull() | (x["of"] == F.col("category")))))
    rows = rows.select("doc_id", "w.list", "w.system", "term", "begin_offset", "end_offset", "text", "category")
    linked = rows.join(broadcast_if_small(c.select("system", F.lower("term").alias("term"), "code", "description", "concept_rank")),
                       ["system", "term"], "left").select(cols)
    phi = detect_phi(docs).withColumn("list", F.lit("phi"))
    return linked.unionByName(phi.select(*cols[:6], *(F.lit(None).cast(t).alias(n) for n, t in none.items())))

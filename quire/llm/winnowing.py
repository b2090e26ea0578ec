"""Operator 6: benchmark decontamination by winnowing (DataFrame functions only).

Words are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lowered. A benchmark item's windows are its runs of
``span`` words; an item of fewer words, but not none, is one window. Of every ``w`` consecutive ``k``-word hashes of
a text the least one is kept as a fingerprint. Two texts that share ``k + w - 1`` words share such a run of hashes and so a fingerprint.
Windows are winnowed in families of their size (``family``), each with ``k + w - 1`` at most the sizes in it, so no shared window is missed;
windows of ``span`` words are a family of their own and those of one to three words are compared whole, so a short item adds
candidates only where its own words occur. Documents that share a fingerprint with an
item are read again and the hits are extended: each of their windows of that family's sizes is compared, word for word, with those of
the items, and the words under equal windows are counted.

Fingerprints and windows of the benchmark are broadcast only if their measured size allows; otherwise the join
shuffles. Documents are never shuffled by a word or window: only fingerprint hits and windows that are equal to one
of an item reach a grouping, by document.

Defined cases: null or wordless text has no words and is not contaminated; items without words match nothing;
``doc_id`` identifies a document (repeated rows give one row, a null id is a value); items with equal texts are all
reported; empty tables give no rows or no hits; further columns are ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import bind
from quire.llm.common import save, sized_broadcast

SPAN = 13
_GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    lowered = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(F.coalesce(lowered, F.lit("")), _GAP, -1), "")


def folded_words(text: Column) -> Column:
    """As ``words``, with all letters lowered, which is much faster. Lowering a capital sigma depends on what surrounds the word, so
    final sigmas become plain ones. Equal words have equal folded words and the positions are the same, so this serves to find
    candidates."""
    lowered = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\u03c2"), F.lit("\u03c3"))
    return F.array_remove(F.split(lowered, _GAP, -1), "")


def runs(array: Column, size: Column, of) -> Column:
    """``of`` every run of ``size`` consecutive elements of an array (a lambda's variable); none if it is shorter."""
    last = F.size(array) - size
    at = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: of(F.slice(array, i + 1, size), i))


def family(size: int, span: int) -> tuple[int, int]:
    """``(k, w)`` for windows of ``size`` words, ``k + w - 1 <= size``. Sizes 1 to 3 stand alone, 4 to 7, 8 to 15 and so on share a family, up
    to ``span``, which stands alone: at most ``3 + log2(span)`` families."""
    if size >= span:
        k = (span + 1) // 2
        return k, span - k + 1
    if size < 4:
        return size, 1
    least = 1 << (size.bit_length() - 1)
    k = max(4, 3 * least // 4)
    return k, least - k + 1


def fingerprints(text: Column, families: list[tuple[int, int]]) -> Column:
    """``n_words`` and ``prints``: for every ``(k, w)`` the distinct minima of ``w`` consecutive ``k``-word hashes; one minimum if there are
    fewer hashes than ``w``, none if there are fewer words than ``k``."""
    def minima(w):
        def of(hashes):
            width = F.least(F.lit(w), F.greatest(F.size(hashes), F.lit(1)))
            return F.array_distinct(runs(hashes, width, lambda x, _: F.array_min(x)))

        return of

    hashed = F.transform(folded_words(text), lambda x: F.xxhash64(x))
    return bind(hashed, lambda h: F.struct(
        F.size(h).cast("long").alias("n_words"),
        F.concat(*(bind(runs(h, F.lit(k), lambda x, _: F.xxhash64(x)), minima(w)) for k, w in families)).alias("prints")))


def windows(text: Column, sizes: dict[int, int], wanted: Column) -> Column:
    """Windows of a text, as ``(start, size, text)``, of the sizes (``size -> number of its family``) whose family is ``wanted``, an array."""
    def of_size(array, n):
        return runs(array, F.lit(n), lambda x, i: F.struct(
            i.alias("start"), F.lit(n).alias("size"), F.array_join(x, " ").alias("text")))

    none = F.array().cast("array<struct<start:int,size:int,text:string>>")
    return bind(F.struct(words(text).alias("d"), wanted.alias("f")), lambda x: F.concat(*(
        F.when(F.array_contains(x["f"], f), of_size(x["d"], n)).otherwise(none) for n, f in sizes.items())))


def item_windows(benchmark: DataFrame, span: int) -> DataFrame:
    """``(text, items)``: every distinct window of the items with the items that have it."""
    def cut(b):
        size = F.least(F.size(b), F.lit(span))
        return runs(b, F.greatest(size, F.lit(1)), lambda x, _: F.struct(F.array_join(x, " ").alias("text"), size.alias("size")))

    b = benchmark.select("item_id", F.explode(bind(words(F.col("text")), cut)).alias("b")).select("item_id", "b.*")
    return b.groupBy("text", "size").agg(F.collect_set("item_id").alias("items"))


def candidates(docs: DataFrame, found: DataFrame, span: int = SPAN) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, n_words, hit`` (numbers of the families of which it shares a fingerprint) of every document, written; and the family's
    number of every size of the windows ``found``."""
    sizes = sorted(r[0] for r in found.select("size").distinct().collect()) or [span]  # at most ``span`` rows
    families = sorted({family(n, span) for n in sizes})
    number = {n: families.index(family(n, span)) for n in sizes}
    marks = [found.where(F.col("size").isin([n for n in sizes if number[n] == i])).select(
        F.explode(fingerprints(F.col("text"), [f])["prints"]).alias("print"), F.lit(i).alias("family")) for i, f in enumerate(families)]
    marks = sized_broadcast(reduce(DataFrame.union, marks).groupBy("print").agg(F.collect_set("family").alias("hit")))
    prints = docs.select("doc_id", fingerprints(F.col("text"), families).alias("f")).select(
        "doc_id", "f.n_words", F.explode_outer("f.prints").alias("print"))
    # a set of families per document, as flags that combine before the shuffle
    flags = [F.max(F.array_contains("hit", i)).alias(f"hit{i}") for i in range(len(families))]
    hit = F.array_compact(F.array(*(F.when(F.col(f"hit{i}"), i) for i in range(len(families)))))
    per_doc = prints.join(marks, "print", "left").groupBy("doc_id").agg(F.max("n_words").alias("n_words"), *flags).select(
        "doc_id", "n_words", hit.alias("hit"))
    return save(per_doc, "prints"), number


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """``doc_id, n_words, n_hit`` (words inside an occurrence of a window), ``items`` (ids of the items with occurring windows) and
    ``spans`` (start and end word of each occurrence). Small jobs over the benchmark run while this is built."""
    found = save(item_windows(benchmark, span), "windows")
    per_doc, number = candidates(docs, found, span)
    # one plan at every size: the candidates' ids grow with the documents, so they are not for a broadcast
    near = per_doc.where(F.size("hit") > 0).select(F.col("doc_id").alias("__id"), "hit").hint("shuffle_hash")
    again = docs.select("doc_id", "text").join(near, F.col("doc_id").eqNullSafe(F.col("__id")))
    again = again.select("doc_id", F.explode_outer(windows(F.col("text"), number, F.col("hit"))).alias("x"))
    again = again.select("doc_id", "x.start", "x.size", "x.text")
    hits = again.join(sized_broadcast(found.drop("size")), "text").select(
        "doc_id", F.struct("start", (F.col("start") + F.col("size")).alias("end")).alias("span"), "items")
    hits = hits.groupBy(F.col("doc_id").alias("__id")).agg(
        F.array_sort(F.collect_set("span")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
    reach = F.aggregate("spans", F.struct(F.lit(0).alias("to"), F.lit(0).cast("long").alias("n")), lambda a, s: F.struct(
        F.greatest(a["to"], s["end"]).alias("to"),
        (a["n"] + F.greatest(F.lit(0), s["end"] - F.greatest(a["to"], s["start"]))).alias("n")))
    hits = hits.withColumn("n_hit", reach["n"])
    return per_doc.drop("hit").join(hits, F.col("doc_id").eqNullSafe(F.col("__id")), "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<bigint>")).alias("items"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"))


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words") -> Column:
    """At least a twentieth of the document's words lie in benchmark windows."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))

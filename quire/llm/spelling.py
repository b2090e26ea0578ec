"""Operator 13: groups of spelling variants by pivotal grams.

Words are counted over the whole corpus. Two words are near if one insertion, deletion or replacement of a code point turns one into the
other. Every word has overlapping bigrams; by one global order (rarest bigram first) its three rarest (``q * tau + 1``, with all that
tie with the third) are its prefix. Dynamic programming over the prefix picks two disjoint bigrams (``tau + 1``) of least total
frequency, the pivots. One edit touches at most one of them, and it lies right of the left pivot or left of the right one: so
the left pivot stands in the other word too, with all that precedes it, or the right pivot does, with all that follows it. If the other word's
prefix does not end before this one's in the global order, that bigram belongs to its prefix.

So the pivots are joined with the prefix bigrams of all words on the bigram, the side, its place from that side (the position limit), a hash
of the part that is equal, and the other word's length (one less, equal, one more); candidates are compared by the order of their
prefixes and verified by edit distance. A bigram key with very many words is cut into blocks of ``block`` words, each of which meets the
pivots of the key in a task of its own.

The frequencies of bigrams of the alphabet (26 lower-case letters and U+00C0 to U+00FF, 90 x 90) are broadcast; nothing else is.

Defined cases: a null text has no words; a null id counts as an empty text in the checksum; words below ``min_length`` code points after the
deletion are not counted; ties of frequency go to the smaller word in code-point order; repeated rows count again; other columns are
ignored; an empty table gives no rows; a text of any length is read whole, by one task.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import save, sized_broadcast

RUN = "[A-Za-zÀ-ÿ]"
BLOCK = 5_000
_LOWER = {c: c + 32 for c in range(65, 91)}


# --- words ------------------------------------------------------------------------------------------------------

def count_words(docs: DataFrame, min_length: int = 7, slip_every: int = 31, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``(word, n)`` over all texts: maximal runs of letters, A-Z in lower case. Where ``slip_every`` divides the checksum ``h`` of ``<doc_id>:<run>``
    the code point ``h % length`` of the run is left out (0: never). Tasks count before the shuffle."""
    import pyarrow as pa

    find = re.compile(f"{RUN}{{{min_length},}}").findall

    def words_of(key: str, raw: str):
        """The words of a text with their counts."""
        start = zlib.crc32(f"{key}:".encode())
        own: Counter = Counter()
        for run, n in Counter(find(raw)).items():
            own[run.lower() if run.isascii() else run.translate(_LOWER)] += n
        for word, n in own.items():
            if slip_every:
                h = zlib.crc32(word.encode(), start)
                if h % slip_every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1:]
                    if len(word) < min_length:
                        continue
            yield word, n

    def batch(found):
        return pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], names=["word", "n"])

    def run(batches):
        found: Counter = Counter()
        for b in batches:
            for key, raw in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for word, n in words_of("" if key is None else str(key), raw or ""):
                    found[word] += n
                if len(found) > 400_000:
                    yield batch(found)
                    found = Counter()
        yield batch(found)

    rows = docs.select(F.col(f"`{doc_id}`").cast("string").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# --- grams ------------------------------------------------------------------------------------------------------

def pivots(prefix: list[tuple[int, int]], weights: list[int], q: int = 2) -> tuple[int, int]:
    """Places of two disjoint grams of least total weight among ``prefix``, ``(place, rank)`` in order of place; ``weights`` by rank. Dynamic
    programming: ``best`` holds the lightest gram that ends before each place in turn; equal weights: the earlier pair."""
    best, chosen, behind = None, None, 0
    for place, rank in prefix:
        while prefix[behind][0] + q <= place:  # grams that end before this one
            w, p = weights[prefix[behind][1]], prefix[behind][0]
            if best is None or w < best[0]:
                best = w, p
            behind += 1
        if best is not None and (chosen is None or best[0] + weights[rank] < chosen[0]):
            chosen = best[0] + weights[rank], best[1], place
    return chosen[1], chosen[2]


def gram_rows(words: DataFrame, frequencies: dict[str, int], q: int = 2, tau: int = 1) -> DataFrame:
    """``(word, n, pivot, key, last, letters)``: a row per key under which a word is filed (``pivot`` false) or asks (true), ``last``, the
    rank of the last gram of its prefix, and ``letters``, a bit per letter that it has. ``key``: hash of side, gram, place from that side and
    length of the other word, and hash of the part up to the gram."""
    import pyarrow as pa

    order = sorted(frequencies, key=lambda g: (frequencies[g], g))
    rank, weights = {g: i for i, g in enumerate(order)}, [frequencies[g] for g in order]
    known = words.sparkSession.sparkContext.broadcast((rank, weights))

    def key(side: str, gram: int, place: int, part: str, size: int) -> int:
        return (zlib.crc32(f"{side}{gram}.{place}.{size}".encode()) << 32 | zlib.crc32(part.encode())) - (1 << 63)

    def keys(word: str):
        ranks, weights = known.value
        grams = [ranks[word[i:i + q]] for i in range(len(word) - q + 1)]
        last, size = sorted(grams)[q * tau], len(word)
        prefix = [(i, r) for i, r in enumerate(grams) if r <= last]
        letters = 0
        for c in set(word):
            letters |= 1 << (ord(c) & 63)
        letters -= letters >> 63 << 64  # as a signed number
        for place, r in prefix:
            yield False, key("L", r, place, word[:place], size), last, letters
            yield False, key("R", r, size - place, word[place + q:], size), last, letters
        left, right = pivots(prefix, weights, q)
        for other in range(size - tau, size + tau + 1):
            yield True, key("L", grams[left], left, word[:left], other), last, letters
            yield True, key("R", grams[right], size - right, word[right + q:], other), last, letters

    def run(batches):
        for b in batches:
            found = [(word, n, *k) for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist()) for k in keys(word)]
            columns = list(zip(*found)) if found else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.int64()))],
                names=["word", "n", "pivot", "key", "last", "letters"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, pivot boolean, key long, last int, letters long")


def gram_frequencies(words: DataFrame, q: int = 2) -> dict[str, int]:
    """Number of words' places that hold each gram: at most 90 x 90 of them."""
    places = F.transform(F.sequence(F.lit(1), F.length("word") - q + 1), lambda i: F.substr("word", i, F.lit(q)))
    rows = words.select(F.explode(places).alias("gram")).groupBy("gram").count().collect()
    return {r[0]: r[1] for r in rows}


def near_pairs(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(a, n_a, b, n_b)``, ``a < b``: every pair of ``words`` ``(word, n)``, distinct words of at least four code points, at edit distance 1, once."""
    grams = save(gram_rows(words, gram_frequencies(words)), "grams")
    filed, asked = grams.where("NOT pivot").drop("pivot"), grams.where("pivot").drop("pivot")
    large = save(filed.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")).where("blocks > 1"), "gram-blocks")
    large = sized_broadcast(large)
    one = F.coalesce("blocks", F.lit(1))
    filed = filed.join(large, "key", "left").withColumn("block", F.pmod(F.xxhash64("word"), one).cast("int")).drop("blocks")
    asked = asked.join(large, "key", "left").withColumn("block", F.explode(F.sequence(F.lit(0), one - 1))).drop("blocks")
    filed, asked = (t.select("key", "block", *(F.col(c).alias(f"{c}_{x}") for c in ("word", "n", "last", "letters")))
                    for t, x in ((filed, "f"), (asked, "p")))
    found = asked.join(filed, ["key", "block"]).where(
        (F.col("last_p") <= F.col("last_f")) & (F.col("word_p") != F.col("word_f"))
        # an edit adds one letter at most and takes one at most
        & (F.bit_count(F.col("letters_p").bitwiseXOR(F.col("letters_f"))) <= 2)
        & (F.levenshtein("word_p", "word_f", 1) == 1))
    first = F.col("word_p") < F.col("word_f")

    def ordered(x, y):
        return F.when(first, F.col(x)).otherwise(F.col(y))

    return found.select(ordered("word_p", "word_f").alias("a"), ordered("n_p", "n_f").alias("n_a"),
                        ordered("word_f", "word_p").alias("b"), ordered("n_f", "n_p").alias("n_b")).distinct()


# --- variants ---------------------------------------------------------------------------------------------------

def variant_forms(words: DataFrame, times: int = 10, block: int = BLOCK) -> DataFrame:
    """``(word, n, n_near, form, form_n)``: ``form`` is the near word of largest ``n`` (ties: the smallest), if that is at least
    ``times`` the word's own."""
    pairs = save(near_pairs(words, block), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("neg"), F.col("near"))).alias("best"))
    enough = -F.col("best")["neg"] >= times * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("best")["near"]).alias("form"), F.when(enough, -F.col("best")["neg"]).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """``forms`` and ``root``, the word at the end of the chain of forms. ``n`` grows at least tenfold with every step, so chains have at most 18;
    every round doubles the steps that are known."""
    forms = save(forms, "forms")
    step = save(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while not step.isEmpty():
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        wider = save(step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                              F.col("next").isNotNull().alias("moved")), "roots")
        step = wider.drop("moved")
        if wider.where("moved").isEmpty():
            break
    return forms.join(step, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_groups(docs: DataFrame, min_length: int = 7, min_count: int = 2, times: int = 10, slip_every: int = 31) -> DataFrame:
    """Count words, find near ones, name forms and roots: ``(word, n, n_near, form, form_n, root)`` per word."""
    words = save(count_words(docs, min_length, slip_every).where(F.col("n") >= min_count), "words")
    return with_roots(variant_forms(words, times))

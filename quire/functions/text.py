"""Text column expressions: whitespace tokens, byte-bounded chunking (C1), fixed-size splitting (C4), drift offsets.

All are per-row higher-order-function expressions (JVM-side, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.split() treats as whitespace (its "split on runs of whitespace").
WHITESPACE_CODEPOINTS = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]

# Java regex form (used by Spark) and RE2 form (used by the DuckDB oracles) of one whitespace run.
WS_JAVA = "[" + "".join(f"\\x{{{c:x}}}" for c in WHITESPACE_CODEPOINTS) + "]+"
WS_RE2 = WS_JAVA  # RE2 accepts the same \x{hex} escapes

# Default limits.
CHUNK_MAX_BYTES = 4800
SPLIT_CHUNK_SIZE = 1000
SPLIT_CHUNK_OVERLAP = 200


def strip(text: Column) -> Column:
    """Remove white space at both ends, like Python's ``str.strip()``."""
    return F.regexp_replace(text, f"^{WS_JAVA}|{WS_JAVA}$", "")


def words(text: Column) -> Column:
    """Whitespace tokens like Python's ``str.split()``: runs of whitespace split, empty pieces dropped."""
    return F.filter(F.split(text, WS_JAVA, -1), lambda w: w != "")


def chunk_starts(ws: Column, max_bytes: int = CHUNK_MAX_BYTES) -> Column:
    """0-based word index at which each chunk starts (C1's greedy packing).

    Each word costs its UTF-8 bytes + 1; a chunk is flushed when adding the next word would pass ``max_bytes``
    and the chunk is not empty, so an oversized word forms a chunk of its own. The fold carries scalars and
    the (short) list of chunk starts only.
    """
    init = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("size"), F.lit(0).alias("i"))

    def step(acc, w):
        cost = F.octet_length(w) + 1
        flush = (acc["size"] + cost > max_bytes) & (acc["size"] > 0)
        return F.when(flush, F.struct(F.concat(acc["starts"], F.array(acc["i"])).alias("starts"),
                                      cost.alias("size"), (acc["i"] + 1).alias("i"))) \
            .otherwise(F.struct(acc["starts"].alias("starts"), (acc["size"] + cost).alias("size"),
                                (acc["i"] + 1).alias("i")))

    return F.when(F.size(ws) > 0, F.concat(F.array(F.lit(0)), F.aggregate(ws, init, step, lambda acc: acc["starts"]))
                  ).otherwise(F.array().cast("array<int>"))


def with_chunks(df: DataFrame, text_col: str = "text", out_col: str = "chunks",
                max_bytes: int = CHUNK_MAX_BYTES) -> DataFrame:
    """Add ``out_col`` = ``array<string>`` of byte-bounded chunks, each its words joined by one space.

    The word array and the chunk starts are materialised as columns before the slicing lambda reads them, so
    they are computed once per document (an expression inside a lambda is re-evaluated per element).
    """
    df = df.withColumn("__ws", words(F.col(text_col)))
    df = df.withColumn("__st", chunk_starts(F.col("__ws"), max_bytes))
    ends = F.concat(F.slice("__st", 2, F.greatest(F.size("__st") - 1, F.lit(0))), F.array(F.size("__ws")))
    df = df.withColumn("__en", ends)
    chunks = F.when(F.size("__ws") > 0, F.zip_with("__st", "__en", lambda s, e: F.array_join(
        F.slice(F.col("__ws"), s + 1, e - s), " "))).otherwise(F.array().cast("array<string>"))
    return df.withColumn(out_col, chunks).drop("__ws", "__st", "__en")


def with_drift_offsets(df: DataFrame, chunks_col: str = "chunks", out_col: str = "drift_offsets") -> DataFrame:
    """W3 compatible form: chunk j starts at the sum of the lengths of chunks before it (the dropped separators
    and whitespace runs are not counted, so chunk j drifts left by at least j characters)."""
    df = df.withColumn("__lens", F.transform(chunks_col, lambda c: F.length(c)))
    return df.withColumn(out_col, F.transform("__lens", lambda _l, i: F.aggregate(
        F.slice(F.col("__lens"), 1, i), F.lit(0), lambda a, x: a + x))).drop("__lens")


def window_starts(text: Column, size: int = SPLIT_CHUNK_SIZE, overlap: int = SPLIT_CHUNK_OVERLAP) -> Column:
    """1-based starts of the windows of a text that is not empty (C4)."""
    return F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - overlap), F.lit(size - overlap))


def split_text_fixed(text: Column, size: int = SPLIT_CHUNK_SIZE, overlap: int = SPLIT_CHUNK_OVERLAP) -> Column:
    """C4 fixed form: windows of ``size`` characters stepping ``size - overlap``; ``array<struct<start, text>>``.

    Length 1000 gives one chunk, 1001 gives two; empty text gives none. Starts are 1-based code points.
    """
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")
    return F.when(F.length(text) > 0, F.transform(window_starts(text, size, overlap), lambda s: F.struct(
        s.alias("start"), F.substring(text, s, F.lit(size)).alias("text")))).otherwise(F.array())


def token_set(text: Column, pattern: str = "[^a-z0-9]+") -> Column:
    """Distinct lower-case tokens split on ``pattern`` (J15 query/key tokens)."""
    return F.array_distinct(F.filter(F.split(F.lower(text), pattern, -1), lambda t: t != ""))


def rebase_spans(pieces: DataFrame, text_col: str, spans_col: str, id_col: str = "doc_id", ord_col: str = "piece_ord") -> DataFrame:
    """Spans found in consecutive pieces of a text (one row per piece) -> one row per span, its offsets moved by the lengths of
    the pieces before it. The offsets are a running sum over a document's pieces; only lengths and spans are carried."""
    from pyspark.sql import Window

    w = Window.partitionBy(id_col).orderBy(ord_col).rowsBetween(Window.unboundedPreceding, -1)
    p = pieces.select(id_col, ord_col, F.length(text_col).alias("__n"), F.col(spans_col).alias("__s"))
    p = p.withColumn("__at", F.coalesce(F.sum("__n").over(w), F.lit(0)).cast("int"))
    s = p.select(id_col, "__at", F.explode_outer("__s").alias("s")).where(F.col("s").isNotNull())
    return s.select(id_col, "s.type", (F.col("s.begin_offset") + F.col("__at")).alias("begin_offset"),
                    (F.col("s.end_offset") + F.col("__at")).alias("end_offset"), "s.text", "s.score")

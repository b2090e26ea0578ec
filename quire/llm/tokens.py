"""Operator 7: token ids as Parquet list columns.

Ids are stored as one list column per document next to small metadata columns, ordered by document, with the ids
delta- or dictionary-encoded, a fixed row-group size and page indexes. A reader that asks for metadata never
touches the ids' column chunks, and one that asks for a range of documents reads only the row groups and pages
whose statistics overlap it.

Defined cases: null and empty text has the end id alone; repeated rows are documents of their own; rows with one ``doc_id`` keep
one order, by text, and a null ``doc_id`` sorts first; an empty table writes an empty dataset; columns other than ``doc_id`` and ``text`` are
ignored, whatever they are called. A very long text is one list, so a row group may exceed its limit by one document.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import UnitTable, lower_ascii, shared_dir, slices, worker_cache

#: ASCII marks between which and an ASCII letter the pre-tokeniser always cuts. The apostrophe (contractions) and the
#: characters of special tokens are left out.
_MARKS = np.frombuffer(b",.!?;:#$%&*", np.uint8)
_KIND = np.full(256, 3, np.uint8)  # 0 blank, 1 ASCII letter, 2 mark, 3 anything else
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[97:123] = 1
_KIND[_MARKS] = 2


class WordEncoder:
    """Encodes texts with a byte-pair tokenizer that lowers case and whose pre-tokeniser never joins across white
    space or between a letter and a mark, so the ids of a text are those of such units in order. Each distinct
    unit is encoded once per worker. Units that the tokenizer may read differently once lowered, those with characters beyond
    ASCII (which it composes first) or ``<`` (special tokens are matched on raw text), keep their bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        ends = [i for t, i in self.tok.get_vocab().items() if t.endswith("</w>")]
        self.is_end = np.zeros(self.tok.get_vocab_size(), bool)
        self.is_end[ends] = True
        self.table = UnitTable(self.encode_units)

    def encode_units(self, units: list[str]):
        """Words of ASCII letters are one pre-token each: they are encoded many at a time and cut after ids that
        end a word. Other units are encoded one by one."""
        out: list = [None] * len(units)
        plain = [i for i, u in enumerate(units) if u.isascii() and u.isalpha()]
        for at in range(0, len(plain), 4000):
            part = plain[at:at + 4000]
            joined = [" ".join(units[i] for i in part[k:k + 200]) for k in range(0, len(part), 200)]
            got = self.tok.encode_batch_fast(joined, add_special_tokens=False)
            ids = np.concatenate([np.array(e.ids, np.int32) for e in got])
            for i, x in zip(part, np.split(ids, np.flatnonzero(self.is_end[ids])[:-1] + 1)):
                out[i] = x
        rest = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(rest), 4000):
            part = rest[at:at + 4000]
            for i, e in zip(part, self.tok.encode_batch_fast([units[i] for i in part], add_special_tokens=False)):
                out[i] = np.array(e.ids, np.int32)
        return out, np.zeros((len(units), 0))

    def encode(self, data: np.ndarray, offsets: np.ndarray):
        """Texts ``data[offsets[i]:offsets[i + 1]]`` -> all ids, and the number of ids before each text."""
        low = lower_ascii(data)
        kind = _KIND[low]
        before = np.empty_like(kind)
        before[0:1], before[1:] = 0, kind[:-1]
        before[offsets[offsets < len(data)]] = 0
        starts = np.flatnonzero((kind > 0) & ((before == 0) | (kind + before == 3) & (kind != 3) & (before != 3)))
        after = np.empty_like(kind)
        after[-1:], after[:-1] = 0, kind[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        after[inner - 1] = 0
        ends = np.flatnonzero((kind > 0) & ((after == 0) | (kind + after == 3) & (kind != 3) & (after != 3))) + 1
        count = np.concatenate([[0], np.cumsum((data >= 128) | (data == ord("<")))])
        as_is = count[ends] > count[starts]
        edge = np.zeros(len(data) + 1, np.int8)
        edge[starts[as_is]] += 1
        edge[ends[as_is]] -= 1
        low = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, data, low)
        ids, upto = self.table.gather(self.table.find(low, starts, ends)) if len(starts) else (
            np.zeros(0, np.int32), np.zeros(1, np.int64))
        return ids, upto[np.searchsorted(starts, offsets)]


def encode_table(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """``(doc_id, text) -> (part, doc_id, start_in_part, n_tokens, ids)`` in the order of the input's partitions.

    Null text is empty: only the end id. Ids of documents in one partition are numbered from 0; ``part`` is the
    number of the partition.
    """
    import pyarrow as pa

    schema = pa.schema([("part", pa.int32()), ("doc_id", pa.int64()), ("start_in_part", pa.int64()),
                        ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from pyspark import TaskContext

        enc = worker_cache(("word_encoder", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        part, start = TaskContext.get().partitionId(), 0
        for b in batches:
            doc_ids = b.column("doc_id")
            for lo, hi, data, offsets in slices(b.column("text")):
                ids, upto = enc.encode(data, offsets)
                n = np.diff(upto) + 1
                ids = np.insert(ids, upto[1:], end_id)
                offs = np.concatenate([[0], np.cumsum(n)])
                lists = pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(hi - lo, part, np.int32)), doc_ids.slice(lo, hi - lo),
                     pa.array(start + offs[:-1]), pa.array(n), lists], schema=schema)
                start += int(offs[-1])

    return docs.select("doc_id", "text").mapInArrow(
        run, "part int, doc_id long, start_in_part long, n_tokens long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, encoding: str = "delta",
                 row_group_bytes: int = 16 << 20, page_bytes: int = 256 << 10, page_rows: int = 4_000) -> None:
    """Write the token ids of ``docs`` in ascending ``doc_id`` order as Parquet.

    ``encoding``: ``delta`` (DELTA_BINARY_PACKED ids, data pages of version 2) or ``dictionary``. The page limits
    and the column index written for ``doc_id`` let readers skip pages. Null ids sort first; rows with equal
    ``doc_id`` keep one order, by text. An empty table writes an empty dataset.
    """
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = ordered.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    (encode_table(ordered, tokenizer_path, end_id).write
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.writer.version", "v2" if encoding == "delta" else "v1")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes)
     .option("parquet.page.row.count.limit", page_rows)
     .option("compression", "zstd")
     .parquet(path))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, part, start, n_tokens)`` without reading the ids. ``start`` counts the ids of all documents
    before the row: the totals of the parts are summed in order and broadcast (one row per written partition, so a few
    megabytes for a million partitions)."""
    from pyspark.sql import Window as W

    meta = spark.read.parquet(path).select("doc_id", "part", "start_in_part", "n_tokens")
    totals = meta.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(F.col("part"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return meta.join(F.broadcast(before), "part").select(
        "doc_id", "part", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``(doc_id, ids)`` of the documents from ``first`` to ``last``; the bounds reach row groups and pages."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df.select("doc_id", "ids")


def digest_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back: ``(doc_id, start, n_tokens, ids_crc32)`` with the CRC of the ids as 32-bit
    little-endian integers."""
    import pyarrow as pa
    from pyspark.sql import Window as W

    def run(batches):
        for b in batches:
            lists = b.column("ids")
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            off = lists.offsets.to_numpy(zero_copy_only=False)
            crc = [zlib.crc32(values[a:z].tobytes()) for a, z in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("part"), b.column("start_in_part"), pa.array(np.diff(off), pa.int64()),
                 pa.array(crc, pa.int64())], names=["doc_id", "part", "start_in_part", "n_tokens", "ids_crc32"])

    rows = spark.read.parquet(path).mapInArrow(
        run, "doc_id long, part int, start_in_part long, n_tokens long, ids_crc32 long")
    totals = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(F.col("part"), (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    return rows.join(F.broadcast(before), "part").select(
        "doc_id", (F.col("before") + F.col("start_in_part")).alias("start"), "n_tokens", "ids_crc32")


def token_output(docs: DataFrame, tokenizer_path: str, end_id: int = 2, **layout) -> DataFrame:
    """Write ``docs`` as token files in the shared folder and return the digest of what the files hold."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id, **layout)
    return digest_tokens(docs.sparkSession, path)

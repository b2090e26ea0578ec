"""Helpers shared by the operators: table access, shared intermediate tables, byte-level hashing in numpy."""

from __future__ import annotations

import sys
import tempfile
import types
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.session import checkpoint_dir


def hand_over_less(spark: SparkSession, rows: int = 1000) -> None:
    """Hand at most ``rows`` texts to a Python worker at once, unless the session has a setting of its own: ten thousand texts, Spark's default,
    can be a large part of an executor's memory."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    hand_over_less(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def kept(columns: str) -> list[str]:
    """Names in a list of columns with types; commas inside ``<>`` and ``()`` belong to a type."""
    names, depth, start = [], 0, 0
    for i, c in enumerate(columns + ","):
        depth += (c in "<(") - (c in ">)")
        if c == "," and not depth:
            names += columns[start:i].split()[:1]
            start = i + 1
    return names


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (shared by driver and executors).

    Where the setting is absent a local session (tests, a laptop) takes a scratch folder; on a cluster it must be set.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not known:
        local = spark.sparkContext.master.startswith("local")
        known = checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="quire-ckpt-") if local else None)
    return f"{known.rstrip('/')}/quire-llm-{name}-{uuid.uuid4().hex}"


def save(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: lineage ends in files that survive a
    lost executor, and later plans see the true size of the table."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Within it, jobs hand ``rows`` rows at most to a Python worker at once: for rows that are blocks of many kilobytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``shared_dir`` named and that no later step reads."""
    if "/quire-llm-" not in path:
        raise ValueError(f"not an intermediate table: {path}")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def crc_bucket(col: str, n: int):
    """``crc32(id as text) mod n``; a null id has no bucket."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def worker_cache(key, make):
    """One object per Python worker process and key, kept across tasks. Functions reach the workers by value, so
    a module global would start empty in every task."""
    store = sys.modules.setdefault("_quire_worker_cache", types.ModuleType("_quire_worker_cache")).__dict__
    if key not in store:
        store[key] = make()
    return store[key]


# --- hashing of byte ranges -------------------------------------------------------------------------------------

_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class RangeHash:
    """64-bit hashes of arbitrary ranges of a sequence of 64-bit symbols, from prefix sums of ``symbol * base^i``
    (arithmetic modulo 2^64; the base is odd, so ``base^-start`` exists and makes a hash position-free)."""

    _powers: dict = {}

    def __init__(self, symbols: np.ndarray, which: int = 0):
        n = len(symbols)
        pw, inv = self.powers(which, n + 1)
        self.inv = inv
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * pw[:n], out=self.sums[1:])

    @classmethod
    def powers(cls, which: int, n: int):
        have = cls._powers.get(which)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            base = _BASES[which] | 1
            out = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                out.append(np.cumprod(p))
            have = cls._powers[which] = tuple(out)
        return have

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start] + (end - start).astype(np.uint64))


_SYMBOLS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def byte_symbols(data: np.ndarray) -> np.ndarray:
    return _SYMBOLS[data]


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray):
    """Starts and ends (byte offsets) of the maximal runs of bytes other than U+0020 and U+0009-U+000D. In UTF-8
    those bytes never occur inside another character, so these are the words of the text."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def text_bytes(column):
    """Iterate over an Arrow string column as numpy byte arrays without copying; null is empty."""
    import pyarrow as pa

    arr = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    offsets = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = np.frombuffer(arr.buffers()[2], np.uint8) if arr.buffers()[2] is not None else np.zeros(0, np.uint8)
    valid = arr.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(arr)):
        yield data[offsets[i]:offsets[i + 1]] if valid[i] else data[:0]


class UnitTable:
    """Id sequences of distinct text units (words), looked up for whole slices of text at once.

    Units are found by a 64-bit hash of their bytes. ``encode`` gets the strings of units seen for the first time and
    returns one integer array each and a row of ``values`` numbers each (kept in ``value``). When more than ``limit`` units are
    held, the table starts anew, so memory is bounded.
    """

    def __init__(self, encode, values: int = 0, limit: int = 400_000):
        self.encode, self.values, self.limit = encode, values, limit
        self.clear()

    def clear(self):
        self.keys, self.rank = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.offset, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.value = np.zeros((0, self.values))
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def add(self, keys, strings):
        ids, values = self.encode(strings)
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        total = int(sizes.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(total, len(self.flat)), np.int32)])
        self.flat[self.used:self.used + total] = np.concatenate(ids) if total else []
        first = len(self.size)
        self.offset = np.concatenate([self.offset, self.used + np.cumsum(sizes) - sizes])
        self.size, self.value = np.concatenate([self.size, sizes]), np.concatenate([self.value, values])
        self.used += total
        at = np.searchsorted(self.keys, keys)
        self.keys = np.insert(self.keys, at, keys)
        self.rank = np.insert(self.rank, at, np.arange(first, first + len(keys)))

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Row of the table for every unit ``data[start:end]``."""
        if len(self.keys) > self.limit:
            self.clear()
        uniq, first, inverse = np.unique(RangeHash(byte_symbols(data)).of(starts, ends), return_index=True,
                                         return_inverse=True)
        at = np.searchsorted(self.keys, uniq)
        known = np.zeros(len(uniq), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == uniq[inside]
        if not known.all():
            new = first[~known]
            raw = data.tobytes()
            self.add(uniq[~known], [raw[a:z].decode("utf-8", "replace") for a, z in zip(starts[new].tolist(), ends[new].tolist())])
            at = np.searchsorted(self.keys, uniq)
        return self.rank[at][inverse]

    def gather(self, rows: np.ndarray):
        """Concatenated ids of ``rows`` and the number of ids before each (one more than rows)."""
        sizes = self.size[rows].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(self.offset[rows] - before[:-1], sizes) + np.arange(before[-1])
        return self.flat[where], before


def slices(column, size: int = 1 << 20):
    """Cut an Arrow string column into runs of about ``size`` bytes (one text at least): first and last row, the
    concatenated bytes of the run and the offsets of its texts. Null is empty."""
    texts = list(text_bytes(column))
    at = 0
    while at < len(texts):
        to, total = at, 0
        while to < len(texts) and (to == at or total + len(texts[to]) <= size):
            total += len(texts[to])
            to += 1
        sizes = np.fromiter(map(len, texts[at:to]), np.int64, to - at)
        yield at, to, np.concatenate(texts[at:to]), np.concatenate([[0], np.cumsum(sizes)])
        at = to


def sized_broadcast(df: DataFrame, limit: int = 32 << 20) -> DataFrame:
    """Hint a broadcast if the rows of ``df``, written out as JSON, take at most ``limit`` bytes (one small job);
    otherwise the join stays a shuffle join."""
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def join_groups(rows: DataFrame, groups: DataFrame, on: list[str], size: str = "group_n", most: int = 4096) -> DataFrame:
    """Left join of ``rows`` to ``groups``, which holds one row per key and in ``size`` the number of rows that have the key.

    Groups of a few megabytes are broadcast whole. Else keys of more than one ``most``-th of all rows (and more than a thousand rows) are at most ``most``: they are broadcast, so that a
    key with a third of all rows needs no shuffle. The others are joined by a shuffle whose largest group is as small as that. Both tables are
    read twice, so they should be written ones.
    """
    small = sized_broadcast(groups, 16 << 20)
    if small is not groups:
        return rows.join(small, on, "left")
    line = max(rows.count() // most, 1000)
    hot = groups.where(F.col(size) > line).withColumn("__hot", F.lit(True))
    first = rows.join(F.broadcast(hot), on, "left")
    rest = first.where("__hot IS NULL").select(*rows.columns)
    rest = rest.join(groups.where(F.col(size) <= line).hint("shuffle_merge"), on, "left")
    return first.where("__hot IS NOT NULL").drop("__hot").unionByName(rest)

"""Operator 2: removal of byte strings that occur again, with a logarithmic family of suffix arrays.

A byte goes if a string of ``SPAN`` bytes that covers it also starts anywhere else in the table, same text included.

Suffixes are sampled: every ``SPAN``-byte window selects its least ``SEED``-byte string (by hash, leftmost on ties). Equal
windows select the same place, so the suffixes that start at selected places see every match. An entry stands for the
consecutive windows with one selected place: the hash of its seed (the sort key), the hash of all bytes of these
windows (equal: every one of the windows occurs twice), and hashes of the ``FLANK`` bytes right and left, one of which every
matching window contains.

Batches of documents get their suffix array (entries sorted by seed, cut into buckets of the key), which is merge-scanned
against the arrays of the levels: equal entries are long matches, entries with a common seed and flank are edges of matches.
Then it becomes a level, and levels of equal size merge, so an index over ``b`` batches has at most ``log2 b + 1`` levels. Levels are tables of
packed blocks in the shared folder, replaced as a whole.

The edges are resolved exactly: the bytes under their windows are sent to the seed's bucket, where the windows are matched one by one. Places and
texts travel as packed blocks, so there is never a row per suffix, window or pair. Entries of a text that repeat are
counted where they arise, and seeds that a small part of the documents shows to be frequent in different surroundings are keyed by
seed and flank, so neither copies nor common lines gather in one task. Where seed and flank are frequent too (a passage that very
many documents share), the entries skip the index: hashes of their windows are sent to the bucket of the window's own hash, windows
that occur twice in what a task holds as one record, so common passages do not gather either.

Defined cases: null text is empty; texts shorter than ``SPAN`` keep all bytes; repeated rows are documents of their
own; a null ``doc_id`` is returned as it is; an empty table gives no rows; further columns are ignored. Strings are
compared by two independent 64-bit hashes.
"""

from __future__ import annotations

import gc
import hashlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.common import RangeHash, batches_of, byte_symbols, discard, mix, save, shared_dir, text_bytes
from quire.llm.jaccard_join import _by_bucket, _streamed

SPAN, SEED = 200, 32
FLANK = (SPAN + SEED) // 2
BATCHES = 3
#: A seed with this many different surroundings in one ``1 / HOT_PART`` part of the documents is keyed by its flanks.
HOT_FROM, HOT_PART, HOT_LIMIT = 24, 16, 1 << 20
#: A seed and flank with this many different contents in that part: the windows are matched by their own hash.
WIDE_FROM = 128
#: Of so few documents every seed and flank is counted, not only those that an Arrow batch holds twice, so that seeds spread thinly
#: over very many documents are found as well: ``RARE_FROM`` of them stand for about ``RARE_FROM * RARE_PART`` documents.
RARE_FROM, RARE_PART = 24, 1024

#: Rows, most of them blocks, that a Python worker gets at once.
BLOCKS_AT_ONCE = 400
#: Entries in one block of a level.
PIECE = 2000
#: Entries that are sorted and cut into blocks at once.
ENTRIES_AT_ONCE = 200_000
#: Windows that are matched in a task before they are sent.
WINDOWS_AT_ONCE = 500_000

ENTRY = np.dtype([("key", "<u8"), ("all", "<u8"), ("right", "<u2"), ("left", "<u2"), ("doc", "<i8"), ("at", "<u4"),
                  ("back", "u1"), ("len", "u1"), ("twice", "u1")])
#: A range of windows of a text: the windows starting at ``at`` to ``at + len - 1``; ``gives``: they occur twice anyway and
#: only serve others; ``wide``: they are matched by their own hash.
PLACE = np.dtype([("doc", "<i8"), ("at", "<u4"), ("key", "<u8"), ("len", "u1"), ("gives", "u1"), ("wide", "u1")])
WINDOW = np.dtype([("one", "<u8"), ("two", "<u8"), ("doc", "<i8"), ("at", "<u4"), ("gives", "u1")])
STRETCH = np.dtype([("doc", "<i8"), ("start", "<u4"), ("end", "<u4")])


def entries(data: np.ndarray, doc: int, twice: bool, span: int = SPAN, seed: int = SEED) -> np.ndarray:
    """The sampled suffixes of a text."""
    n = len(data) - span + 1
    if n <= 0:
        return np.zeros(0, ENTRY)
    symbols = byte_symbols(data)
    first, second = RangeHash(symbols), RangeHash(symbols, 1)
    at = np.arange(len(data) - seed + 1)
    seeds = first.of(at, at + seed)
    order = (seeds >> np.uint64(32) << np.uint64(32)) | at.astype(np.uint64)  # by hash, then place
    width, have = span - seed + 1, 1
    while have < width:  # minimum over ``width`` places by doubling
        step = min(have, width - have)
        order = np.minimum(order[:len(order) - step], order[step:])
        have += step
    place = (order & np.uint64(0xFFFFFFFF)).astype(np.int64)
    cut = np.flatnonzero(np.diff(place)) + 1
    start, end = np.concatenate([[0], cut]), np.concatenate([cut, [n]])
    place = place[start]
    flank = (span + seed) // 2
    out = np.zeros(len(start), ENTRY)
    # selected hashes are small ones, so mixed again they fill the buckets evenly
    out["key"], out["all"] = mix(seeds[place]), second.of(start, end + span - 1)
    out["right"] = second.of(place, np.minimum(place + flank, len(data))) >> np.uint64(48)
    out["left"] = second.of(np.maximum(place + seed - flank, 0), place + seed) >> np.uint64(48)
    out["doc"], out["at"], out["back"], out["len"], out["twice"] = doc, start, place - start, end - start, twice
    return out


def by_flank(e: np.ndarray, left: bool) -> np.ndarray:
    """Keys of seed and flank."""
    return mix(e["key"] ^ (e["left"].astype(np.uint64) << np.uint64(20) if left else e["right"].astype(np.uint64)))


def _among(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` are in the sorted ``known``."""
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys if len(known) else np.zeros(len(keys), bool)


def _same_as_before(*columns: np.ndarray) -> np.ndarray:
    same = np.ones(len(columns[0]), bool)
    same[:1] = False
    for c in columns:
        same[1:] &= c[1:] == c[:-1]
    return same


def _group_any(flag: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Per row, whether any row of its run has the flag."""
    group = np.cumsum(~same) - 1
    return np.bincount(group, flag, group[-1] + 1 if len(group) else 0)[group] > 0 if len(group) else flag


def distinct(e: np.ndarray):
    """Sort by key, then content; one entry per content (the least place), marked if it occurred twice. Second: the
    mask, in sorted order, of those kept."""
    e = e[np.lexsort((e["at"], e["doc"], e["all"], e["key"]))]
    same = _same_as_before(e["key"], e["all"])
    again = np.zeros(len(e), bool)
    again[:-1] = same[1:]
    e["twice"] |= _group_any(again | (e["twice"] > 0), same).astype(np.uint8)
    return e, ~same


def stretches(e: np.ndarray, span: int) -> np.ndarray:
    out = np.zeros(len(e), STRETCH)
    out["doc"], out["start"], out["end"] = e["doc"], e["at"], e["at"] + e["len"].astype(np.uint32) + np.uint32(span - 1)
    return out


def places_under(e: np.ndarray, left: bool, span: int, seed: int) -> np.ndarray:
    """The windows of entries that contain a flank; right: windows that start near the seed; left: those that start far
    before it."""
    flank = (span + seed) // 2
    back, n = e["back"].astype(np.int64), e["len"].astype(np.int64)
    low = np.zeros(len(e), np.int64) if left else np.maximum(back - (span - flank), 0)
    high = np.minimum(n, back - (flank - seed) + 1) if left else n
    ok = high > low
    p = np.zeros(int(ok.sum()), PLACE)
    p["doc"], p["at"], p["len"] = e["doc"][ok], e["at"][ok] + low[ok].astype(np.uint32), (high - low)[ok]
    p["gives"], p["key"] = e["twice"][ok], e["key"][ok]
    return p


def scan_merge(new: np.ndarray, old: np.ndarray, span: int = SPAN, seed: int = SEED):
    """Scan a batch's array against the levels' arrays of a bucket -> (the batch's distinct entries, the stretches that certainly
    occur twice, the places to be resolved)."""
    e = np.concatenate([new, old])
    is_new = np.arange(len(e)) < len(new)
    perm = np.lexsort((e["at"], e["doc"], e["all"], e["key"]))
    e, is_new = e[perm], is_new[perm]
    same = _same_as_before(e["key"], e["all"])
    again = np.zeros(len(e), bool)
    again[:-1] = same[1:]
    was = e["twice"] > 0
    twice = _group_any(again | same | was, same)
    certain = stretches(e[twice & (is_new | ~was)], span)
    e["twice"] = twice
    u, kept = e[~same], _group_any(is_new, same)[~same]
    # among distinct contents: a neighbour with the same seed and right, or left, flank
    shares = np.zeros((2, len(u)), bool)
    fresh = np.zeros((2, len(u)), bool)
    asks = np.zeros((2, len(u)), bool)
    for i, side in enumerate(("right", "left")):
        by = np.lexsort((u[side], u["key"]))
        s = _same_as_before(u["key"][by], u[side][by])
        nxt = np.zeros(len(u), bool)
        nxt[:-1] = s[1:]
        shares[i][by] = s | nxt
        fresh[i][by] = _group_any(kept[by], s)
        asks[i][by] = _group_any(u["twice"][by] == 0, s)
    use = shares & fresh & asks
    places = [places_under(u[use[i]], i == 1, span, seed) for i in range(2)]
    mine = np.zeros(len(u), bool)
    mine[:] = kept
    return u[mine], certain, np.concatenate(places)


def _block_schema():
    import pyarrow as pa

    return pa.schema([("bucket", pa.int64()), ("kind", pa.string()), ("block", pa.binary())])


_BLOCKS = "bucket long, kind string, block binary"


def _pieces(bucket: int, e: np.ndarray):
    """A sorted array as level blocks of a bounded size."""
    return [(bucket, "level", e[i:i + PIECE].tobytes()) for i in range(0, len(e), PIECE)]


def _docs_in_blocks(records: np.ndarray, bits: int, kind: str):
    """Records with a ``doc`` in blocks by document."""
    if len(records):
        for k, (part,) in _by_bucket(mix(records["doc"].view(np.uint64) if records["doc"].flags.c_contiguous
                                         else np.ascontiguousarray(records["doc"]).view(np.uint64)), bits, [records]):
            yield k, kind, part.tobytes()


def _batch_of(rows: list, schema):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(schema.types)], schema=schema)


class LogIndex:
    """Logarithmic family of suffix arrays. ``insert`` takes ``(cls, text)`` rows and returns the blocks of what it found."""

    def __init__(self, spark: SparkSession, hot: np.ndarray, bits: int, span: int = SPAN, seed: int = SEED,
                 wide: np.ndarray = np.zeros(0, np.uint64)):
        self.spark, self.bits, self.span, self.seed = spark, bits, span, seed
        self.frequent = spark.sparkContext.broadcast((hot, wide))
        self.levels: list[tuple[int, str]] = []  # (number of batches inside, folder of the blocks), largest first

    def array_of(self, texts: DataFrame) -> DataFrame:
        bits, span, seed, shared, schema = self.bits, self.span, self.seed, self.frequent, _block_schema()

        def run(batches):
            held, size = [], 0  # entries of several batches, so that blocks are not tiny
            for b in batches:
                for part, _ in _classes(b, 4 << 20):
                    held.append(np.concatenate([entries(t, c, many, span, seed) for c, t, many in part]))
                    size += len(held[-1])
                    if size >= ENTRIES_AT_ONCE:
                        yield blocks(np.concatenate(held))
                        held, size = [], 0
            if size:
                yield blocks(np.concatenate(held))

        def blocks(e):
            hot, wide = shared.value
            found, rows, at_once = _among(hot, e["key"]), [], []
            if found.any():
                sides = [e[~found]]
                for left in (False, True):
                    side = e[found].copy()
                    side["key"] = by_flank(side, left)
                    many = _among(wide, side["key"])
                    at_once.append((left, *distinct(side[many])))
                    sides.append(side[~many])
                e = np.concatenate(sides)
            s, keep = distinct(e)
            rows += [(k, "entry", c[0].tobytes()) for k, c in _by_bucket(s["key"][keep], bits, [s[keep]])]
            for left, w, first in at_once:
                p = places_under(w[first], left, span, seed)
                p["wide"] = 1
                rows += [*_docs_in_blocks(p, bits, "place"), *_docs_in_blocks(stretches(w[w["twice"] > 0], span), bits, "stretch")]
            return _batch_of(rows + list(_docs_in_blocks(stretches(s[~keep], span), bits, "stretch")), schema)

        return texts.mapInArrow(run, _BLOCKS)

    def insert(self, texts: DataFrame, last: bool = False) -> DataFrame:
        """Scan the batch against all levels, then file it, merging levels of equal size. ``last``: nothing will be
        inserted after it, so its own level is not filed."""
        bits, span, seed, schema = self.bits, self.span, self.seed, _block_schema()

        def scan(bucket, rows):
            kind = rows["kind"].to_pylist()
            part = {k: [np.frombuffer(x.as_py(), ENTRY) for x, y in zip(rows["block"], kind) if y == k]
                    for k in ("entry", "level")}
            out = [(bucket, y, x.as_py()) for x, y in zip(rows["block"], kind) if y in ("stretch", "place")]
            if part["entry"]:
                old = np.concatenate(part["level"]) if part["level"] else np.zeros(0, ENTRY)
                mine, certain, places = scan_merge(np.concatenate(part["entry"]), old, span, seed)
                if not last:
                    out += _pieces(bucket, mine)
                out += [*_docs_in_blocks(certain, bits, "stretch"), *_docs_in_blocks(places, bits, "place")]
            return tuple(zip(*out)) if out else None

        # stretches of the batch itself and wide places are already by document; they pass through
        array = self.array_of(texts)
        for _, folder in self.levels:
            array = array.unionByName(self.blocks_in(folder))
        path = shared_dir(self.spark, "scan")
        with batches_of(self.spark, BLOCKS_AT_ONCE):
            _streamed(array, "bucket", scan, _BLOCKS, schema).write.partitionBy("kind").parquet(path)
        if last:
            self.close()
        else:
            self.file(path)
        free(self.spark)
        return self.blocks_in(path, "kind <> 'level'")

    def blocks_in(self, folder: str, which: str = "kind = 'level'") -> DataFrame:
        found = self.spark.read.schema("bucket long, block binary, kind string").parquet(folder)
        return found.where(which).select("bucket", "kind", "block")

    def close(self) -> None:
        """Delete the levels."""
        for _, folder in self.levels:
            discard(self.spark, f"{folder}/kind=level")
        self.levels = []

    def file(self, folder: str) -> None:
        """Add a level of one batch; merge levels while the last two are of equal size."""
        self.levels.append((1, folder))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels.pop(), self.levels.pop()

            def merge(bucket, rows):
                s, keep = distinct(np.concatenate([np.frombuffer(x.as_py(), ENTRY) for x in rows["block"]]))
                return tuple(zip(*_pieces(bucket, s[keep])))

            with batches_of(self.spark, BLOCKS_AT_ONCE):
                both = self.blocks_in(a).unionByName(self.blocks_in(b))
                path = shared_dir(self.spark, "level")
                _streamed(both, "bucket", merge, _BLOCKS, _block_schema()).write.partitionBy("kind").parquet(path)
            self.levels.append((n + m, path))
            for folder in (a, b):
                discard(self.spark, f"{folder}/kind=level")


def free(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps, which stay until the driver notices that nobody refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _classes(batch, size: int):
    """Distinct texts of an Arrow batch ``(cls, text)`` in runs of about ``size`` bytes: ``(cls, bytes, seen twice)``."""
    cls = batch.column("cls").to_numpy()
    count: dict[int, int] = {}
    for c in cls.tolist():
        count[c] = count.get(c, 0) + 1
    part, total, seen = [], 0, set()
    for c, t in zip(cls.tolist(), text_bytes(batch.column("text"))):
        if c in seen:
            continue
        seen.add(c)
        part.append((c, t, count[c] > 1))
        total += len(t)
        if total >= size:
            yield part, total
            part, total = [], 0
    if part:
        yield part, total


def frequent_seeds(texts: DataFrame, span: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds with many surroundings in a part of the documents, and keys of seed and flank with many contents. Only the
    spread of the work depends on them."""
    import pyarrow as pa

    schema = pa.schema([("key", pa.int64()), ("wide", pa.bool_()), ("rare", pa.bool_()), ("n", pa.int64())])

    def run(batches):
        for b in batches:
            for part, _ in _classes(b, 8 << 20):
                e = np.concatenate([entries(t, c, False, span, seed) for c, t, _ in part])
                for rare, some, least in ((False, e, 2), (True, e[e["doc"] % RARE_PART == 0], 1)):
                    s, keep = distinct(some)
                    s = s[keep]
                    for keys, wide in ((s["key"], False), (by_flank(s, False), True), (by_flank(s, True), True)):
                        keys, n = np.unique(keys, return_counts=True)
                        keys, n = keys[n >= least], n[n >= least]
                        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(n), wide)),
                                                          pa.array(np.full(len(n), rare)), pa.array(n)], schema=schema)

    some = texts.where((F.pmod("cls", F.lit(HOT_PART)) == 0) | (F.pmod("cls", F.lit(RARE_PART)) == 0)).mapInArrow(
        run, "key long, wide boolean, rare boolean, n long")
    many = F.when(F.col("rare"), RARE_FROM).when(F.col("wide"), WIDE_FROM).otherwise(HOT_FROM)
    top = (some.groupBy("key", "wide", "rare").agg(F.sum("n").alias("n")).where(F.col("n") >= many)
           .orderBy(F.desc("n"), "wide", "rare", "key").limit(2 * HOT_LIMIT).toArrow())
    keys, wide = top["key"].to_numpy().view(np.uint64), top["wide"].to_numpy()
    return np.unique(keys[~wide]), np.unique(keys[wide])


def windows_under(p: np.ndarray, data: np.ndarray, span: int) -> np.ndarray:
    """The windows of places, from the bytes under them."""
    n = p["len"].astype(np.int64)
    size = n + span - 1
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(np.cumsum(size) - size, n) + inside
    symbols = byte_symbols(data)
    w = np.zeros(len(start), WINDOW)
    w["one"], w["two"] = RangeHash(symbols).of(start, start + span), RangeHash(symbols, 1).of(start, start + span)
    w["doc"], w["at"], w["gives"] = np.repeat(p["doc"], n), np.repeat(p["at"].astype(np.int64), n) + inside, np.repeat(p["gives"], n)
    return w


def matched(w: np.ndarray, span: int):
    """Windows, equal ones as one (marked if it occurs twice), and the stretches of those that occur twice and do not only give."""
    w = w[np.lexsort((-w["gives"].astype(int), w["at"], w["doc"], w["two"], w["one"]))]
    w = w[~_same_as_before(w["one"], w["two"], w["doc"], w["at"])]  # places may overlap
    same = _same_as_before(w["one"], w["two"])
    nxt = np.zeros(len(w), bool)
    nxt[:-1] = same[1:]
    hit = w[(same | nxt) & (w["gives"] == 0)]
    out = np.zeros(len(hit), STRETCH)
    out["doc"], out["start"], out["end"] = hit["doc"], hit["at"], hit["at"] + np.uint32(span)
    w["gives"] = _group_any((w["gives"] > 0) | nxt, same)
    return w[~same], merged(out)


def once(texts: DataFrame) -> DataFrame:
    """``texts`` without the copies that a task meets again, so that a text with very many copies leaves each task once."""
    import pyarrow as pa

    def run(batches):
        seen: set[int] = set()
        for b in batches:
            new = []
            for i, c in enumerate(b.column("cls").to_pylist()):
                if c not in seen:
                    seen.add(c)
                    new.append(i)
            yield b if len(new) == b.num_rows else b.take(pa.array(new, pa.int64()))

    return texts.mapInArrow(run, texts.schema)


def resolve(texts: DataFrame, found: DataFrame, bits: int, span: int) -> DataFrame:
    """Match the windows of the places in ``found`` one by one; returns the stretches of those that occur twice. A place's windows can
    only match those of places with the same key, so the bytes under them are sent to that key's bucket; the windows of wide places
    are sent to the bucket of their own hash. Exact copies have the same places, so one of them sends for all."""
    import pyarrow as pa

    schema, per_doc = _block_schema(), pa.schema([("cls", pa.int64()), ("places", pa.binary())])
    sent = pa.schema([("bucket", pa.int64()), ("kind", pa.string()), ("block", pa.binary()), ("data", pa.binary())])

    def gather(_, rows):
        p = np.unique(np.concatenate([np.frombuffer(x.as_py(), PLACE) for x in rows["block"]]))
        parts = np.split(p, np.flatnonzero(np.diff(p["doc"])) + 1)
        return [int(x["doc"][0]) for x in parts], [x.tobytes() for x in parts]

    places = _streamed(found.where("kind = 'place'"), "bucket", gather, "cls long, places binary", per_doc)
    at = once(texts).join(places.hint("shuffle_hash"), "cls")

    def send(batches):
        held, wide, size, sent_for = [], [], 0, set()
        for b in batches:
            for c, t, raw in zip(b.column("cls").to_pylist(), text_bytes(b.column("text")), b.column("places")):
                if c in sent_for:
                    continue
                sent_for.add(c)
                for p in np.frombuffer(raw.as_py(), PLACE):
                    (wide if p["wide"] else held).append((p, t[p["at"]:p["at"] + p["len"] + span - 1].tobytes()))
                    size += int(p["len"]) * int(p["wide"])
                    if len(held) > 20_000:
                        yield packed(held)
                        held = []
                    if size > WINDOWS_AT_ONCE:
                        yield hashed(wide)
                        wide, size = [], 0
        if held:
            yield packed(held)
        if wide:
            yield hashed(wide)

    def packed(held):
        p, bytes_ = np.array([x for x, _ in held], PLACE), [x for _, x in held]
        rows = [(k, "bytes", q.tobytes(), b"".join(bytes_[i] for i in at))
                for k, (q, at) in _by_bucket(p["key"], bits, [p, np.arange(len(p))])]
        return _batch_of(rows, sent)

    def hashed(held):
        w = windows_under(np.array([x for x, _ in held], PLACE), np.frombuffer(b"".join(x for _, x in held), np.uint8), span)
        w, twice = matched(w, span)
        rows = [(k, "window", q.tobytes(), None) for k, (q,) in _by_bucket(w["one"], bits, [w])]
        return _batch_of(rows + [(*r, None) for r in _docs_in_blocks(twice, bits, "stretch")], sent)

    def match(bucket, rows):
        kind, block = rows["kind"].to_pylist(), rows["block"].to_pylist()
        got = [(bucket, y, x) for x, y in zip(block, kind) if y == "stretch"]
        data = [x for x in rows["data"].to_pylist() if x is not None]
        for some, of in (("bytes", PLACE), ("window", WINDOW)):
            part = [np.frombuffer(x, of) for x, y in zip(block, kind) if y == some]
            if part:
                w = np.concatenate(part)
                if some == "bytes":
                    w = windows_under(w, np.frombuffer(b"".join(data), np.uint8), span)
                got += _docs_in_blocks(matched(w, span)[1], bits, "stretch")
        return tuple(zip(*got)) if got else None

    rows = at.mapInArrow(send, "bucket long, kind string, block binary, data binary")
    return _streamed(rows, "bucket", match, _BLOCKS, schema)


def merged(s: np.ndarray) -> np.ndarray:
    """Stretches of each document, overlapping and touching ones joined."""
    if not len(s):
        return s
    s = s[np.lexsort((s["start"], s["doc"]))]
    doc, start, end = s["doc"], s["start"].astype(np.int64), s["end"].astype(np.int64)
    group = np.cumsum(np.diff(doc, prepend=doc[0]) != 0)
    reach = np.maximum.accumulate(end + group * (1 << 33)) - group * (1 << 33)  # the farthest end so far, per document
    new = np.ones(len(s), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] > reach[:-1])
    first = np.flatnonzero(new)
    out = np.zeros(len(first), STRETCH)
    out["doc"], out["start"] = doc[first], start[first]
    out["end"] = reach[np.append(first[1:], len(s)) - 1]
    return out


def repeated_spans(docs: DataFrame, span: int = SPAN, seed: int = SEED, batches: int = BATCHES) -> DataFrame:
    """``(cls, spans)``: for every text (named by ``xxhash64(text)``) the packed stretches to remove."""
    import pyarrow as pa

    spark = docs.sparkSession
    texts = docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("cls"), "text").where(F.octet_length("text") >= span)
    bits = max(5, (8 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))).bit_length() - 1)
    hot, wide = frequent_seeds(texts, span, seed)
    index = LogIndex(spark, hot, bits, span, seed, wide)
    found = None
    for i in range(batches):  # the documents arrive in batches
        batch = texts.where(F.pmod(F.shiftright("cls", 8), F.lit(batches)) == i)
        got = index.insert(batch, last=i == batches - 1)
        found = got if found is None else found.unionByName(got)
    with batches_of(spark, BLOCKS_AT_ONCE):
        edges = save(resolve(texts, found, bits, span), "edges")
    free(spark)

    def join(_, rows):
        m = merged(np.concatenate([np.frombuffer(x.as_py(), STRETCH) for x in rows["block"]]))
        parts = np.split(m, np.flatnonzero(np.diff(m["doc"])) + 1)
        return [int(x["doc"][0]) for x in parts], [x.tobytes() for x in parts]

    both = found.where("kind = 'stretch'").unionByName(edges)
    with batches_of(spark, BLOCKS_AT_ONCE):
        return save(_streamed(both, "bucket", join, "cls long, spans binary",
                              pa.schema([("cls", pa.int64()), ("spans", pa.binary())])), "spans")


def dedup(docs: DataFrame, span: int = SPAN, seed: int = SEED, batches: int = BATCHES, digest: bool = False) -> DataFrame:
    """``docs`` (``doc_id, text``) -> ``doc_id, n_bytes, n_removed, n_spans`` and ``kept`` (the bytes left) or, with ``digest``,
    ``kept_sha256``."""
    spans = repeated_spans(docs, span, seed, batches).withColumnRenamed("cls", "__cls").hint("shuffle_hash")
    rows = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("cls"))
    return cut(rows.join(spans, F.col("cls") == F.col("__cls"), "left"), digest)


def cut(rows: DataFrame, digest: bool = False) -> DataFrame:
    """Remove the ``spans`` of ``text``; ``digest``: return the SHA-256 of what is left instead of the bytes."""
    import pyarrow as pa

    last = "kept_sha256" if digest else "kept"
    kind = pa.string() if digest else pa.binary()

    def run(batches):
        for b in batches:
            size, gone, count, left = [], [], [], []
            for t, raw in zip(text_bytes(b.column("text")), b.column("spans")):
                s = np.frombuffer(raw.as_py() or b"", STRETCH)
                parts, at = [], 0
                for a, z in zip(s["start"].tolist(), s["end"].tolist()):
                    parts.append(t[at:a])
                    at = z
                kept = b"".join(p.tobytes() for p in [*parts, t[at:]])
                size.append(len(t))
                gone.append(len(t) - len(kept))
                count.append(len(s))
                left.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()),
                 pa.array(left, kind)], names=["doc_id", "n_bytes", "n_removed", "n_spans", last])

    return rows.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id long, n_bytes long, n_removed long, n_spans long, {last} {'string' if digest else 'binary'}")

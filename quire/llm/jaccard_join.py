"""Operator 3: n-gram Jaccard join with several global token orders.

A document's tokens are the 64-bit hashes of its distinct word shingles; documents with equal sets form a class. Two
classes link when their Jaccard similarity reaches ``percent`` / 100 (compared in integers).

1. Half of all tokens (those with an even hash) are counted in blocks that reach one bucket each; the most frequent ones, a bounded
   number, are sent to all tasks with their frequency.
2. First order: counted tokens that are rare, then those not counted, then frequent ones by powers of two; each by hash. Under any order two linked sets
   share a token among the first ``n - ceil(n * percent / 100) + 1``, so classes are posted under these tokens only; the frequencies
   keep passages that many documents share out of the prefixes.
3. Classes of fitting sizes that meet under a token meet again in the group of the smallest class among them (large texts
   meet many others, small ones few). A group has a row per class, however
   many tokens it shares, and never a row per pair. Groups beyond ``BLOCK`` rows are split at random; every part also gets
   the group's first class, and what is not linked to it visits all parts in a second round, in blocks, so every pair
   meets and no task gets more than two blocks.
4. To a group come first only the posted tokens that classes share, with their positions. Linked sets share so many of them that the tokens
   that follow can make up the overlap; pairs below that go, and so do classes left without a pair. Only then do the sets follow.
5. Remaining pairs must also share prefix tokens under two further orders (other hashes of the tokens); those that pass all
   filters and are not connected yet are verified by exact counts.
6. The links, at most one per class and group, are joined into components.

Defined cases: null or wordless text has the empty set and links with nothing; fewer words than ``width`` make one
shingle; repeated rows and equal texts are one class; a null ``doc_id`` keeps its row, is no component's least
id and is linked only through an equal text that has an id; documents without any id in their component get a null component; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import batches_of, byte_symbols, join_groups, lower_ascii, mix, RangeHash, save, slices, word_bounds
from quire.llm.components import connected

WIDTH, PERCENT = 5, 75
#: Tokens whose frequency is sent to all tasks (12 bytes each), and the least frequency that counts as known.
KNOWN_TOKENS, KNOWN_FROM = 1 << 20, 4
BLOCK = 2000
#: Postings that are cut into blocks at once.
POSTINGS_AT_ONCE = 400_000
_SLICE = 8 << 20
POSTING = np.dtype([("token", "<u8"), ("cls", "<i8"), ("n", "<u4"), ("pos", "<u4"), ("last", "<u4")])
MEETING = np.dtype([("cls", "<i8"), ("n", "<u4"), ("pos", "<u4"), ("last", "<u4"), ("token", "<u8"), ("home", "<i8")])
SHARED = np.dtype([("token", "<u8"), ("pos", "<u4")])
_ORDERS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))


def shingles(data: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct shingle hashes of a text given as bytes."""
    low = lower_ascii(data)
    starts, ends = word_bounds(low)
    if not len(starts):
        return np.zeros(0, np.uint64)
    words = RangeHash(byte_symbols(low)).of(starts, ends)
    k = min(width, len(words))
    at = np.arange(len(words) - k + 1)
    return np.unique(RangeHash(words, 1).of(at, at + k))


def class_of(tokens: np.ndarray) -> int:
    """A 64-bit name of the set (0 for the empty set)."""
    if not len(tokens):
        return 0
    n = np.array([len(tokens)])
    return int(RangeHash(tokens).of(n * 0, n).view(np.int64)[0]) or 1


def prefix_size(n, percent: int = PERCENT):
    return n - -(-n * percent // 100) + 1


def _by_bucket(keys: np.ndarray, bits: int, columns: list[np.ndarray]):
    """Yield ``(bucket, [columns])`` by the top ``bits`` bits of ``keys``."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    sorted_bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(sorted_bucket)) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), [c[part] for c in columns]


def _texts(batches, columns=()):
    """Slices of a text column: their rows and the texts as byte arrays."""
    for b in batches:
        for lo, hi, data, offsets in slices(b.column("text"), _SLICE):
            yield [data[offsets[i]:offsets[i + 1]] for i in range(hi - lo)], [b.column(c).slice(lo, hi - lo) for c in columns]


def _streamed(df: DataFrame, key: str, of_group, schema: str, arrow_schema, *more: str) -> DataFrame:
    """Apply ``of_group(key, list of column slices)`` to the rows of each key. Rows of a partition are sorted by key and
    streamed, so memory holds one group at a time, and there is no cost per group besides the call."""
    import pyarrow as pa

    def run(batches):
        held, current = [], None
        for b in batches:
            keys = b.column(key).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                if lo == hi:
                    continue
                if held and keys[lo] != current:
                    yield from out(current, held)
                    held = []
                current = keys[lo]
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from out(current, held)

    def out(k, held):
        columns = of_group(k, pa.Table.from_batches(held))
        if columns is not None and len(columns[0]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=arrow_schema)

    return df.repartition(key).sortWithinPartitions(key, *more).mapInArrow(run, schema)


def scan(docs: DataFrame, bits: int, width: int) -> DataFrame:
    """One pass over the texts: a row per document (``doc_id, n, cls``) and blocks of the even tokens of the distinct
    classes of a slice (``bucket, block``), four bytes each."""
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("bucket", pa.int64()),
                        ("block", pa.binary())])

    def run(batches):
        for texts, (ids,) in _texts(batches, ["doc_id"]):
            sets = [shingles(t, width) for t in texts]
            cls = np.array([class_of(s) for s in sets], np.int64)
            none = pa.nulls(len(sets))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(cls), none.cast(pa.int64()),
                 none.cast(pa.binary())], schema=schema)
            tokens = np.concatenate([sets[i] for i in np.unique(cls, return_index=True)[1]])
            tokens = tokens[tokens & np.uint64(1) == 0]
            rest = (tokens >> np.uint64(32 - bits)).astype(np.uint32)
            blocks = [(k, c[0].tobytes()) for k, c in _by_bucket(tokens, bits, [rest])]
            none = pa.nulls(len(blocks), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array([k for k, _ in blocks], pa.int64()),
                                              pa.array([x for _, x in blocks], pa.binary())], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, cls long, bucket long, block binary")


def known_frequencies(blocks: DataFrame, bits: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``limit`` most frequent counted tokens (their first ``32 + bits`` bits) and the powers of two of their counts."""
    import pyarrow as pa

    def count(bucket, rows):
        tokens = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in rows["block"]])
        u, c = np.unique(tokens, return_counts=True)
        keep = c >= KNOWN_FROM
        return (np.int64(bucket) << 32 | u[keep].astype(np.int64)), np.log2(c[keep]).astype(np.int32)

    found = _streamed(blocks, "bucket", count, "token long, level int",
                      pa.schema([("token", pa.int64()), ("level", pa.int32())]))
    top = found.orderBy(F.desc("level"), "token").limit(limit).toArrow()
    tokens, levels = top["token"].to_numpy(), top["level"].to_numpy()
    order = np.argsort(tokens)
    return tokens[order], levels[order].astype(np.int8)


def postings(docs: DataFrame, known, bits: int, width: int, percent: int) -> DataFrame:
    """Blocks of postings: the prefixes of the distinct classes of a slice under the first order."""
    import pyarrow as pa

    schema = pa.schema([("bucket", pa.int64()), ("block", pa.binary())])
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        names, levels = shared.value
        posts, size = [], 0
        for texts, _ in _texts(batches):
            done = set()
            for t in texts:
                s = shingles(t, width)
                c = class_of(s)
                if c in done or not len(s):
                    continue
                done.add(c)
                n = len(s)
                level = (s & np.uint64(1)).astype(np.uint32)  # 0: counted and rare, 1: not counted, then by frequency
                if len(names):
                    short = (s >> np.uint64(32 - bits)).astype(np.int64)
                    at = np.minimum(np.searchsorted(names, short), len(names) - 1)
                    known = (names[at] == short) & (level == 0)
                    level[known] = levels[at[known]] + 1
                place = level << np.uint32(26) | (s >> np.uint64(38)).astype(np.uint32)
                by = np.argsort(place, kind="stable")
                s, place = s[by], place[by]
                p = np.empty(prefix_size(n, percent), POSTING)
                p["token"], p["cls"], p["n"], p["pos"], p["last"] = s[:len(p)], c, n, np.arange(1, len(p) + 1), place[len(p) - 1]
                posts.append(p)
                size += len(p)
            if size >= POSTINGS_AT_ONCE:
                yield blocks(np.concatenate(posts))
                posts, size = [], 0
        if size:
            yield blocks(np.concatenate(posts))

    def blocks(p):
        got = [(k, c[0].tobytes()) for k, c in _by_bucket(p["token"], bits, [p])]
        return pa.RecordBatch.from_arrays([pa.array([g[i] for g in got], schema.types[i]) for i in range(2)], schema=schema)

    return docs.select("text").mapInArrow(run, "bucket long, block binary")


def _bounds(*same: np.ndarray) -> np.ndarray:
    """Start of every run of equal rows in sorted columns, and the end."""
    new = np.zeros(len(same[0]) + 1, bool)
    new[[0, -1]] = True
    for c in same:
        new[1:-1] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def size_bands(percent: int, most: int = 1 << 32) -> np.ndarray:
    """First sizes of bands, such that sets of similar enough sizes are in the same band or in neighbouring ones."""
    out = [1]
    while out[-1] < most:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out)


def meetings(blocks: DataFrame, bits: int, percent: int) -> DataFrame:
    """Classes that meet others of a fitting size: ``cls, n``, the place of the ``last`` token of the prefix in the order, the ``tokens``
    under which they meet others with their positions in the prefix, and the ``homes``."""
    import pyarrow as pa

    schema, bands = pa.schema([("bucket", pa.int64()), ("block", pa.binary())]), size_bands(percent)
    profile = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("last", pa.int64()), ("tokens", pa.binary()),
                         ("homes", pa.list_(pa.int64()))])

    def meet(_, rows):
        p = np.concatenate([np.frombuffer(x.as_py(), POSTING) for x in rows["block"]])
        p = p[np.lexsort((p["cls"], p["n"], p["token"]))]
        p = p[_bounds(p["token"], p["cls"])[:-1]]
        # a size band and the next one hold all partners of the band's classes: a list is cut into such pairs of bands
        band = np.searchsorted(bands, p["n"], side="right")
        row = np.concatenate([np.arange(len(p)), np.arange(len(p))])
        low = np.concatenate([band, band - 1])
        upper = np.arange(len(row)) >= len(p)
        by = np.lexsort((row, low, p["token"][row]))
        row, low, upper = row[by], low[by], upper[by]
        cut = _bounds(p["token"][row], low)
        size = np.diff(cut)
        keep = (size > 1) & ~upper[cut[:-1]]  # rows are by size, so a group without the lower band starts with the upper
        out = np.empty(len(row), MEETING)
        for name in ("cls", "n", "token", "pos", "last"):
            out[name] = p[name][row]
        out["home"] = np.repeat(p["cls"][row[cut[:-1]]], size)
        out = out[np.repeat(keep, size)]
        if not len(out):
            return None
        got = list(_by_bucket(mix(out["cls"].astype(np.uint64)), bits, [out]))
        return [k for k, _ in got], [c[0].tobytes() for _, c in got]

    def gather(_, rows):
        m = np.concatenate([np.frombuffer(x.as_py(), MEETING) for x in rows["block"]])
        m = m[np.lexsort((m["token"], m["cls"]))]
        parts = [m[a:z] for a, z in zip(*(lambda c: (c[:-1], c[1:]))(_bounds(m["cls"])))]
        shared = []
        for x in parts:
            x = x[_bounds(x["token"])[:-1]]
            t = np.empty(len(x), SHARED)
            t["token"], t["pos"] = x["token"], x["pos"]
            shared.append(t.tobytes())
        return ([int(x["cls"][0]) for x in parts], [int(x["n"][0]) for x in parts], [int(x["last"][0]) for x in parts], shared,
                [np.unique(x["home"]).tolist() for x in parts])

    met = _streamed(blocks, "bucket", meet, "bucket long, block binary", schema)
    return _streamed(met, "bucket", gather, "cls long, n long, last long, tokens binary, homes array<bigint>", profile)


_DENSE = 64


def _lists(tokens: np.ndarray, owner: np.ndarray):
    """Entries sorted by token, the starts of the tokens' lists, and which entries are in short lists."""
    order = np.lexsort((owner, tokens))
    cut = _bounds(tokens[order])
    size = np.diff(cut)
    return order, cut, size, np.repeat(size <= _DENSE, size)


def pair_counts(tokens: np.ndarray, owner: np.ndarray, rows: int, pos: np.ndarray | None = None):
    """Rows x rows matrix of the number of shared tokens. Tokens of many rows are counted by matrix products, a thousand at a time, the
    others by pairing the entries of each token's short list. With ``pos``, also the matrix of the greatest position in
    the row of a token that the column shares."""
    order, cut, size, few = _lists(tokens, owner)
    tokens, owner = tokens[order], owner[order].astype(np.int64)
    both = np.zeros(rows * rows, np.int32)
    reach = np.zeros((rows, rows), np.int32) if pos is not None else None
    t, o = tokens[few], owner[few]
    q = pos[order][few].astype(np.int32) if pos is not None else None
    for d in range(1, _DENSE):
        same = np.flatnonzero(t[d:] == t[:-d]) if len(t) > d else []
        if not len(same):
            break
        np.add.at(both, o[same] * rows + o[same + d], 1)
        if pos is not None:
            np.maximum.at(reach, (o[same], o[same + d]), q[same])
            np.maximum.at(reach, (o[same + d], o[same]), q[same + d])
    both = both.reshape(rows, rows)
    both += both.T
    column = np.repeat(np.cumsum(size > _DENSE) - 1, size)[~few]
    many = owner[~few]
    for first in range(0, int((size > _DENSE).sum()), 1024):
        sel = (column >= first) & (column < first + 1024)
        part = np.zeros((rows, 1024), np.float32)
        part[many[sel], column[sel] - first] = 1
        both += (part @ part.T).astype(np.int32)
    if pos is None:
        return both
    for k in np.flatnonzero(size > _DENSE):
        m, p = owner[cut[k]:cut[k + 1]], pos[order[cut[k]:cut[k + 1]]].astype(np.int32)
        at = np.ix_(m, m)
        reach[at] = np.maximum(reach[at], p[:, None])
    return both, reach


def pairs_that_fit(n: np.ndarray, visitor: np.ndarray, percent: int) -> np.ndarray:
    fits = 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
    np.fill_diagonal(fits, False)
    if visitor.any():
        fits &= visitor[:, None] != visitor
    return fits


def _tree(linked: np.ndarray):
    """Component of every row of a symmetric matrix of links, and links that connect each one."""
    comp = np.full(len(linked), -1)
    edges = []
    for i in range(len(linked)):
        if comp[i] < 0:
            comp[i] = i
            queue = [i]
            while queue:
                a = queue.pop()
                for b in np.flatnonzero(linked[a] & (comp < 0)).tolist():
                    comp[b] = i
                    edges.append((a, b))
                    queue.append(b)
    return comp, edges


def _owners(parts: list[np.ndarray]):
    return np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])


def prune(n: np.ndarray, last: np.ndarray, shared: list[np.ndarray], visitor: np.ndarray, percent: int) -> np.ndarray:
    """Number of the cluster of every class, by the pairs whose shared prefix tokens allow a link; -1: none.

    Say the prefix of ``a`` ends before that of ``b``. What ``a``'s prefix shares with ``b`` is then shared by the prefixes; beyond it ``a``
    has ``n_a - p_a`` tokens, and ``b`` has at most those after the last shared token. The overlap cannot exceed the sum.
    """
    fits = pairs_that_fit(n, visitor, percent)
    entries, owner = _owners(shared)
    both, reach = pair_counts(entries["token"], owner, len(n), entries["pos"])
    rest = n - prefix_size(n, percent)
    mine = np.minimum(rest[:, None], n - reach.T)  # if the row's prefix ends first
    bound = np.where(last[:, None] < last, mine, np.where(last[:, None] > last, mine.T, np.maximum(mine, mine.T)))
    least = -(-percent * (n[:, None] + n) // (100 + percent))  # of the overlap
    fits &= (both > 0) & (both + bound >= least)
    return np.where(fits.any(1), _tree(fits)[0], -1)


def verify(cls: np.ndarray, sets: list[np.ndarray], visitor: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that connect the classes of a group. If some are marked as visitors, only their pairs with others are asked."""
    n = np.array([len(s) for s in sets], np.int64)
    tokens, owner = _owners(sets)
    fits = pairs_that_fit(n, visitor, percent)
    for salt in _ORDERS:  # the prefixes under the other orders must meet as well
        place = np.lexsort((mix(tokens ^ salt), owner))
        rank = np.empty(len(owner), np.int64)
        rank[place] = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        pre = rank < prefix_size(n, percent)[owner]
        fits &= pair_counts(tokens[pre], owner[pre], len(n)) > 0
    if not fits.any():
        return []
    asked = np.flatnonzero(fits.any(1))
    place = np.full(len(n), -1)
    place[asked] = np.arange(len(asked))
    there = place[owner] >= 0
    both = pair_counts(tokens[there], place[owner[there]], len(asked)).astype(np.int64)
    m = n[asked]
    linked = fits[np.ix_(asked, asked)] & (100 * both >= percent * (m[:, None] + m - both))
    return [(int(cls[asked[a]]), int(cls[asked[b]])) for a, b in _tree(linked)[1]]


def _pack(tokens: np.ndarray) -> bytes:
    """Six bytes a token: 48 bits tell the tokens of a group apart."""
    return np.ascontiguousarray((tokens >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    raw = np.zeros((len(data) // 6, 8), np.uint8)
    raw[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return raw.reshape(-1).view("<u8")


def verify_groups(docs: DataFrame, visits: DataFrame, profiles: DataFrame, reps: DataFrame, width: int, percent: int) -> DataFrame:
    """``visits`` (``grp, cls, visitor``) -> links ``(src, dst)``. The classes that remain after ``prune`` have their texts read once and their sets
    sent to every cluster that they belong to."""
    import pyarrow as pa

    kept = pa.schema([("cluster", pa.int64()), ("cls", pa.int64()), ("visitor", pa.bool_())])
    sets = pa.schema([("cluster", pa.int64()), ("cls", pa.int64()), ("visitor", pa.bool_()), ("tokens", pa.binary())])

    def select(grp, rows):
        cls, visitor = rows["cls"].to_numpy(), rows["visitor"].to_numpy()
        part = prune(rows["n"].to_numpy(), rows["last"].to_numpy(), [np.frombuffer(x.as_py(), SHARED) for x in rows["tokens"]],
                     visitor, percent)
        keep = part >= 0
        name = mix(cls[part[keep]].astype(np.uint64) ^ mix(np.array([grp], np.int64).view(np.uint64))).view(np.int64)
        return name, cls[keep], visitor[keep]

    def emit(batches):
        for b in batches:
            for lo, hi, data, offsets in slices(b.column("text")):
                out = [], [], [], []
                places, cls = b.column("places").slice(lo, hi - lo).to_pylist(), b.column("cls").slice(lo, hi - lo)
                for i in range(hi - lo):
                    packed = _pack(shingles(data[offsets[i]:offsets[i + 1]], width))
                    for p in places[i]:
                        for column, value in zip(out, (p["cluster"], cls[i].as_py(), p["visitor"], packed)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, sets.types)], schema=sets)

    def check(_, rows):
        cls = rows["cls"].to_numpy()
        links = verify(cls, [_unpack(x.as_py()) for x in rows["tokens"]], rows["visitor"].to_numpy(), percent)
        return [a for a, _ in links], [b for _, b in links]

    rows = visits.join(profiles.select("cls", "n", "last", "tokens"), "cls")
    left = save(_streamed(rows, "grp", select, "cluster long, cls long, visitor boolean", kept, "cls"), "clusters")
    places = left.groupBy("cls").agg(F.collect_list(F.struct("cluster", "visitor")).alias("places"))
    wanted = places.join(reps, "cls").select("cls", "places", F.col("rep").alias("doc_id"))
    # the ids grow with the documents: a shuffle join at every size
    texts = docs.select("doc_id", "text").join(wanted.hint("shuffle_hash"), "doc_id")
    rows = texts.mapInArrow(emit, "cluster long, cls long, visitor boolean, tokens binary")
    return _streamed(rows, "cluster", check, "src long, dst long", pa.schema([("src", pa.int64()), ("dst", pa.int64())]), "cls")


def join_components(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, known_tokens: int = KNOWN_TOKENS,
                    block: int = BLOCK) -> DataFrame:
    """``docs`` (``doc_id, text``) -> ``doc_id, n_shingles, component_id`` (the least ``doc_id`` reachable over links)."""
    spark = docs.sparkSession
    bits = max(6, (4 * int(spark.conf.get("spark.sql.shuffle.partitions", "200"))).bit_length() - 1)
    scanned = save(scan(docs, bits, width), "shingles")
    with batches_of(spark, 400):  # rows are blocks
        known = known_frequencies(scanned.where("bucket is not null").select("bucket", "block"), bits, known_tokens)
    rows = scanned.where("bucket is null").select("doc_id", "n", "cls")
    reps = rows.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count("*").alias("docs"))
    with batches_of(spark, 400):
        profiles = save(meetings(postings(docs, known, bits, width, percent), bits, percent), "meetings")
    met = profiles.select("cls", F.explode("homes").alias("home"))
    sizes = met.groupBy("home").agg(F.ceil(F.count("*") / block).alias("parts"))
    groups = save(sizes, "groups")
    part = met.where("cls <> home").join(groups, "home").withColumn("p", F.pmod(F.xxhash64("cls", "home"), F.col("parts")))
    grp = F.xxhash64("home", "p")
    home = groups.select("home", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("p"))
    first = part.select(grp.alias("grp"), "cls").unionByName(home.select(grp.alias("grp"), F.col("home").alias("cls")))
    with batches_of(spark, 400):
        links = save(verify_groups(docs, first.withColumn("visitor", F.lit(False)), profiles, reps, width, percent), "links")
    large = part.where("parts > 1")
    if large.limit(1).count():
        # classes of split groups that did not reach the group's first class visit all of its parts
        label = connected(links).withColumnRenamed("node", "cls")
        roots = label.select(F.col("cls").alias("home"), F.col("component").alias("home_comp"))
        apart = large.join(label, "cls", "left").join(roots, "home", "left").where(
            ~F.coalesce(F.col("component") == F.col("home_comp"), F.lit(False))).select("home", "cls", "parts")
        apart = save(apart, "apart")
        tours = save(apart.groupBy("home").agg(F.ceil(F.count("*") / block).alias("tours")), "tours")
        apart = apart.join(tours, "home").withColumn("q", F.pmod(F.xxhash64("home", "cls"), F.col("tours")))
        grp = F.xxhash64("home", "p", "q")
        every = F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)
        tour = apart.select("home", "cls", "q", F.explode(every).alias("p")).select(
            grp.alias("grp"), "cls", F.lit(True).alias("visitor"))
        stay = large.join(tours, "home").select("home", "cls", "p", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("tours") - 1)).alias("q")).select(
            grp.alias("grp"), "cls", F.lit(False).alias("visitor"))
        # a class that visits its own part stays in it: it meets the other visitors there
        again = stay.unionByName(tour).groupBy("grp", "cls").agg(F.min("visitor").alias("visitor"))
        with batches_of(spark, 400):
            links = save(links.unionByName(verify_groups(docs, again, profiles, reps, width, percent)), "links")
    return name_components(rows, reps, connected(links))


def name_components(rows: DataFrame, reps: DataFrame, label: DataFrame) -> DataFrame:
    """Rows ``(doc_id, n, cls)``, classes ``(cls, rep, docs)`` and the components of linked classes ``(node, component)`` ->
    ``doc_id, n_shingles, component_id``. The least id is found among the classes and then handed to their documents, so
    neither a component of very many classes nor a class of very many copies is the key of one task."""
    linked = save(reps.join(label, reps["cls"] == label["node"]).select("cls", "rep", "docs", "component"), "linked")
    least = save(linked.groupBy("component").agg(F.min("rep").alias("least"), F.count("*").alias("classes")), "least")
    named = join_groups(linked, least, ["component"], "classes").select("cls", "docs", "least")
    alone = reps.join(label, reps["cls"] == label["node"], "left_anti").select("cls", "docs", F.col("rep").alias("least"))
    of_class = save(named.unionByName(alone), "class-names")
    found = join_groups(rows.where("n > 0"), of_class, ["cls"], "docs")
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id")).unionByName(
        rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))

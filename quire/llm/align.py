"""Operator 12: alignment of the tokens of two tokenizers by sparse incidence matrices.

The tokens of tokenizer A (byte-level BPE) and B (SentencePiece) of a text cover the same bytes. Token-byte incidence matrices in CSR form,
a row per token and a column per byte, are built by hand for a whole slice of texts at once; Gustavson's row product
``A x B^T`` holds for every pair of tokens that overlap the number of bytes they share (``overlap`` links). The pairs among them
whose byte ranges end together (``end`` links) are the places where both tokenizers cut: they split the text into groups, the least stretches
that hold whole tokens on both sides. Token-group incidence matrices follow; their product ``Ga x Gb^T`` holds the pairs of tokens of one
group (``group`` links), and their transposes list the tokens of every group.

A pair of ids may be linked very often, but there are few such pairs: of two tokens that end together the shorter one is a
suffix of the longer, so the number of pairs is at most the number of suffixes of all vocabulary entries that are
entries of the other vocabulary (``pair_bound``; some hundred thousand), whatever the corpus. So the corpus-wide counts are
combined in tasks, summed by a shuffle and broadcast.

Bounds: a slice is about a megabyte of text or one text; products are formed in blocks of rows (``BLOCK`` entries), group products are never
held whole.

Defined cases: null and empty texts, and texts whose pieces do not spell a blank and the text (a SentencePiece model
that normalises, characters without a piece), have no tokens; strings of special tokens are plain text; repeated rows get
equal results, and each counts in the corpus; a null id is carried; columns not named in ``keep`` are ignored, whatever their
names; an empty table gives no rows and no pairs; very long texts are held by one task each.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import UnitTable, kept, save, slices, worker_cache

BLOCK = 1 << 21


# --- sparse matrices --------------------------------------------------------------------------------------------

@dataclass
class CSR:
    """A sparse matrix: row ``i`` has the entries ``indptr[i]`` to ``indptr[i + 1]`` of ``indices`` (columns) and ``data``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    n_cols: int

    @property
    def n_rows(self) -> int:
        return len(self.indptr) - 1

    @classmethod
    def of_ranges(cls, starts: np.ndarray, ends: np.ndarray, n_cols: int) -> CSR:
        """Row ``i`` has a one in the columns ``starts[i]`` to ``ends[i] - 1``."""
        sizes = ends - starts
        indptr = np.concatenate([[0], np.cumsum(sizes)])
        indices = np.repeat(starts - indptr[:-1], sizes) + np.arange(indptr[-1])
        return cls(indptr, indices, np.ones(len(indices), np.int32), n_cols)

    @classmethod
    def of_labels(cls, labels: np.ndarray, n_cols: int) -> CSR:
        """Row ``i`` has a one in the column ``labels[i]``."""
        return cls(np.arange(len(labels) + 1), labels, np.ones(len(labels), np.int32), n_cols)

    def transpose(self) -> CSR:
        order = np.argsort(self.indices, kind="stable")
        rows = np.repeat(np.arange(self.n_rows), np.diff(self.indptr))
        indptr = np.concatenate([[0], np.cumsum(np.bincount(self.indices, minlength=self.n_cols))])
        return CSR(indptr, rows[order], self.data[order], self.n_rows)

    def row_sizes(self, other: CSR) -> np.ndarray:
        """Number of terms in every row of the product with ``other``."""
        width = np.diff(other.indptr)[self.indices]
        upto = np.concatenate([[0], np.cumsum(width)])
        return upto[self.indptr[1:]] - upto[self.indptr[:-1]]

    def product(self, other: CSR, block: int = BLOCK):
        """Gustavson's product: a row of the result is the sum of the rows of ``other`` that the row's entries name,
        weighted by them. Yields ``(rows, columns, values)`` for blocks of rows of about ``block`` terms."""
        terms = np.concatenate([[0], np.cumsum(self.row_sizes(other))])
        first = 0
        while first < self.n_rows:
            last = max(int(np.searchsorted(terms, terms[first] + block, side="right")) - 1, first + 1)
            at = slice(self.indptr[first], self.indptr[last])
            mid, weight = self.indices[at], self.data[at]
            row = np.repeat(np.arange(first, last), np.diff(self.indptr[first:last + 1]))
            width = other.indptr[mid + 1] - other.indptr[mid]
            before = np.cumsum(width) - width
            term = np.repeat(other.indptr[mid] - before, width) + np.arange(int(width.sum()))
            key = np.repeat(row, width) * np.int64(other.n_cols) + other.indices[term]
            value = np.repeat(weight, width) * other.data[term]
            if len(key):
                if (key[1:] < key[:-1]).any():  # the terms of a row come in order of the middle index, not of the column
                    order = np.argsort(key, kind="stable")
                    key, value = key[order], value[order]
                new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                key, value = key[new], np.add.reduceat(value, new)
                yield key // other.n_cols, key % other.n_cols, value
            first = last


# --- two tokenizers ---------------------------------------------------------------------------------------------

def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: visible Latin-1 characters for themselves, the other bytes in
    order for the characters from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return {chr(b): b for b in own} | {chr(0x100 + i): b for i, b in enumerate(sorted(set(range(256)) - set(own)))}


class Side:
    """Token bytes of one vocabulary, joined."""

    def __init__(self, entries: list[bytes]):
        self.entries = entries
        self.size = np.array([len(e) for e in entries], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(entries), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.size[ids]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.at[ids] - before, sizes) + np.arange(int(sizes.sum()))]


class Pair:
    """The two tokenizers of an alignment."""

    def __init__(self, bpe_path: str, piece_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.bpe = Tokenizer.from_file(bpe_path)
        self.bpe.encode_special_tokens = True
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        alphabet, vocab = byte_alphabet(), self.bpe.get_vocab()
        entries = [b""] * (max(vocab.values()) + 1)
        for text, i in vocab.items():
            entries[i] = bytes(alphabet[c] for c in text) if all(c in alphabet for c in text) else b""
        self.a = Side(entries)
        sp = self.pieces
        self.b = Side([bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else
                       b"" if sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i).replace("▁", " ").encode()
                       for i in range(sp.get_piece_size())])
        self.names_a, self.names_b = ([str(i) for i in range(len(s.entries))] for s in (self.a, self.b))
        self.units_a, self.units_b = UnitTable(self.bpe_units), UnitTable(self.piece_units)
        #: whether some piece has these two bytes next to each other: between others no merge ever happens
        self.joined = None
        model = model_of(piece_path)
        if model.normalizer_spec.name == "identity" and not model.normalizer_spec.remove_extra_whitespaces:
            model.normalizer_spec.add_dummy_prefix = False  # units begin with the blank that they have
            self.pieces = SentencePieceProcessor(model_proto=model.SerializeToString())
            self.joined = np.zeros((256, 256), bool)
            self.joined[:, 0x80:0xC0] = True  # inside a character
            for e in self.b.entries:
                raw = np.frombuffer(e, np.uint8)
                self.joined[raw[:-1], raw[1:]] = True

    def bpe_units(self, units: list[str]):
        got = []
        for at in range(0, len(units), 4000):
            got += [np.array(e.ids, np.int32) for e in self.bpe.encode_batch_fast(units[at:at + 4000], add_special_tokens=False)]
        return got, np.zeros((len(units), 0))

    def piece_units(self, units: list[str]):
        return [np.array(x, np.int32) for x in self.pieces.encode(units, num_threads=1)], np.zeros((len(units), 0))

    def pair_bound(self) -> int:
        """Most pairs of ids that can end together: pairs of entries of which one is a suffix of the other."""
        found = 0
        for x, y, equal in ((self.a, self.b, 1), (self.b, self.a, 0)):
            have: dict[bytes, int] = {}
            for e in x.entries:
                have[e] = have.get(e, 0) + 1
            found += sum(have.get(e[k:], 0) for e in y.entries if e for k in range(1 - equal, len(e)))
        return found

    def encode(self, texts: list[str], data: np.ndarray, offsets: np.ndarray):
        """Ids of both sides for the texts, whose bytes are ``data[offsets[i]:offsets[i + 1]]``, with the number of ids before each text.
        Texts that the tokens do not spell have none."""
        filled = np.diff(offsets) > 0
        text = np.insert(data, offsets[:-1][filled], 0x20)  # the blank before every text
        at = offsets + np.concatenate([[0], np.cumsum(filled)])
        both = [self.encode_bpe(text, at), self.encode_pieces(text, at, texts)]
        good = filled
        for side, (ids, upto) in zip((self.a, self.b), both):
            spelled = side.spell(ids)
            ends = np.concatenate([[0], np.cumsum(side.size[ids])])[upto]
            if not np.array_equal(ends, at) or not np.array_equal(spelled, text):
                good = good & [np.array_equal(spelled[ends[i]:ends[i + 1]], text[at[i]:at[i + 1]]) for i in range(len(texts))]
        if good.all():
            return both
        keep = [np.repeat(good, np.diff(upto)) for _, upto in both]
        return [(ids[k], np.concatenate([[0], np.cumsum(k)])[upto]) for (ids, upto), k in zip(both, keep)]

    def encode_bpe(self, text: np.ndarray, at: np.ndarray):
        """Ids of the texts ``text[at[i]:at[i + 1]]`` by the byte-level tokenizer, and the number before each. It always cuts before a single blank
        between two visible characters (ASCII or U+00C0 to U+00FF), between a letter and an ASCII mark, and between a mark other than the
        apostrophe and a letter, so distinct stretches between such places are encoded once."""
        if not len(text):
            return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        latin = text == 0xC3
        seen = (text > 0x20) & (text < 0x7F)
        cut = np.zeros(len(text), bool)
        cut[1:-1] = (text[1:-1] == 0x20) & (seen[2:] | latin[2:])
        cut[1:] &= seen[:-1] | np.concatenate([[False], latin[:-2]]) & (text[:-1] >= 0x80)
        letter = ((text | 0x20) >= 0x61) & ((text | 0x20) <= 0x7A)
        mark = seen & ~letter & ~((text >= 0x30) & (text <= 0x39))
        cut[1:] |= letter[:-1] & mark[1:] | (mark & (text != 0x27))[:-1] & letter[1:]
        cut[at[:-1][np.diff(at) > 0]] = True
        return by_units(self.units_a, text, cut, at)

    def encode_pieces(self, text: np.ndarray, at: np.ndarray, texts: list[str]):
        """The same by the SentencePiece model. It never joins two bytes that are neighbours in no piece; models with a normaliser get whole
        texts."""
        if self.joined is None:
            got = [np.array(x, np.int64) for x in self.pieces.encode(texts, num_threads=1)]
            return np.concatenate([np.zeros(0, np.int64), *got]), np.concatenate([[0], np.cumsum([len(x) for x in got])]).astype(np.int64)
        if not len(text):
            return np.zeros(0, np.int64), np.zeros(len(at), np.int64)
        cut = np.ones(len(text), bool)
        cut[1:] = ~self.joined[text[:-1], text[1:]]
        cut[at[:-1][np.diff(at) > 0]] = True
        return by_units(self.units_b, text, cut, at)


def by_units(units: UnitTable, text: np.ndarray, cut: np.ndarray, at: np.ndarray):
    starts = np.flatnonzero(cut)
    ids, upto = units.gather(units.find(text, starts, np.append(starts[1:], len(text))))
    return ids.astype(np.int64), upto[np.searchsorted(starts, at)]


def model_of(piece_path: str):
    """The contents of a SentencePiece model file."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(piece_path, "rb") as f:
        model.ParseFromString(f.read())
    return model


class Alignment:
    """The links of a slice of texts, given the sizes of their tokens in bytes; both sides cover the same bytes."""

    def __init__(self, sizes_a: np.ndarray, sizes_b: np.ndarray):
        ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        n = int(ends_a[-1]) if len(ends_a) else 0
        self.bytes_a = CSR.of_ranges(ends_a - sizes_a, ends_a, n)
        bytes_b = CSR.of_ranges(ends_b - sizes_b, ends_b, n)
        self.bytes_b = bytes_b.transpose()
        pairs = []
        for row, col, _ in self.bytes_a.product(self.bytes_b):
            both = ends_a[row] == ends_b[col]
            pairs.append((row[both], col[both]))
        none = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        #: tokens that end together, in order
        self.end_a, self.end_b = (np.concatenate(x) for x in zip(*(pairs or none)))
        cuts = ends_a[self.end_a]
        self.groups_a = CSR.of_labels(np.searchsorted(cuts, ends_a), len(cuts))
        self.groups_b = CSR.of_labels(np.searchsorted(cuts, ends_b), len(cuts)).transpose()

    def overlap_links(self):
        """Blocks of ``(token of A, token of B, shared bytes)``."""
        return self.bytes_a.product(self.bytes_b)

    def group_links(self):
        """Blocks of ``(token of A, token of B, 1)`` for tokens of one group."""
        return self.groups_a.product(self.groups_b)

    def group_sizes(self):
        """Tokens of A and of B in every group."""
        return np.diff(self.groups_a.transpose().indptr), np.diff(self.groups_b.indptr)


def pair_of(bpe_path: str, piece_path: str) -> Pair:
    return worker_cache(("align", bpe_path, piece_path), lambda: Pair(bpe_path, piece_path))


SLICE = 1 << 18


def _slices(batch, pair: Pair):
    """``(first row, last row, ids and offsets of A, of B)`` of the slices of a batch."""
    for lo, hi, data, offsets in slices(batch.column("text"), SLICE):
        texts = [t or "" for t in batch.column("text").slice(lo, hi - lo).to_pylist()]
        yield lo, hi, *pair.encode(texts, data, offsets)


_PARTS = ["a_ids", "b_ids", "a_sizes", "b_sizes"]


def align(docs: DataFrame, bpe_path: str, piece_path: str, keep: str = "doc_id long", packed: bool = False) -> DataFrame:
    """``docs`` -> carried columns, ``a_ids``, ``b_ids`` and the tokens of either side in every group, ``a_sizes`` and ``b_sizes``. The last
    tokens of a group are the ones that end together. ``packed``: the four are the bytes of 32-bit little-endian integers, which later tasks
    read without turning every number into a row's element."""
    import pyarrow as pa

    names = kept(keep)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = pair_of(bpe_path, piece_path)

        def column(values, at):
            if packed:
                return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer((at * 4).astype(np.int32)),
                                                                        pa.py_buffer(values.astype("<i4"))])
            return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(values.astype(np.int32)))

        for b in batches:
            for lo, hi, (a_ids, a_at), (b_ids, b_at) in _slices(b, pair):
                links = Alignment(pair.a.size[a_ids], pair.b.size[b_ids])
                n_a, n_b = links.group_sizes()
                groups = np.searchsorted(links.end_a, a_at)  # groups before each text
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, hi - lo) for c in names), column(a_ids, a_at), column(b_ids, b_at),
                     column(n_a, groups), column(n_b, groups)], names=[*names, *_PARTS])

    kind = "binary" if packed else "array<int>"
    return docs.select(*names, "text").mapInArrow(run, f"{keep}, " + ", ".join(f"{c} {kind}" for c in _PARTS))


def links(docs: DataFrame, bpe_path: str, piece_path: str, kind: str = "overlap", keep: str = "doc_id long") -> DataFrame:
    """A row per link: carried columns, ``a`` and ``b`` (number of the token in its text), ``a_id``, ``b_id``, ``weight``.

    ``kind``: ``overlap`` (weight: shared bytes), ``end`` (ranges that end together) or ``group`` (tokens of one group).
    """
    import pyarrow as pa

    if kind not in ("overlap", "end", "group"):
        raise ValueError(f"unknown kind of link: {kind}")
    names = kept(keep)

    def run(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        pair = pair_of(bpe_path, piece_path)
        for b in batches:
            for lo, hi, (a_ids, a_at), (b_ids, b_at) in _slices(b, pair):
                found = Alignment(pair.a.size[a_ids], pair.b.size[b_ids])
                for x, y, w in (found.overlap_links() if kind == "overlap" else found.group_links() if kind == "group" else
                                [(found.end_a, found.end_b, np.ones(len(found.end_a), np.int64))]):
                    doc = np.searchsorted(a_at, x, side="right") - 1
                    rows = pa.array(lo + doc)
                    yield pa.RecordBatch.from_arrays(
                        [*(b.column(c).take(rows) for c in names), pa.array(x - a_at[doc]), pa.array(y - b_at[doc]),
                         pa.array(a_ids[x].astype(np.int32)), pa.array(b_ids[y].astype(np.int32)), pa.array(w.astype(np.int64))],
                        names=[*names, "a", "b", "a_id", "b_id", "weight"])

    return docs.select(*names, "text").mapInArrow(run, f"{keep}, a long, b long, a_id int, b_id int, weight long")


# --- corpus-wide counts -----------------------------------------------------------------------------------------

def _lists(column):
    """Values and offsets (from 0) of a packed column."""
    raw, off = column.buffers()[2], np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return np.frombuffer(values.tobytes(), "<i4").astype(np.int64), (off - off[0]) // 4


def _end_pairs(batch):
    """Keys ``a_id * 2^32 + b_id`` of the end links of a batch of ``align``, and the number of links before each row."""
    (a_ids, a_at), (b_ids, b_at), (n_a, g_at), (n_b, _) = (_lists(batch.column(c)) for c in _PARTS)
    return (a_ids[np.cumsum(n_a) - 1] << 32) + b_ids[np.cumsum(n_b) - 1], g_at


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(a_id, b_id, n)``: how often the ids are linked at their ends in the whole packed table."""
    import pyarrow as pa

    def run(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            k, n = np.unique(_end_pairs(b)[0], return_counts=True)
            both, where = np.unique(np.concatenate([keys, k]), return_inverse=True)
            keys, counts = both, np.bincount(where, np.concatenate([counts, n]), len(both)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array((keys >> 32).astype(np.int32)), pa.array((keys & 0xFFFFFFFF).astype(np.int32)),
                                          pa.array(counts)], names=["a_id", "b_id", "n"])

    rows = aligned.select(*_PARTS).mapInArrow(run, "a_id int, b_id int, n long")
    return rows.groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def alignment_digest(docs: DataFrame, bpe_path: str, piece_path: str, keep: str = "doc_id long") -> DataFrame:
    """Align, count the pairs of the corpus, and describe every text by both: carried columns, ``n_a``, ``n_b``, ``n_groups``, ``n_links`` (end
    links), ``n_best`` (links whose pair is the most frequent of its B id, ties included), ``count_sum`` (over links),
    ``groups_sha256`` and ``n_shared`` (group links, counted by the sizes of their product's rows)."""
    import pyarrow as pa

    names = kept(keep)
    aligned = save(align(docs, bpe_path, piece_path, keep, packed=True), "aligned", compression="zstd")
    counts = pair_counts(aligned).toArrow()  # at most Pair.pair_bound() rows, whatever the corpus
    key = (counts.column("a_id").to_numpy().astype(np.int64) << 32) + counts.column("b_id").to_numpy()
    order = np.argsort(key)
    key, n = key[order], counts.column("n").to_numpy()[order]
    top = np.zeros(int((key & 0xFFFFFFFF).max()) + 1 if len(key) else 0, np.int64)
    np.maximum.at(top, key & 0xFFFFFFFF, n)
    known = docs.sparkSession.sparkContext.broadcast((key, n, n == top[key & 0xFFFFFFFF]))

    def run(batches):
        pair = pair_of(bpe_path, piece_path)
        key, n, best = known.value
        for b in batches:
            found, at = _end_pairs(b)
            where = np.searchsorted(key, found)
            total = np.concatenate([[0], np.cumsum(n[where])])
            bests = np.concatenate([[0], np.cumsum(best[where])])
            n_a, n_b = (_lists(b.column(c))[0] for c in ("a_sizes", "b_sizes"))
            shared = np.concatenate([[0], np.cumsum(n_a * n_b)])
            n_links = np.diff(at)
            hashes = [groups_sha256(pair, *row) for row in zip(*(_rows(b.column(c)) for c in _PARTS))]
            sizes = [np.diff(_lists(b.column(c))[1]) for c in ("a_ids", "b_ids")]
            numbers = [*sizes, n_links, n_links, np.diff(bests[at]), np.diff(total[at])]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in names), *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(hashes, pa.string()),
                 pa.array(np.diff(shared[at]).astype(np.int64))],
                names=[*names, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"])

    return aligned.mapInArrow(run, f"{keep}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                                   "groups_sha256 string, n_shared long")


def _rows(column):
    values, at = _lists(column)
    return [values[x:y] for x, y in zip(at[:-1].tolist(), at[1:].tolist())]


def groups_sha256(pair: Pair, a_ids, b_ids, n_a, n_b) -> str:
    """Hex digest of the groups, written ``a1,a2|b1;a3|b2,b3``; without tokens the empty string."""
    if not len(n_a):
        return ""
    marks_a, marks_b = np.zeros(len(a_ids), np.int8), np.zeros(len(b_ids), np.int8)
    marks_a[np.cumsum(n_a) - 1] = 1
    marks_b[np.cumsum(n_b) - 1] = 1
    texts = [pair.names_a[i] + ("|" if m else ",") for i, m in zip(a_ids.tolist(), marks_a.tolist())]
    others = [pair.names_b[i] + (";" if m else ",") for i, m in zip(b_ids.tolist(), marks_b.tolist())]
    # tokens of a group of A go before those of B: their places follow from the sizes before them
    out = np.empty(len(texts) + len(others), object)
    before_a, before_b = np.cumsum(n_a), np.cumsum(n_b)
    out[np.repeat(before_b - n_b, n_a) + np.arange(len(texts))] = texts
    out[np.repeat(before_a, n_b) + np.arange(len(others))] = others
    return hashlib.sha256("".join(out.tolist())[:-1].encode()).hexdigest()

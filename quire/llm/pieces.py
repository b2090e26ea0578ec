"""Operator 1: SentencePiece encoding and decoding with N-best segmentation.

A text's pieces form a lattice: an edge per piece of the model that matches at a character, and one edge per
character that is no piece, which stands for its bytes. A forward pass gives every position the best score of a
path from the start (Viterbi); these scores are exact heuristics for an A* search from the end, which therefore
yields complete segmentations in order of their score, best first, until ``n`` are found.

Most units only need their best segmentation and the distance to the second. These are found for many units at once: edges come from a
trie over bytes, walked from all characters together, and a forward pass takes the edges of all units that start at the same offset.

No edge crosses a place between two bytes that are neighbours in no piece. The lattice falls apart there, so a text
is cut into units, each distinct unit is searched once per worker, and the N best segmentations of a text are the N
best sums over its units: those only differ from the best one in the N - 1 units whose second segmentation is
closest to their first.

Scores are those of the model file (of a byte-pair model: minus the rank of the merge), added up; a character
without a piece scores 10 less than the worst piece. Equal scores: fewer pieces first, then the smaller ids compared
from the end; between texts' units, the earlier unit first.

Defined cases: null and empty text have no pieces and one segmentation; a blank is put before any other text, and
decoding removes it; white space is kept; bytes without a piece decode to themselves, so decoding returns the
text; control pieces are never produced from text; repeated rows get equal results; an empty table gives no rows; a null
``doc_id`` is carried like any; columns that ``keep`` does not name are ignored, whatever they are called. A very long text is one
row of one task; its memory grows with its length.
"""

from __future__ import annotations

import heapq
import zlib
from itertools import count

import numpy as np
from pyspark.sql import DataFrame

from quire.llm.common import UnitTable, kept, slices, worker_cache

_UNKNOWN_PENALTY = 10.0
#: Bytes of a unit beyond which it is searched on its own, and of units that are searched at once.
_LONG, _TOGETHER = 256, 1 << 18


class Step:
    """A piece of a partial segmentation, found from the end of the text: ``after`` is the next piece of the text, ``jump`` one farther on
    (skew-binary pointers), so that two steps are compared in logarithmic time. The step of depth 0 stands for the end."""

    __slots__ = ("after", "jump", "id", "depth")

    def __init__(self, after: Step | None = None, id: int = -1):
        self.after, self.id = after or self, id
        self.depth = after.depth + 1 if after else 0
        far = after.jump if after else self
        self.jump = self if after is None else far.jump if after.depth - far.depth == far.depth - far.jump.depth else after

    def up(self, depth: int) -> Step:
        at = self
        while at.depth > depth:
            at = at.jump if at.jump.depth >= depth else at.after
        return at

    def __lt__(self, other: Step) -> bool:
        """Order of the ids compared from the end of the text: decided next to the last piece that both share."""
        depth = min(self.depth, other.depth)
        x, y = self.up(depth), other.up(depth)
        if x is y:
            return self.depth < other.depth
        while x.after is not y.after:
            x, y = (x.jump, y.jump) if x.jump is not y.jump else (x.after, y.after)
        return x.id < y.id if x.id != y.id else self.depth < other.depth

    def ids(self) -> tuple[int, ...]:
        out, at = [], self
        while at.depth:
            out.append(at.id)
            at = at.after
        return tuple(out)


class PieceLattice:
    """N-best segmentation over the pieces of a SentencePiece model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        self.size = sp.get_piece_size()
        self.ids: dict[str, int] = {}
        self.byte_id: dict[int, int] = {}
        self.bytes: list[bytes] = []
        for i in range(self.size):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes.append(bytes([int(piece[3:-1], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes.append(b"")
            else:
                text = piece.replace("▁", " ")
                self.ids[text] = i
                self.bytes.append(text.encode())
        self.score = {t: sp.get_score(i) for t, i in self.ids.items()}
        self.unknown = min(self.score.values()) - _UNKNOWN_PENALTY
        #: every beginning of a piece -> its (score, id), or None where it is only a beginning
        self.trie = {t[:k]: None for t in self.ids for k in range(1, len(t))} | {
            t: (self.score[t], i) for t, i in self.ids.items()}
        self.joined = np.zeros((256, 256), bool)
        self.joined[:, 0x80:0xC0] = True  # inside a character
        for t in self.ids:
            b = np.frombuffer(t.encode(), np.uint8)
            self.joined[b[:-1], b[1:]] = True
        self.byte_ids = np.array([self.byte_id.get(b, -1) for b in range(256)], np.int32)
        node, step = {b"": 0}, []
        for t in self.ids:
            raw = t.encode()
            for k in range(len(raw)):
                if raw[:k + 1] not in node:
                    node[raw[:k + 1]] = len(node)
                    step.append((node[raw[:k]] * 256 + raw[k], node[raw[:k + 1]]))
        #: the trie over bytes: ``node * 256 + byte`` -> next node, and the piece that ends at a node (-1: none)
        self.step_from, self.step_to = np.array([*sorted(step), (np.iinfo(np.int64).max, 0)], np.int64).T.copy()
        self.piece_of = np.full(len(node), -1, np.int32)
        self.piece_of[[node[t.encode()] for t in self.ids]] = list(self.ids.values())
        self.scores = np.zeros(self.size)
        self.scores[list(self.ids.values())] = list(self.score.values())

    def edges_into(self, unit: str):
        """Forward pass: per position the edges ``(score, start, id)`` that end there, the best score and the least
        number of pieces with it. The id of a character without a piece is -1."""
        n, trie = len(unit), self.trie
        best, pieces, into = [-1e300] * (n + 1), [0] * (n + 1), [[] for _ in range(n + 1)]
        best[0] = 0.0
        for a in range(n):
            z, here, p = a + 1, best[a], pieces[a] + 1
            hit = trie.get(unit[a:z], 0)
            more = hit != 0
            if not hit:
                hit = self.unknown, -1
                p += len(unit[a].encode()) - 1
            while True:
                if hit:
                    s = here + hit[0]
                    into[z].append((hit[0], a, hit[1]))
                    if s > best[z] or s == best[z] and p < pieces[z]:
                        best[z], pieces[z] = s, p
                z += 1
                if not more or z > n:
                    break
                p = pieces[a] + 1
                hit = trie.get(unit[a:z], 0)
                if hit == 0:
                    break
        return into, best, pieces

    def nbest(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best segmentations as (score, ids), best first; fewer if there are no more. A character without a
        piece appears as its byte pieces."""
        if not unit:
            return [(0.0, ())]
        into, best, pieces = self.edges_into(unit)
        end, found, order = len(unit), [], count()
        heap = [(-best[end], pieces[end], Step(), next(order), end, 0.0)]
        while heap and len(found) < n:
            neg, _, step, _, at, tail = heapq.heappop(heap)
            if at == 0:
                found.append((-neg, step.ids()))
                continue
            for s, a, i in into[at]:
                t, part = tail + s, step
                for i in (i,) if i >= 0 else [self.byte_id[b] for b in reversed(unit[a:at].encode())]:
                    part = Step(part, i)
                heapq.heappush(heap, (-(best[a] + t), pieces[a] + part.depth, part, next(order), a, t))
        return found

    def edges_of(self, data: np.ndarray, ends: np.ndarray):
        """Edges of all units, the bytes of which end at ``ends`` in ``data`` (UTF-8): start and end as byte offsets, id and score. A
        character without a piece is an edge per byte, the first of which has its score."""
        lead = (data & 0xC0) != 0x80
        width = 1 + (data >= 0xC0) + (data >= 0xE0) + (data >= 0xF0)
        limit = np.repeat(ends, np.diff(ends, prepend=0))
        known = np.zeros(len(data), bool)
        at, out = np.flatnonzero(lead), []
        node, depth = np.zeros(len(at), np.int64), 0
        while len(at):
            step = node * 256 + data[at + depth]
            found = np.searchsorted(self.step_from, step)
            ok = self.step_from[found] == step
            at, node, depth = at[ok], self.step_to[found[ok]], depth + 1
            piece = self.piece_of[node]
            hit = piece >= 0
            start, piece = at[hit], piece[hit]
            known[start[width[start] == depth]] = True
            out.append((start, start + depth, piece, self.scores[piece]))
            more = at + depth < limit[at]
            at, node = at[more], node[more]
        bare = np.flatnonzero(~known[lead][np.cumsum(lead) - 1])
        ids = self.byte_ids[data[bare]]
        if (ids < 0).any():
            raise KeyError(int(data[bare[ids < 0][0]]))
        out.append((bare, bare + 1, ids, np.where(lead[bare], self.unknown, 0.0)))
        return tuple(map(np.concatenate, zip(*out)))

    def best_of(self, units: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of the best segmentation of each unit, as ``nbest`` orders them, with its score and the distance to the second (infinite if
        there is none). No two edges from one place of a unit end at the same place, so the edges from one offset in
        all units are taken at once."""
        raw = [u.encode() for u in units]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        start, end, ids, scores = self.edges_of(np.frombuffer(b"".join(raw), np.uint8), ends)
        unit = np.repeat(np.arange(len(raw)), sizes)[start]
        offset = start - (ends - sizes)[unit]
        order = np.argsort(offset.astype(np.int32), kind="stable")
        # a place between bytes per unit: one more than bytes
        start, end, ids, scores = (start + unit)[order], (end + unit)[order], ids[order], scores[order]
        rounds = np.searchsorted(offset[order], np.arange(int(sizes.max(initial=0)) + 1)).tolist()
        last_place = ends + np.arange(len(raw))
        n = int(last_place[-1]) + 1
        best, second = np.full(n, -np.inf), np.full(n, -np.inf)
        pieces, last_id, by = np.zeros(n, np.int64), np.zeros(n, np.int32), np.full(n, -1)
        best[last_place - sizes] = 0.0
        for lo, hi in zip(rounds, rounds[1:]):
            a, z, i = start[lo:hi], end[lo:hi], ids[lo:hi]
            score, other, p = best[a] + scores[lo:hi], second[a] + scores[lo:hi], pieces[a] + 1
            had, had_p = best[z], pieces[z]
            better = (score > had) | (score == had) & ((p < had_p) | (p == had_p) & (i < last_id[z]))
            second[z] = np.where(better, np.maximum(had, other), np.maximum(second[z], score))
            to = z[better]
            best[to], pieces[to], last_id[to] = score[better], p[better], i[better]
            by[to] = np.flatnonzero(better) + lo
        upto = np.cumsum(pieces[last_place])
        flat = np.empty(int(upto[-1]), np.int32)
        place, at = last_place, upto
        while True:  # a piece of every unit, from the end
            more = by[place] >= 0
            place, at = place[more], at[more] - 1
            if not len(place):
                break
            flat[at] = last_id[place]
            place = start[by[place]]
        before = upto - pieces[last_place]
        return [flat[a:z] for a, z in zip(before.tolist(), upto.tolist())], np.stack([best[last_place], best[last_place] - second[last_place]], 1)


class PieceEncoder:
    """Encodes slices of texts; each distinct unit is searched once."""

    def __init__(self, path: str):
        self.lattice = PieceLattice(path)
        self.table = UnitTable(self.search, values=2)
        pieces = self.lattice.bytes
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)
        self.piece_size = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = np.cumsum(self.piece_size) - self.piece_size

    def search(self, units: list[str]):
        """Best ids of each unit, with its score and the distance to the second segmentation."""
        ids, values = [None] * len(units), np.empty((len(units), 2))
        together, total = [], 0

        def search_together():
            if together:
                got, values[together] = self.lattice.best_of([units[k] for k in together])
                for k, x in zip(together, got):
                    ids[k] = x
                together.clear()

        for k, u in enumerate(units):
            size = len(u.encode())
            if size > _LONG:  # as many passes as its bytes would each be over few units
                got = self.lattice.nbest(u, 2)
                ids[k] = np.array(got[0][1], np.int32)
                values[k] = got[0][0], (got[0][0] - got[1][0] if len(got) > 1 else np.inf)
                continue
            if total + size > _TOGETHER:
                search_together()
                total = 0
            together.append(k)
            total += size
        search_together()
        return ids, values

    def encode(self, data: np.ndarray, offsets: np.ndarray, n: int):
        """Texts ``data[offsets[i]:offsets[i + 1]]`` -> ids of their best segmentations, number of ids before each
        text, and per text the list of the ``n`` best as (score, ids)."""
        sizes = np.diff(offsets)
        filled = np.flatnonzero(sizes > 0)
        text = np.insert(data, offsets[filled], 0x20)  # the blank before every text
        at = offsets + np.concatenate([[0], np.cumsum(sizes > 0)])
        cut = np.ones(len(text) + 1, bool)
        cut[1:-1] = ~self.lattice.joined[text[:-1], text[1:]]
        cut[at] = True
        edges = np.flatnonzero(cut)
        starts, ends = edges[:-1], edges[1:]
        rows = self.table.find(text, starts, ends) if len(text) else np.zeros(0, np.int64)
        ids, upto = self.table.gather(rows)
        first = np.searchsorted(starts, at)
        value = self.table.value[rows]
        return ids, upto[first], [
            self.document(text, starts, ends, upto, ids, value, int(first[i]), int(first[i + 1]), n)
            for i in range(len(sizes))]

    def document(self, text, starts, ends, upto, ids, value, a: int, z: int, n: int):
        """The ``n`` best segmentations of one text from those of its units ``a`` to ``z``."""
        total = float(value[a:z, 0].sum())
        best = ids[upto[a]:upto[z]]
        if n == 1 or a == z:
            return [(total, best)]
        gaps = value[a:z, 1]
        near = np.argpartition(gaps, n - 2)[:n - 1] if len(gaps) > n - 1 else np.arange(len(gaps))
        if len(gaps) > n - 1:  # units as close as the farthest one taken: the earlier ones
            limit = gaps[near].max()
            near = np.concatenate([np.flatnonzero(gaps < limit), np.flatnonzero(gaps == limit)])[:n - 1]
        near = np.sort(near[np.isfinite(gaps[near])])
        options = []
        for u in near.tolist():
            got = self.lattice.nbest(text[starts[a + u]:ends[a + u]].tobytes().decode("utf-8", "replace"), n)
            options.append([(got[0][0] - s, x) for s, x in got])
        choices = [(0.0, ())]
        for o in options:  # sums of the units so far; equal sums: fewer changes, then earlier ones
            choices = sorted(((d + x[0], (*c, k)) for d, c in choices for k, x in enumerate(o)),
                             key=lambda t: (t[0], sum(map(bool, t[1])), tuple(-k for k in t[1])))[:n]
        out = []
        for d, c in choices[:n]:
            parts, at = [], upto[a]
            for u, k, o in zip(near.tolist(), c, options):
                if k:
                    parts += [ids[at:upto[a + u]], np.array(o[k][1], np.int32)]
                    at = upto[a + u + 1]
            out.append((total - d, np.concatenate([*parts, ids[at:upto[z]]]) if parts else best))
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of the pieces in order, with the leading blank of each text still in place."""
        sizes = self.piece_size[ids]
        before = np.cumsum(sizes) - sizes
        return self.piece_bytes[np.repeat(self.piece_at[ids] - before, sizes) + np.arange(int(sizes.sum()))]


def encoder(path: str) -> PieceEncoder:
    return worker_cache(("pieces", path), lambda: PieceEncoder(path))


def encode(docs: DataFrame, model_path: str, n: int = 2, keep: str = "doc_id long") -> DataFrame:
    """``docs`` -> carried columns, ``ids`` and ``score`` of the best segmentation, ``others``: the next ones as an array of
    (score, ids), best first, and ``decoded``: whether every one of the ``n`` decodes to the text again."""
    import pyarrow as pa

    names = kept(keep)
    more = pa.list_(pa.struct([("score", pa.float64()), ("ids", pa.list_(pa.int32()))]))

    def run(batches):
        enc = encoder(model_path)
        for b in batches:
            for lo, hi, data, offsets in slices(b.column("text")):
                ids, upto, got = enc.encode(data, offsets, n)
                lists = pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(ids.astype(np.int32)))
                rows = [[{"score": s, "ids": x} for s, x in best[1:]] for best in got]
                same = [all(np.array_equal(enc.decode(x)[1:], data[offsets[i]:offsets[i + 1]]) for _, x in best)
                        for i, best in enumerate(got)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, hi - lo) for c in names), lists, pa.array([best[0][0] for best in got], pa.float64()),
                     pa.array(rows, more), pa.array(same, pa.bool_())], names=[*names, "ids", "score", "others", "decoded"])

    return docs.select(*names, "text").mapInArrow(
        run, f"{keep}, ids array<int>, score double, others array<struct<score:double, ids:array<int>>>, decoded boolean")


def decode(tokens: DataFrame, model_path: str, ids: str = "ids", keep: str = "doc_id long") -> DataFrame:
    """``ids`` -> carried columns and ``text``. Null ids give null."""
    import pyarrow as pa

    names = kept(keep)

    def run(batches):
        enc = encoder(model_path)
        for b in batches:
            texts = [None if x is None else enc.decode(np.array(x, np.int64))[1:].tobytes().decode("utf-8", "replace")
                     for x in b.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(texts, pa.string())],
                                             names=[*names, "text"])

    return tokens.select(*names, ids).mapInArrow(run, f"{keep}, text string")


def digest(docs: DataFrame, model_path: str, n: int = 2, keep: str = "doc_id long") -> DataFrame:
    """Encode, then decode what was encoded: per document ``n_tokens``, ``ids_crc32`` (ids as little-endian 32-bit
    integers), ``scores`` of the ``n`` best segmentations, ``second_crc32`` (ids of the second one, null if there is
    none) and ``decoded`` (whether every one of them decodes to the text)."""
    import pyarrow as pa

    names = kept(keep)

    def run(batches):
        enc = encoder(model_path)
        for b in batches:
            for lo, hi, data, offsets in slices(b.column("text")):
                _, _, got = enc.encode(data, offsets, n)
                n_tokens, crc, second, scores, same = [], [], [], [], []
                for i, best in enumerate(got):
                    n_tokens.append(len(best[0][1]))
                    codes = [zlib.crc32(x.astype("<u4").tobytes()) for _, x in best[:2]]
                    crc.append(codes[0])
                    second.append(codes[1] if len(codes) > 1 else None)
                    scores.append([s for s, _ in best])
                    raw = data[offsets[i]:offsets[i + 1]]
                    same.append(all(np.array_equal(enc.decode(x)[1:], raw) for _, x in best))
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c).slice(lo, hi - lo) for c in names), pa.array(n_tokens, pa.int64()),
                     pa.array(crc, pa.int64()), pa.array(scores, pa.list_(pa.float64())), pa.array(second, pa.int64()),
                     pa.array(same, pa.bool_())],
                    names=[*names, "n_tokens", "ids_crc32", "scores", "second_crc32", "decoded"])

    return docs.select(*names, "text").mapInArrow(
        run, f"{keep}, n_tokens long, ids_crc32 long, scores array<double>, second_crc32 long, decoded boolean")

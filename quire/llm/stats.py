"""Statistics of whole texts, computed on their UTF-8 bytes (white space and symbols are single bytes there).

Null text is empty and has zeros; an empty table gives no rows; the carried columns may be null.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from quire.llm.common import RangeHash, byte_symbols, kept, text_bytes, word_bounds

#: Statistics of a text; all are counts. ``n_repeat_words``: words inside 8-word windows that occur twice or more,
#: first occurrence included; ``n_stutter``: words equal to the one before; ``n_dup_lines``: lines with a word that equal an earlier line.
STATS = ("n_chars", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
         "n_distinct_words", "n_stutter", "n_upper", "n_lower", "n_digits", "n_marks", "n_bang", "n_pipe", "n_stops", "max_word")
REPEAT_WINDOW = 8
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)


def repeated_cover(hashes: np.ndarray, width: int, n: int) -> int:
    """Number of the ``n`` positions covered by windows of ``width`` whose hash occurs twice or more."""
    if not len(hashes):
        return 0
    _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def text_stats(data: np.ndarray) -> list[int]:
    if not len(data):
        return [0] * len(STATS)
    hist = np.bincount(data, minlength=256)
    starts, ends = word_bounds(data)
    n = len(starts)
    n_chars = len(data) - int(hist[128:192].sum())
    space = int(hist[0x20] + hist[9:14].sum())
    symbols = byte_symbols(data)
    prefix = RangeHash(symbols)
    words = prefix.of(starts, ends)
    grams = RangeHash(words, 1)
    at = np.arange(max(0, n - REPEAT_WINDOW + 1))
    repeats = repeated_cover(grams.of(at, at + REPEAT_WINDOW), REPEAT_WINDOW, n)
    cuts = np.flatnonzero(data == 10)
    line_start = np.concatenate([[0], cuts + 1])
    line_end = np.concatenate([cuts, [len(data)]])
    with_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    lines = prefix.of(line_start[with_word], line_end[with_word])
    return [n_chars, n, n_chars - space, int(hist[_SYMBOLS].sum()), len(lines), len(lines) - len(np.unique(lines)),
            repeats, len(np.unique(words)), int((words[1:] == words[:-1]).sum()), int(hist[65:91].sum()), int(hist[97:123].sum()), int(hist[48:58].sum()),
            int(hist[33:48].sum() + hist[58:65].sum() + hist[91:97].sum() + hist[123:127].sum()),
            int(hist[33]), int(hist[124]), int(hist[46]), int((ends - starts).max()) if n else 0]


def with_stats(docs: DataFrame, keep: str = "doc_id long", text: str = "text") -> DataFrame:
    """``docs`` with one column per statistic of ``text``; ``keep`` lists the columns (with types) to carry. Null text is
    empty; all statistics of a text without words other than its characters are 0."""
    import pyarrow as pa

    names = kept(keep)

    def run(batches):
        for b in batches:
            rows = np.array([text_stats(t) for t in text_bytes(b.column(text))], np.int64).reshape(-1, len(STATS))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array(rows[:, i]) for i in range(len(STATS))],
                names=[*names, *STATS])

    return docs.select(*dict.fromkeys([*names, text])).mapInArrow(run, ", ".join([keep, *(f"{s} long" for s in STATS)]))

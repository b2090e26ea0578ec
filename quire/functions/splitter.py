"""C4 separator form: chunks that end at the best separator, as column expressions.

The text is read as atoms: a run of up to half a part of non-blank characters with the blanks after it. An atom's end is
a boundary of level 0 (blank line), 1 (line), 2 (sentence), 3 (word). A part holds at most ``size - overlap`` characters;
when the next atom does not fit, it ends at the last boundary of the lowest level found in its second half (or
where the atoms end, if there is none there) and what follows that boundary opens the next part. A chunk is a part with
the ``overlap`` characters before it; chunks without other characters than white space are dropped.

One fold over the atoms, as for the byte-bounded chunks: it carries offsets, the last boundary of each level and the list of
cuts. Null text has no chunks.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quire.functions.text import strip

LEVELS = 4


def atom_pattern(size: int, overlap: int) -> str:
    most = max(1, (size - overlap) // 2)
    return f"[^ \\n]{{1,{most}}}[ \\n]{{0,{most}}}|[ \\n]{{1,{most}}}"


def _with_level(atom: Column) -> Column:
    level = (F.when(F.contains(atom, F.lit("\n\n")), 0).when(F.contains(atom, F.lit("\n")), 1)
             .when(atom.rlike("[.!?] +$"), 2).otherwise(3))
    return F.struct(F.length(atom).alias("n"), level.alias("level"))


def split_cuts(text: Column, size: int, overlap: int) -> Column:
    """Ends of the parts but the last, ascending (``array<int>``)."""
    part = size - overlap
    atoms = F.transform(F.regexp_extract_all(text, F.lit(f"({atom_pattern(size, overlap)})"), 1), _with_level)
    zero = F.struct(F.lit(0).alias("start"), F.lit(0).alias("at"), *[F.lit(-1).alias(f"b{i}") for i in range(LEVELS)],
                    F.array().cast("array<int>").alias("cuts"))

    def step(acc, a):
        end = acc["at"] + a["n"]
        full = (end - acc["start"] > part) & (acc["at"] > acc["start"])
        best = acc["at"]
        for i in reversed(range(LEVELS)):
            best = F.when(acc[f"b{i}"] >= acc["start"] + part // 2, acc[f"b{i}"]).otherwise(best)
        again = full & (end - best > part) & (acc["at"] > best)
        return F.struct(
            F.when(again, acc["at"]).when(full, best).otherwise(acc["start"]).alias("start"), end.alias("at"),
            *[F.when(a["level"] == i, end).otherwise(acc[f"b{i}"]).alias(f"b{i}") for i in range(LEVELS)],
            F.when(again, F.concat(acc["cuts"], F.array(best, acc["at"]))).when(full, F.concat(acc["cuts"], F.array(best)))
            .otherwise(acc["cuts"]).alias("cuts"))

    return F.aggregate(atoms, zero, step)["cuts"]


def split_text_separators(text: Column, size: int = 1000, overlap: int = 200) -> Column:
    """``array<string>`` of the chunks of a text."""
    if not 0 <= overlap < size:
        raise ValueError("need 0 <= overlap < size")

    def chunks(ends):
        def chunk(end, i):
            begin = F.when(i > 0, F.greatest(F.get(ends, i - 1) - overlap, F.lit(0))).otherwise(0)
            return strip(F.substring(text, begin + 1, end - begin))

        return F.filter(F.transform(ends, chunk), lambda c: c != "")

    ends = F.concat(split_cuts(text, size, overlap), F.array(F.length(text)))
    return F.when(text.isNotNull(), F.element_at(F.transform(F.array(ends), chunks), 1)).otherwise(
        F.array().cast("array<string>"))

"""Redaction boxes over the block graph (J4) and their pixel rectangles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Up to so many strings a document's lines are tried in the row, string by string; beyond, by an automaton.
FEW_STRINGS = 32
#: Positions of blocks that one task searches with a document's automaton.
BLOCK_LINES = 4_096
#: Strings of one automaton; a document with more has several, one after the other.
AUTOMATON_STRINGS = 16_384


def _lines_with_any(strings_at_once: int):
    """Per (document, run of lines): the lines that contain any string of the document, in one pass over each line."""
    import pyarrow as pa

    def run(lines, strings):
        import ahocorasick

        found = [False] * lines.num_rows
        patterns = strings.column("pii")[0].as_py() if strings.num_rows else []
        texts = lines.column("low").to_pylist()
        for i in range(0, len(patterns), strings_at_once):
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for p in patterns[i:i + strings_at_once]:
                automaton.add_word(p)
            automaton.make_automaton()
            for j, text in enumerate(texts):
                found[j] = found[j] or next(automaton.iter(text), None) is not None
        return lines.filter(pa.array(found, pa.bool_())).drop_columns(["low", "run"])

    return run


def redaction_boxes(blocks: DataFrame, pii: DataFrame, few: int = FEW_STRINGS, block_lines: int = BLOCK_LINES,
                    strings_at_once: int = AUTOMATON_STRINGS) -> DataFrame:
    """WORD or LINE blocks with geometry whose lower-cased text contains any PII string of the document.

    PII strings ``(doc_id, text)`` are first grouped per document into a distinct, lower-cased array (empty
    strings dropped — they would match everything). A document of at most ``few`` strings is joined on ``doc_id`` alone: one row per
    block, no block x PII pairs. The lines of a document with more are cut into runs of ``block_lines`` positions; each run meets the
    strings once, as an automaton that reads every line in one pass, so the work grows with lines plus strings. Each block is
    emitted once; the three numbers change the plan, never the result.
    """
    strings = (pii.select("doc_id", F.lower("text").alias("p")).where(F.col("p") != "")
               .groupBy("doc_id").agg(F.array_distinct(F.collect_list("p")).alias("pii")))
    lines = blocks.where(F.col("block_type").isin("WORD", "LINE") & F.col("bbox").isNotNull()).select(
        "doc_id", "ord", F.col("bbox.Left").alias("left"), F.col("bbox.Top").alias("top"),
        F.col("bbox.Width").alias("width"), F.col("bbox.Height").alias("height"),
        F.coalesce("text", F.lit("")).alias("text"))
    low = F.lower("text")
    in_row = lines.join(strings.where(F.size("pii") <= few), "doc_id").where(
        F.exists("pii", lambda p: F.instr(low, p) > 0)).drop("pii")
    many = strings.where(F.size("pii") > few)
    run = F.floor(F.col("ord") / block_lines).alias("run")
    long_docs = lines.join(many.select("doc_id"), "doc_id", "left_semi").select("*", low.alias("low"), run)
    runs = blocks.select("doc_id", run).distinct()
    keyed = many.join(runs, "doc_id")
    schema = lines.schema
    by_automaton = long_docs.groupBy("doc_id", "run").cogroup(keyed.groupBy("doc_id", "run")).applyInArrow(
        _lines_with_any(strings_at_once), schema)
    return in_row.unionByName(by_automaton)


def box_to_pixels(boxes: DataFrame, width: int, height: int) -> DataFrame:
    """Pixel rectangle of a page-fraction box; each term is truncated separately, so
    ``right = int(left * w) + int(width * w)`` (not ``int((left + width) * w)``)."""
    lx = (F.col("left") * width).cast("int")
    ty = (F.col("top") * height).cast("int")
    return boxes.select("*", lx.alias("x0"), ty.alias("y0"),
                        (lx + (F.col("width") * width).cast("int")).alias("x1"),
                        (ty + (F.col("height") * height).cast("int")).alias("y1"))

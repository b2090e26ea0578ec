"""Block-graph sources (S5, S6): OCR responses -> a flat block node table and an edge table.

A response is one JSON document per input document. Parsing uses an explicit schema and ``posexplode`` so every
block keeps ``ord``, its position in the response, which decides every "first"/"last" rule downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from quire.functions.arrays import bind, explode_rows
from quire.schemas import BLOCK_RESPONSE
from quire.session import materialize

BLOCK_COLUMNS = ["doc_id", "ord", "block_type", "id", "text", "confidence", "row_index", "col_index",
                 "selection_status", "entity_types", "query_text", "query_alias", "relationships", "bbox", "dup_ids"]


#: Responses of at most so many bytes have their references followed in their row, where an id is found by a scan of the response's
#: ids; in longer ones, where scans would cost the square of the blocks, by joins.
IN_ROW_BYTES = 32_768


def _dup_ids(blocks_arr) -> "F.Column":
    """True when a response repeats a block Id (checked in the response row: a hash-based distinct, linear)."""
    ids = F.filter(F.transform(F.coalesce(blocks_arr, F.array()), lambda b: b["Id"]), lambda i: i.isNotNull())
    return bind(ids, lambda i: F.size(F.array_distinct(i)) < F.size(i))


def _starts(block) -> Column:
    """Whether a decoder starts at this block: a TABLE, a QUERY, a KEY."""
    return F.coalesce(block["BlockType"].isin("TABLE", "QUERY") | ((block["BlockType"] == "KEY_VALUE_SET") & F.array_contains(
        F.coalesce(block["EntityTypes"], F.array()), "KEY")), F.lit(False))


def with_lookup(blocks_arr: Column, body) -> Column:
    """``body(found)`` with ``found(id)`` the last block of a response with that Id, null for a dangling one; found by a scan of the ids."""
    return bind(F.reverse(blocks_arr), lambda back: bind(F.transform(back, lambda b: b["Id"]), lambda ids: body(  # the first hit from the end
        lambda i: F.get(back, (F.array_position(ids, i) - 1).cast("int")))))


def referred(block: Column, kind: str, found) -> Column:
    """The blocks that the ``kind`` relationships of a block name, in order, null where a reference dangles."""
    named = F.filter(F.coalesce(block["Relationships"], F.array()), lambda r: r["Type"] == kind)
    return F.transform(F.flatten(F.transform(named, lambda r: F.coalesce(r["Ids"], F.array().cast("array<string>")))), found)


def _with_linked(blocks_arr) -> Column:
    """``array<struct<ord, b, linked>>`` of the blocks at which decoders start, with their references in order and what the blocks
    named by them hold: ``linked array<struct<type, rel_ord, block_type, text, ..., linked>>``, where the inner ``linked``
    has the references of that block in turn. An Id names its last block; a dangling reference has a null ``block_type`` and no references."""
    def refs(block, found, held):
        ids = F.array().cast("array<string>")
        return F.flatten(F.transform(F.coalesce(block["Relationships"], F.array()), lambda r, k: F.transform(
            F.transform(F.coalesce(r["Ids"], ids), found), lambda t, j: held(r["Type"], k, j, t))))

    def linked(found):
        def word(kind, k, j, t):
            return F.struct(kind.alias("type"), t["BlockType"].alias("block_type"), t["Text"].alias("text"),
                            t["SelectionStatus"].alias("selection_status"))

        def block(kind, k, j, t):
            return F.struct(
                kind.alias("type"), k.alias("rel_ord"), t["BlockType"].alias("block_type"), t["Text"].alias("text"),
                t["Confidence"].alias("confidence"), t["RowIndex"].alias("row_index"), t["ColumnIndex"].alias("col_index"),
                refs(t, found, word).alias("linked"))

        numbered = F.transform(blocks_arr, lambda b, i: F.struct(i.alias("ord"), b.alias("b")))
        return F.transform(F.filter(numbered, lambda x: _starts(x["b"])), lambda x: F.struct(
            x["ord"].alias("ord"), x["b"].alias("b"), refs(x["b"], found, block).alias("linked")))

    return with_lookup(blocks_arr, linked)


def _flatten(parsed: DataFrame, id_col: str) -> DataFrame:
    p = parsed.select(F.col(id_col).alias("doc_id"), "r").withColumn("dup_ids", _dup_ids(F.col("r.Blocks")))
    return explode_rows(p, ["doc_id", "dup_ids"], F.col("r.Blocks"), "b", "ord").select(  # missing Blocks -> none
        "doc_id", "ord", *_block_fields(), "dup_ids")


def _flatten_linked(parsed: DataFrame, id_col: str) -> DataFrame:
    """The blocks of short responses, those at which decoders start (``start``) with ``linked``. They are one side of a union, so that
    a decoder that reads only them leaves the rest unmade."""
    p = parsed.select(F.col(id_col).alias("doc_id"), "r").withColumn("dup_ids", _dup_ids(F.col("r.Blocks")))
    starts = explode_rows(p, ["doc_id", "dup_ids"], _with_linked(F.col("r.Blocks")), "x").select(
        "doc_id", F.col("x.ord").alias("ord"), F.col("x.b").alias("b"), F.col("x.linked").alias("linked"), "dup_ids")
    rest = explode_rows(p, ["doc_id", "dup_ids"], F.col("r.Blocks"), "b", "ord").where(~_starts(F.col("b")))
    return (starts.select("doc_id", "ord", *_block_fields(), "dup_ids", F.lit(True).alias("start"), "linked")
            .unionByName(rest.select("doc_id", "ord", *_block_fields(), "dup_ids", F.lit(False).alias("start")), allowMissingColumns=True))


def _block_fields():
    return [
        F.col("b.BlockType").alias("block_type"),
        F.col("b.Id").alias("id"),
        F.col("b.Text").alias("text"),
        F.col("b.Confidence").alias("confidence"),
        F.col("b.RowIndex").alias("row_index"),
        F.col("b.ColumnIndex").alias("col_index"),
        F.col("b.SelectionStatus").alias("selection_status"),
        F.col("b.EntityTypes").alias("entity_types"),
        F.col("b.Query.Text").alias("query_text"),
        F.col("b.Query.Alias").alias("query_alias"),
        F.col("b.Relationships").alias("relationships"),
        F.col("b.Geometry.BoundingBox").alias("bbox"),
    ]


def parse_blocks(df: DataFrame, json_col: str = "response", id_col: str = "doc_id", in_row_bytes: int = IN_ROW_BYTES) -> DataFrame:
    """``(doc_id, response json)`` -> one row per block with its response position ``ord``.

    In documents whose responses have at most ``in_row_bytes`` bytes (``in_row``), the blocks at which decoders start (``start``) carry
    what they refer to (``linked``, see ``_with_linked``)."""
    def parsed(rows):
        return rows.select(id_col, F.from_json(json_col, BLOCK_RESPONSE).alias("r"))

    short = F.octet_length(json_col) <= in_row_bytes
    return _flatten_linked(parsed(df.where(short)), id_col).withColumn("in_row", F.lit(True)).unionByName(
        _flatten(parsed(df.where(~short)), id_col).withColumn("in_row", F.lit(False)), allowMissingColumns=True)


def parse_documents(df: DataFrame, json_col: str = "response", id_col: str = "doc_id", in_row_bytes: int = IN_ROW_BYTES) -> DataFrame:
    """S5 by document: ``(doc_id, blocks, long)``, a response of at most ``in_row_bytes`` bytes with its blocks as an array in their order.
    A longer one (``long``) has null, its blocks are for ``parse_blocks``."""
    short = F.coalesce(F.octet_length(json_col) <= in_row_bytes, F.lit(True))
    return df.select(F.col(id_col).alias("doc_id"), F.from_json(F.when(short, F.col(json_col)), BLOCK_RESPONSE)["Blocks"].alias("blocks"),
                     (~short).alias("long"))


def split_documents(blocks: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """``(starts, others)``: the blocks that carry what they refer to, and all blocks of the documents in which none do and
    references take joins; None where there are none. The others are read by several lookups and written once; this runs a job."""
    if "linked" not in blocks.columns:
        return None, blocks
    others = materialize(blocks.where(~F.col("in_row")).drop("in_row", "start", "linked"), "long-responses")
    return blocks.where(F.col("in_row") & F.col("start")), None if others.isEmpty() else others


def response_status(df: DataFrame, json_col: str = "response", id_col: str = "doc_id") -> DataFrame:
    """``(doc_id, error)`` for every response that is present: null, or why it cannot be read. A corrupt response gives
    no blocks; its error belongs in the document's result."""
    from pyspark.sql import types as T

    sch = T.StructType([*BLOCK_RESPONSE.fields, T.StructField("_corrupt", T.StringType())])
    r = F.from_json(F.col(json_col), sch, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return df.where(F.col(json_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.when(r["_corrupt"].isNotNull(), F.lit("Extraction failed: response is not valid JSON"))
        .alias("error"))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """S5 from files: one response JSON per file (whole-file JSON); ``doc_id`` is the file path."""
    raw = (spark.read.schema(BLOCK_RESPONSE).option("multiLine", "true").option("mode", "PERMISSIVE")
           .json(path).select(F.input_file_name().alias("doc_id"), F.struct("Blocks").alias("r")))
    return _flatten(raw, "doc_id")


def combine_pages(df: DataFrame, json_col: str = "response", id_col: str = "doc_id",
                  page_col: str = "page_ord") -> DataFrame:
    """A multi-page job arrives as pages; blocks are renumbered in (page, position) order.

    A page's first number is the running sum of the sizes of the pages before it: a window over pages, not blocks. Ids
    that repeat in a document are found by a grouping on ``(doc_id, id)``, so neither step grows with the square of a
    document's blocks.
    """
    parsed = df.select(F.col(id_col).alias("doc_id"), F.col(page_col).alias("__page"),
                       F.from_json(json_col, BLOCK_RESPONSE).alias("r"))
    n = F.coalesce(F.size("r.Blocks"), F.lit(0))
    w = Window.partitionBy("doc_id").orderBy("__page").rowsBetween(Window.unboundedPreceding, -1)
    first = parsed.withColumn("__first", F.coalesce(F.sum(F.greatest(n, F.lit(0))).over(w), F.lit(0)).cast("int"))
    b = explode_rows(first, ["doc_id", "__first"], F.col("r.Blocks"), "b", "__o")
    dup = (b.where(F.col("b.Id").isNotNull()).groupBy("doc_id", F.col("b.Id").alias("id")).count().where("count > 1")
           .select("doc_id").distinct().withColumn("__dup", F.lit(True)))
    return (b.withColumn("ord", F.col("__first") + F.col("__o")).join(dup, "doc_id", "left")
            .select("doc_id", "ord", *_block_fields(), F.coalesce("__dup", F.lit(False)).alias("dup_ids")))


def resolve(refs: DataFrame, blocks: DataFrame, keys: list[str], cols: list[str], how: str = "inner",
            types: tuple[str, ...] | None = None, having: Column | None = None) -> DataFrame:
    """Follow references: ``refs(doc_id, id, *keys)`` -> each ref with the columns ``cols`` of block ``id``.

    This is the reference's ``{Id: block}`` lookup as an equi-join on ``(doc_id, id)``; a repeated Id keeps the
    *last* block. ``types`` and ``having`` (a condition on ``cols``) say which blocks the caller can use: only their rows, and only
    ``cols``, are shuffled; a reference to another block counts as dangling. When the block table carries ``dup_ids`` (set by the parsers, per document), only documents
    that repeat an Id go through the "last block" aggregation and the rest join directly. Without the flag the
    join may match several blocks and ``max_by(..., ord)`` picks one per ref, grouped on a superset of the join
    key so it runs in the join's stage. ``how='left'`` keeps dangling (or null) references with null columns.
    """
    fits = F.col("block_type").isin(list(types)) if types else F.lit(True)
    if having is not None:
        fits = F.coalesce(fits & having, F.lit(False))
    b = blocks.where(F.col("id").isNotNull())
    need = list(dict.fromkeys([*cols, "block_type"]))
    if "dup_ids" in blocks.columns:
        side = [F.col(c).alias(f"__l_{c}") for c in cols]
        plain = b.where(~F.col("dup_ids") & fits).select("doc_id", "id", *side)
        last = (b.where(F.col("dup_ids")).groupBy("doc_id", "id")
                .agg(F.max_by(F.struct(*need), "ord").alias("__b"))
                .select("doc_id", "id", "__b.*").where(fits).select("doc_id", "id", *side))
        return refs.join(plain.unionByName(last), ["doc_id", "id"], how).select(
            "doc_id", "id", *keys, *[F.col(f"__l_{c}").alias(c) for c in cols])
    # the flag, not the filter: a last block that does not fit hides an earlier one that does
    j = refs.join(b.select("doc_id", "id", "ord", *cols, fits.alias("__fits")), ["doc_id", "id"], how)
    picked = j.groupBy("doc_id", "id", *keys).agg(F.max_by(F.struct(*cols, "__fits"), "ord").alias("__b"))
    ok = F.col("__b.__fits")
    out = picked.select("doc_id", "id", *keys, *[F.when(ok, F.col(f"__b.{c}")).alias(c) for c in cols], ok.alias("__ok"))
    return (out.where("__ok") if how == "inner" else out).drop("__ok")


def child_refs(parents: DataFrame, rel_type: str, keys: list[str], rel_col: str = "relationships",
               outer: bool = False) -> DataFrame:
    """Ids referenced by ``rel_type`` relationships of each parent row, in order: adds ``rel_ord, id_ord, id``.

    ``outer=True`` keeps a parent without such references as one row with null positions and id.
    """
    ids = F.flatten(F.transform(
        F.filter(F.coalesce(F.col(rel_col), F.array()), lambda r: r["Type"] == rel_type),
        lambda r, k: F.transform(F.coalesce(r["Ids"], F.array().cast("array<string>")),
                                 lambda i, j: F.struct(k.alias("rel_ord"), j.alias("id_ord"), i.alias("id")))))
    gen = F.explode_outer(ids) if outer else F.explode(ids)
    return parents.select("doc_id", *keys, gen.alias("__r")).select(
        "doc_id", *keys, F.col("__r.rel_ord").alias("rel_ord"), F.col("__r.id_ord").alias("id_ord"),
        F.col("__r.id").alias("id"))

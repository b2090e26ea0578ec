"""Encoders: turn the given star-schema tables into OCR-style responses, so the decoders can be checked by SQL.

Each encoder is a Spark job over the given tables (its work grows with them) that emits ``(doc_id, response)``
with ``response`` a JSON string in the shape an OCR service returns. The DuckDB oracles read the star tables
directly, so "encode -> parse -> decode" must reproduce them. Encoders also plant the edge cases the decoders
must honour (dangling ids, repeated types, several answer relationships, missing fields).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import bind
from quire.schemas import BLOCK


def _null(dtype: str) -> Column:
    return F.lit(None).cast(dtype)


def block(block_type: str, id_: Column, text: Column | None = None, confidence: Column | None = None,
          row: Column | None = None, col: Column | None = None, entity_types: list[str] | None = None,
          query: Column | None = None, rels: Column | None = None, bbox: Column | None = None) -> Column:
    """A block struct with exactly the fields of ``schemas.BLOCK`` (absent fields are null, dropped by to_json)."""
    f = {s.name: s.dataType.simpleString() for s in BLOCK.fields}
    return F.struct(
        F.lit(block_type).alias("BlockType"),
        id_.alias("Id"),
        (text if text is not None else _null(f["Text"])).alias("Text"),
        (confidence if confidence is not None else _null(f["Confidence"])).alias("Confidence"),
        (row if row is not None else _null(f["RowIndex"])).alias("RowIndex"),
        (col if col is not None else _null(f["ColumnIndex"])).alias("ColumnIndex"),
        _null(f["SelectionStatus"]).alias("SelectionStatus"),
        (F.array(*[F.lit(e) for e in entity_types]) if entity_types else _null(f["EntityTypes"])).alias(
            "EntityTypes"),
        (query if query is not None else _null(f["Query"])).alias("Query"),
        (rels if rels is not None else _null(f["Relationships"])).alias("Relationships"),
        (F.struct(bbox.alias("BoundingBox")) if bbox is not None else _null(f["Geometry"])).alias("Geometry"),
    )


def rel(rel_type: str, ids: Column) -> Column:
    return F.struct(F.lit(rel_type).alias("Type"), ids.alias("Ids"))


def _response(df: DataFrame, blocks: Column, id_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("doc_id"), F.to_json(F.struct(blocks.alias("Blocks"))).alias("response"))


# ---------------------------------------------------------------- documents -> LINE blocks

def encode_lines(documents: DataFrame) -> DataFrame:
    """One LINE per ``\\n``-separated line (with a page box), each followed by a WORD noise block."""
    lines = F.split(F.col("text"), "\n", -1)
    blocks = F.flatten(F.transform(lines, lambda l, i: F.array(
        block("LINE", F.concat(F.lit("L"), i.cast("string")), text=l, confidence=F.lit(99.0),
              bbox=F.struct(F.lit(0.1).alias("Left"), (i * F.lit(0.01)).alias("Top"), F.lit(0.8).alias("Width"),
                            F.lit(0.01).alias("Height"))),
        block("WORD", F.concat(F.lit("W"), i.cast("string")), text=F.element_at(F.split(l, " ", -1), 1)),
    )))
    return _response(documents, blocks, "doc_id")


# ---------------------------------------------------------------- orders x lineitem -> TABLE blocks

def lineitem_rows(lineitem: DataFrame) -> DataFrame:
    """Line items of each order with a 1-based row number in a total order (``(orderkey, linenumber)`` repeats)."""
    items = (lineitem.groupBy("l_orderkey")
             .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                                        "l_extendedprice", "l_returnflag", "l_discount"))).alias(
                 "items")))
    return items


def encode_tables(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One TABLE per order; one row per line item; cells (partkey, returnflag, price as %.2f).

    Orders without line items become TABLE blocks without children (empty tables).
    """
    items = lineitem_rows(lineitem)
    o = orders.select(F.col("o_orderkey").alias("doc_id")).join(
        items.withColumnRenamed("l_orderkey", "doc_id"), "doc_id", "left")
    o = o.withColumn("items", F.coalesce("items", F.array()))

    def text(value):  # of characters that need no escape
        return F.coalesce(F.concat(F.lit(',"Text":"'), value, F.lit('"')), F.lit(""))

    def of_item(it, r):
        flag = F.to_json(F.struct(it["l_returnflag"].alias("Text")))
        flag = F.when(it["l_returnflag"].isNull(), F.lit("")).otherwise(F.concat(F.lit(","), F.substring(flag, F.lit(2), F.length(flag) - 2)))
        texts = [text(it["l_partkey"].cast("string")), flag, text(F.format_string("%.2f", it["l_extendedprice"]))]
        # written out as to_json writes the blocks, which costs a fraction of building the structs
        return F.concat(*[F.concat(
            F.lit(',{"BlockType":"CELL","Id":"C'), r, F.lit(f'_{c}","RowIndex":'), r,
            F.lit(f',"ColumnIndex":{c},"Relationships":[{{"Type":"CHILD","Ids":["W'), r,
            F.lit(f'_{c}"]}}]}},{{"BlockType":"WORD","Id":"W'), r, F.lit(f'_{c}"'), t, F.lit("}")) for c, t in enumerate(texts, 1)])

    def number(r):
        return (r + 1).cast("string")

    cells = F.array_join(F.transform("items", lambda it, r: bind(number(r), lambda n: of_item(it, n))), "")
    cell_ids = F.array_join(F.transform("items", lambda it, r: bind(number(r), lambda n: F.concat(
        *[F.concat(F.lit(f'{"," if c > 1 else ""}"C'), n, F.lit(f'_{c}"')) for c in (1, 2, 3)]))), ",")
    rels = F.when(F.size("items") > 0, F.concat(F.lit(',"Relationships":[{"Type":"CHILD","Ids":['), cell_ids, F.lit("]}]"))).otherwise(F.lit(""))
    return o.select("doc_id", F.concat(F.lit('{"Blocks":[{"BlockType":"TABLE","Id":"T0"'), rels, F.lit("}"), cells, F.lit("]}")).alias("response"))


# ---------------------------------------------------------------- customer -> KEY_VALUE_SET blocks

def encode_forms(customer: DataFrame) -> DataFrame:
    """Four KEY blocks per customer: Customer Name, Market Segment (two words), Account Balance, and an unfilled Fax Number
    with white space around its words.

    Account Balance carries two VALUE relationships, a stale one first: the last id must win. Fax Number has none.
    """
    pairs = F.array(
        F.struct(F.lit("Customer Name").alias("k"), F.col("c_name").alias("v")),
        F.struct(F.lit("Market Segment").alias("k"), F.concat(F.col("c_mktsegment"), F.lit(" segment")).alias("v")),
        F.struct(F.lit("Account Balance").alias("k"), F.format_string("%.2f", F.col("c_acctbal")).alias("v")),
    )

    def ids(prefix, k, words):
        return F.transform(words, lambda _w, j: F.concat(F.lit(prefix), k.cast("string"), F.lit("_"),
                                                          j.cast("string")))

    def one(p, k):
        kw, vw = F.split(p["k"], " ", -1), F.split(p["v"], " ", -1)
        vid = F.concat(F.lit("V"), k.cast("string"))
        value_rels = F.when(k == 2, F.array(rel("VALUE", F.array(F.lit("Vstale"))), rel("VALUE", F.array(vid)))) \
            .otherwise(F.array(rel("VALUE", F.array(vid))))
        key_block = block("KEY_VALUE_SET", F.concat(F.lit("K"), k.cast("string")), entity_types=["KEY"],
                          rels=F.concat(F.array(rel("CHILD", ids("KW", k, kw))), value_rels))
        value_block = block("KEY_VALUE_SET", vid, entity_types=["VALUE"],
                            rels=F.array(rel("CHILD", ids("VW", k, vw))))
        kwords = F.transform(kw, lambda w, j: block("WORD", F.concat(F.lit("KW"), k.cast("string"), F.lit("_"),
                                                                     j.cast("string")), text=w))
        vwords = F.transform(vw, lambda w, j: block("WORD", F.concat(F.lit("VW"), k.cast("string"), F.lit("_"),
                                                                     j.cast("string")), text=w))
        return F.concat(F.array(key_block, value_block), kwords, vwords)

    stale = F.array(block("KEY_VALUE_SET", F.lit("Vstale"), entity_types=["VALUE"],
                          rels=F.array(rel("CHILD", F.array(F.lit("SW"))))),
                    block("WORD", F.lit("SW"), text=F.lit("stale")))
    unfilled = F.array(block("KEY_VALUE_SET", F.lit("Kfax"), entity_types=["KEY"], rels=F.array(rel("CHILD", F.array(
        F.lit("FW0"), F.lit("FW1"))))), block("WORD", F.lit("FW0"), text=F.lit("\t\u00a0Fax")),
        block("WORD", F.lit("FW1"), text=F.lit("Number\n")))
    blocks = F.concat(F.flatten(F.transform(pairs, one)), unfilled, stale)
    return _response(customer, blocks, "c_custkey")


# ---------------------------------------------------------------- supplier -> QUERY blocks

SUPPLIER_QUERIES = [("What is the supplier name?", "SUPPLIER_NAME"), ("What is the account balance?", None)]


def encode_queries(supplier: DataFrame) -> DataFrame:
    """Two QUERY blocks per supplier: name (aliased) and balance (no alias, so alias = text).

    Keys divisible by 5 are unanswered. Even keys carry two ANSWER relationships (a stale result first, then the
    true result followed by a decoy): the last relationship with a result wins, and in it the first result.
    Odd keys lead their single relationship with a dangling id, which is skipped.
    """
    k = F.col("s_suppkey")
    answers = F.array(F.col("s_name"), F.format_string("%.2f", F.col("s_acctbal")))
    # multiples of three get a confidence on a tie of the first decimal
    confs = F.array(F.when(k % 3 == 0, 98.25).otherwise(((k * 37) % 1000) / 10.0), ((k * 53) % 1000) / 10.0)
    blocks = []
    for q, (qtext, alias) in enumerate(SUPPLIER_QUERIES):
        r, stale, decoy = F.lit(f"R{q}"), F.lit(f"S{q}"), F.lit(f"D{q}")
        rels = (F.when(k % 5 == 0, F.lit(None))
                .when(k % 2 == 0, F.array(rel("ANSWER", F.array(stale)), rel("ANSWER", F.array(r, decoy))))
                .otherwise(F.array(rel("ANSWER", F.array(F.lit("missing"), r)))))
        query = F.struct(F.lit(qtext).alias("Text"), F.lit(alias).cast("string").alias("Alias"))
        blocks += [
            block("QUERY", F.lit(f"Q{q}"), query=query, rels=rels),
            block("QUERY_RESULT", r, text=answers[q], confidence=confs[q]),
            block("QUERY_RESULT", stale, text=F.lit("stale"), confidence=F.lit(1.0)),
            block("QUERY_RESULT", decoy, text=F.lit("decoy"), confidence=F.lit(2.0)),
        ]
    return _response(supplier, F.array(*blocks), "s_suppkey")


# ---------------------------------------------------------------- orders x lineitem -> expense documents (A3-A5)

def _field(type_text: Column | None, value: Column | None) -> Column:
    t = F.struct(type_text.alias("Text")) if type_text is not None else F.lit(None).cast("struct<Text:string>")
    v = F.struct(value.alias("Text")) if value is not None else F.lit(None).cast("struct<Text:string>")
    return F.struct(t.alias("Type"), v.alias("ValueDetection"))


def encode_expense(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One expense document per order: summary TOTAL, STATUS (a stale value first), PRIORITY, an untyped field
    (-> UNKNOWN) and DUE without value (-> ''); line items grouped by return flag (several groups, in flag
    order), each with ITEM (stale first), PRICE, ROW and NOTE without value."""
    items = lineitem_rows(lineitem)
    o = orders.join(items.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left") \
        .withColumn("items", F.coalesce("items", F.array()))
    summary = F.array(
        _field(F.lit("TOTAL"), F.format_string("%.2f", F.col("o_totalprice"))),
        _field(F.lit("STATUS"), F.lit("stale")),
        _field(F.lit("STATUS"), F.col("o_orderstatus")),
        _field(F.lit("PRIORITY"), F.col("o_orderpriority")),
        _field(None, F.concat(F.lit("cust-"), F.col("o_custkey").cast("string"))),
        _field(F.lit("DUE"), None),
    )
    def value(name, text):  # as to_json writes a field, of characters that need no escape
        found = F.coalesce(F.concat(F.lit('"Text":"'), text, F.lit('"')), F.lit(""))
        return F.concat(F.lit(f',{{"Type":{{"Text":"{name}"}},"ValueDetection":{{'), found, F.lit("}}"))

    written = F.transform("items", lambda it, r: F.struct(it["l_returnflag"].alias("flag"), F.concat(
        F.lit('{"LineItemExpenseFields":[{"Type":{"Text":"ITEM"},"ValueDetection":{"Text":"stale"}}'), value("ITEM", it["l_partkey"].cast("string")),
        value("PRICE", F.format_string("%.2f", it["l_extendedprice"])), value("ROW", (r + 1).cast("string")),
        F.lit(',{"Type":{"Text":"NOTE"}}]}')).alias("json")))
    flags = F.array_sort(F.array_distinct(F.transform("items", lambda it: it["l_returnflag"])))
    groups = bind(written, lambda w: F.array_join(F.transform(flags, lambda f: F.concat(F.lit('{"LineItems":['), F.array_join(
        F.transform(F.filter(w, lambda x: x["flag"] == f), lambda x: x["json"]), ","), F.lit("]}"))), ","))
    return o.select(F.col("o_orderkey").alias("doc_id"), F.concat(
        F.lit('{"ExpenseDocuments":[{"SummaryFields":'), F.to_json(summary), F.lit(',"LineItemGroups":['), groups, F.lit("]}]}")).alias("response"))


# ---------------------------------------------------------------- customer -> identity documents

def encode_identity(customer: DataFrame) -> DataFrame:
    """Two identity documents per customer; SEGMENT appears in both (the later wins), one field has no type
    (UNKNOWN) and DOB has no value ('')."""
    d1 = F.struct(F.array(
        _field(F.lit("NAME"), F.col("c_name")),
        _field(F.lit("SEGMENT"), F.lit("stale")),
        _field(F.lit("NATION"), F.col("c_nationkey").cast("string")),
    ).alias("IdentityDocumentFields"))
    d2 = F.struct(F.array(
        _field(F.lit("SEGMENT"), F.col("c_mktsegment")),
        _field(None, F.format_string("%.2f", F.col("c_acctbal"))),
        _field(F.lit("DOB"), None),
    ).alias("IdentityDocumentFields"))
    return customer.select(F.col("c_custkey").alias("doc_id"),
                           F.to_json(F.struct(F.array(d1, d2).alias("IdentityDocuments"))).alias("response"))


# ---------------------------------------------------------------- orders -> class scores

# Classes and the multipliers of their synthetic scores (score = (orderkey * p mod 101) / 101).
CLASS_SCORES = [("invoice", 7), ("receipt", 13), ("bank-statement", 29)]


def encode_classes(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    score = {n: ((k * p) % 101).cast("double") / F.lit(101.0) for n, p in CLASS_SCORES}
    # scores whose exact value lies beside a tie of the fourth decimal, or on it
    score["receipt"] = F.when(k % 7 == 0, 0.55555).when(k % 7 == 1, 0.00015).when(k % 7 == 2, 0.03125).otherwise(score["receipt"])
    classes = F.array(*[F.struct(F.lit(n).alias("Name"), s.alias("Score")) for n, s in score.items()])
    return orders.select(k.alias("doc_id"), F.to_json(F.struct(classes.alias("Classes"))).alias("response"))


def field_confidences(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Per order one confidence per line item: key ``item_<row>``, score ``round(l_discount * 10, 4)``."""
    items = lineitem_rows(lineitem)
    return (orders.select(F.col("o_orderkey").alias("doc_id"))
            .join(items.withColumnRenamed("l_orderkey", "doc_id"), "doc_id")
            .select("doc_id", F.posexplode("items").alias("r", "it"))
            .select("doc_id", F.col("r").alias("key_ord"), F.concat(F.lit("item_"), (F.col("r") + 1).cast("string")).alias("key"),
                    F.round(F.col("it.l_discount") * 10, 4).alias("score")))


def encode_line_pages(documents: DataFrame, lines_per_page: int = 10) -> DataFrame:
    """The LINE encoding of ``encode_lines`` split into pages of ``lines_per_page`` lines, one response per
    ``(doc_id, page_ord)`` (a multi-page OCR job); combining the pages must give back the single response."""
    lines = F.split(F.col("text"), "\n", -1)
    n_pages = F.greatest(F.lit(1), F.ceil(F.size(lines) / lines_per_page).cast("int"))
    d = documents.select("doc_id", lines.alias("lines"), F.explode(F.sequence(F.lit(0), n_pages - 1)).alias(
        "page_ord"))
    page = F.slice("lines", F.col("page_ord") * lines_per_page + 1, lines_per_page)
    first = F.col("page_ord") * lines_per_page
    blocks = F.flatten(F.transform(page, lambda l, j: F.array(
        block("LINE", F.concat(F.lit("L"), (first + j).cast("string")), text=l, confidence=F.lit(99.0),
              bbox=F.struct(F.lit(0.1).alias("Left"), ((first + j) * F.lit(0.01)).alias("Top"),
                            F.lit(0.8).alias("Width"), F.lit(0.01).alias("Height"))),
        block("WORD", F.concat(F.lit("W"), (first + j).cast("string")), text=F.element_at(F.split(l, " ", -1), 1)),
    )))
    return d.select("doc_id", "page_ord", F.to_json(F.struct(blocks.alias("Blocks"))).alias("response"))

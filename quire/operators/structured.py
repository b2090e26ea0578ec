"""Structured responses: expense documents (A3-A5), identity documents (A6), class scores.

Missing type -> 'UNKNOWN', missing value -> '', a repeated type keeps the last value (dict overwrite). The
"last" is decided by carried positions, and keys are de-duplicated before any map is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.arrays import bind, explode_rows
from quire.functions.numbers import round_exact
from quire.schemas import CLASS_RESPONSE, EXPENSE_RESPONSE, IDENTITY_RESPONSE


def _typed(field):
    return (F.coalesce(field["Type"]["Text"], F.lit("UNKNOWN")).alias("type"),
            F.coalesce(field["ValueDetection"]["Text"], F.lit("")).alias("value"))


def _last_of_each(fields):
    """A field list -> ``array<struct<type, value>>``: the last value of each type, in order of first appearance. From the end of the
    list a type's first place is its last value."""
    def pick(back):
        return bind(F.transform(back, lambda f: _typed(f)[0]), lambda types: F.transform(
            F.array_distinct(F.reverse(types)), lambda n: F.struct(n.alias("type"), _typed(F.get(
                back, (F.array_position(types, n) - 1).cast("int")))[1])))

    return bind(F.reverse(F.coalesce(fields, F.array())), pick)


def _expense_docs(resp: DataFrame, json_col: str) -> DataFrame:
    """``(doc_id, docs)`` with ``docs array<struct<summary, items>>``. A response is one row, so "last value wins" and the numbering
    of the items of all groups are decided inside it: one parse, no shuffle."""
    r = resp.select("doc_id", F.from_json(json_col, EXPENSE_RESPONSE).alias("r"))

    def one(e):
        groups = F.transform(F.coalesce(e["LineItemGroups"], F.array()), lambda g: F.coalesce(g["LineItems"], F.array()))
        return F.struct(_last_of_each(e["SummaryFields"]).alias("summary"), F.transform(
            F.flatten(groups), lambda it: _last_of_each(it["LineItemExpenseFields"])).alias("items"))

    return r.select("doc_id", F.transform(F.coalesce("r.ExpenseDocuments", F.array()), one).alias("docs"))


def expense_summary(resp: DataFrame, json_col: str = "response") -> DataFrame:
    """A3: ``(doc_id, expense_ord, type, value)``, one value per summary type, last wins."""
    d = explode_rows(_expense_docs(resp, json_col), ["doc_id"], F.col("docs"), "d", "expense_ord")
    f = explode_rows(d, ["doc_id", "expense_ord"], F.col("d.summary"), "f")
    return f.select("doc_id", "expense_ord", "f.type", "f.value")


def expense_line_items(resp: DataFrame, json_col: str = "response") -> DataFrame:
    """A4: ``(doc_id, expense_ord, item_ord, type, value)``; items of all groups numbered in order."""
    d = explode_rows(_expense_docs(resp, json_col), ["doc_id"], F.col("docs"), "d", "expense_ord")
    items = explode_rows(d, ["doc_id", "expense_ord"], F.col("d.items"), "it", "item_ord")
    f = explode_rows(items, ["doc_id", "expense_ord", "item_ord"], F.col("it"), "f")
    return f.select("doc_id", "expense_ord", "item_ord", "f.type", "f.value")


def expense(resp: DataFrame, json_col: str = "response") -> DataFrame:
    """A5 API form: ``(doc_id, expense_data struct<documents: array<struct<summary_fields, line_items>>>)``.

    Every expense document is kept (an empty one gets an empty map and no items).
    """
    return _expense_docs(resp, json_col).select("doc_id", F.struct(F.transform("docs", lambda d: F.struct(
        F.map_from_entries(d["summary"]).alias("summary_fields"),
        F.transform(d["items"], lambda it: F.map_from_entries(it)).alias("line_items"))).alias("documents")).alias("expense_data"))


def identity_fields(resp: DataFrame, json_col: str = "response") -> DataFrame:
    """``(doc_id, type, value)`` over all identity documents of a response; last (document, field) wins."""
    r = resp.select("doc_id", F.from_json(json_col, IDENTITY_RESPONSE).alias("r"))
    d = explode_rows(r, ["doc_id"], F.col("r.IdentityDocuments"), "d", "d_ord")
    f = (explode_rows(d, ["doc_id", "d_ord"], F.col("d.IdentityDocumentFields"), "f", "f_ord")
         .select("doc_id", "d_ord", "f_ord", *_typed(F.col("f"))))
    return f.groupBy("doc_id", "type").agg(F.max_by("value", F.struct("d_ord", "f_ord")).alias("value"))


def _keyed_classes(resp: DataFrame, json_col: str, out_col: str) -> DataFrame:
    """Add ``array<struct<missing, neg, pos, name>>``, whose natural order is the ranking: rounded score descending, ties in
    response order, classes without a score last. A repeated class keeps its first position with its last score (dict semantics).

    The class list of one document is short, so all of it happens inside the row. The parsed class list is a column of its own so the lambdas
    below read it instead of re-parsing the JSON.
    """
    d = resp.withColumn("__cs", F.coalesce(F.from_json(F.col(json_col), CLASS_RESPONSE)["Classes"], F.array()))
    names = F.array_distinct(F.transform(F.filter("__cs", lambda c: c["Name"].isNotNull()), lambda c: c["Name"]))
    entries = F.transform(names, lambda n, i: F.struct(
        n.alias("name"), i.alias("pos"), F.element_at(F.filter(F.col("__cs"), lambda c: c["Name"] == n), -1)["Score"].alias("s")))
    return d.withColumn(out_col, F.transform(entries, lambda e: F.struct(
        e["s"].isNull().alias("missing"), (-round_exact(e["s"], 4)).alias("neg"), e["pos"].alias("pos"), e["name"].alias("name")))).drop("__cs")


def with_ranked_classes(resp: DataFrame, json_col: str = "response", out_col: str = "ranked") -> DataFrame:
    """W1 as a column: ``array<struct<name, pos, score>>`` sorted by rounded score desc, ties in response order, classes without
    a score last."""
    d = _keyed_classes(resp, json_col, "__keyed")
    # one pass of a lambda variable binds the list: later uses read a value instead of ranking again
    return d.withColumn(out_col, bind(F.array_sort("__keyed"), lambda r: F.transform(r, lambda e: F.struct(
        e["name"].alias("name"), e["pos"].alias("pos"), (F.lit(0.0) - e["neg"]).alias("score"))))).drop("__keyed")


def rank_classes(resp: DataFrame, json_col: str = "response") -> DataFrame:
    """W1 long form: ``(doc_id, class, score, rank)``."""
    return (explode_rows(with_ranked_classes(resp, json_col), ["doc_id"], F.col("ranked"), "c", "r")
            .select("doc_id", F.col("c.name").alias("class"), F.col("c.score").alias("score"),
                    (F.col("r") + 1).alias("rank")))


def top_class(resp: DataFrame, json_col: str = "response") -> DataFrame:
    """``(doc_id, document_type, classification_confidence, error)``; no class with a score -> null type and an error. The least
    key of the ranking, without sorting."""
    top = _keyed_classes(resp, json_col, "__keyed").select("doc_id", F.array_min("__keyed").alias("t"))
    fine = F.col("t").isNotNull() & ~F.col("t.missing")
    return top.select("doc_id", F.when(fine, F.col("t.name")).alias("document_type"),
                      F.when(fine, F.lit(0.0) - F.col("t.neg")).alias("classification_confidence"),
                      F.when(F.col("t").isNull(), F.lit("Classification failed: no classes returned"))
                      .when(~fine, F.lit("Classification failed: no class has a score")).alias("error"))

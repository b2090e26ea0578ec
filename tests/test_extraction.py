"""Block-graph and structured-response decoders on hand-built responses (fixtures and edge cases)."""

from conftest import responses

from pyspark.sql import functions as F

from quire.operators import blocks as B
from quire.operators import structured as S
from quire.sources.blocks import combine_pages, parse_blocks
from quire.sources.files import resolve_input


def rel(t, *ids):
    return {"Type": t, "Ids": list(ids)}


def test_detect_text_lines(spark):
    r = {"Blocks": [
        {"BlockType": "LINE", "Id": "1", "Text": "Invoice Number: B-7731"},
        {"BlockType": "LINE", "Id": "2", "Text": "Total Amount: 73.10"},
        {"BlockType": "WORD", "Id": "3", "Text": "Invoice"},
    ]}
    blocks = parse_blocks(responses(spark, {1: r}))
    lines = [x.text for x in B.text_lines(blocks).orderBy("ord").collect()]
    assert lines == ["Invoice Number: B-7731", "Total Amount: 73.10"]
    text = B.document_text(blocks).collect()[0].text
    assert text == "Invoice Number: B-7731\nTotal Amount: 73.10"


def test_training_text_is_space_joined_and_blocks_without_id(spark):
    r = {"Blocks": [{"BlockType": "LINE", "Text": "a b"}, {"BlockType": "LINE", "Text": "c"},
                    {"BlockType": "LINE", "Text": "d"}]}
    blocks = parse_blocks(responses(spark, {1: r}))
    assert B.document_text(blocks, " ").collect()[0].text == "a b c d"


def test_missing_blocks_is_empty(spark):
    blocks = parse_blocks(responses(spark, {1: {}}))
    assert blocks.count() == 0


def test_query_answer_fixture(spark):
    r = {"Blocks": [
        {"BlockType": "QUERY", "Id": "q1", "Query": {"Text": "What is the invoice number?", "Alias": "INV_NO"},
         "Relationships": [rel("ANSWER", "r1")]},
        {"BlockType": "QUERY_RESULT", "Id": "r1", "Text": "B-7731", "Confidence": 98.5},
    ]}
    d = B.answer_details(parse_blocks(responses(spark, {1: r}))).collect()
    assert [(x.alias, x.answer, x.confidence, x.query) for x in d] == [
        ("INV_NO", "B-7731", "98.5%", "What is the invoice number?")]
    assert {x.alias: x.answer for x in B.query_answers(
        B.answer_details(parse_blocks(responses(spark, {1: r})))).collect()} == {"INV_NO": "B-7731"}


def test_query_answer_edge_cases(spark):
    r = {"Blocks": [
        # two results in one relationship -> first; a later relationship with a result -> wins
        {"BlockType": "QUERY", "Id": "q1", "Query": {"Text": "t1", "Alias": "A"},
         "Relationships": [rel("ANSWER", "r1", "r2"), rel("ANSWER", "r3", "r4"), rel("ANSWER", "nope")]},
        {"BlockType": "QUERY_RESULT", "Id": "r1", "Text": "one", "Confidence": 10.0},
        {"BlockType": "QUERY_RESULT", "Id": "r2", "Text": "two", "Confidence": 20.0},
        {"BlockType": "QUERY_RESULT", "Id": "r3", "Text": "three", "Confidence": 30.0},
        {"BlockType": "QUERY_RESULT", "Id": "r4", "Text": "four", "Confidence": 40.0},
        # unanswered, no alias -> alias is the text
        {"BlockType": "QUERY", "Id": "q2", "Query": {"Text": "t2"}},
        # duplicate alias: dict form keeps the last, detailed form keeps both
        {"BlockType": "QUERY", "Id": "q3", "Query": {"Text": "t3", "Alias": "A"}, "Relationships": [rel("ANSWER", "r1")]},
    ]}
    blocks = parse_blocks(responses(spark, {1: r}))
    d = {(x.query_ord, x.alias): (x.answer, x.confidence) for x in B.answer_details(blocks).collect()}
    assert d[(0, "A")] == ("three", "30.0%")
    assert d[(5, "t2")] == ("", "0.0%")
    assert d[(6, "A")] == ("one", "10.0%")
    m = {x.alias: x.answer for x in B.query_answers(B.answer_details(blocks)).collect()}
    assert m == {"A": "one", "t2": ""}


def _table_response():
    return {"Blocks": [
        {"BlockType": "TABLE", "Id": "t", "Relationships": [rel("CHILD", "c11", "c12", "c21", "dangling", "w9"),
                                                            rel("CHILD", "c22", "c22b")]},
        {"BlockType": "CELL", "Id": "c11", "RowIndex": 1, "ColumnIndex": 1, "Relationships": [rel("CHILD", "w1", "w2")]},
        {"BlockType": "CELL", "Id": "c12", "ColumnIndex": 2, "Relationships": [rel("CHILD", "s1")]},  # row -> 1
        {"BlockType": "CELL", "Id": "c21", "RowIndex": 2, "ColumnIndex": 1},  # no words -> ''
        {"BlockType": "CELL", "Id": "c22", "RowIndex": 3, "ColumnIndex": 3, "Relationships": [rel("CHILD", "w3")]},
        {"BlockType": "CELL", "Id": "c22b", "RowIndex": 3, "ColumnIndex": 3, "Relationships": [rel("CHILD", "w4")]},
        {"BlockType": "WORD", "Id": "w1", "Text": "Hello"},
        {"BlockType": "WORD", "Id": "w2", "Text": "world"},
        {"BlockType": "SELECTION_ELEMENT", "Id": "s1", "SelectionStatus": "SELECTED"},
        {"BlockType": "WORD", "Id": "w3", "Text": "first"},
        {"BlockType": "WORD", "Id": "w4", "Text": "last"},
        {"BlockType": "WORD", "Id": "w9", "Text": "not a cell"},
        {"BlockType": "TABLE", "Id": "empty"},
    ]}


def test_table_grid_edge_cases(spark):
    blocks = parse_blocks(responses(spark, {1: _table_response()}))
    grids = B.table_grids(blocks).collect()[0].tables
    assert grids == [
        [["Hello world", "SELECTED", ""], ["", "", ""], ["", "", "last"]],
        [],
    ]


def test_repeated_id_keeps_last_block(spark):
    r = {"Blocks": [
        {"BlockType": "TABLE", "Id": "t", "Relationships": [rel("CHILD", "c")]},
        {"BlockType": "CELL", "Id": "c", "RowIndex": 1, "ColumnIndex": 1, "Relationships": [rel("CHILD", "w")]},
        {"BlockType": "WORD", "Id": "w", "Text": "old"},
        {"BlockType": "WORD", "Id": "w", "Text": "new"},
    ]}
    assert B.table_grids(parse_blocks(responses(spark, {1: r}))).collect()[0].tables == [[["new"]]]


def test_kv_edge_cases(spark):
    r = {"Blocks": [
        {"BlockType": "KEY_VALUE_SET", "Id": "k1", "EntityTypes": ["KEY"],
         "Relationships": [rel("CHILD", "kw1"), rel("VALUE", "v1", "v2")]},
        {"BlockType": "KEY_VALUE_SET", "Id": "v1", "EntityTypes": ["VALUE"], "Relationships": [rel("CHILD", "vw1")]},
        {"BlockType": "KEY_VALUE_SET", "Id": "v2", "EntityTypes": ["VALUE"], "Relationships": [rel("CHILD", "vw2")]},
        {"BlockType": "WORD", "Id": "kw1", "Text": "Name:"},
        {"BlockType": "WORD", "Id": "vw1", "Text": "first"},
        {"BlockType": "WORD", "Id": "vw2", "Text": "second"},
        # dangling last value -> ''
        {"BlockType": "KEY_VALUE_SET", "Id": "k2", "EntityTypes": ["KEY"],
         "Relationships": [rel("CHILD", "kw2"), rel("VALUE", "v1"), rel("VALUE", "gone")]},
        {"BlockType": "WORD", "Id": "kw2", "Text": "Total"},
        # checkbox value -> ''
        {"BlockType": "KEY_VALUE_SET", "Id": "k3", "EntityTypes": ["KEY"],
         "Relationships": [rel("CHILD", "kw3"), rel("VALUE", "v3")]},
        {"BlockType": "KEY_VALUE_SET", "Id": "v3", "EntityTypes": ["VALUE"], "Relationships": [rel("CHILD", "sel")]},
        {"BlockType": "SELECTION_ELEMENT", "Id": "sel", "SelectionStatus": "SELECTED"},
        {"BlockType": "WORD", "Id": "kw3", "Text": "Paid"},
        # empty key -> dropped
        {"BlockType": "KEY_VALUE_SET", "Id": "k4", "EntityTypes": ["KEY"], "Relationships": [rel("VALUE", "v1")]},
        # duplicate key (after trim) -> last block wins
        {"BlockType": "KEY_VALUE_SET", "Id": "k5", "EntityTypes": ["KEY"],
         "Relationships": [rel("CHILD", "kw5"), rel("VALUE", "v1")]},
        {"BlockType": "WORD", "Id": "kw5", "Text": "\tName:\n"},
        # unfilled: no VALUE relationship -> ''
        {"BlockType": "KEY_VALUE_SET", "Id": "k6", "EntityTypes": ["KEY"], "Relationships": [rel("CHILD", "kw6")]},
        {"BlockType": "WORD", "Id": "kw6", "Text": "Fax"},
    ]}
    blocks = parse_blocks(responses(spark, {1: r}))
    m = {x.key: x.value for x in B.kv_map_long(B.kv_pairs(blocks)).collect()}
    assert m == {"Name:": "first", "Total": "", "Paid": "", "Fax": ""}
    mp = B.kv_map(B.kv_pairs(blocks)).collect()[0].kv_pairs
    assert mp == m
    order = F.map_keys("kv_pairs")
    assert B.kv_map(B.kv_pairs(blocks)).select(order).first()[0] == ["Name:", "Total", "Paid", "Fax"]


def test_value_blocks_without_words(spark):
    """Only blocks with children travel to the value lookup; the last block of an Id still hides an earlier one with words."""
    def key(n, value):
        return [{"BlockType": "KEY_VALUE_SET", "Id": f"k{n}", "EntityTypes": ["KEY"], "Relationships": [rel("CHILD", f"kw{n}"), rel("VALUE", value)]},
                {"BlockType": "WORD", "Id": f"kw{n}", "Text": f"key{n}"}]

    full = {"BlockType": "KEY_VALUE_SET", "EntityTypes": ["VALUE"], "Relationships": [rel("CHILD", "w")]}
    plain = [*key(1, "v"), *key(2, "none"), *key(3, "other"), *key(4, "w"), {"BlockType": "WORD", "Id": "w", "Text": "word"},
             {**full, "Id": "v"}, {"BlockType": "KEY_VALUE_SET", "Id": "none", "EntityTypes": ["VALUE"]},
             {"BlockType": "KEY_VALUE_SET", "Id": "other", "EntityTypes": ["VALUE"], "Relationships": [rel("VALUE", "w")]}]
    hides = [*plain, {"BlockType": "KEY_VALUE_SET", "Id": "v", "EntityTypes": ["VALUE"]}]  # the last one has no words
    shows = [*plain, {**full, "Id": "none"}]
    blocks = parse_blocks(responses(spark, {1: {"Blocks": plain}, 2: {"Blocks": hides}, 3: {"Blocks": shows}}))
    want = {1: ["word", "", "", ""], 2: ["", "", "", ""], 3: ["word", "word", "", ""]}
    for b in (blocks, blocks.drop("dup_ids")):
        got = B.kv_pairs(b).orderBy("doc_id", "key_ord").collect()
        assert {d: [r.value for r in got if r.doc_id == d] for d in want} == want
        assert [r.key for r in got if r.doc_id == 2] == ["key1", "key2", "key3", "key4"]


def test_exact_rounding(spark):
    from quire.functions.numbers import round_exact

    values = [0.55555, 0.00015, 0.03125, 0.09375, 98.25, 98.35, 0.5, 1e-9, 0.0, 1.0, 0.12345, 0.99995, 33.33335]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.select(round_exact(F.col("x"), 4), round_exact(F.col("x"), 1)).collect()
    assert [tuple(r) for r in got] == [(round(v, 4), round(v, 1)) for v in values]


def test_combine_pages_finds_repeated_ids(spark):
    import json

    page = lambda *ids: json.dumps({"Blocks": [{"BlockType": "LINE", "Id": i, "Text": i} for i in ids]})
    df = spark.createDataFrame([(1, 0, page("a", "b")), (1, 1, page("a")), (2, 0, page("a")), (2, 1, page("b"))],
                               "doc_id long, page_ord int, response string")
    got = {(r.doc_id, r.ord, r.id, r.dup_ids) for r in combine_pages(df).collect()}
    assert got == {(1, 0, "a", True), (1, 1, "b", True), (1, 2, "a", True), (2, 0, "a", False), (2, 1, "b", False)}


def test_expense_fixture(spark):
    def f(t, v):
        return {"Type": {"Text": t}, "ValueDetection": {"Text": v}}

    r = {"ExpenseDocuments": [{
        "SummaryFields": [f("VENDOR_NAME", "Bluebird Mills"), f("TOTAL", "73.10"), {"ValueDetection": {"Text": "x"}},
                          {"Type": {"Text": "DUE"}}],
        "LineItemGroups": [{"LineItems": [{"LineItemExpenseFields": [
            f("ITEM", "Twine spool"), f("QUANTITY", "2"), f("PRICE", "36.55")]}]}],
    }]}
    e = S.expense(responses(spark, {1: r})).collect()[0].expense_data
    assert len(e.documents) == 1
    d = e.documents[0]
    assert d.summary_fields == {"VENDOR_NAME": "Bluebird Mills", "TOTAL": "73.10", "UNKNOWN": "x", "DUE": ""}
    assert d.line_items == [{"ITEM": "Twine spool", "QUANTITY": "2", "PRICE": "36.55"}]


def test_expense_groups_and_repeats(spark):
    def f(t, v):
        return {"Type": {"Text": t}, "ValueDetection": {"Text": v}}

    r = {"ExpenseDocuments": [{"SummaryFields": [f("TOTAL", "1"), f("TOTAL", "2")],
                               "LineItemGroups": [{"LineItems": [{"LineItemExpenseFields": [f("A", "1")]}]},
                                                  {"LineItems": [{"LineItemExpenseFields": [f("A", "2")]},
                                                                 {"LineItemExpenseFields": []}]}]},
                              {}]}
    e = S.expense(responses(spark, {1: r})).collect()[0].expense_data
    assert e.documents[0].summary_fields == {"TOTAL": "2"}
    assert e.documents[0].line_items[:2] == [{"A": "1"}, {"A": "2"}]
    assert e.documents[1].summary_fields == {} and e.documents[1].line_items == []


def test_identity_fixture(spark):
    def f(t, v):
        return {"Type": {"Text": t}, "ValueDetection": {"Text": v}}

    r = {"IdentityDocuments": [{"IdentityDocumentFields": [
        f("FIRST_NAME", "Ines"), f("LAST_NAME", "Mora"), f("DATE_OF_BIRTH", "12/03/1987")]}]}
    got = {x.type: x.value for x in S.identity_fields(responses(spark, {1: r})).collect()}
    assert got == {"FIRST_NAME": "Ines", "LAST_NAME": "Mora", "DATE_OF_BIRTH": "12/03/1987"}


def test_no_input_is_an_error(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "k.pdf"), (3, bytearray(b"x"), "k.pdf")],
                               "doc_id long, content binary, key string")
    got = {x.doc_id: (x.input_kind, x.input_uri, x.error) for x in resolve_input(df, "bkt").collect()}
    assert got[1] == (None, None, "Provide either s3_key or image_bytes")
    assert got[2] == ("s3", "s3://bkt/k.pdf", None)
    assert got[3] == ("bytes", None, None)


def test_combine_pages_renumbers(spark):
    p0 = {"Blocks": [{"BlockType": "LINE", "Id": "a", "Text": "one"}, {"BlockType": "LINE", "Id": "b", "Text": "two"}]}
    p1 = {"Blocks": [{"BlockType": "LINE", "Id": "c", "Text": "three"}]}
    import json

    df = spark.createDataFrame([(1, 1, json.dumps(p1)), (1, 0, json.dumps(p0))],
                               "doc_id long, page_ord int, response string")
    lines = [(x.ord, x.text) for x in B.text_lines(combine_pages(df)).orderBy("ord").collect()]
    assert lines == [(0, "one"), (1, "two"), (2, "three")]


def test_references_followed_in_the_row_and_by_joins_agree(spark):
    """Short responses are decoded in their rows, long ones by joins; random responses with repeated, missing and dangling Ids."""
    import random

    rng = random.Random(5)
    docs = {}
    for d in range(60):
        ids = [f"i{i}" for i in range(rng.randint(1, 14))]
        some = lambda: [rng.choice([*ids, "nope", None]) for _ in range(rng.randint(0, 4))]
        kinds = ["TABLE", "CELL", "CELL", "WORD", "WORD", "SELECTION_ELEMENT", "KEY_VALUE_SET", "QUERY", "QUERY_RESULT", None]
        docs[d] = {"Blocks": [{k: v for k, v in {
            "BlockType": rng.choice(kinds), "Id": rng.choice([*ids, None]), "Text": rng.choice(["a", " b ", "", None]),
            "Confidence": rng.choice([98.25, 1.0, None]), "RowIndex": rng.choice([1, 2, None]), "ColumnIndex": rng.choice([1, 2, None]),
            "SelectionStatus": rng.choice(["SELECTED", None]), "EntityTypes": rng.choice([["KEY"], ["KEY"], ["VALUE"], None]),
            "Query": rng.choice([{"Text": "t"}, {"Text": "t", "Alias": "A"}, None]),
            "Relationships": rng.choice([None, [], [{"Type": rng.choice(["CHILD", "CHILD", "VALUE", "ANSWER"]), "Ids": rng.choice([some(), None])}
                                                    for _ in range(rng.randint(1, 3))]])}.items() if v is not None}
            for _ in range(rng.randint(0, 30))]}
    raw = responses(spark, docs)
    ways = [parse_blocks(raw), parse_blocks(raw, in_row_bytes=0), parse_blocks(raw, in_row_bytes=1500)]
    n = {w.select("doc_id", "in_row").distinct().groupBy().agg(F.sum(F.col("in_row").cast("int"))).first()[0] for w in ways}
    assert len(n) == 3  # all, none and some of the documents
    plain = ["doc_id", "ord", "block_type", "id", "text", "dup_ids"]
    for decode in (lambda b: b.select(*plain), B.table_cells, B.table_grids, B.kv_pairs, B.answer_details):
        rows = [sorted(map(repr, decode(w).collect())) for w in ways]
        assert rows[0] == rows[1] == rows[2] and rows[0]
    p = B._cells_in_row(ways[0].where("in_row AND start"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in p


def test_answers_take_one_grouping_of_the_pairs(spark):
    kv = spark.createDataFrame([(1, 0, "Customer Name", "a"), (1, 1, "Name", "b"), (1, 2, "name!", "c"), (2, 0, "--", "d"), (3, 5, None, "e")],
                               "doc_id long, key_ord int, key string, value string")
    got = B.answer_queries(kv, [("N", "the customer"), ("N", "name?"), ("C", "Customer, customer"), ("X", "")])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate") == 1 and plan.index("Generate") < plan.index("Exchange")  # no pair is repeated for each query
    assert sorted(map(tuple, got.collect())) == [
        (1, "C", "a", 50.0), (1, "N", "b", 100.0), (1, "X", "", 0.0), (2, "C", "", 0.0), (2, "N", "", 0.0), (2, "X", "", 0.0),
        (3, "C", "", 0.0), (3, "N", "", 0.0), (3, "X", "", 0.0)]

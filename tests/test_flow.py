"""File readers (S5, S12), run metrics (A16), phase guards (P7), query numbering (P8), page texts (P12), the
separator splitter (C4), per-document assembly with errors (A12, F4, O2) and block-fed results."""

import json
import os

from conftest import responses
from pyspark.sql import functions as F

from quire.functions.splitter import split_text_separators
from quire.operators import assembly as AS
from quire.operators import blocks as B
from quire.operators.review import loop_outputs, parse_review_output, read_review_json, read_review_output
from quire.session import materialize
from quire.sources.blocks import parse_blocks, read_blocks, response_status


def test_read_blocks_from_files(spark, scratch):
    d = os.path.join(scratch, "ocr")
    os.makedirs(d)
    for i, lines in enumerate([["a", "b"], ["c"]]):
        r = {"Blocks": [{"BlockType": "LINE", "Id": f"l{j}", "Text": t} for j, t in enumerate(lines)]}
        with open(os.path.join(d, f"doc{i}.json"), "w") as f:
            json.dump(r, f, indent=2)  # multi-line JSON, one response per file
    texts = {os.path.basename(r.doc_id): r.text for r in B.document_text(read_blocks(spark, d)).collect()}
    assert texts == {"doc0.json": "a\nb", "doc1.json": "c"}


def test_read_review_output_from_files(spark, scratch):
    d = os.path.join(scratch, "review")
    os.makedirs(d)
    with open(os.path.join(d, "loop1.json"), "w") as f:
        json.dump({"humanAnswers": [{"answerContent": {"total": "10.00"}}, {"answerContent": {"total": "12.00"}}]}, f)
    with open(os.path.join(d, "loop2.json"), "w") as f:
        f.write("{}")
    got = {(os.path.basename(r.doc_id), r.key, r.value) for r in read_review_output(spark, d).collect()}
    assert got == {("loop1.json", "total", "12.00")}
    loops = spark.createDataFrame([("l1", 7, f"file://{d}/loop1.json"), ("l2", 8, f"file:{d}/loop2.json"), ("l3", 9, "file:/none")],
                                  "loop_id string, doc_id long, output_uri string")
    whole = loop_outputs(loops, read_review_json(spark, d))
    assert {r.loop_id: r.output is not None and json.loads(r.output) != {} for r in whole.collect()} == {"l1": True, "l2": False, "l3": False}
    assert [(r.doc_id, r.key, r.value) for r in parse_review_output(whole).collect()] == [(7, "total", "12.00")]


def test_run_metrics_observe(spark):
    df = spark.range(10).withColumn("pii", F.col("id") % 3)
    observed, obs = AS.run_metrics(df, "phase_counts", rows=F.count(F.lit(1)), pii=F.sum("pii"))
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 10, "pii": 9}


def test_phase_guards(spark):
    df = spark.createDataFrame([("x", ".TIF"), ("", ".pdf"), (None, ".txt")], "text string, ext string")
    got = [(r.run_qa, r.run_expense) for r in AS.phase_guards(df, "text", "ext").collect()]
    assert got == [(True, True), (False, True), (False, False)]


def test_number_queries(spark):
    q = spark.createDataFrame([(0, "a", None), (1, "b", "B")], "query_ord int, text string, alias string")
    assert [r.alias for r in B.number_queries(q).orderBy("query_ord").collect()] == ["Q1", "B"]


def test_page_texts(spark):
    p0 = {"Blocks": [{"BlockType": "LINE", "Text": "one"}, {"BlockType": "WORD", "Text": "x"},
                     {"BlockType": "LINE", "Text": "two"}]}
    p1 = {"Blocks": [{"BlockType": "LINE", "Text": "three"}]}
    df = spark.createDataFrame([(1, 0, json.dumps(p0)), (1, 1, json.dumps(p1))],
                               "doc_id long, page_ord int, response string")
    got = {r.page_ord: r.text for r in B.page_texts(df).collect()}
    assert got == {0: "one\ntwo", 1: "three"}


def test_page_texts_of_blank_and_unreadable_pages(spark):
    rows = [(1, 0, '{"Blocks": []}'), (1, 1, '{"Blocks": [{"BlockType": "PAGE"}]}'), (1, 2, "{}"), (1, 3, '{"Blocks": [{"BlockT'), (1, 4, None),
            (1, 5, '{"Blocks": [{"BlockType": "LINE"}, {"BlockType": "LINE", "Text": "b"}]}'), (2, 0, "")]
    df = B.page_texts(spark.createDataFrame(rows, "doc_id long, page_ord int, response string"))
    assert {(r.doc_id, r.page_ord): r.text for r in df.collect()} == {
        (1, 0): "", (1, 1): "", (1, 2): "", (1, 3): None, (1, 4): None, (1, 5): "\nb", (2, 0): None}
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()  # a page is a row


def _split(spark, text, size, overlap):
    df = spark.createDataFrame([(text,)], "text string")
    return df.select(split_text_separators(F.col("text"), size, overlap)).first()[0]


def test_split_prefers_the_best_separator(spark):
    assert _split(spark, "one two. three\n\nfour five six seven", 20, 0) == ["one two. three", "four five six seven"]
    assert _split(spark, "one two. three four five six", 18, 0) == ["one two.", "three four five", "six"]
    assert _split(spark, "abcdefghij", 4, 0) == ["abcd", "efgh", "ij"]
    assert _split(spark, "aa bb cc dd", 8, 2) == ["aa bb", "b cc dd"]
    assert _split(spark, "", 10, 2) == [] and _split(spark, None, 10, 2) == [] and _split(spark, " \n ", 10, 2) == []


def test_split_text_separators_bounds(spark):
    text = ("Lorem ipsum dolor sit amet. " * 40 + "\n\n") * 5 + "x" * 900 + " end"
    chunks = _split(spark, text, 200, 50)
    assert all(0 < len(c) <= 200 for c in chunks)
    at = 0
    for c in chunks:  # in order, covering everything but white space, with some overlap
        i = text.index(c, max(0, at - 60))
        assert text[at:i].strip() == "" and i <= at + 4
        at = i + len(c)
    assert text[at:].strip() == ""


def test_phase_errors_blank_pages_and_identity(spark):
    docs = spark.createDataFrame([(i, f"in/{i}.{'pdf' if i != 5 else 'txt'}") for i in range(1, 7)], "doc_id long, document_path string")
    good = json.dumps({"Blocks": [{"BlockType": "LINE", "Id": "l", "Text": "hello there"}]})
    raw = spark.createDataFrame([(1, good), (2, '{"Blocks": []}'), (3, "{not json"), (4, good), (5, good)], "doc_id long, response string")
    errors = spark.createDataFrame([(4, "upload", "Upload failed: denied"), (1, "pii", "PII failed"), (1, "queries", "Queries failed")],
                                   "doc_id long, phase string, error string")
    identity = spark.createDataFrame([(1, "NAME", "Ada"), (1, "CITY", "Ulm")], "doc_id long, type string, value string")
    expense = spark.createDataFrame([(i, ([({"T": "9"}, [])],)) for i in (1, 5)],
                                    "doc_id long, expense_data struct<documents:array<struct<summary_fields:map<string,string>,"
                                    "line_items:array<map<string,string>>>>>")
    r = {x.doc_id: x for x in AS.process_documents(
        docs, blocks=parse_blocks(raw), responses=response_status(raw), phase_errors=errors, identity=identity, expense=expense).collect()}
    assert r[1].errors == ["Queries failed", "PII failed"] and r[1].id_fields == {"NAME": "Ada", "CITY": "Ulm"}
    assert r[1].raw_text == "hello there" and len(r[1].genai_answers) == 3
    assert r[1].genai_answers[0].source_documents[0].source == "in/1.pdf"
    assert r[2].errors == [] and r[2].raw_text == ""
    assert r[3].errors == ["Extraction failed: response is not valid JSON"]
    assert r[4].errors == ["Upload failed: denied"] and r[4].raw_text == "" and r[4].genai_answers == []
    assert r[6].errors == ["Extraction failed: no text"]
    assert len(r[1].expense_data.documents) == 1 and r[5].expense_data.documents == []


def test_process_documents_errors_and_batch(spark):
    docs = spark.createDataFrame([(1, "mail a@b.io now"), (2, None), (3, "")], "doc_id long, text string")
    classes = spark.createDataFrame([(1, None, None, "Classification failed: no classes returned")],
                                    "doc_id long, document_type string, classification_confidence double, error string")
    r = {x.doc_id: x for x in AS.process_documents(docs, classes=classes).collect()}
    assert r[1].errors == ["Classification failed: no classes returned"]
    assert r[1].redacted_text == "mail ****** now" and len(r[1].pii_entities) == 1
    assert r[2].errors == ["Extraction failed: no text"] and r[2].raw_text == ""
    assert r[3].errors == [] and r[3].redacted_text == ""
    assert all(x.human_review_triggered is False for x in r.values())


def test_process_documents_from_blocks(spark):
    rel = {"Type": "CHILD", "Ids": ["c"]}
    resp = {"Blocks": [{"BlockType": "LINE", "Id": "l", "Text": "Total 5"},
                       {"BlockType": "TABLE", "Id": "t", "Relationships": [rel]},
                       {"BlockType": "CELL", "Id": "c", "RowIndex": 1, "ColumnIndex": 1,
                        "Relationships": [{"Type": "CHILD", "Ids": ["w"]}]},
                       {"BlockType": "WORD", "Id": "w", "Text": "5"}]}
    blocks = materialize(parse_blocks(responses(spark, {1: resp})), "test-blocks")
    docs = spark.createDataFrame([(1,), (2,)], "doc_id long")
    r = {x.doc_id: x for x in AS.process_documents(docs, blocks=blocks).collect()}
    assert r[1].raw_text == "Total 5" and r[1].tables == [[["5"]]] and r[1].errors == []
    assert r[2].errors == ["Extraction failed: no text"]
    summary = {x.doc_id: x for x in AS.document_summary(
        AS.process_documents(docs, blocks=blocks)).collect()}
    assert summary[1].n_tables == 1 and summary[1].document_type == "N/A"


def _random_response(rnd):
    """Blocks of all types with repeated, missing and dangling ids, null parts, addresses that repeat or are not given."""
    def some(values, p=0.8):
        return rnd.choice(values) if rnd.random() < p else None

    ids = [f"i{n}" for n in range(rnd.randrange(4, 12))]
    blocks = []
    for _ in range(rnd.randrange(0, 40)):
        rels = [some([{"Type": some(["CHILD", "CHILD", "CHILD", "VALUE", "ANSWER"], 0.95), "Ids": some([[some([*ids, "gone"], 0.95) for _ in range(
            rnd.randrange(0, 5))]], 0.95)}], 0.95) for _ in range(rnd.randrange(0, 4))]
        b = {"BlockType": some(["TABLE", "CELL", "CELL", "CELL", "WORD", "WORD", "WORD", "WORD", "SELECTION_ELEMENT", "QUERY", "QUERY_RESULT",
                                "QUERY_RESULT", "LINE", *["KEY_VALUE_SET"] * 4], 0.97),
             "Id": some(ids, 0.95), "Text": some(["a", "b", " c\t", "", "\u00e9 x"]), "Confidence": some([1.0, 50.25]), "RowIndex": some([1, 2, 4]),
             "ColumnIndex": some([1, 3]), "SelectionStatus": some(["SELECTED", "NOT_SELECTED"]), "EntityTypes": some([["KEY"], ["KEY"], ["VALUE"], []]),
             "Query": some([{"Text": some(["q1", "q2"]), "Alias": some(["A", "B"], 0.5)}]), "Relationships": some([rels], 0.9)}
        blocks.append(some([{k: v for k, v in b.items() if v is not None or rnd.random() < 0.5}], 0.97))
    for _ in range(rnd.randrange(0, 5)):  # keys with words, some of which repeat
        word = rnd.choice(["w1", "w2"])
        blocks += [{"BlockType": "KEY_VALUE_SET", "EntityTypes": ["KEY"], "Relationships": [
            {"Type": "CHILD", "Ids": [word]}, {"Type": "VALUE", "Ids": rnd.sample([*ids, "gone"], 2)}]}, {"BlockType": "WORD", "Id": word, "Text": f" {word}"}]
    return json.dumps(some([{"Blocks": blocks}, {"Blocks": blocks}, {"Blocks": blocks}, {"Blocks": None}, {}], 0.98))


def test_responses_decoded_in_their_row(spark, monkeypatch):
    """A result fed by responses is the one fed by their blocks, whether a response is decoded in its row, is too long for that, or is one of
    several of its document; a response is parsed once, and no block becomes a row."""
    import random

    from quire.operators import blocks as B
    from quire.sources import blocks as SB

    rnd = random.Random(5)
    raw = spark.createDataFrame([(i, _random_response(rnd)) for i in range(300)] + [(i, _random_response(rnd)) for i in range(290, 300)] + [
        (300, "{"), (301, None), (302, "[]"), (None, _random_response(rnd))], "doc_id long, response string")
    docs = raw.where("doc_id IS NOT NULL").select("doc_id").distinct()
    blocks = materialize(SB.parse_blocks(raw, in_row_bytes=0), "test-blocks")

    def results(given):
        r = AS.process_documents(docs, blocks=given, responses=response_status(raw), questions=[])
        return {x.doc_id: {**x.asDict(), "kv_order": list(x.kv_pairs)} for x in r.collect()}

    want = results(blocks)
    assert sum(map(bool, (x["tables"] for x in want.values()))) > 50 and sum(map(bool, (x["query_answers"] for x in want.values()))) > 50
    assert sum(len(x["kv_pairs"]) > 1 for x in want.values()) > 5 and sum(any(map(any, x["tables"])) for x in want.values()) > 10
    got = results(raw)
    assert {i for i in want if got[i] != want[i]} == set()
    long = SB.parse_documents
    monkeypatch.setattr(SB, "parse_documents", lambda df: long(df, in_row_bytes=600))
    assert long(raw, in_row_bytes=600).groupBy("long").count().count() == 2
    got = results(raw)
    assert {i for i in want if got[i] != want[i]} == set()
    decoded = B.decode_documents(long(raw))
    plan = decoded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and "Generate" not in plan and "Aggregate" not in plan


def test_tables_of_orders_decoded_in_their_row(spark):
    """Cells that fill their grid in reading order, in any other order, with gaps, with repeated addresses, with indexes out of range."""
    from quire.operators import blocks as B
    from quire.plans.q_blocks import table_blocks, table_responses
    from quire.sources.blocks import parse_documents

    def tables(df):
        return {r.doc_id: r.tables for r in df.collect()}

    sf_dir = "/root/testdata/sf0.001"
    want = tables(B.table_grids(table_blocks(spark, sf_dir)))
    assert tables(B.decode_documents(parse_documents(table_responses(spark, sf_dir)))) == want and max(map(len, (t[0] for t in want.values()))) > 5
    addresses = [[(1, 1), (1, 2), (2, 1), (2, 2)], [(2, 2), (1, 1), (1, 2), (2, 1)], [(1, 1), (2, 2)], [(1, 1), (1, 1), (1, 2), (1, 2)],
                 [(1, 1), (1, 1)], [(1, 1), (2, 0)], [(0, 2), (1, 2)], [(0, 1)], [(1, 3), (2, 1), (2, 2), (2, 3)], [(None, 1), (None, 2), (2, 1), (2, None)]]
    raw = responses(spark, {d: {"Blocks": [{"BlockType": "TABLE", "Id": "t", "Relationships": [{"Type": "CHILD", "Ids": [f"c{i}" for i in range(len(a))]}]}, *[
        {"BlockType": "CELL", "Id": f"c{i}", "RowIndex": r, "ColumnIndex": c, "Relationships": [{"Type": "CHILD", "Ids": [f"w{i}"]}]} for i, (r, c) in enumerate(a)],
        *[{"BlockType": "WORD", "Id": f"w{i}", "Text": f"{d} {i}"} for i in range(len(a))]]} for d, a in enumerate(addresses)})
    assert tables(B.decode_documents(parse_documents(raw))) == tables(B.table_grids(parse_blocks(raw)))


def test_phases_depend_on_earlier_ones(spark):
    """Every field of a failed upload but its path is at its default and later errors are not told; a failed step of extraction skips
    the next ones; other phases lose their own fields only."""
    block = json.dumps({"Blocks": [
        {"BlockType": "LINE", "Id": "l", "Text": "mail a@b.io"},
        {"BlockType": "TABLE", "Id": "t", "Relationships": [{"Type": "CHILD", "Ids": ["c"]}]},
        {"BlockType": "CELL", "Id": "c", "RowIndex": 1, "ColumnIndex": 1, "Relationships": [{"Type": "CHILD", "Ids": ["w"]}]},
        {"BlockType": "WORD", "Id": "w", "Text": "9"},
        {"BlockType": "KEY_VALUE_SET", "Id": "k", "EntityTypes": ["KEY"], "Relationships": [
            {"Type": "CHILD", "Ids": ["w"]}, {"Type": "VALUE", "Ids": ["v"]}]},
        {"BlockType": "KEY_VALUE_SET", "Id": "v", "EntityTypes": ["VALUE"], "Relationships": [{"Type": "CHILD", "Ids": ["w"]}]}]})
    failing = [None, "upload", "extraction", "tables", "forms", "classification", "entities", "pii", "questions", "review"]
    docs = spark.createDataFrame([(i, f"{i}.pdf") for i in range(len(failing))], "doc_id long, document_path string")
    raw = spark.createDataFrame([(i, block) for i in range(len(failing))], "doc_id long, response string")
    errors = spark.createDataFrame([(i, p, f"{p} failed") for i, p in enumerate(failing) if p] + [(1, "review", "never ran")],
                                   "doc_id long, phase string, error string")
    classes = spark.createDataFrame([(i, "letter", 0.4, None) for i in range(len(failing))],
                                    "doc_id long, document_type string, classification_confidence double, error string")
    identity = spark.createDataFrame([(i, "NAME", "Ada") for i in range(len(failing))], "doc_id long, type string, value string")
    expense = spark.createDataFrame([(i, ([({"T": "9"}, [])],)) for i in range(len(failing))],
                                    "doc_id long, expense_data struct<documents:array<struct<summary_fields:map<string,string>,line_items:array<map<string,string>>>>>")
    r = {failing[x.doc_id]: x for x in AS.process_documents(
        docs, blocks=parse_blocks(raw), responses=response_status(raw), phase_errors=errors, identity=identity, expense=expense,
        classes=classes).collect()}
    def filled(x):
        return {f for f in ("s3_uri", "document_type", "raw_text", "tables", "kv_pairs", "id_fields", "entities", "pii_entities", "redacted_text",
                            "genai_answers", "human_review_triggered", "human_review_arn", "classification_confidence") if x[f]} | (
            {"expense"} if x.expense_data.documents else set())

    every = filled(r[None])
    assert {"tables", "kv_pairs", "expense", "pii_entities", "genai_answers", "human_review_triggered", "id_fields"} <= every and r[None].errors == []
    assert filled(r["upload"]) == set() and r["upload"].errors == ["upload failed"] and r["upload"].document_path == "1.pdf"
    assert filled(r["extraction"]) == {"s3_uri"}
    assert every - filled(r["tables"]) == {"tables", "kv_pairs", "expense"} and every - filled(r["forms"]) == {"kv_pairs", "expense"}
    assert every - filled(r["classification"]) >= {"document_type", "classification_confidence"}
    assert every - filled(r["pii"]) == {"pii_entities", "redacted_text"} and every - filled(r["questions"]) == {"genai_answers"}
    assert every - filled(r["review"]) == {"human_review_triggered", "human_review_arn"}
    assert all(r[p].errors == [f"{p} failed"] for p in failing if p)


def test_expense_responses_are_written_as_to_json_writes_them(spark):
    """Line items with characters to escape, null values and flags; each type keeps its last value, in one pass over a field list."""
    import json

    from quire.operators.structured import expense_line_items
    from quire.plans.encode import encode_expense, encode_tables

    orders = spark.createDataFrame([(1, 9.5, 'q"\t', None, 7), (2, None, None, "1-URGENT", None)],
                                   "o_orderkey long, o_totalprice double, o_orderstatus string, o_orderpriority string, o_custkey long")
    items = spark.createDataFrame([(1, 2, 5, 1, 1.0, 2.5, 'a"\\\né', 0.0), (1, 1, None, 1, 1.0, None, 'a"\\\né', 0.0), (1, 3, 6, 1, 1.0, 3.0, None, 0.0)],
                                  "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, "
                                  "l_returnflag string, l_discount double")
    got = {r.doc_id: json.loads(r.response)["ExpenseDocuments"][0] for r in encode_expense(orders, items).collect()}
    assert got[2]["LineItemGroups"] == [] and [len(g["LineItems"]) for g in got[1]["LineItemGroups"]] == [2, 0]
    first = got[1]["LineItemGroups"][0]["LineItems"][0]["LineItemExpenseFields"]
    assert first[1] == {"Type": {"Text": "ITEM"}, "ValueDetection": {}} and first[2]["ValueDetection"] == {"Text": "nu"}
    rows = sorted((r.item_ord, r.type, r.value) for r in expense_line_items(encode_expense(orders, items)).collect())
    assert rows == [(0, "ITEM", ""), (0, "NOTE", ""), (0, "PRICE", "nu"), (0, "ROW", "1"), (1, "ITEM", "5"), (1, "NOTE", ""), (1, "PRICE", "2.50"),
                    (1, "ROW", "2")]
    table = {r.doc_id: json.loads(r.response)["Blocks"] for r in encode_tables(orders, items).collect()}
    assert table[2] == [{"BlockType": "TABLE", "Id": "T0"}]
    assert [b.get("Text") for b in table[1] if b["BlockType"] == "WORD"] == [None, 'a"\\\né', "nu", "5", 'a"\\\né', "2.50", "6", None, "3.00"]
    plan = encode_expense(orders, items)._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct(LineItemExpenseFields" not in plan and "struct(LineItemExpenseFields" not in plan  # text, not structs

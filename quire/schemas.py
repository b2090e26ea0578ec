"""Explicit schemas for every JSON shape the library reads or writes (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

BBOX = T.StructType([
    T.StructField("Left", T.DoubleType()),
    T.StructField("Top", T.DoubleType()),
    T.StructField("Width", T.DoubleType()),
    T.StructField("Height", T.DoubleType()),
])

RELATIONSHIP = T.StructType([
    T.StructField("Type", T.StringType()),
    T.StructField("Ids", T.ArrayType(T.StringType())),
])

BLOCK = T.StructType([
    T.StructField("BlockType", T.StringType()),
    T.StructField("Id", T.StringType()),
    T.StructField("Text", T.StringType()),
    T.StructField("Confidence", T.DoubleType()),
    T.StructField("RowIndex", T.IntegerType()),
    T.StructField("ColumnIndex", T.IntegerType()),
    T.StructField("SelectionStatus", T.StringType()),
    T.StructField("EntityTypes", T.ArrayType(T.StringType())),
    T.StructField("Query", T.StructType([T.StructField("Text", T.StringType()), T.StructField("Alias", T.StringType())])),
    T.StructField("Relationships", T.ArrayType(RELATIONSHIP)),
    T.StructField("Geometry", T.StructType([T.StructField("BoundingBox", BBOX)])),
])

BLOCK_RESPONSE = T.StructType([T.StructField("Blocks", T.ArrayType(BLOCK))])

TYPED_FIELD = T.StructType([
    T.StructField("Type", T.StructType([T.StructField("Text", T.StringType())])),
    T.StructField("ValueDetection", T.StructType([T.StructField("Text", T.StringType())])),
])

EXPENSE_RESPONSE = T.StructType([
    T.StructField("ExpenseDocuments", T.ArrayType(T.StructType([
        T.StructField("SummaryFields", T.ArrayType(TYPED_FIELD)),
        T.StructField("LineItemGroups", T.ArrayType(T.StructType([
            T.StructField("LineItems", T.ArrayType(T.StructType([
                T.StructField("LineItemExpenseFields", T.ArrayType(TYPED_FIELD)),
            ]))),
        ]))),
    ]))),
])

IDENTITY_RESPONSE = T.StructType([
    T.StructField("IdentityDocuments", T.ArrayType(T.StructType([
        T.StructField("IdentityDocumentFields", T.ArrayType(TYPED_FIELD)),
    ]))),
])

CLASS_RESPONSE = T.StructType([
    T.StructField("Classes", T.ArrayType(T.StructType([
        T.StructField("Name", T.StringType()),
        T.StructField("Score", T.DoubleType()),
    ]))),
])

ENTITY = T.StructType([
    T.StructField("Text", T.StringType()),
    T.StructField("Type", T.StringType()),
    T.StructField("Category", T.StringType()),
    T.StructField("Score", T.DoubleType()),
    T.StructField("BeginOffset", T.IntegerType()),
    T.StructField("EndOffset", T.IntegerType()),
    T.StructField("Traits", T.ArrayType(T.StructType([
        T.StructField("Name", T.StringType()), T.StructField("Score", T.DoubleType())]))),
    T.StructField("Attributes", T.ArrayType(T.StructType([
        T.StructField("Type", T.StringType()), T.StructField("Text", T.StringType()),
        T.StructField("Score", T.DoubleType())]))),
])

ENTITY_RESPONSE = T.StructType([T.StructField("Entities", T.ArrayType(ENTITY))])

REVIEW_PAYLOAD = T.StructType([
    T.StructField("taskObject", T.StringType()),
    T.StructField("extractedData", T.StructType([
        T.StructField("document_type", T.StringType()),
        T.StructField("kv_pairs", T.MapType(T.StringType(), T.StringType())),
        T.StructField("confidence", T.DoubleType()),
    ])),
])

# Reviewer output file: answers keyed by field name.
REVIEW_OUTPUT = T.StructType([
    T.StructField("humanAnswers", T.ArrayType(T.StructType([
        T.StructField("answerContent", T.MapType(T.StringType(), T.StringType())),
    ]))),
])

LOOP_EVENT = T.StructType([
    T.StructField("loop_id", T.StringType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

GENAI_ANSWER = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("source_documents", T.ArrayType(T.StructType([
        T.StructField("text", T.StringType()), T.StructField("source", T.StringType())]))),
])

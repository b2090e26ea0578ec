import random

import pytest

SF_SMALL = "/root/testdata/sf0.001"
CLASHING = ("cls", "n", "n_words", "score", "label", "bucket", "block", "votes", "found", "spans", "tokens", "grp", "h", "lang",
            "items", "start", "part", "seq", "v")


def words(n, seed, alphabet="abcdefghij"):
    r = random.Random(seed)
    return [("".join(r.choice(alphabet) for _ in range(r.randint(2, 7)))) for _ in range(n)]


def edge_texts():
    """Nulls, empty and blank texts, few words, equal and nearly equal texts, shared passages, very long and odd ones."""
    base = words(120, 1)
    near = [*base]
    near[60] = "changed"
    passage = words(70, 2)
    long = words(30_000, 3)
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two"), (5, "ONE two"), (6, " ".join(base)), (7, " ".join(base)),
        (8, " ".join(near)), (9, " ".join([*words(80, 4), *passage])), (10, " ".join([*passage, *words(90, 5)])),
        (11, " ".join(long)), (12, " ".join([*long[:29_000], *words(900, 6)])), (13, "a" * 3000), (14, "née Ünï 😀 日本語 " * 40),
        (15, "x\n" * 300), (16, "ab " * 400), (17, "mail a.b@c.example.com ip 10.0.0.1 card 4111 1111 1111 1111 +1 (555) 123-4567"),
        (18, "token = \"0123456789abcdef0123456789abcdef\" 1.2.3.4.5 999.1.1.1 1111111111111111"), (19, "." * 500), (20, "é" * 250),
    ]


@pytest.fixture(scope="session")
def edge(spark):
    """The edge texts with a repeated row, a row without id, and columns named like the operators' own."""
    rows = [*edge_texts(), (7, edge_texts()[6][1]), (None, "no id but a text of some words")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'{c}!' AS {c}" for c in CLASHING))


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def texts_of(df):
    return [(r[0], r[1]) for r in df.select("doc_id", "text").collect()]


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")

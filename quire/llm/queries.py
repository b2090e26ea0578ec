"""Registered queries of the operators: thin digests derived from their outputs."""

from __future__ import annotations

from quire.llm.common import table
from quire.plans.registry import Builder

QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return deco


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op7_token_output")
def op7(spark, sf_dir):
    from quire.llm.tokens import token_output

    return token_output(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), end_id=2)


OP4_SQL = r"""
WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, 24 + length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '[', '\b'))
            + length(replace(replace(replace(text, '\', '\\'), '<', '\l'), '[', '\b')) AS n FROM m)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       length(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(n) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query("op4_chat_format", OP4_SQL)
def op4(spark, sf_dir):
    from pyspark.sql import functions as F

    from quire.llm.chat import fold_events, format_chat, learned_text, log_of_rows, parse_chat

    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    out = format_chat(fold_events(log_of_rows(rows)))
    out = out.select("conv_id", parse_chat(F.col("formatted")).alias("turns"),
                     learned_text(F.col("segments")).alias("learned"), F.length("formatted").alias("chars"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.col("chars").cast("long").alias("formatted_chars"))


@query("op9_quality_rules")
def op9(spark, sf_dir):
    from pyspark.sql import functions as F

    from quire.llm.quality_rules import quality

    scored = quality(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return scored.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & F.col("good")).alias("kept"), "p_good")


def quality_labels(spark, sf_dir):
    """Labels that a quality model may learn from: rows whose ``crc32(doc_id) mod 4`` is not 2."""
    from pyspark.sql import functions as F

    from quire.llm.common import crc_bucket

    rows = table(spark, sf_dir, "labels").where(crc_bucket("doc_id", 4) != 2)
    return rows.select("doc_id", F.col("quality").cast("int").alias("label"))


@query("op10_quality_classifier")
def op10(spark, sf_dir):
    from pyspark.sql import functions as F

    from quire.llm.common import crc_bucket
    from quire.llm.rule_ensemble import score, train

    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, quality_labels(spark, sf_dir)))
    return scored.select("doc_id", F.coalesce(crc_bucket("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op5_language_id")
def op5(spark, sf_dir):
    from pyspark.sql import functions as F

    from quire.llm.common import crc_bucket
    from quire.llm.language_id import predict, train

    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(crc_bucket("doc_id", 3) != 1).select("doc_id", "text", "lang"))
    return predict(docs, model).select(
        "doc_id", F.coalesce(crc_bucket("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score",
        "is_ambiguous")


@query("op8_pii")
def op8(spark, sf_dir):
    from quire.llm.pii_labels import detect

    return detect(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@query("op1_sentencepiece_nbest")
def op1(spark, sf_dir):
    from quire.llm.pieces import digest

    return digest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), n=4)


_WORDS = (r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")
OP6_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
b2 AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS t
       FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM b2)),
ns AS (SELECT DISTINCT n FROM b2),
dw AS (SELECT doc_id, i, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS t
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, ns)),
h AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw USING (t)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM h) GROUP BY 1),
s AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
             sha256(string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS x FROM h GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(x, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN s ON s.doc_id = d.doc_id
"""


@query("op6_decontamination", OP6_SQL)
def op6(spark, sf_dir):
    from pyspark.sql import functions as F

    from quire.llm.winnowing import contaminated, decontaminate

    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    named = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(named.cast("binary"), 256).alias("items_sha256"), contaminated().alias("contaminated"))


@query("op3_jaccard_join")
def op3(spark, sf_dir):
    from quire.llm.jaccard_join import join_components

    return join_components(table(spark, sf_dir, "documents"))


@query("op2_suffix_dedup")
def op2(spark, sf_dir):
    from quire.llm.suffix_dedup import dedup

    return dedup(table(spark, sf_dir, "documents"), digest=True)


OP11_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, strlen(html) AS n, sha1(html) AS d, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
       CASE WHEN n < 1000 OR top IS NULL OR page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN n < 1000 OR top IS NULL OR page_id = top THEN NULL ELSE top END AS refers_to
FROM m
"""


@query("op11_warc", OP11_SQL)
def op11(spark, sf_dir):
    from pyspark.sql import functions as F

    from quire.llm.common import shared_dir
    from quire.llm.warc import read_warc, resolve_revisits, write_warc

    path = shared_dir(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    found = resolve_revisits(read_warc(spark, path))
    return found.select(F.col("key").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                        F.col("type").alias("record_type"), F.col("refers_key").cast("long").alias("refers_to"))


@query("op12_alignment")
def op12(spark, sf_dir):
    from quire.llm.align import alignment_digest

    return alignment_digest(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


# code points beyond ASCII become single bytes (U+00C0 to U+00FF for marks, digits and capitals, which words do not hold), since the distance
# counts bytes; the checksum is computed byte by byte from its table
_BYTES = "".join(chr(c) for c in [*range(33, 39), *range(40, 97), *range(123, 127)])[:64]
_LATIN = "".join(chr(c) for c in range(0xC0, 0x100))
OP13_SQL = rf"""
WITH RECURSIVE bits AS (
  SELECT i AS b, CAST(i AS BIGINT) AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
runs AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
own AS (SELECT doc_id, w, count(*) AS n FROM runs WHERE length(w) >= 7 GROUP BY ALL),
hashed AS (SELECT w, n, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '')
             || ':' || w)), '..'), lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
           FROM own, crc),
slipped AS (SELECT CASE WHEN h % 31 = 0 THEN w[:h % length(w)] || w[h % length(w) + 2:] ELSE w END AS word, n FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n, translate(word, '{_LATIN}', '{_BYTES.replace("'", "''")}') AS x
          FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS m FROM words a JOIN words b
         ON length(b.x) BETWEEN length(a.x) - 1 AND length(a.x) + 1 AND levenshtein(a.x, b.x) = 1),
best AS (SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, other) AS form, max(m) AS form_n FROM near GROUP BY word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form,
                 CASE WHEN form_n >= 10 * n THEN form_n END AS form_n FROM words LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM forms
          UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN forms f ON f.word = c.next)
SELECT word, n, n_near, form, form_n, root FROM forms JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""


@query("op13_spelling", OP13_SQL)
def op13(spark, sf_dir):
    from quire.llm.spelling import spelling_groups

    return spelling_groups(table(spark, sf_dir, "documents"))

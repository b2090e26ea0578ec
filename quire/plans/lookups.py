"""Lookup tables derived by Spark from the given tables (dictionary, lexicon, code tables, question sets).

No real code lists ship with the library; these deterministic tables stand in for them and grow with the
``benchmark`` table they are derived from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.text import words
from quire.operators.assembly import DEFAULT_QUESTIONS  # noqa: F401
from quire.operators.entities import MEDICAL_CATEGORIES, TRAILING_PUNCT

# Custom entity type names and the code systems.
CUSTOM_TYPES = ("SAVINGS_AC", "CHECKING_AC")
CODE_SYSTEMS = ("ICD10CM", "RXNORM", "SNOMEDCT")


def entity_list(benchmark: DataFrame) -> DataFrame:
    """``(text, type)``: first two tokens of each passage, lower-cased, distinct; SAVINGS_AC for an even
    ``item_id`` else CHECKING_AC, the smallest ``item_id`` deciding duplicates."""
    p = benchmark.select("item_id", F.lower(F.array_join(F.slice(words(F.col("text")), 1, 2), " ")).alias("text"))
    return (p.where(F.col("text") != "").groupBy("text").agg(F.min("item_id").alias("mid"))
            .select("text", F.when(F.col("mid") % 2 == 0, CUSTOM_TYPES[0]).otherwise(CUSTOM_TYPES[1]).alias("type")))


def lexicon(benchmark: DataFrame) -> DataFrame:
    """``(term, category, type)``: distinct lower-cased tokens of 8+ letters (trailing punctuation removed);
    category by ``length(term) % 4`` over the first four medical categories; type GENERIC."""
    t = (benchmark.select(F.explode(words(F.col("text"))).alias("w"))
         .select(F.lower(F.regexp_replace("w", TRAILING_PUNCT, "")).alias("term"))
         .where(F.col("term").rlike("^\\p{L}{8,}$")).distinct())
    cats = F.array(*[F.lit(c) for c in MEDICAL_CATEGORIES[:4]])
    return t.select("term", F.element_at(cats, (F.length("term") % 4 + 1).cast("int")).alias("category"),
                    F.lit("GENERIC").alias("type"))


def codes(lex: DataFrame) -> DataFrame:
    """``(system, term, code, description, score)``: per system two concepts for a term of even length, one for others, none
    for terms of a length divisible by five; scores differ, and tie for some."""
    systems = F.array(*[F.lit(s) for s in CODE_SYSTEMS])
    c = lex.select("term", F.explode(systems).alias("system")).select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("i"))
    n = F.length("term")
    c = c.where((n % 5 != 0) & ((F.col("i") == 0) | (n % 2 == 0)))
    score = F.when(F.col("i") == 0, 0.75).otherwise(0.5 + (n % 3) * 0.25)
    return c.select("system", "term", F.substring(F.md5(F.concat("system", "term", F.col("i").cast("string"))), 1, 6).alias("code"),
                    F.upper("term").alias("description"), score.alias("score"))

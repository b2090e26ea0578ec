"""Exploding computed arrays without duplicating their computation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_rows(df: DataFrame, keep: list, arr: Column, val: str, pos: str | None = None) -> DataFrame:
    """One row per element of ``arr`` (and its 0-based position as ``pos`` when given); empty/null -> no rows.

    A plain ``explode``/``posexplode`` makes Catalyst infer ``size(arr) > 0`` in front of the generator and push
    that predicate down through projections and repartitions, so an expensive array expression (pattern spans,
    chunking, JSON parsing) is evaluated twice, the first time ahead of any repartition. The ``_outer`` generator
    gets no inferred filter; the padding row it emits for an empty array is dropped by a filter on the
    generator's own output, which cannot be pushed below it.
    """
    p = pos or "__pos"
    out = df.select(*keep, F.posexplode_outer(arr).alias(p, val)).where(F.col(p).isNotNull())
    return out if pos else out.drop(p)


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A column that a lambda reads is not safe as a column of its own: where it is referenced once, Catalyst inlines its
    expression into the lambda, which then evaluates it per element. A lambda's own variable is a value.
    """
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)  # a one-argument lambda: ``body`` may have more


# Arrays up to this length use a plain fold (quadratic copying is negligible there); longer ones the blocked form.
PREFIX_SUM_SMALL = 64


def _fold(values):
    init = F.struct(F.lit(0).alias("s"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, init, lambda acc, x: F.struct(
        (acc["s"] + x).alias("s"), F.concat(acc["out"], F.array(acc["s"])).alias("out")))


def with_exclusive_prefix_sum(df: DataFrame, arr_col: str, out_col: str) -> DataFrame:
    """``out[i] = arr[0] + ... + arr[i-1]`` for an ``array<int>`` column, inside the row.

    Spark has no scan over arrays, and a fold that appends to an array copies it at every step (quadratic).
    Short arrays (the common case) use that fold directly. Longer ones are cut into blocks of about the cube root
    of their length: each block is folded on its own, the block totals are folded once more, and each block's
    partial sums are shifted by its block offset — O(n * n^(1/3)) per row. Every intermediate is its own column,
    so no lambda re-evaluates an outer expression; rows on the short path skip the blocked steps.
    """
    n = F.size(arr_col)
    big = n > PREFIX_SUM_SMALL
    d = df.withColumn("__ps_b", F.when(big, F.ceil(F.pow(n.cast("double"), 1.0 / 3.0)).cast("int")))
    d = d.withColumn("__ps_blocks", F.when(big, F.transform(
        F.sequence(F.lit(0), ((n + F.col("__ps_b") - 1) / F.col("__ps_b")).cast("int") - 1),
        lambda j: F.slice(F.col(arr_col), j * F.col("__ps_b") + 1, F.col("__ps_b")))))
    d = d.withColumn("__ps_inner", F.when(big, F.transform("__ps_blocks", lambda b: _fold(b))))
    d = d.withColumn("__ps_off", F.when(big, _fold(F.transform("__ps_inner", lambda r: r["s"]))["out"]))
    blocked = F.flatten(F.zip_with("__ps_inner", "__ps_off", lambda r, o: F.transform(r["out"], lambda x: x + o)))
    d = d.withColumn(out_col, F.when(big, blocked).otherwise(_fold(F.col(arr_col))["out"]))
    return d.drop("__ps_b", "__ps_blocks", "__ps_inner", "__ps_off")

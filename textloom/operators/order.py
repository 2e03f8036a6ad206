"""Contiguous positions and chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from textloom.plans.materialize import materialize


def with_position(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Rows numbered 1, 2, ... in ``order``: a range sort, then each partition's rows are shifted by the rows before it.

    Only one row per partition is collected into one task. Rows that tie in ``order`` are numbered in any order.
    """
    at = F.monotonically_increasing_id()
    rows = materialize(df.sort(*order).withColumn("_at", at), "position")
    rows = rows.withColumn("_part", F.shiftright("_at", 33)).withColumn("_row", F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(W.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").withColumn(name, F.col("_before") + F.col("_row") + 1).drop("_at", "_part", "_row", "_n", "_before")


def first_rows(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first ``limit`` rows in ``order``, exactly; all without a limit. Every task keeps its own first rows only."""
    return df if limit is None else df.sort(*order).limit(limit)


def chunks(df: DataFrame, *order: str, n: int = 10) -> DataFrame:
    """``chunk`` 1 to ``n`` in order; the first ``rows mod n`` chunks hold one row more. No global window is needed."""
    placed = with_position(df, *order)
    total = placed.agg(F.count("*").alias("_total"))
    size, extra = F.floor(F.col("_total") / n), F.col("_total") % n
    p = F.col("pos") - 1
    cut = extra * (size + 1)
    chunk = F.when(p < cut, F.floor(p / (size + 1))).otherwise(extra + F.floor((p - cut) / F.greatest(size, F.lit(1)))) + 1
    return placed.crossJoin(F.broadcast(total)).withColumn("chunk", chunk.cast("long")).drop("_total")

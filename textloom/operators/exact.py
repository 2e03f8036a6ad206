"""Exact duplicate removal: first occurrence wins, short documents are set aside first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import word_count


def with_status(docs: DataFrame, order: str | Column, text: str = "text", threshold: int = 15, key: Column | None = None) -> DataFrame:
    """Adds ``status``: ``short`` (fewer than ``threshold`` words, or a null text), ``kept`` or ``duplicate``.

    The first document of each text, by ``order``, is kept; documents that tie in ``order`` with it are kept with it.
    Grouping is an aggregation with map-side combining, so a text that makes up a third of the corpus costs one row per task.
    The smallest order value of each text is joined back by order and text, of which the order is spread evenly: neither a
    frequent text nor the short documents meet in one task.
    """
    o = F.col(order) if isinstance(order, str) else order
    h = key if key is not None else F.md5(text)
    base = docs.withColumn("_order", o).withColumn("_key", F.when(word_count(F.col(text)) >= threshold, h))
    first = base.filter("_key is not null").groupBy("_key").agg(F.min("_order").alias("_order")).withColumn("_first", F.lit(True))
    joined = base.join(first, ["_order", "_key"], "left")
    status = F.when(F.col("_key").isNull(), "short").when(F.col("_first"), "kept").otherwise("duplicate")
    return joined.withColumn("status", status).drop("_order", "_key", "_first")


def kept(docs: DataFrame, order: str, text: str = "text", threshold: int = 15) -> DataFrame:
    return with_status(docs, order, text, threshold).filter("status = 'kept'").drop("status")


def removed(docs: DataFrame, order: str, text: str = "text", threshold: int = 15, save_duplicates: bool = False) -> DataFrame:
    """Short documents, and duplicates on request."""
    wanted = ["short", "duplicate"] if save_duplicates else ["short"]
    return with_status(docs, order, text, threshold).filter(F.col("status").isin(wanted))


def counters(docs: DataFrame, text: str = "text", threshold: int = 15) -> DataFrame:
    """``processed, removed, unique_docs``; ``removed`` counts short documents only."""
    keyed = docs.select(F.when(word_count(F.col(text)) >= threshold, F.md5(text)).alias("h"))
    by_key = keyed.groupBy("h").agg(F.count("*").alias("n"))
    return by_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum(F.when(F.col("h").isNull(), F.col("n"))), F.lit(0)).alias("removed"),
        F.count("h").alias("unique_docs"),
    )


def parts_order(file: str, pos: str) -> Column:
    """Order of several parts that share one state: file, then place in it."""
    return F.struct(file, pos)


def count_parts(docs: DataFrame, file: str, text: str = "text", threshold: int = 15) -> DataFrame:
    """``file, n_docs, n_short`` per part, and the total with a null ``file``."""
    long_enough = F.coalesce(word_count(F.col(text)) >= threshold, F.lit(False))
    flagged = docs.select(F.col(file).alias("file"), long_enough.alias("ok"))
    return flagged.rollup("file").agg(F.count_if("ok").alias("n_docs"), F.count_if(~F.col("ok")).alias("n_short"))

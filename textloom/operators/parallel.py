"""Line-aligned corpora: pairing, duplicate removal and filtering that keep both sides in step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs of lines with the same place; the longer side's tail is left out."""
    return source.join(target, keys, "inner")


def assert_parallel(source: DataFrame, target: DataFrame) -> None:
    """Raises ``ValueError`` when the sides differ in length."""
    n, m = source.count(), target.count()
    if n != m:
        raise ValueError(f"source has {n} lines, target {m}")


def first_lines(source: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Places of lines that repeat an earlier line of the source: ``keys``. Null lines repeat one another.

    First places are found with map-side combining and left out by place, which is spread evenly, not by line.
    """
    keyed = source.select(*keys, F.coalesce(F.md5(text), F.lit("")).alias("_h"), F.struct(*keys).alias("_o"))
    first = keyed.groupBy("_h").agg(F.min("_o").alias("_o"))
    return keyed.join(first, ["_o", "_h"], "left_anti").select(*keys)


def drop_repeated(source: DataFrame, target: DataFrame, keys: list[str], text: str) -> tuple[DataFrame, DataFrame]:
    """Both sides without the places where the source repeats itself; a longer target keeps its tail."""
    gone = first_lines(source, keys, text)
    return source.join(gone, keys, "left_anti"), target.join(gone, keys, "left_anti")


def mismatch_counts(pairs: DataFrame) -> DataFrame:
    """``total, mismatched`` of pairs with a ``status``; zeros for no pairs."""
    return pairs.agg(F.count("*").alias("total"), F.count_if(F.col("status") == "mismatched").alias("mismatched"))


def with_language_status(pairs: DataFrame, tag: str, wanted: str) -> DataFrame:
    """``status``: ``matched`` where the source's language is the wanted one, else ``mismatched``."""
    same = F.lower(F.trim(F.coalesce(F.col(tag), F.lit("")))) == wanted.strip().lower()
    return pairs.withColumn("status", F.when(same, "matched").otherwise("mismatched"))

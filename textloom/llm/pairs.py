"""Pairs inside classes, with identical copies kept apart until the end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.materialize import materialize

#: Parts into which one side of a class is dealt, so that the pairs of a large class are made in as many tasks.
SALTS = 8


def crossed(left: DataFrame, right: DataFrame, keys: list[str], by: str) -> DataFrame:
    """Join on ``keys`` whose left rows are dealt by column ``by`` to salts and meet a copy of the right rows in each."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = left.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return dealt.join(right.withColumn("_salt", salts), [*keys, "_salt"]).drop("_salt")


def differing_pairs(members: DataFrame) -> DataFrame:
    """``id_a < id_b`` of the same ``class_id`` and ``form_key`` with different ``text_key``.

    The join runs between the distinct texts of a class, so a class that is one text copied any number of times costs one
    row; members are attached afterwards, dealt by salt. Only the pairs themselves grow with the square of a class.
    """
    m = materialize(members.select("class_id", "form_key", "text_key", "id"), "class-members")
    kinds = m.select("class_id", "form_key", "text_key").distinct()
    a = kinds.select("class_id", "form_key", F.col("text_key").alias("ka"))
    b = kinds.select("class_id", "form_key", F.col("text_key").alias("kb"))
    pairs = a.join(b, ["class_id", "form_key"]).filter("ka < kb").select("class_id", "ka", "kb")
    left = m.select("class_id", F.col("text_key").alias("ka"), F.col("id").alias("x"))
    right = m.select("class_id", F.col("text_key").alias("kb"), F.col("id").alias("y"))
    both = crossed(crossed(left, pairs, ["class_id", "ka"], "x"), right, ["class_id", "kb"], "x")
    return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))

"""Joins on keys of which one may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.plans.materialize import materialize

#: Rows of a table up to which it is broadcast.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> bool:
    """Whether a table has at most ``most`` rows; reads no more than it must to know."""
    return df.limit(most + 1).count() <= most


def dealt(many: DataFrame, once: DataFrame, keys: list[str], by: str, most: int = 20_000) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the keys to join on: keys with over ``most`` rows in ``many`` are dealt to salts by column ``by``, and the
    rows of ``once`` go to every salt of their key. Other keys are joined as they are.

    There are at most ``rows / most`` such keys; they are broadcast while few, else joined.
    """
    hot = many.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > most)
    hot = materialize(hot.select(*keys, F.ceil(F.col("_n") / F.lit(most)).cast("int").alias("_salts")), "hot-keys")
    if hot.isEmpty():
        return many, once, keys
    hot = F.broadcast(hot) if small(hot) else hot
    salts = F.coalesce("_salts", F.lit(1))
    many = many.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(by), salts).cast("int")).drop("_salts")
    once = once.join(hot, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return many, once, [*keys, "_salt"]

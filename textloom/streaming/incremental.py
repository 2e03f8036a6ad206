"""The row functions run on streams unchanged; these operators keep state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.words import word_count


def dedup_stream(docs: DataFrame, text: str = "text", time: str | None = None, watermark: str = "7 days", threshold: int = 15) -> DataFrame:
    """First occurrence of each text of a stream, short documents left out. With ``time`` the state is bounded: a text is
    remembered for ``watermark`` after its last event, else for ever."""
    keyed = docs.filter(word_count(F.col(text)) >= threshold).withColumn("_h", F.md5(text))
    if time is None:
        return keyed.dropDuplicates(["_h"]).drop("_h")
    return keyed.withWatermark(time, watermark).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def counts_stream(docs: DataFrame, time: str, window: str = "1 day", watermark: str = "7 days", text: str = "text", threshold: int = 15) -> DataFrame:
    """``window_start, n_docs, n_short`` per time window; windows close when the watermark passes them."""
    long_enough = F.coalesce(word_count(F.col(text)) >= threshold, F.lit(False))
    grouped = docs.withWatermark(time, watermark).groupBy(F.window(time, window))
    return grouped.agg(F.count_if(long_enough).alias("n_docs"), F.count_if(~long_enough).alias("n_short")).select(F.col("window.start").alias("window_start"), "n_docs", "n_short")

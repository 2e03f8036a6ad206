"""Readers of the Parquet tables of a data folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Tables whose rows hold whole texts, so that the work is in the rows and not in the bytes.
TEXT_TABLES = frozenset(["docu", "documents", "scored_docs"])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as it is read; a table of texts that comes as fewer splits than there are cores is dealt out to all of them.

    A large table has more splits than cores and is never moved. Columns and filters still reach the scan.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if name not in TEXT_TABLES:
        return df
    cores = spark.sparkContext.defaultParallelism
    size = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    # files are few where they can be few splits: their number is all that is looked up
    splits = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() // size + len(df.inputFiles())
    return df.repartition(cores) if splits * 2 <= cores else df

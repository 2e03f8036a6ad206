"""Names of the commands, and row functions for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from textloom.functions import clean, tokens, words
from textloom.plans.commands import COMMANDS

#: Row functions that SQL can call under these names once :func:`register` has run.
SQL_FUNCTIONS = {
    "tl_words": words.word_count,
    "tl_strip": words.strip,
    "tl_collapse": words.collapse,
    "tl_tokenize": tokens.tokenize,
    "tl_detokenize": tokens.detokenize,
    "tl_clamp_newlines": clean.clamp_newlines,
    "tl_printable": clean.printable,
    "tl_punctuation_tag": words.punctuation_tag,
}


def list_commands() -> list[str]:
    return sorted(COMMANDS)


def register(spark: SparkSession) -> list[str]:
    """SQL functions made of the same expressions, so they stay in the JVM; the names that were registered. One that cannot
    be registered raises."""
    for name, function in SQL_FUNCTIONS.items():
        body = spark.range(1).select(function(F.lit("x"))).schema[0].dataType.simpleString()
        expression = function(F.col("c"))._jc.toString()
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(c STRING) RETURNS {body} RETURN {expression}")
    return sorted(SQL_FUNCTIONS)

"""Operators in a chain, with the reason of every removal in ``status``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions.clean import encode_fix
from textloom.operators import exact, lexicon, parallel, perplexity, rules, translate


def documents(docs: DataFrame, scores: DataFrame, lex: DataFrame, suffixes: DataFrame, rule_table: DataFrame, top: int, wanted: str = "gl", limit: float = 2000.0, threshold: int = 15) -> DataFrame:
    """Encoder, duplicate removal, perplexity filter, language filter, normalization: ``id, text, lang, status``.

    ``scores`` has ``id`` and ``pyplexity_score``; documents without a score go on. Removed documents keep the text they had
    and say ``short``, ``duplicate``, ``high_perplexity`` or ``language``.
    """
    fixed = docs.select("id", encode_fix(F.col("text")).alias("text"))
    unique = exact.with_status(fixed, "id", threshold=threshold)
    scored = unique.join(scores.select("id", "pyplexity_score"), "id", "left")
    ok = F.col("pyplexity_score").isNull() | ((F.col("pyplexity_score") < limit) & ~F.isnan("pyplexity_score"))
    scored = scored.withColumn("status", F.when((F.col("status") == "kept") & ~ok, "high_perplexity").otherwise(F.col("status")))
    tagged = lexicon.tag_lines(scored.filter("status = 'kept'"), "id", lex, suffixes, top)
    left = lexicon.filter_lines(tagged, wanted).withColumnRenamed("text", "filtered")
    out = scored.join(left, "id", "left")
    status = F.when((F.col("status") == "kept") & F.col("filtered").isNull(), "language").otherwise(F.col("status"))
    text = F.when(status == "kept", rules.normalize(F.col("filtered"), rules.rule_list(rule_table))).otherwise(F.col("text"))
    return out.select("id", text.alias("text"), "lang", status.alias("status"))


def pairs(corpus: DataFrame, lex: DataFrame, suffixes: DataFrame, rule_table: DataFrame, top: int, keys: list[str], wanted: str = "gl") -> DataFrame:
    """Encoder on both sides, duplicate removal by source, language filter on the source, normalization of the source:
    ``keys, src, tgt, status``. Pairs stay together throughout."""
    fixed = corpus.select(*keys, encode_fix(F.col("src")).alias("src"), encode_fix(F.col("tgt")).alias("tgt"))
    gone = parallel.first_lines(fixed, keys, "src").withColumn("again", F.lit(True))
    placed = fixed.join(gone, keys, "left").withColumn("line_id", F.struct(*keys))
    tagged = lexicon.tag_lines(placed.filter("again is null"), "line_id", lex, suffixes, top, "src").select(F.col("id").alias("line_id"), "lang")
    out = placed.join(tagged, "line_id", "left")
    matched = parallel.with_language_status(out, "lang", wanted)
    status = F.when(F.col("again"), "duplicate").when(F.col("status") == "mismatched", "language").otherwise("kept")
    src = F.when(status == "kept", rules.normalize(F.col("src"), rules.rule_list(rule_table))).otherwise(F.col("src"))
    return matched.select(*keys, src.alias("src"), "tgt", status.alias("status"))


def translated(pairs: DataFrame, dictionary: DataFrame, rule_table: DataFrame, keys: list[str]) -> DataFrame:
    """Encoder, duplicate removal by target, dictionary translation of the target with transliteration, normalization:
    ``keys, src, tgt``."""
    fixed = pairs.select(*keys, encode_fix(F.col("src")).alias("src"), encode_fix(F.col("tgt")).alias("tgt"))
    source, _ = parallel.drop_repeated(fixed, fixed, keys, "src")
    done = translate.translate_lines(source, dictionary, keys, "tgt")
    out = source.drop("tgt").join(done, keys)
    clean = translate.clean_marks(F.col("translated"))
    return out.select(*keys, "src", rules.normalize(clean, rules.rule_list(rule_table)).alias("tgt"))
